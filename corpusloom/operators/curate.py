"""Curation of segments: search, paging, statistics, import, review, sources, export and the rights gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import normalize_text, strip
from corpusloom.operators import dedup, trigrams
from corpusloom.plans.storage import checkpoint
from corpusloom.schemas import PUBLIC_RIGHTS, REVIEW_STATUSES, SPLITS

LONGEST_PAGE = 500
REVIEWED = ["approved", "corrected"]


def search(segments: DataFrame, q: str | None = None, status: str | None = None, source_id: str | None = None) -> DataFrame:
    """Segments that hold the trimmed ``q`` in a text or the reference, whatever the case, with the status and the source asked for.

    ``%`` and ``_`` are wildcards, as the service that this stands for has them live; a backslash is a letter like others.
    """
    out = segments
    if q and q.strip():
        fits = [trigrams.matches(F.col(c), trigrams.containing(q.strip())) for c in ("a_text", "b_text", "ref")]
        out = out.where(fits[0] | fits[1] | fits[2])
    if status:
        out = out.where(F.col("status") == status)
    if source_id:
        out = out.where(F.col("source_id") == source_id)
    return out


def page(segments: DataFrame, limit: int = 50, offset: int = 0, order: str = "id") -> tuple[DataFrame, int]:
    """Rows ``offset`` to ``offset + limit`` by id, and how many there are."""
    if not 1 <= limit <= LONGEST_PAGE or offset < 0:
        raise ValueError("limit is 1 to 500, offset 0 or more")
    return segments.orderBy(order).offset(offset).limit(limit), segments.count()


def page_by_counts(segments: DataFrame, limit: int = 50, offset: int = 0, order: str = "id", cells: int = 1024, few: int = 10_000) -> tuple[DataFrame, int]:
    """The same page as ``page``, for whole-number ids: rows are counted by cells of ids, and only those of the cells that the page is in are sorted.

    A cell with more than ``few`` rows is counted by smaller cells, as long as its ids differ: a level is one aggregate.
    """
    if not 1 <= limit <= LONGEST_PAGE or offset < 0:
        raise ValueError("limit is 1 to 500, offset 0 or more")
    key = F.col(f"`{order}`").cast("bigint")
    low, high, total, nulls = segments.agg(F.min(key), F.max(key), F.count("*"), F.count_if(key.isNull())).first()
    if low is None or offset < nulls:  # ids that are null come first
        return page(segments, limit, offset, order)[0], total
    ranges, before = [(low, high)], nulls
    while True:
        first, last = ranges[0][0], ranges[-1][1]
        width = max(1, -(-(last - first + 1) // cells))
        counts = {r[0]: r[1] for r in segments.where(key.between(first, last)).groupBy(F.floor((key - first) / width)).count().collect()}
        ranges, seen = [], before
        for cell in sorted(counts):
            if seen + counts[cell] > offset and seen < offset + limit:
                if not ranges:
                    start = seen
                ranges.append((first + cell * width, min(last, first + (cell + 1) * width - 1), counts[cell]))
            seen += counts[cell]
        if not ranges:
            return segments.limit(0), total
        before, size = start, sum(r[2] for r in ranges)
        if size <= max(few, 2 * limit) or width == 1:
            break
        ranges = [r[:2] for r in ranges]
    inside = segments.where(key.between(ranges[0][0], ranges[-1][1]))
    return inside.orderBy(order).offset(offset - before).limit(limit), total


def get(segments: DataFrame, ident: int) -> DataFrame:
    found = segments.where(F.col("id") == ident)
    if found.isEmpty():
        raise LookupError(f"no segment {ident}")
    return found


def stats(segments: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: total, reviewed, pending, rejected, and the number of sources."""
    counts = segments.agg(F.count("*").alias("total"), F.count_if(F.col("status").isin(REVIEWED)).alias("reviewed"), F.count_if(F.col("status") == "unreviewed").alias("pending"), F.count_if(F.col("status") == "rejected").alias("rejected"))
    return counts.crossJoin(sources.agg(F.count("*").alias("sources")))


def cleaned(batch: DataFrame) -> DataFrame:
    """Imported rows with normalized texts; rows without text on either side go."""
    rows = batch.withColumns({"a_text": normalize_text(F.coalesce("a_text", F.lit(""))), "b_text": normalize_text(F.coalesce("b_text", F.lit("")))})
    return rows.where("a_text <> '' and b_text <> ''")


def import_batch(segments: DataFrame, batch: DataFrame, source_id: str, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """The new segments of a batch (a_text, b_text, ref), ready to be appended.

    Rows meet by a digest of their texts and source; the batch is stored once, cleaned.  ``known`` are the digests of
    ``segments`` (``content_key``), if the caller keeps them.
    """
    rows = checkpoint(cleaned(batch).withColumn("source_id", F.lit(source_id)).withColumns({"__key": content_key(), "__row": F.monotonically_increasing_id()}))
    had = segments.select(content_key().alias("__key")) if known is None else known.select(F.col("content_key").alias("__key"))
    fresh = dedup.insert_absent(segments, rows, ["__key"], [*order, "__row"], known=had)
    return fresh.select("id", F.coalesce("ref", F.lit("")).alias("ref"), "a_text", "b_text", "source_id", F.lit("unassigned").alias("split"), F.lit("unreviewed").alias("status"))


def content_key() -> Column:
    """A digest of both texts and the source, equal for equal ones only."""
    parts = (F.coalesce(F.col(c), F.lit("")) for c in ("a_text", "b_text", "source_id"))
    return F.sha2(F.concat(*(x for c in parts for x in (F.length(c).cast("string"), F.lit(":"), c))), 256)


def import_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    kept = cleaned(batch).agg(F.count("*").alias("rows"))
    return kept.crossJoin(inserted.agg(F.count("*").alias("inserted"))).select("inserted", (F.col("rows") - F.col("inserted")).alias("duplicates"))


def check_updates(updates: DataFrame) -> DataFrame:
    """Updates with what is wrong: an unknown status or split, or a text that is empty after normalization."""
    wrong = F.when(F.col("status").isNotNull() & ~F.col("status").isin(REVIEW_STATUSES), "status").when(F.col("split").isNotNull() & ~F.col("split").isin([*SPLITS, "unassigned"]), "split")
    for side in ("a_text", "b_text"):
        wrong = F.coalesce(wrong, F.when(normalize_text(F.col(side)) == "", side))
    return updates.withColumn("wrong", wrong)


def review(segments: DataFrame, updates: DataFrame, fields: tuple[str, ...] = ("a_text", "b_text", "split", "status", "notes")) -> tuple[DataFrame, DataFrame]:
    """Segments with the given fields of good updates (one a segment), and the updates that are refused with a ``reason``.

    Texts are normalized, notes stripped, and ``updated_at`` is the time of the update.  Refused are an unknown status
    or split and a blank text (``status``, ``split``, ``a_text``, ``b_text``), and ids that no segment has (``unknown``).
    """
    checked = check_updates(updates)
    known = segments.select(F.col("id").alias("__id"), F.lit(True).alias("__known"))
    judged = checked.join(known, F.col("id") == F.col("__id"), "left").drop("__id")
    refused = judged.withColumn("reason", F.coalesce("wrong", F.when(F.col("__known").isNull(), "unknown"))).where("reason is not null").drop("wrong", "__known")
    tidy = {"a_text": normalize_text, "b_text": normalize_text, "notes": strip}
    good = checked.where("wrong is null").select("id", F.lit(True).alias("__new"), *(tidy.get(c, F.col)(F.col(c) if c in tidy else c).alias(f"new_{c}") for c in fields))
    out = segments.join(good, "id", "left").withColumns({c: F.coalesce(f"new_{c}", c) for c in fields})
    if "updated_at" in segments.columns:
        out = out.withColumn("updated_at", F.when(F.col("__new"), F.current_timestamp()).otherwise(F.col("updated_at")))
    return out.select(*segments.columns), refused


def upsert_sources(sources: DataFrame, new: DataFrame) -> DataFrame:
    return dedup.latest_wins(sources, new, "source_id")


def export_reviewed(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("status").isin(REVIEWED)).select("id", "ref", "a_text", "b_text", "source_id", "status").orderBy("id")


def releasable(segments: DataFrame, sources: DataFrame) -> DataFrame:
    """Segments of sources whose rights allow a public release."""
    return segments.join(sources.where(F.col("rights_status").isin(PUBLIC_RIGHTS)), "source_id", "left_semi")


def registry_rows(raw: DataFrame) -> DataFrame:
    """Source rows of a registry (``sources``: an array of maps), whatever alias a field has; rows without an id go."""
    one = raw.select(F.explode("sources").alias("s"))
    first = lambda *names: F.coalesce(*(F.col("s")[n] for n in names), F.lit(""))
    rows = one.select(
        F.coalesce(F.col("s")["source_id"], F.col("s")["id"]).alias("source_id"), first("title", "name").alias("title"), first("provider", "publisher").alias("provider"), first("license").alias("license"),
        F.coalesce(F.col("s")["rights_status"], F.col("s")["rights"], F.lit("UNKNOWN")).alias("rights_status"), first("canonical_url", "url").alias("canonical_url"), first("notes").alias("notes"),
    )
    return rows.where("coalesce(source_id, '') <> ''")
