"""From captures to normalized segments: explosion, reference grammar, deduplication, summary lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.functions.text import is_blank, squeeze
from corpusloom.operators import dedup
from corpusloom.schemas import VERIFIED


def segments(captures: DataFrame, path: str = "source_file") -> DataFrame:
    """A row a verse of each capture, with ``pos``, and texts squeezed; ``language_status`` is UNKNOWN if absent."""
    one = captures.select("version", "version_id", "book_name", "url", "content_hash", F.col(path).alias("source_file"), F.coalesce("language_verification.status", F.lit("UNKNOWN")).alias("language_status"), F.posexplode("verses").alias("pos", "v"))
    return one.select("version", "version_id", "book_name", "url", "content_hash", "source_file", "language_status", "pos", F.col("v.reference").alias("reference"), F.col("v.label").alias("label"), squeeze(F.coalesce("v.text", F.lit(""))).alias("text"))


def parsed(rows: DataFrame) -> DataFrame:
    """Rows with a valid reference, and its parts."""
    r = F.col("reference")
    return rows.where(refs.is_reference(r)).withColumns({"book_code": refs.book(r), "chapter": refs.chapter(r), "verse": refs.verse(r)})


def rejects(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce(refs.is_reference(F.col("reference")), F.lit(False)))


ORDER = ["source_file", "pos"]


def normalized(captures: DataFrame) -> DataFrame:
    """The first segment of each version and reference, by file and place, in canonical order within versions."""
    kept = dedup.keep_first(parsed(segments(captures)), ["version", "reference"], [F.col(c) for c in ORDER])
    return kept.orderBy("version", *refs.canonical_order(F.col("reference"))).drop("pos")


def dropped(captures: DataFrame) -> DataFrame:
    """The segments that lost: version, reference, kept_file, dropped_file."""
    out = dedup.duplicates(parsed(segments(captures)), ["version", "reference"], [F.col(c) for c in ORDER], "source_file")
    return out.withColumnsRenamed({"kept": "kept_file", "dropped": "dropped_file"})


def repeated_pages(captures: DataFrame) -> DataFrame:
    """Captures with the content hash of an earlier one of their version."""
    keyed = captures.withColumn("chapter_key", F.concat_ws(".", "book_code", F.col("chapter").cast("string")))
    w = Window.partitionBy("version", "content_hash").orderBy("source_file")
    return keyed.withColumns({"rank": F.row_number().over(w), "first": F.first("chapter_key").over(w)}).where("rank > 1 and content_hash is not null").select("version", "content_hash", "first", F.col("chapter_key").alias("repeated"))


def empty_segments(rows: DataFrame, group: list[str], shown: str, text: str = "text") -> DataFrame:
    """For each group the sorted references without text."""
    return rows.where(F.coalesce(is_blank(F.col(text)), F.lit(True))).groupBy(*group).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(shown)).alias("empty"))


def uncertain_groups(rows: DataFrame, group: list[str]) -> DataFrame:
    """Distinct groups with a row whose language isn't verified (null included)."""
    return rows.where(~F.col("language_status").eqNullSafe(VERIFIED)).select(*group).distinct()


def failed_groups(tasks: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks whose state is failed, with its error."""
    return tasks.join(state.where("status = 'failed'").select(*keys, "error"), keys)


def summary(captures: DataFrame) -> DataFrame:
    """Counts by version: captures, segments, rejected, kept, duplicates, empty, uncertain captures."""
    all_rows = segments(captures)
    good = parsed(all_rows)
    files = captures.groupBy("version").agg(F.count("*").alias("captures"), F.count_if(~F.col("language_verification.status").eqNullSafe(VERIFIED)).alias("uncertain"))
    seen = all_rows.groupBy("version").agg(F.count("*").alias("segments"), F.count_if(~F.coalesce(refs.is_reference(F.col("reference")), F.lit(False))).alias("rejected"), F.count_if(is_blank(F.col("text"))).alias("empty"))
    kept = good.groupBy("version", "reference").agg(F.count("*").alias("n")).groupBy("version").agg(F.count("*").alias("kept"), F.sum(F.col("n") - 1).alias("duplicates"))
    return files.join(seen, "version", "left").join(kept, "version", "left").na.fill(0)
