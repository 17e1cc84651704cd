"""Alignment of two sides by reference: every reference gets one status and a reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.functions.text import is_blank, is_bracketed, round4, sha256
from corpusloom.schemas import ALIGNMENT_STATUSES, SPLITS, VERIFIED

CONTAMINATED_RATIO, CONTAMINATED_LEAST = 0.5, 3


def join_sides(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Full outer join of two deduplicated sides: ``has_a``/``has_b`` tell presence, ``a_*``/``b_*`` hold the other columns."""
    left = a.select(*key, *(F.col(c).alias(f"a_{c}") for c in a.columns if c not in key), F.lit(True).alias("has_a"))
    right = b.select(*key, *(F.col(c).alias(f"b_{c}") for c in b.columns if c not in key), F.lit(True).alias("has_b"))
    return left.join(right, key, "full_outer").withColumns({s: F.coalesce(s, F.lit(False)) for s in ("has_a", "has_b")})


def paired(rows: DataFrame, key: list[str], order: list[str], shown: str) -> DataFrame:
    """Deduplication and join of both sides in one pass, for sides that come from the same rows (``in_a``, ``in_b``, ``a_*``, ``b_*``).

    Of each key the row that ``leads`` has what ``join_sides`` makes of the sides' first rows by ``order``; every row
    says whether a side lost it (``lost_a``, ``lost_b``; ``kept_a`` and ``kept_b`` are the winners' ``shown``, ``dropped`` its own).
    Rows that are partitioned by a part of the key already aren't shuffled.  Sides don't meet at a null key.
    """
    apart = reduce(lambda x, y: x | y, (F.col(k).isNull() for k in key))
    rows = rows.withColumn("__apart", F.explode(F.when(apart, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit(None).cast("string")))))
    rows = rows.withColumns({f"in_{s}": F.col(f"in_{s}") & F.coalesce(F.col("__apart") == s, F.lit(True)) for s in "ab"}).where("in_a or in_b")
    names = {s: [c for c in rows.columns if c.startswith(f"{s}_")] for s in "ab"}
    ordered = Window.partitionBy(*key, "__apart").orderBy(*order, *names["a"], *names["b"])
    so_far, whole = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow), ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {s: F.first(F.when(F.col(f"in_{s}"), F.struct(*names[s], F.col(shown).alias("__shown"))), ignorenulls=True).over(whole).alias(f"__{s}") for s in "ab"}
    nth = {s: F.count_if(F.col(f"in_{s}")).over(so_far).alias(f"__nth_{s}") for s in "ab"}
    seen = rows.select(*key, F.col(shown).alias("dropped"), "in_a", "in_b", *first.values(), *nth.values(), (F.row_number().over(ordered) == 1).alias("leads"))
    side = lambda s: [F.col(f"__{s}.{c}").alias(c) for c in names[s]] + [(F.col("leads") & F.col(f"__{s}").isNotNull()).alias(f"has_{s}"), (F.col(f"in_{s}") & (F.col(f"__nth_{s}") > 1)).alias(f"lost_{s}"), F.col(f"__{s}.__shown").alias(f"kept_{s}")]
    return seen.select(*key, "leads", "dropped", *side("a"), *side("b"))


def _identical() -> Column:
    return F.col("has_a") & F.col("has_b") & (F.col("a_text") != "") & (F.col("a_text") == F.col("b_text"))


def identical_ratios(a: DataFrame, b: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """For each group with references on both sides: ``common``, ``identical``, ``ratio``."""
    both = a.select(*key, F.col("text").alias("a_text")).join(b.select(*key, F.col("text").alias("b_text")), key)
    same = (F.col("a_text") != "") & (F.col("a_text") == F.col("b_text"))
    return both.groupBy(*group).agg(F.count("*").alias("common"), F.count_if(same).alias("identical")).withColumn("ratio", round4(F.col("identical") / F.col("common")))


def contaminated(ratios: DataFrame) -> DataFrame:
    """Groups with too many identical texts."""
    return ratios.where((F.col("ratio") >= CONTAMINATED_RATIO) & (F.col("common") >= CONTAMINATED_LEAST))


def decide(joined: DataFrame, group: list[str]) -> DataFrame:
    """``joined`` (with ``a_text``, ``a_language_status`` and so on) with ``alignment_status``, ``a_status``, ``b_status`` and ``reason``.

    Group statistics are a window over the joined rows: where these are partitioned
    by the group already, there is no further shuffle.
    """
    w = Window.partitionBy(*group)
    common = F.count_if(F.col("has_a") & F.col("has_b")).over(w)
    identical = F.count_if(F.coalesce(_identical(), F.lit(False))).over(w)
    rows = joined.withColumns({"common": common, "identical": identical}).withColumn("ratio", F.when(F.col("common") > 0, round4(F.col("identical") / F.col("common"))))
    suspect = F.coalesce((F.col("ratio") >= CONTAMINATED_RATIO) & (F.col("common") >= CONTAMINATED_LEAST), F.lit(False)) & F.col("has_a")
    doubt_a = F.col("has_a") & ~F.col("a_language_status").eqNullSafe(VERIFIED)
    doubt_b = F.col("has_b") & ~F.col("b_language_status").eqNullSafe(VERIFIED)
    blank_a, blank_b = (F.col(f"has_{s}") & F.coalesce(is_blank(F.col(f"{s}_text")), F.lit(True)) for s in "ab")
    status = (
        F.when(doubt_a | doubt_b | suspect, "language_uncertain").when(~F.col("has_a"), "missing_a").when(~F.col("has_b"), "missing_b")
        .when(blank_a & blank_b, "extraction_error").when(blank_a, "missing_a").when(blank_b, "missing_b").otherwise("aligned")
    )
    rows = rows.withColumn("alignment_status", status)
    judged = F.col("alignment_status") != "language_uncertain"
    both = F.col("has_a") & F.col("has_b")
    side = lambda s, blank: F.when(~F.col(f"has_{s}"), "missing").when(judged & both & blank, "present_no_text").otherwise("present")
    quoted = lambda c: F.when(c.isNull(), "None").otherwise(F.concat(F.lit("'"), c, F.lit("'")))
    label_a, label_b = (F.col(f"{s}_label") if f"{s}_label" in joined.columns else F.lit(None).cast("string") for s in "ab")
    label = F.coalesce(F.when(blank_a, label_a).otherwise(label_b), F.lit(""))
    no_text = F.concat(F.lit("reference is there but its source has no text for it (label '"), label, F.lit("'"), F.when(is_bracketed(label), "; bracketed/omitted in this edition").otherwise(""), F.lit(")"))
    doubts = F.concat_ws(
        "; ", F.when(doubt_a, F.concat(F.lit("side a language status="), F.coalesce("a_language_status", F.lit("None")))), F.when(doubt_b, F.concat(F.lit("side b language status="), F.coalesce("b_language_status", F.lit("None")))),
        F.when(suspect, F.concat(F.lit("identical texts "), F.col("identical").cast("string"), F.lit("/"), F.col("common").cast("string"), F.lit(" in the group"))),
    )
    reason = (
        F.when(~judged, doubts).when(~F.col("has_a"), "published on side b only").when(~F.col("has_b"), "published on side a only")
        .when(blank_a & blank_b, F.concat(F.lit("no text on both sides (labels a="), quoted(label_a), F.lit(", b="), quoted(label_b), F.lit(")")))
        .when(blank_a | blank_b, no_text).when(F.col("a_text") == F.col("b_text"), "texts identical (flagged)").otherwise("")
    )
    return rows.withColumns({"a_status": side("a", blank_a), "b_status": side("b", blank_b), "reason": reason, "identical_text_flag": F.coalesce(_identical(), F.lit(False))})


def _judged() -> dict[str, Column]:
    """The audit's columns of a reference."""
    hashed = lambda s: F.when(F.col(f"has_{s}"), sha256(F.col(f"{s}_text")))
    return {c: F.col(c) for c in ("a_status", "b_status", "alignment_status")} | {"a_text_hash": hashed("a"), "b_text_hash": hashed("b"), "reason": F.col("reason")}


def _dropped(side: Column, kept: Column, dropped: Column) -> dict[str, Column]:
    """The audit's columns of a dropped duplicate."""
    status = lambda s: F.when(side == s, "duplicate").otherwise("present_or_missing")
    none = F.lit(None).cast("string")
    reason = F.concat(F.lit("duplicate reference on side "), side, F.lit("; kept "), kept.cast("string"), F.lit(", dropped "), dropped.cast("string"))
    return {"a_status": status("a"), "b_status": status("b"), "alignment_status": F.concat(F.lit("duplicate_"), side), "a_text_hash": none, "b_text_hash": none, "reason": reason}


def audit(decided: DataFrame, key: list[str], duplicates: DataFrame | None = None) -> DataFrame:
    """One row a reference, and one a dropped duplicate (``key``, ``side``, ``kept``, ``dropped``)."""
    rows = decided.select(*key, *(v.alias(k) for k, v in _judged().items()))
    if duplicates is None:
        return rows
    return duplicates.select(*key, *(v.alias(k) for k, v in _dropped(F.col("side"), F.col("kept"), F.col("dropped")).items())).unionByName(rows)


def audit_paired(decided: DataFrame, key: list[str], only: list[str] | None = None) -> DataFrame:
    """The same audit from the decided rows of ``paired``, where they are; ``only`` names the columns that are wanted."""
    cells = lambda found: F.struct(*(v.alias(k) for k, v in found.items() if only is None or k in only))
    lost = [F.when(F.col(f"lost_{s}"), cells(_dropped(F.lit(s), F.col(f"kept_{s}"), F.col("dropped")))) for s in "ab"]
    return decided.select(*key, F.explode(F.array_compact(F.array(F.when(F.col("leads"), cells(_judged())), *lost))).alias("__row")).select(*key, "__row.*")


REASON_PARTS = ["alignment_status", "reason", "kept", "dropped"]


def reason_parts(decided: DataFrame) -> DataFrame:
    """What the audit's reasons are made of (``REASON_PARTS``), from the decided rows of ``paired``: of dropped duplicates both numbers instead of the text."""
    known = lambda s, c: F.when(F.col(f"kept_{s}").isNotNull() & F.col("dropped").isNotNull(), F.col(c))
    none = lambda c: F.lit(None).cast(decided.schema[c].dataType)
    cells = lambda *values: F.struct(*(v.alias(c) for v, c in zip(values, REASON_PARTS, strict=True)))
    lost = [F.when(F.col(f"lost_{s}"), cells(F.lit(f"duplicate_{s}"), none("reason"), known(s, f"kept_{s}"), known(s, "dropped"))) for s in "ab"]
    lead = F.when(F.col("leads"), cells(F.col("alignment_status"), F.col("reason"), none("dropped"), none("dropped")))
    return decided.select(F.explode(F.array_compact(F.array(lead, *lost))).alias("__part")).select("__part.*")


def reason_counts(parts: DataFrame) -> DataFrame:
    """How often the audit has each reason: counted by its parts, which are shorter than the text that is made of them behind."""
    status = F.col("alignment_status")
    text = F.when(status.startswith("duplicate_"), _dropped(F.substring(status, 11, 1), F.col("kept"), F.col("dropped"))["reason"]).otherwise(F.col("reason"))
    return parts.groupBy(*REASON_PARTS).agg(F.count("*").alias("n")).select("alignment_status", text.alias("reason"), "n")


def parallel(decided: DataFrame) -> DataFrame:
    return decided.where("alignment_status = 'aligned'")


def ml(parallel_rows: DataFrame, ident: Column, source: str = "a_text", target: str = "b_text") -> DataFrame:
    return parallel_rows.select(ident.alias("id"), F.col(source).alias("source"), F.col(target).alias("target"))


def histogram(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Counts of the column's values, with zeros for those of ``values`` that don't occur."""
    counts = rows.groupBy(F.coalesce(column, F.lit("unknown")).alias(column)).agg(F.count("*").alias("n"))
    fixed = rows.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return fixed.join(counts, column, "full_outer").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def status_histogram(decided: DataFrame) -> DataFrame:
    return histogram(decided, "alignment_status", ALIGNMENT_STATUSES)


def with_split(rows: DataFrame, code: Column) -> DataFrame:
    return rows.withColumn("split", refs.split_label(code))


def split_summary(rows: DataFrame, code: str = "book") -> DataFrame:
    """Rows and distinct collections of each split, zeros included."""
    found = rows.groupBy("split").agg(F.count("*").alias("segments"), F.countDistinct(code).alias("books"))
    fixed = rows.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return fixed.join(found, "split", "left").select("split", F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce("books", F.lit(0)).alias("books"))


def split_books(rows: DataFrame, code: str = "book") -> DataFrame:
    return rows.select("split", code).distinct().groupBy("split").agg(F.sort_array(F.collect_list(code)).alias("books"))


def split_overlap(rows: DataFrame, code: str = "book") -> DataFrame:
    """Collections in more than one split: none, if splits are whole."""
    return rows.groupBy(code).agg(F.countDistinct("split").alias("splits")).where("splits > 1")


def assigned_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either frame that the other lacks, with the side that has them."""
    return left.distinct().exceptAll(right.distinct()).withColumn("only_in", F.lit("left")).unionByName(right.distinct().exceptAll(left.distinct()).withColumn("only_in", F.lit("right")))


def translation_directions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("a-b", "a", "b"), ("b-a", "b", "a")], "direction string, source string, target string")
