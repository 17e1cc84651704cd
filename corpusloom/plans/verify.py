"""Verification: named checks over the pipeline's outputs, as (check, ok, detail) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.functions.text import is_blank


def schema_errors(rows: DataFrame, required: list[str]) -> DataFrame:
    """A row an error: ``row_id``, ``error``.

    A missing field, or else a bad reference, is all that is said of a row; otherwise a
    wrong id, a wrong collection, an empty side and a missing address each count.
    """
    r = F.col("reference")
    absent = reduce(lambda x, y: x | y, (F.col(c).isNull() for c in required))
    others = F.array_compact(
        F.array(
            F.when(~F.col("id").eqNullSafe(r), "id_mismatch"), F.when(~F.col("book_code").eqNullSafe(refs.book(r)), "book_mismatch"),
            *(F.when(F.coalesce(is_blank(F.col(f"{s}_text")), F.lit(True)), f"empty_{s}") for s in "ab"), *(F.when(F.coalesce(f"{s}_url", F.lit("")) == "", f"missing_url_{s}") for s in "ab"),
        )
    )
    errors = F.when(absent, F.array(F.lit("missing_fields"))).when(~refs.is_reference(r), F.array(F.lit("bad_reference"))).otherwise(others)
    return rows.select("row_id", F.explode(errors).alias("error"))


def countable(rows: DataFrame, required: list[str]) -> DataFrame:
    """The rows that count in the search for repeated ids: those without a missing field or a bad reference."""
    there = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in required))
    return rows.where(there & refs.is_reference(F.col("reference")))


def samples(errors: DataFrame, limit: int = 20) -> DataFrame:
    """The first ``limit`` errors: the report shows no more."""
    return errors.orderBy("row_id", "error").limit(limit)


def spot_checks(rows: DataFrame, wanted: list[str], key: str = "reference") -> DataFrame:
    fixed = rows.sparkSession.createDataFrame([(k,) for k in wanted], f"{key} string")
    return F.broadcast(fixed).join(rows.select(key, F.lit(True).alias("there")).distinct(), key, "left").select(key, F.coalesce("there", F.lit(False)).alias("found"))


def audit_reconciles(audit: DataFrame, parallel: DataFrame) -> DataFrame:
    """One row: the audit's aligned count, the parallel rows, and whether they agree (without parallel rows they do)."""
    return audit_reconciles_variants(audit, parallel, {"": F.lit(1)}, "variant").drop("variant")


def audit_reconciles_variants(audit: DataFrame, parallel: DataFrame, times: dict[str, Column], name: str) -> DataFrame:
    """The same for several tables made of the parallel rows, a row each with its ``name``: ``times`` says how often a row is in each.  Both frames are read once."""
    a = audit.agg(F.count_if(F.col("alignment_status") == "aligned").alias("audit_aligned"))
    counts = [F.struct(F.lit(k).alias(name), F.coalesce(F.sum(v.cast("bigint")), F.lit(0)).alias("parallel_rows")) for k, v in times.items()]
    out = a.crossJoin(parallel.agg(F.array(*counts).alias("__counts"))).select("audit_aligned", F.explode("__counts").alias("__c")).select("audit_aligned", "__c.parallel_rows", f"__c.{name}")
    return out.select("audit_aligned", "parallel_rows", ((F.col("parallel_rows") == 0) | (F.col("audit_aligned") == F.col("parallel_rows"))).alias("ok"), name)


def leaked_uncertain(parallel: DataFrame, audit: DataFrame, keys: list[str]) -> DataFrame:
    """Parallel rows whose whole reference the audit calls uncertain: none, if all is well."""
    return parallel.join(audit.where("alignment_status = 'language_uncertain'").select(*keys), keys, "left_semi")


def ml_errors(ml: DataFrame, parallel: DataFrame) -> DataFrame:
    """One row: ML rows without an id or a text, rows of the ML and the parallel table."""
    empty = F.col("id").isNull() | F.coalesce(is_blank(F.col("source")), F.lit(True)) | F.coalesce(is_blank(F.col("target")), F.lit(True))
    return ml.agg(F.count("*").alias("ml"), F.count_if(empty).alias("errors")).crossJoin(parallel.agg(F.count("*").alias("parallel")))


def manifest_counts(tasks: DataFrame) -> DataFrame:
    """One row: groups and collections of a side's manifest, and how many canonical collections it lacks."""
    known = F.countDistinct(F.when(F.col("book_code").isin([*refs.COLLECTIONS]), F.col("book_code")))
    return tasks.agg(F.count("*").alias("chapters"), F.countDistinct("book_code").alias("books"), (F.lit(len(refs.COLLECTIONS)) - known).alias("missing"))


def capture_faults(tasks: DataFrame, captures: DataFrame, unreadable: DataFrame, keys: list[str]) -> DataFrame:
    """One row: tasks without a capture, and files that can't be read."""
    absent = tasks.join(captures.select(*keys), keys, "left_anti").agg(F.count("*").alias("missing"))
    return absent.crossJoin(unreadable.agg(F.count("*").alias("unreadable")))


def check(name: str, row: DataFrame, ok: Column, detail: Column) -> DataFrame:
    """One check from a frame of one row."""
    return row.select(F.lit(name).alias("check"), ok.alias("ok"), detail.alias("detail"))


def checks(row: DataFrame, tests: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Several checks, each with its condition and detail, from one frame of one row."""
    cells = [F.struct(F.lit(k).alias("check"), ok.alias("ok"), detail.alias("detail")) for k, (ok, detail) in tests.items()]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(report_rows: DataFrame, uncertain: DataFrame, unreadable: DataFrame, missing: DataFrame) -> DataFrame:
    """``ok``: all checks hold.  ``complete``: and nothing is uncertain, unreadable or missing."""
    counts = [f.agg(F.count("*").alias(n)) for f, n in ((uncertain, "uncertain"), (unreadable, "unreadable"), (missing, "missing"))]
    one = reduce(lambda x, y: x.crossJoin(y), counts, report_rows.agg(F.bool_and("ok").alias("ok")))
    return one.withColumn("complete", F.col("ok") & (F.col("uncertain") + F.col("unreadable") + F.col("missing") == 0))


def line_corpus_checks(files: dict[str, DataFrame], tsv_lines: DataFrame, header: str, sft: DataFrame) -> DataFrame:
    """Checks of a line corpus: equal line counts, exact header, five columns, no repeated reference, whole chat records."""
    from corpusloom.operators import training

    counts = [f.agg(F.lit(n).alias("file"), F.count("*").alias("n")) for n, f in files.items()]
    equal = reduce(DataFrame.unionByName, counts).agg(F.countDistinct("n").alias("n"))
    body = tsv_lines.where("line_no > 0 and text <> ''")
    heads = tsv_lines.where("line_no = 0").agg(F.count_if(F.col("text") == header).alias("n"))
    columns = body.agg(F.count_if(F.size(F.split("text", "\t", -1)) != 5).alias("n"))
    repeated = body.groupBy(F.split("text", "\t", -1)[0].alias("ref")).agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n"))
    broken = training.record_errors(sft).agg(F.count("error").alias("n"))
    n = F.col("n")
    found = [("equal_line_counts", equal, n <= 1), ("header", heads, n == 1), ("columns", columns, n == 0), ("unique_references", repeated, n == 0), ("chat_records", broken, n == 0)]
    return report([check(k, f, ok, n.cast("string")) for k, f, ok in found])
