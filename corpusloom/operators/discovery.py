"""Discovery of collections: expectations, mismatches, and the mapping over sides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_counts(chapters: DataFrame, keys: list[str]) -> DataFrame:
    return chapters.groupBy(*keys).agg(F.count("*").alias("groups"))


def missing_and_extra(found: DataFrame, canon: DataFrame, code: str) -> DataFrame:
    """Codes of one frame only: ``missing`` are canonical ones that weren't found, ``extra`` the others."""
    f, c = found.select(code).distinct(), canon.select(code).distinct()
    return c.join(f, code, "left_anti").withColumn("kind", F.lit("missing")).unionByName(f.join(c, code, "left_anti").withColumn("kind", F.lit("extra")))


def count_mismatches(found: DataFrame, canon: DataFrame, code: str, have: str, expect: str) -> DataFrame:
    return found.join(canon.select(code, expect), code).where(F.col(have) != F.col(expect)).select(code, expect, have)


def checks(books: DataFrame, canon: DataFrame, version_code: str) -> DataFrame:
    """(check, ok) rows of a discovered side; books: code, name, version_code, groups (least group number as ``first``)."""
    one = books.agg(
        F.count("*").alias("n"), F.countDistinct("code").alias("codes"), F.count_if(~F.col("version_code").eqNullSafe(version_code)).alias("other_versions"),
        F.count_if(F.coalesce("first", F.lit(1)) < 1).alias("bad_groups"), F.count_if(F.coalesce("name", F.lit("")) == "").alias("nameless"),
    )
    absent = canon.select(F.col("code")).join(books.select("code"), "code", "left_anti").agg(F.count("*").alias("absent"))
    all_ = one.crossJoin(absent).crossJoin(canon.agg(F.count("*").alias("expected")))
    tests = {
        "books_non_empty": F.col("n") > 0, "codes_unique": F.col("n") == F.col("codes"), "version_uniform": (F.col("n") > 0) & (F.col("other_versions") == 0), "expected_count": F.col("n") == F.col("expected"),
        "groups_positive": F.col("bad_groups") == 0, "names_present": F.col("nameless") == 0, "canon_present": F.col("absent") == 0,
    }
    return all_.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), v.alias("ok")) for k, v in tests.items()))).alias("c")).select("c.check", "c.ok")


def status(checked: DataFrame) -> DataFrame:
    return checked.agg(F.when(F.bool_and("ok"), "verified").otherwise("UNCERTAIN").alias("status"))


def merge_mapping(sides: dict[str, DataFrame], code: str = "code") -> DataFrame:
    """One row a code: each side's name and groups; the testament of the last side that knows one."""
    parts = [s.select(code, F.col("name").alias(f"{k}_name"), F.col("groups").alias(f"{k}_groups"), F.col("testament").alias(f"{k}_testament")) for k, s in sides.items()]
    joined = reduce(lambda x, y: x.join(y, code, "full_outer"), parts)
    names = [*sides]
    return joined.withColumn("testament", F.coalesce(*(f"{k}_testament" for k in reversed(names)))).drop(*(f"{k}_testament" for k in names))
