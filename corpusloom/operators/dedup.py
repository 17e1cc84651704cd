"""Keyed and exact deduplication; whatever is dropped is reported."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.storage import checkpoint


def first_wins(rows: DataFrame, keys: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """``rows`` with each row's rank within its key, by an order that should be total."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_wins(rows, keys, order).where("rank = 1").drop("rank")


def duplicates(rows: DataFrame, keys: list[str], order: list[Column], shown: str) -> DataFrame:
    """The rows that lose, with ``kept`` and ``dropped``: the winner's and their own ``shown``.

    Equal rows are counted and winners found before keys meet, in a join that the
    optimizer may split: a key that many rows share (an empty text) is in no one sort.
    The counts are stored, so that ``rows`` are read once.
    """
    at = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(shown).alias("dropped"))
    counted = checkpoint(rows.groupBy(*keys, at.alias("__at")).agg(F.count("*").alias("__n")))
    first = counted.groupBy(*keys).agg(F.min("__at").alias("__first"), F.sum("__n").alias("__all")).where("__all > 1").select(*(F.col(k).alias(f"__{k}") for k in keys), "__first")
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    lost = counted.join(first, same).withColumn("__lost", F.col("__n") - F.when(F.col("__at").eqNullSafe(F.col("__first")), 1).otherwise(0)).where("__lost > 0")
    return lost.select(*keys, F.col("__first.dropped").alias("kept"), F.col("__at.dropped").alias("dropped"), F.explode(F.sequence(F.lit(1), F.col("__lost").cast("int")))).drop("col")


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys, and rows too many: one row.  Keys are counted after partial aggregation."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def repeated_keys(rows: DataFrame, keys: list[str], limit: int | None = 20) -> DataFrame:
    """Keys that occur more than once, in order, the first ``limit`` of them (the report shows no more)."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return found.orderBy(*keys).limit(limit) if limit else found


def equal_contents(rows: DataFrame, content: Column, order: list[Column], shown: str) -> DataFrame:
    """Rows whose content hash an earlier row has: ``content_hash``, ``first_seen``, ``repeated``."""
    hashed = rows.withColumn("content_hash", F.sha2(content, 256))
    return duplicates(hashed, ["content_hash"], order, shown).withColumnsRenamed({"kept": "first_seen", "dropped": "repeated"})


def insert_absent(existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str], key: str = "id", known: DataFrame | None = None) -> DataFrame:
    """The rows of ``batch`` to insert: first of their key, whose key is not there yet, numbered on from the largest id.

    Only keys and order go through the sorts and joins that decide; the other columns are joined to the numbers at the
    end, so ``order`` must be total.  ``known`` are the keys that are there, if not those of ``existing``.
    """
    least = F.min(F.struct(*order)).alias("__first")
    first = batch.select(*keys, *order).groupBy(*keys).agg(least).join(known if known is not None else existing.select(*keys), keys, "left_anti")
    places = checkpoint(first.select(*keys, "__first.*"))
    ids = numbered(places, order, key, existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("start")))
    named = {c: f"{c}__" for c in [*keys, *order]}
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()))
    return batch.join(ids.withColumnsRenamed(named), same).drop(*named.values())


def numbered(rows: DataFrame, order: list[str], name: str, start: DataFrame, ranges: int = 64) -> DataFrame:
    """Consecutive numbers in the order of the columns ``order`` (the first one is a number), from ``start`` (one row, one column) + 1 on.

    Rows are ranked within ranges of the first column, cut at its quantiles, and each
    range adds the rows before it: no task gets all rows.
    """
    lead = order[0]
    cuts = rows.agg(F.percentile_approx(lead, [i / ranges for i in range(1, ranges)]).alias("cuts"))
    placed = rows.crossJoin(F.broadcast(cuts)).withColumn("__range", F.size(F.filter(F.coalesce("cuts", F.array()), lambda c: c < F.col(lead)))).drop("cuts")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    out = placed.join(F.broadcast(offsets), "__range").crossJoin(F.broadcast(start.toDF("__start")))
    return out.withColumn(name, (rank + F.col("__before") + F.col("__start")).cast("bigint")).drop("__range", "__before", "__start")


def latest_wins(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert: a row of ``new`` replaces that of ``old`` with its key, in all columns; ``new`` has a key once at most."""
    both = old.withColumn("__age", F.lit(1)).unionByName(new.withColumn("__age", F.lit(0)))
    return keep_first(both, [key], [F.col("__age")]).drop("__age")
