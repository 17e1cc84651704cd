"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each document is repeated as often as a Poisson variable with its source's
repetition rate says; the variable inverts the distribution at a uniform number
taken from a seeded hash of the document's id, so equal ids repeat equally and a
rerun gives the same rows.  The copies are put into one global random order.

Defined results: a null source is a source of its own, and so is one whose name is
a NUL character and ``null``, which counts as null; a source without a target
weight, or with weight 0, is left out; rows with null ids share one uniform
number, and the copies of equal number one place in the order; texts of any length
are carried along whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, quoted, shuffle_partitions

_NULL = "\x00null"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from a hash of the parts as text."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def rates(packed: DataFrame, weights: dict[str | None, float] | None, total: float | None) -> DataFrame:
    """One row a source: its rate, the first count of its table, and the table of the distribution function.

    The table leaves out counts whose probability is below 1e-30.
    """
    counts = packed.groupBy("__source").agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.lit(1.0))
    else:
        pairs = F.array(*(F.struct(F.lit(_NULL if s is None else s).alias("s"), F.lit(float(w)).alias("w")) for s, w in weights.items()))
        counts = counts.withColumn("w", F.element_at(F.map_from_entries(pairs), F.col("__source")))
    counts = counts.where("w > 0")
    whole = counts.agg(F.sum("w").alias("sum_w"), F.sum("n").alias("sum_n"))
    rate = F.lit(total) if total is not None else F.col("sum_n")
    out = counts.crossJoin(F.broadcast(whole)).withColumn("rate", rate * F.col("w") / F.col("sum_w") / F.col("n"))
    span = 12 * F.sqrt("rate") + 40
    out = out.withColumn("first", F.greatest(F.lit(0), F.floor(F.col("rate") - span)).cast("bigint")).withColumn("last", F.ceil(F.col("rate") + span).cast("bigint"))
    k = F.col("first").cast("double")
    # ln k! by Stirling's series; the table starts above 0 only where k is in the hundreds.
    log_factorial = F.when(F.col("first") == 0, 0.0).otherwise(k * F.ln(k) - k + 0.5 * F.ln(2 * F.lit(3.141592653589793) * k) + 1 / (12 * k) - 1 / (360 * k * k * k))
    log_p = F.when(F.col("first") == 0, -F.col("rate")).otherwise(k * F.ln("rate") - F.col("rate") - log_factorial)
    # A row a count; running sums along a source's counts, of which there are 24 square roots of its rate.
    along = Window.partitionBy("__source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = out.select("__source", "rate", "first", log_p.alias("log_p"), F.explode(F.sequence("first", "last")).alias("k"))
    rows = rows.withColumn("p", F.exp(F.col("log_p") + F.sum(F.when(F.col("k") > F.col("first"), F.ln(F.col("rate") / F.col("k"))).otherwise(0.0)).over(along)))
    rows = rows.withColumn("c", F.sum("p").over(along))
    return rows.groupBy("__source", "rate", "first").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("cdf"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None, seed: int = 17, source: str = "source", key: str = "doc_id", copy: str | None = "copy", broadcast_sources: int = 2000) -> DataFrame:
    """``docs`` repeated to the target weights (equal ones if none are given; ``total`` rows in the mean, as many as there are if None).

    ``copy`` names the column that numbers a document's repetitions from 0, in place of any such column; None leaves it out.
    The sources' table is broadcast if it has ``broadcast_sources`` rows at most; beyond that it is joined by shuffling.
    """
    packed = docs.select(F.struct("*").alias("__row"), F.coalesce(quoted(source), F.lit(_NULL)).alias("__source"), quoted(key).alias("__key"))
    table = checkpoint(rates(packed, weights, total))
    sources, longest = table.agg(F.count("*"), F.coalesce(F.max(F.size("cdf")), F.lit(1))).first()
    drawn = packed.join(F.broadcast(table) if sources <= broadcast_sources else table, "__source").withColumn("__u", uniform(F.lit(seed), F.col("__key")))
    # How many entries are at or below the uniform number: a binary search, one step a bit.
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(longest.bit_length()))))
    entries = F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= F.size("cdf")) & (F.get("cdf", n + step - 1) <= F.col("__u")), n + step).otherwise(n))
    counted = drawn.select("__row", "__key", F.coalesce((F.col("first") + entries).cast("int"), F.lit(0)).alias("__n"))
    # The count is compared behind the explode: a filter before it would become a condition of the join.
    copies = counted.select("__row", "__key", "__n", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.col("__n") - 1, F.lit(0)))).alias("__copy")).where("__copy < __n")
    # The order is that of a uniform hash, so its range is cut evenly, without a sample of the copies.
    n = shuffle_partitions(docs.sparkSession)
    place = copies.withColumn("__place", F.xxhash64(F.lit(seed), F.col("__key"), F.col("__copy")))
    part = F.shiftright((F.shiftright("__place", 33) + F.lit(1 << 30)) * F.lit(n).cast("bigint"), 31).cast("int")
    ordered = place.repartitionById(n, part).sortWithinPartitions("__place", "__key", "__copy")
    return ordered.select(*(F.col(f"__row.`{c}`") for c in docs.columns if c != copy), *([F.col("__copy").alias(copy)] if copy else []))
