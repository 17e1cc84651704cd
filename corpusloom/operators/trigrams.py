"""Indexed search for patterns: lists of rows by trigram, intersected from the rarest on, and verified.

The index is a Parquet table: for each trigram of the lower-cased texts and each block of ids the ascending ids that
have it, sorted by trigram, so that a read of some trigrams is cut to their row groups; Parquet codes the ids by their
differences.  A frequent trigram has a row a block, so no list is longer than a block.  A pattern is cut at its
wildcards into pieces, whose trigrams every match must have; a pattern without any is a scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids of a block, and how many of a pattern's trigrams are looked up: the rarest ones.
BLOCK, LOOKED_UP = 1 << 16, 8
POSTINGS = "gram string, block bigint, n int, ids array<int>"


def matches(text: Column, pattern: str) -> Column:
    """Does the text match the pattern, whatever the case?  ``%`` and ``_`` are wildcards, and nothing is an escape character.

    Pieces between ``%`` are found one behind the other, each at its first place, which is never tried again: one pass
    over the text, where LIKE would go back for every ``%``.
    """
    first, *rest = (re.sub(r"([^\w\s])", r"\\\1", p).replace("_", ".") for p in pattern.lower().split("%"))
    middle = "".join(f"(?>.*?{p})" for p in rest[:-1] if p)
    tail = "\\z" if not rest else f".*{rest[-1]}\\z" if rest[-1] else ""
    return F.lower(text).rlike(rf"(?s)\A{first}{middle}{tail}")


def containing(q: str) -> str:
    """The pattern of texts that hold ``q``."""
    return f"%{q}%"


def grams_of(text: Column) -> Column:
    """The distinct trigrams of the lower-cased text."""
    # The letters are an element of an array, so that the text is split once and not for each trigram.
    letters = F.array(F.split(F.lower(text), ""))
    grams = lambda x: F.when(F.size(x) >= 3, F.transform(F.sequence(F.lit(0), F.size(x) - 3), lambda i: F.concat(F.get(x, i), F.get(x, i + 1), F.get(x, i + 2)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.get(F.transform(letters, grams), 0))


def required(pattern: str) -> list[str]:
    """Trigrams of the pattern's pieces between wildcards.

    Case folding may change a letter's neighbours (a final sigma, a dotted capital I), so pieces with letters beyond
    ASCII are cut there too: ASCII letters fold alone.
    """
    pieces = re.split(r"[%_]|[^\x00-\x7f]", pattern.lower())
    return sorted({p[i : i + 3] for p in pieces for i in range(len(p) - 2)})


def build(rows: DataFrame, key: str, texts: list[str], path: str) -> DataFrame:
    """Writes the index of ``texts`` by the number ``key`` (0 or more, unique) and returns it."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ident = F.col(f"`{key}`").cast("bigint")
    all_grams = F.array_distinct(F.flatten(F.array(*(F.coalesce(grams_of(F.col(f"`{t}`")), F.array().cast("array<string>")) for t in texts))))
    pairs = rows.select(F.floor(ident / BLOCK).alias("block"), (ident % BLOCK).cast("int").alias("low"), F.explode(all_grams).alias("gram"))
    lists = pairs.groupBy("gram", "block").agg(F.array_sort(F.collect_list("low")).alias("ids"))
    ranged = lists.select("gram", "block", F.size("ids").alias("n"), "ids").repartitionByRange(n, "gram", "block").sortWithinPartitions("gram", "block")
    ranged.write.mode("overwrite").option("parquet.writer.version", "v2").option("parquet.block.size", str(1 << 20)).option("parquet.bloom.filter.enabled#gram", "true").parquet(path)
    return spark.read.schema(POSTINGS).parquet(path)


def candidates(index: DataFrame, pattern: str) -> DataFrame | None:
    """Ids of rows that have all trigrams a match must have (``id``); None if the pattern has none."""
    if not (grams := required(pattern)):
        return None
    found = index.where(F.col("gram").isin(grams))
    sizes = {r.gram: r.n for r in found.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    # A trigram that no row has makes the answer empty; else the rarest ones decide.
    rarest = sorted(grams, key=lambda g: (sizes.get(g, 0), g))[:LOOKED_UP]
    if rarest[0] not in sizes:
        return index.select(F.lit(0).cast("bigint").alias("id")).limit(0)
    lists = index.where(F.col("gram").isin(rarest)).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("n", "ids"))).alias("lists")).where(F.size("lists") == len(rarest))
    both = F.aggregate(F.slice("lists", 2, len(rarest)), F.get(F.col("lists"), 0)["ids"], lambda ids, x: F.array_intersect(ids, x["ids"]))
    return lists.select("block", F.explode(both).alias("low")).select((F.col("block") * BLOCK + F.col("low")).alias("id"))


def search(rows: DataFrame, index: DataFrame, key: str, texts: list[str], pattern: str) -> DataFrame:
    """The rows with a text that matches the pattern: candidates of the index, verified; all rows are read if it has no trigram."""
    near = candidates(index, pattern)
    if near is not None:
        rows = rows.join(near.withColumnRenamed("id", "__id"), F.col(f"`{key}`") == F.col("__id"), "left_semi")
    fits = F.lit(False)
    for t in texts:
        fits = fits | F.coalesce(matches(F.col(f"`{t}`"), pattern), F.lit(False))
    return rows.where(fits)
