"""Derived training sets: filters on pairs, translation pairs, chat records, retrieval documents, the lexicon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import hash_fraction, tokens

LEAST_RATIO, MOST_RATIO = 0.4, 3.0
LEAST_PAIRS, LEAST_DICE = 8, 0.3
ROLES = ("system", "user", "assistant")


def both_sides(a: Column, b: Column) -> Column:
    return (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")


def length_ratio_ok(a: Column, b: Column) -> Column:
    """Lengths in proportion, bounds excluded."""
    r = F.length(a) / F.greatest(F.lit(1), F.length(b))
    return (r > LEAST_RATIO) & (r < MOST_RATIO)


def chat(system: str, prompt: Column, source: Column, target: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", F.concat(prompt, F.lit("\n\n"), source)), turn("assistant", target))


def pick(templates: list[str], key: Column, salt: str) -> Column:
    """One of the templates, by a hash of the key."""
    return F.element_at(F.array(*map(F.lit, templates)), (F.pmod(hash_fraction(key, salt), F.lit(len(templates))) + 1).cast("int"))


def sft_examples(pairs: DataFrame, system: str, forward: list[str], backward: list[str], key: str = "id", extra: str | None = None, second: str | None = None, sample: int = 300) -> DataFrame:
    """Chat examples of pairs (``a``, ``b``, ``split``): both directions; of a further b text, for a sample of the training rows, backward; of a second a text both again."""
    k = F.col(key)
    example = lambda kind, prompts, source, target: F.struct(F.lit(kind).alias("kind"), chat(system, pick(prompts, k, kind), F.col(source), F.col(target)).alias("messages"))
    made = [example("forward", forward, "a", "b"), example("backward", backward, "b", "a")]
    if extra:
        made.append(F.when((F.col("split") == "train") & (F.coalesce(extra, F.lit("")) != "") & (hash_fraction(k, "extra") < sample), example("extra", backward, extra, "a")))
    if second:
        good = (F.coalesce(second, F.lit("")) != "") & length_ratio_ok(F.col(second), F.col("b"))
        made += [F.when(good, example("second_forward", forward, second, "b")), F.when(good, example("second_backward", backward, "b", second))]
    one = pairs.select(key, "split", F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("x"))
    return one.select(key, "split", "x.kind", "x.messages")


def shuffled(rows: DataFrame, key: Column, seed: str) -> DataFrame:
    """A fixed random order, by a hash of the key."""
    return rows.withColumn("shuffle_key", F.sha2(F.concat(key, F.lit(seed)), 256)).orderBy("shuffle_key")


def retrieval_documents(pairs: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    text = F.concat(F.col(key), F.lit(f"\n{names[0]}: "), F.col("a"), F.lit(f"\n{names[1]}: "), F.col("b"))
    return pairs.select(F.col(key).alias("id"), "a", "b", text.alias("text"))


def document_frequency(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def cooccurrence(pairs: DataFrame, key: str, least: int = LEAST_PAIRS) -> DataFrame:
    """``x``, ``y``, ``n``, ``cx``, ``cy`` for tokens that meet in ``least`` pairs or more.

    Tokens in fewer pairs can't reach that and go before the per-row product is made.
    """
    one = pairs.select(key, tokens(F.col("a")).alias("ta"), tokens(F.col("b")).alias("tb"))
    side = lambda c, name, n: one.select(key, F.explode(c).alias(name)).join(one.select(F.explode(c).alias(name)).groupBy(name).agg(F.count("*").alias(n)).where(F.col(n) >= least), name)
    met = side("ta", "x", "cx").join(side("tb", "y", "cy"), key)
    return met.groupBy("x", "y").agg(F.count("*").alias("n"), F.first("cx").alias("cx"), F.first("cy").alias("cy")).where(F.col("n") >= least)


def dice(counted: DataFrame) -> DataFrame:
    return counted.withColumn("dice", 2 * F.col("n") / (F.col("cx") + F.col("cy")))


def lexicon(counted: DataFrame, least: float = LEAST_DICE) -> DataFrame:
    """For each x the y of the greatest Dice coefficient (the first of equal ones), if it is ``least`` or more."""
    best = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("dice"), "y"))
    return dice(counted).withColumn("rank", best).where((F.col("rank") == 1) & (F.col("dice") >= least)).drop("rank")


def lexicon_rows(found: DataFrame) -> DataFrame:
    """In the order of the file: greatest coefficient first; three decimals, halves to even."""
    return found.orderBy(F.desc("dice"), "x").select("x", "y", F.format_string("%.3f", F.bround("dice", 3)).alias("dice"), F.col("cx").alias("x_frequency"))


def record_errors(lines: DataFrame, text: str = "value") -> DataFrame:
    """What is wrong with each chat record line: ``bad_json``, ``bad_count``, ``bad_message``, or null."""
    parsed = F.from_json(text, "struct<messages:array<struct<role:string,content:string>>,_corrupt:string>", {"columnNameOfCorruptRecord": "_corrupt"})
    m = F.col("__r.messages")
    error = F.when(F.col("__r").isNull() | F.col("__r._corrupt").isNotNull() | m.isNull(), "bad_json").when(F.size(m) != 3, "bad_count").when(F.exists(m, lambda x: x["role"].isNull() | x["content"].isNull()), "bad_message")
    return lines.withColumn("__r", parsed).withColumn("error", error).drop("__r")
