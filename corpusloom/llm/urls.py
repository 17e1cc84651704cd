"""URL filter: rules first, a character language-model ratio for the rest; DataFrame operations only.

URLs that the rules decide teach two smoothed variable-order Markov models over
the characters of host and path, one of accepted and one of rejected URLs
(Witten-Bell interpolation over the orders 0 to ``order``).  A URL without a rule
is judged by the difference of the two log-likelihoods over its length, against
the threshold that best separates decided URLs which the models haven't seen.

Each distinct (host, path) counts once, so a hot host or a repeated URL adds no
load to one task.  Log ratios are whole numbers of millionths: sums don't depend
on their order.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged by its end character alone; with no URL to calibrate on, the threshold
is 0; where nothing separates the models, a URL is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, lower_ascii

START, END = "\x02", "\x03"
MICRO = 1_000_000


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(F.coalesce(rest, F.lit("")), "^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null; ``rules`` holds pairs of verdict and rule."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(text: Column, order: int) -> Column:
    """Each character of the text and its end, after its ``order`` predecessors."""
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))


def log_ratios(counted: DataFrame, order: int, few: bool) -> DataFrame:
    """``gram`` and ``ratio``: millionths of ln P(last | before, accepted) - ln P(last | before, rejected).

    ``counted`` holds each full gram with its counts ``a`` and ``r``; if they are ``few``, the model is broadcast, so that a short frequent context meets in no one task.
    """
    suffixes = counted.select("gram", "a", "r", F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("n")).withColumn("tail", F.expr("right(gram, n)"))
    tails = suffixes.groupBy("tail").agg(F.sum("a").alias("a"), F.sum("r").alias("r")).withColumn("context", F.expr("left(tail, length(tail) - 1)"))
    contexts = tails.groupBy("context").agg(F.sum("a").alias("all_a"), F.count_if(F.col("a") > 0).alias("kinds_a"), F.sum("r").alias("all_r"), F.count_if(F.col("r") > 0).alias("kinds_r"))
    model = tails.join(F.broadcast(contexts) if few else contexts, "context").select("tail", F.struct(F.length("tail").alias("n"), "a", "all_a", "kinds_a", "r", "all_r", "kinds_r").alias("level"))
    levels = suffixes.select("gram", "tail").join(F.broadcast(model) if few else model, "tail").groupBy("gram").agg(F.array_sort(F.collect_list("level")).alias("levels"))

    def chance(k: str) -> Column:
        def step(p: Column, x: Column) -> Column:
            return F.when(x[f"all_{k}"] > 0, (x[k] + x[f"kinds_{k}"] * p) / (x[f"all_{k}"] + x[f"kinds_{k}"])).otherwise(p)

        return F.aggregate("levels", F.lit(1 / 256), step)

    return levels.select("gram", F.round(MICRO * (F.ln(chance("a")) - F.ln(chance("r")))).cast("bigint").alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score, in hundredths, from which on a URL is more like the accepted ones: best mean of both classes' recalls.

    The histogram has a fixed number of cells.
    """
    cell = F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-2000)), F.lit(2000))
    rows = sorted(scored.groupBy(cell.alias("cell")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")).collect())
    accepted, rejected = sum(r.a for r in rows), sum(r.r for r in rows)
    if not accepted or not rejected:
        return 0.0
    # Between two neighbouring cells that have URLs the threshold is half-way; the one nearest 0 wins among equals.
    best, at, a, r, before = (-1.0, 0.0), 0.0, accepted, 0, None
    for x in rows:
        edge = (x.cell if before is None else (before + 1 + x.cell) / 2) / 100
        if (score := (a / accepted + r / rejected, -abs(edge))) > best:
            best, at = score, edge
        a, r, before = a - x.a, r + x.r, x.cell
    return at


def judge(pages: DataFrame, rules: list[tuple[str, str]], order: int = 4, url: str = "url", broadcast_grams: int = 200_000) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and the model's ``score`` (null where a rule decides), in place of any such columns.

    Tables of a model of up to ``broadcast_grams`` grams (of ``order`` + 1 characters and seven numbers) are broadcast; larger ones are joined by shuffling.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "score")
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = longest_rule(rules, F.col("host"), F.col("path"))
    urls = parsed.select("host", "path").distinct().withColumn("verdict", found["verdict"])
    # Of the decided URLs a fifth, by hash, is kept from the models to calibrate on.
    kept_out = F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(" ", "host", "path"), 256), 1, 8), 16, 10).cast("bigint"), F.lit(5)) == 0
    exploded = urls.withColumn("kept_out", kept_out).select("*", F.explode(grams(F.concat("host", "path"), order)).alias("gram"))
    teaches = F.col("verdict").isNotNull() & ~F.col("kept_out")
    counted = checkpoint(exploded.groupBy("gram").agg(F.count_if(teaches & (F.col("verdict") == "allow")).alias("a"), F.count_if(teaches & (F.col("verdict") == "block")).alias("r")))
    few = counted.count() <= broadcast_grams
    ratios = checkpoint(log_ratios(counted, order, few))
    asked = exploded.where("verdict is null or kept_out").join(F.broadcast(ratios) if few else ratios, "gram")
    scored = checkpoint(asked.groupBy("host", "path").agg((F.sum("ratio") / F.count("*") / MICRO).alias("score"), F.first("verdict").alias("verdict")))
    least = threshold(scored.where("verdict is not null"))
    model = scored.where("verdict is null").select("host", "path", "score", F.when(F.col("score") >= least, "allow").otherwise("block").alias("__verdict"))
    out = parsed.withColumn("__rule", found).join(model, ["host", "path"], "left")
    return out.select(*(F.col(f"`{c}`") for c in pages.columns), "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", "__verdict").alias("verdict"), "score")
