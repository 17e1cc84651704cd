"""Scans over ranges agree with windows over all rows, wherever the ranges are cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import scans, sequence

SCHEMA = "file string, line int, text string, flag boolean, level int"


@pytest.fixture(params=[(1, 2), (2, 3), (3, 1000)])
def rows(request, spark):
    seed, batch = request.param
    r = random.Random(seed)
    files = [None, "a", "b", "c"]
    out = [(f, i, r.choice([None, None, None, "x", "y"]), r.choice([None, True, True, False]), r.choice([None, None, 1, 2])) for f in files for i in range(r.choice([1, 2, 40, 120]))]
    r.shuffle(out)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    yield spark.createDataFrame(out, SCHEMA).repartition(3)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def same(a, b):
    assert sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(b.columns)).collect()))


def segmented(rows):
    """One order for windows and scans alike: files in order, nulls first."""
    return rows, ["file"], ["line"]


@pytest.mark.parametrize("ranges", [1, 5, 23])
def test_scans_are_windows(rows, ranges):
    rows, by, order = segmented(rows)
    values = {"text_so_far": F.col("text"), "level_so_far": F.col("level")}
    same(scans.forward_fill(rows, by, order, values, ranges), sequence.forward_fill(rows, by, order, values))
    same(scans.change_index(rows, by, order, F.col("text"), ranges=ranges), sequence.change_index(rows, by, order, F.col("text")))
    same(scans.islands(rows, by, order, F.col("flag"), ranges=ranges), sequence.islands(rows, by, order, F.col("flag")))
    outer, inner = F.when(F.col("level") == 1, F.col("line")), F.when(F.col("level") == 2, F.col("line"))
    same(scans.fill_within(rows, by, order, outer, inner, ranges=ranges), sequence.fill_within(rows, by, order, outer, inner))


def test_one_file_needs_no_partition(rows):
    whole = rows.withColumn("one", F.lit(0))
    order = ["file", "line"]
    same(scans.forward_fill(whole, [], order, {"so_far": F.col("text")}, 9), sequence.forward_fill(whole, ["one"], order, {"so_far": F.col("text")}))
    found = scans.islands(whole, [], order, F.col("flag"), ranges=9)
    same(found, sequence.islands(whole, ["one"], order, F.col("flag")))
    assert "Window" not in found._jdf.queryExecution().toString()


def test_numbers(rows):
    got = scans.numbered(rows, ["file"], [F.col("line")], 7).collect()
    wanted = {(r.file, r.line): i for i, r in enumerate(sorted(rows.collect(), key=lambda r: (r.file is not None, r.file or "", r.line)))}
    assert {(r.file, r.line): r["__at"] for r in got} == wanted
    assert all(r["__position"] == r.line for r in got)


def test_merged_lines(rows):
    lines = rows.where("file = 'b'").select("line", F.concat(F.lit("R "), F.col("line")).alias("ref"), F.when(F.col("flag"), sequence.RANGE).otherwise(F.col("text")).alias("t"))
    clean = lambda c: F.when(c == sequence.RANGE, "").otherwise(c)
    got = scans.merge_ranges(lines, "line", "ref", ["t"], ["t"], sequence.RANGE, clean, 5)
    same(got, sequence.merge_ranges(lines.withColumn("one", F.lit(0)), ["one"], "line", "ref", ["t"], ["t"]).drop("one"))


def test_equal_rows_are_dealt_to_several_ranges(spark):
    equal = spark.range(400).select(F.lit(1).alias("k"))
    got = scans.numbered(equal, ["k"], [], 8)
    assert sorted(r["__position"] for r in got.collect()) == list(range(400))
    assert max(r.n for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()) < 200


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert scans.forward_fill(none, ["file"], ["line"], {"x": F.col("text")}).count() == 0
    assert scans.islands(none, [], ["line"], F.col("flag")).count() == 0
    with pytest.raises(ValueError):
        scans.scan(none, [], [("other", F.col("flag"))])
