"""Lines of files that are read in ranges: the same as of whole texts, wherever the ranges are cut."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import readers, sinks


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    for name, value in zip(names, ["97b", "11b", "5"], strict=True):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def wanted(texts):
    return sorted((name, i, line) for name, text in texts.items() for i, line in enumerate(text.split("\n")))


def read(spark, folder, **how):
    out = readers.lines(spark, f"{folder}/*", **how)
    return sorted((f.rsplit("/", 1)[-1], i, t) for f, i, t in out.collect())


def test_ranges_give_the_lines_of_whole_files(spark, tmp_path, small_ranges):
    r = random.Random(3)
    words = ["one", "two\r", "\r", "é x", "", "", "a long line of words " * 9, "\x85\x0b", " "]
    texts = {f"f{k}.txt": "\n".join(r.choice(words) for _ in range(r.choice([1, 2, 30, 200]))) + r.choice(["", "\n", "\n\n"]) for k in range(12)}
    texts |= {"empty.txt": "", "feed.txt": "\n", "mark.txt": "﻿a\nb\n", "marked.txt": "﻿a\nb" + "\nc" * 200, "only.txt": "﻿", "none.txt": "x" * 1000}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = readers.lines(spark, f"{tmp_path}/*")
    assert read(spark, tmp_path) == wanted(texts)
    assert found.rdd.getNumPartitions() > 60
    shuffled = readers._joined  # the way of many ranges
    readers._joined = lambda rows, starts: shuffled(rows, starts, most=0)
    try:
        assert read(spark, tmp_path) == wanted(texts)
    finally:
        readers._joined = shuffled


def test_compressed_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"x\ny\n"))
    (tmp_path / "b.txt").write_bytes(b"z")
    assert read(spark, tmp_path) == [("a.txt.gz", 0, "x"), ("a.txt.gz", 1, "y"), ("a.txt.gz", 2, ""), ("b.txt", 0, "z")]
    with pytest.raises(ValueError):
        readers.lines(spark, f"{tmp_path}/*", together=True)


def test_sorted_output_is_one_file(spark, tmp_path, small_ranges):
    rows = spark.createDataFrame([(i, None if i % 9 == 0 else f"line {i}\nand more" if i % 5 == 0 else f"line {i}") for i in range(300)], "k int, text string")
    sinks.sorted_lines(rows.repartition(3), f"{tmp_path}/out", ["k"])
    whole = "\n".join(r.text or "" for r in rows.orderBy("k").collect()).split("\n")
    out = readers.lines(spark, f"{tmp_path}/out", together=True).orderBy("line_no").collect()
    assert [(r.line_no, r.text) for r in out] == list(enumerate(whole))
    assert len({r.file for r in out}) > 1


def test_a_large_file_is_planned_as_many_tasks(spark, tmp_path):
    """3 GB, of which nothing is written: a hole in the file, planned but not read."""
    with (tmp_path / "large.txt").open("wb") as f:
        f.truncate(3 * 2**30)
    plan = spark.read.text(str(tmp_path / "large.txt"), lineSep="\n").select(F.col("value"))
    assert plan.rdd.getNumPartitions() >= 24


def test_ranges_that_have_changed_are_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\ny\n")
    rows = spark.createDataFrame([("f", 0, 9, "x", 0)], "file string, block bigint, size bigint, text string, at bigint")
    starts = spark.createDataFrame([("f", 0, 5, 1, 0, False)], "file string, block bigint, size bigint, n bigint, first bigint, marked boolean")
    with pytest.raises(Exception, match="ranges of the files have changed"):
        readers._joined(rows, starts).collect()
