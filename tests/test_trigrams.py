"""Searches by index against a matcher that tries everything, and pages by counts against sorted pages."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import curate, trigrams


def like(text, pattern):
    """The pattern as a regular expression of Python's, which goes back as often as it takes."""
    return text is not None and re.fullmatch("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern.lower()), text.lower(), re.S) is not None


ALPHABET = ["a", "b", "A", "ab", "abc", " ", "\\", "\n", "é", "É", ".", "*", "%", "_", "\\E", "("]


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(2)
    rows = [(i, *("".join(r.choice(ALPHABET) for _ in range(r.choice([0, 2, 5, 30]))) for _ in range(2))) for i in range(300)]
    rows += [(70_000, "C:\\dir\\file", "ends in \\"), (200_001, None, None), (70_001, "ABC" * 50, "İstanbul ΣΑΣ")]
    return rows, spark.createDataFrame(rows, "k bigint, a string, b string").repartition(3)


def patterns():
    r = random.Random(3)
    out = ["".join(r.choice([*ALPHABET[:12], "%", "%", "_"]) for _ in range(r.randint(1, 7))) for _ in range(40)]
    return [*out, "%C:\\dir%", "%\\", "%\\%", "c:_dir%le", "%:\\_ir%", "%abcabc%", "%abca_cabc%abc%", "%", "_%_", "%abc%%abc", "%zzzz%", "%στα%", "%(%.%", "%istanbul%"]


def test_matches(spark, texts):
    rows, df = texts
    wanted = {p: sorted(k for k, a, _ in rows if like(a, p)) for p in patterns()}
    found = df.select("k", *(trigrams.matches(F.col("a"), p).alias(f"p{i}") for i, p in enumerate(wanted))).collect()
    assert {p: sorted(r.k for r in found if r[f"p{i}"]) for i, p in enumerate(wanted)} == wanted


def test_index_gives_what_a_scan_gives(spark, texts, tmp_path):
    rows, df = texts
    index = trigrams.build(df, "k", ["a", "b"], str(tmp_path / "index"))
    for p in patterns()[::4] + patterns()[40:]:
        found = sorted(r.k for r in trigrams.search(df, index, "k", ["a", "b"], p).collect())
        assert found == sorted(k for k, a, b in rows if like(a, p) or like(b, p)), p
    stored = index.orderBy("gram", "block").collect()
    assert all(list(r.ids) == sorted(set(r.ids)) and len(r.ids) == r.n for r in stored)
    assert {r.block for r in stored} == {0, 1}
    assert trigrams.required("%ab%abcd_xyz%") == ["abc", "bcd", "xyz"]


def test_a_search_reads_its_trigrams_only(spark, texts, tmp_path):
    """The read is cut to the pattern's trigrams, and only rows with all of them are candidates."""
    df = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(" of many")).alias("a"))
    index = trigrams.build(df, "k", ["a"], str(tmp_path / "index"))
    near = trigrams.candidates(index, "%1234 of%")
    assert [r.id for r in near.collect()] == [1234]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan
    assert trigrams.candidates(index, "%zzz%").count() == 0 and trigrams.candidates(index, "%_%") is None


def test_long_texts_are_matched_in_one_pass(spark):
    """A pattern with many pieces against 300,000 letters that almost match: no going back."""
    df = spark.createDataFrame([("tion " * 60_000,)], "a string")
    assert not df.select(trigrams.matches(F.col("a"), "%tion% %tion% %tion% %ment%")).first()[0]


def test_search_takes_backslashes_as_letters(spark):
    rows = spark.createDataFrame([(1, "C:\\dir", "x\\", "r.1", "approved", "s"), (2, "C:dir", "x", "r.2", "approved", "s")], "id int, a_text string, b_text string, ref string, status string, source_id string")
    for q, ids in (("C:\\dir", [1]), ("x\\", [1]), ("\\", [1]), ("c:%dir", [1, 2]), ("c:_dir", [1]), (" DIR ", [1, 2])):
        assert [r.id for r in curate.search(rows, q).orderBy("id").collect()] == ids


def test_pages_by_counts(spark):
    r = random.Random(4)
    ids = sorted({r.choice([r.randrange(50), r.randrange(10**6), 10**12 + r.randrange(10**4)]) for _ in range(2000)} | {-5})
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id bigint, t string").repartition(3)
    for offset, limit in [(0, 5), (30, 40), (700, 500), (len(ids) - 3, 50), (len(ids), 5), (10**6, 1)]:
        found, total = curate.page_by_counts(df, limit, offset, cells=7, few=20)
        assert ([x.id for x in found.collect()], total) == (ids[offset : offset + limit], len(ids))
    some = spark.createDataFrame([(None, "x"), (3, "a"), (3, "a"), (3, "a"), (4, "b")], "id bigint, t string")
    assert [x.id for x in curate.page_by_counts(some, 3, 0)[0].collect()] == [None, 3, 3]
    assert [x.id for x in curate.page_by_counts(some, 3, 2, cells=2, few=1)[0].collect()] == [3, 3, 4]
    assert curate.page_by_counts(some.limit(0), 3, 0)[0].count() == 0
    with pytest.raises(ValueError):
        curate.page_by_counts(df, 0)
