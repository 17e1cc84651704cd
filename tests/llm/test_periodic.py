"""Periodic runs against a search of all periods, and the query against the words one by one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import periodic, registry

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(r, n):
    words = [b"%d" % r.randrange(r.choice([1, 2, 3, 9, 60])) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        start, p = r.randrange(n), 1 + r.randrange(r.choice([5, max(1, n // 2)]))
        for i in range(start, min(n, start + r.randint(1, n))):
            words[i] = words[start + (i - start) % p]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_all_runs(seed):
    r = random.Random(seed)
    for _ in range(60):
        words = repetitive(r, r.choice([13, 40, 150, 600]))
        assert periodic.runs_of(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=60))
def test_runs_of_two_words(words):
    assert periodic.runs_of(words) == brute(words)


def test_bit_planes_find_long_matches():
    words = [1, 2, 3] * 5 + [9, 8, 7, 6]
    planes = periodic.planes_of(__import__("numpy").array(words))
    assert periodic.long_matches(planes, 3, len(words), 9) == 0b1111
    assert periodic.long_matches(planes, 3, len(words), 13) == 0


def expected(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, b" ".join(repetitive(r, r.choice([12, 30, 300]))).decode(), "x") for i in range(150)]
    rows += [(200, None, "x"), (201, "", "x"), (202, " \t\r\n", "x"), (203, "é " * 30, "x"), (204, "ab " * 4000 + "end", "x"), (None, "a b c d e f g h i j k l m n o p", "x"), (205, "tab\tand\x0bother\x0cspaces " * 9, "x"), (206, "no break " * 12, "x"), (207, "w" * 100_000, "x"), (201, "", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).drop("n_words").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t) for i, t, _ in rows), key=repr)


def test_very_long_text():
    """200,000 words: a periodic tail of which only few lags are tried, and a run with a long period."""
    r = random.Random(9)
    block = [b"%d" % r.randrange(10**6) for _ in range(60_000)]
    words = block + block + [b"x", b"y", b"z"] * 20_000
    assert periodic.runs_of(words) == [(0, 120_000, 60_000), (120_000, 60_000, 3)]


def test_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b " * 10, "kept", "replaced")], "doc_id int, text string, `odd name` string, runs string")
    out = periodic.find(df.withColumn("n_words", F.lit("old")), "text")
    assert out.columns == ["doc_id", "text", "odd name", "n_words", "runs", "collapsed"]
    r = out.first()
    assert (r["odd name"], r.n_words, [tuple(x) for x in r.runs], r.collapsed) == ("kept", 20, [(0, 20, 2)], "a b")
    assert periodic.find(df.limit(0)).count() == 0
