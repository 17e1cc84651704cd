"""Exact top-k against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def whole(x):
    x *= 1024
    return math.floor(x) if abs(x) < 2**63 else 2**63 - 1 if x > 0 else -(2**63)


def brute(rows, k=10):
    good = [(i, [whole(x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 100 == 0:
            scored = sorted((-max(-(2**114), min(2**114, sum(a * b for a, b in zip(q, c, strict=False)))), j) for j, c in good if j != i)[:k]
            out += [(i, rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def found(df, **how):
    return sorted(map(tuple, topk.search(df, F.col("vec_id") % 100 == 0, **how).collect()))


def some_rows(seed, n=700, width=6):
    r = random.Random(seed)
    out = [(i, [r.gauss(0, 1) * r.choice([0.01, 1, 1, 9]) for _ in range(width)], 0) for i in range(n)]
    out += [(n + i, [0.5] * width, 1) for i in range(300)]  # one vector that many rows have
    return out


@pytest.mark.parametrize(("seed", "block"), [(1, 4096), (2, 17), (3, 64)])
def test_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = some_rows(seed)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5), head_share=random.Random(seed).choice([0.2, 0.5, 1.0])) == brute(rows)


def test_defined_results(spark):
    r = random.Random(4)
    rows = some_rows(4, 120, 3)
    rows += [(900, None, 1), (901, [1.0, None, 2.0], 1), (902, [math.nan, 1.0, 1.0], 1), (903, [math.inf, 1.0, 1.0], 1), (None, [9.0] * 3, 1), (1000, [], 1), (1001, [7.0], 1), (1002, [1.0] * 9, 1), (1100, [0.0] * 3, 1)]
    rows += [(1200, [1e30, -1e30, 1.0], 1), (1300, [3e15, 1.0, 2.0], 1), (1301, [-3e15, 1.0, 5.0], 1), (1302, [3e15, 1.0, 3.0], 1), (1400, [1.7e308] * 3, 1)]
    rows += [(i, v, 1) for i, v, _ in rows[:30]]  # repeated rows, queries among them
    r.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 0.5], 0), (5, [1.0, 0.5], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2 * 1024**2), (0, 2, 5, 2 * 1024**2)]
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame(rows[1:], SCHEMA)) == []
    assert found(spark.createDataFrame([(0, [], 0), (1, [], 0)], SCHEMA)) == [(0, 1, 1, 0)]


def test_columns_of_other_names(spark):
    rows = some_rows(5, 150, 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("user's own") for c in ("id", "v", "asks", "row", "q", "c", "p", "length", "rank")})
    assert found(df) == brute(rows)


def test_bounds_spare_products():
    """Long vectors come first, and short ones are left out by length; others by their partial sums."""
    r = np.random.default_rng(6)
    x = np.floor(1024 * r.normal(size=(4000, 16)) * np.exp(-np.arange(16) / 2) * r.exponential(1, (4000, 1))).astype(np.int64)
    x = x[np.argsort(-np.linalg.norm(x, axis=1))]
    values, turned = np.linalg.eigh((x.T @ x).astype(float))
    held = topk.Search(np.arange(50) + 10**6, x[::80], np.full(50, -np.inf), turned[:, ::-1], 4, 10)
    held.meet(np.arange(4000), x)
    assert held.summed < 0.9 * 50 * 4000
    assert held.multiplied < 0.3 * 50 * 4000
    scores = x[::80] @ x.T
    best = np.sort(scores, axis=1)[:, ::-1][:, :10]
    got = (held.high << 52) + held.low
    assert (got == best).all()
