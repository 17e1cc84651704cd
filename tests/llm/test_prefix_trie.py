"""The prefix trie against one built of tuples."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((t is not None, t or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
    return sorted(((min(m), len(x), min(members[x[:-1]]) if x else None, len(m), len(children[x]), leaves[x], saved[x], digest(x)) for x, m in members.items()), key=repr)


def built(df):
    out = prefix_trie.build(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, out.collect()), key=repr)


def some_rows(seed):
    r = random.Random(seed)
    out = []
    for c in [*range(0, 60), *range(100, 130), 250, -3, -100, 10**12]:
        for t in range(r.choice([0, 1, 2, 3, 7, 12])):
            out.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "b", "long " * 5, "é"])))
    out += [(300, t, "user", f"turn {t % 3}") for t in range(700)]  # one long conversation, and others that share its beginning
    out += [(300 + i, t, "user", f"turn {t % 3}") for i in (3, 7) for t in range(40)]
    out += [(400, None, "user", "first"), (400, None, None, None), (400, 2, "user", ""), (400, 2, "user", ""), (401, 1, None, "x"), (None, 1, "user", "nobody's"), (402, 5, "", None)]
    out += [(500 + i % 50, t, "system", "the same") for i in range(50) for t in range(3)] * 2  # ties and repeated rows
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_as_built_of_tuples(spark, seed, monkeypatch):
    rows = some_rows(seed)
    random.Random(seed).shuffle(rows)
    if seed == 2:
        # Without hot keys, and with all of them; pieces of a few ids.
        monkeypatch.setattr(prefix_trie, "HOT", 40)
    assert built(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_columns_of_other_names(spark):
    rows = some_rows(3)[:200]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("ha", "path", "part", "position", "depth", "h", "base", "__segment"):
        df = df.withColumn(c, F.lit("user's own"))
    assert built(df) == brute(rows)


def test_empty_tables(spark):
    assert built(spark.createDataFrame([], SCHEMA)) == []
    assert built(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_a_node_with_many_ends(spark, monkeypatch):
    """A node at which thousands of conversations end: its ids are hashed in pieces."""
    rows = [(1000 + 100 * i, 0, "user", "hello") for i in range(9000)]
    assert built(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_paths_are_heavy(spark):
    """Each node has one path; a light node has at most half of its parent's members, so few are above any node."""
    out = prefix_trie.build(spark.createDataFrame(some_rows(1), SCHEMA)).collect()
    by_path = defaultdict(list)
    for r in out:
        by_path[r.path].append(r)
    for nodes in by_path.values():
        depths = sorted(r.depth for r in nodes)
        assert depths == list(range(depths[0], depths[0] + len(depths)))
        assert [r.n_children for r in nodes if r.depth == depths[-1]] == [0]
    assert sum(r.n_children == 0 for r in out) == len(by_path)
