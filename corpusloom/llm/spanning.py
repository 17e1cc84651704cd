"""Links within groups of any size, and connected components.

Members of a group are compared by a function that returns a spanning forest of the
true links among those it is given.  A group of up to ``size`` members is one part.  A
larger one is dealt to parts of that size; then one member of each component found so
far stands for it in further rounds, as long as each round halves them, so that copies of
one text cost a pass, not all pairs.  What is still apart from the group's largest
component afterwards (strays) is compared with all members, part by part.  So all links
count, every part is bounded, and only members that link to little cost more than a pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bucket_of, by_bucket, checkpoint, groups_of, shuffle_partitions

PACKET = "bucket int, owners binary, sizes binary, counts binary, values binary"
_PACKET_NAMES = ["bucket", "owners", "sizes", "counts", "values"]
LINKS = "u bigint, v bigint"
#: From the ids and bodies of a part, pairs of ids.
Forest = Callable[[list[int], list[bytes]], list[tuple[int, int]]]


def pair_batch(u: np.ndarray, v: np.ndarray, names: tuple[str, str] = ("u", "v")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64))], names=list(names))


def packed(bucket: np.ndarray, owner: np.ndarray, size: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """Values as one row a bucket, run-length encoded by owner and size."""
    order = np.lexsort((size, owner, bucket))
    bucket, owner, size, value = bucket[order], owner[order], size[order], value[order]
    run = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1]) | (size[1:] != size[:-1]))) if len(bucket) else np.zeros(0, np.int64)
    count = np.diff(np.append(run, len(bucket))).astype(np.int32)
    names, first = np.unique(bucket[run], return_index=True)
    rows = np.append(first, len(run))
    ends = np.append(run, len(bucket))[rows]
    cut = lambda x, at: [x[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), *(pa.array(v, pa.binary()) for v in (cut(owner[run].astype(np.int64), rows), cut(size[run].astype(np.int32), rows), cut(count, rows), cut(value, ends)))], names=_PACKET_NAMES)


def unpacked(rows: list[tuple], kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, size and value of everything in the rows' packets."""
    owners, sizes, counts, values = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*rows, strict=True), (np.int64, np.int32, np.int32, kind), strict=True))
    return np.repeat(owners, counts), np.repeat(sizes, counts), values


def _stars(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key's least owner and the key, and distinct edges from the other owners to it."""
    order = np.lexsort((owner, key))
    owner, key = owner[order], key[order]
    first, n = groups_of(key)
    head = np.repeat(owner[first], n)
    u, v = owner[owner != head], head[owner != head]
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])) if len(u) else np.zeros(0, bool)
    return owner[first], key[first], u[new], v[new]


def star_packets(owner: np.ndarray, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """What a task ships of its keys: each key with its least owner, and (in the owners' buckets, size 1) edges from the others to that."""
    head, key, u, v = _stars(owner, key)
    bucket = np.concatenate([bucket_of(key, buckets), bucket_of(u.view(np.uint64), buckets)])
    return packed(bucket, np.concatenate([head, u]), np.repeat([0, 1], [len(key), len(u)]).astype(np.int32), np.concatenate([key, v.view(np.uint64)]))


def star_edges(shipped: DataFrame, buckets: int) -> DataFrame:
    """``u``, ``v``: owners of equal keys, each linked to the key's least one (``shipped`` by ``star_packets``).

    A key costs its bucket as many places as there were chunks, however many owners it has.
    """

    def star(rows: list[tuple]) -> pa.RecordBatch:
        owner, known, key = unpacked(rows)
        edge = known == 1
        _, _, u, v = _stars(owner[~edge], key[~edge])
        u, v = np.concatenate([u, owner[edge]]), np.concatenate([v, key[edge].view(np.int64)])
        return packed(bucket_of(u.view(np.uint64), buckets), u, np.zeros(len(u), np.int32), v.view(np.uint64))

    def edges(rows: list[tuple]) -> pa.RecordBatch:
        """What an owner's keys in many buckets say alike becomes one row."""
        owner, _, head = unpacked(rows, np.int64)
        return pair_batch(*np.unique(np.column_stack([owner, head]), axis=0).T)

    return by_bucket(by_bucket(shipped, star, PACKET, buckets), edges, LINKS, buckets)


def components(edges: DataFrame, one_task_edges: int = 1 << 20) -> DataFrame:
    """``u``, ``root`` for every vertex of ``edges`` (``u``, ``v``) but the roots, which are the least of their components.

    Up to ``one_task_edges`` edges (two numbers each, 16 MB at most) are joined by one
    executor task; more by alternating large and small stars, which no task sees whole.
    """
    e = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.count() <= one_task_edges:
        return checkpoint(e.coalesce(1).mapInArrow(_united, "u bigint, root bigint"))
    state = None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.withColumnRenamed("v", "root")
        state = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = checkpoint(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(small.union(least.withColumnRenamed("m", "v")).distinct())


class Sets:
    """Disjoint sets of numbers; the least of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, i: int) -> int:
        while (up := self.parent.setdefault(i, i)) != i:
            self.parent[i] = self.parent[up]
            i = up
        return i

    def join(self, i: int, j: int) -> bool:
        """Were they apart?"""
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = Sets()
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(u, v)
    found = [(i, r) for i in sets.parent if (r := sets.root(i)) != i]
    yield pair_batch(np.array([i for i, _ in found], np.int64), np.array([r for _, r in found], np.int64), ("u", "root"))


def part_links(parts: DataFrame, forest: Forest) -> DataFrame:
    """``u``, ``v``: spanning links of each part (``part``, ``id``, ``body``), a part at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, bodies = None, [], []

        def settle() -> pa.RecordBatch:
            pairs = np.array(forest(ids, bodies) if len(ids) > 1 else [], np.int64).reshape(-1, 2)
            return pair_batch(pairs[:, 0], pairs[:, 1])

        for batch in batches:
            for p, i, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    yield settle()
                    part, ids, bodies = p, [], []
                ids.append(i)
                bodies.append(b)
        yield settle()

    n = shuffle_partitions(parts.sparkSession)
    return parts.select("part", "id", "body").repartition(n, "part").sortWithinPartitions("part").mapInArrow(run, LINKS)


def bounded(table: DataFrame, rows: int) -> DataFrame:
    """``table`` to be broadcast if it has ``rows`` rows at most, as it is otherwise."""
    return F.broadcast(table) if table.count() <= rows else table


def group_links(members: DataFrame, forest: Forest, size: int, broadcast_groups: int = 100_000) -> DataFrame:
    """``u``, ``v``: links that connect exactly the members of each group which true links connect (``members``: ``group``, ``id``, ``body``; checkpointed).

    Parts are numbered by hashes; those that clash are compared with each other in vain.
    The sizes of large groups are broadcast if they are ``broadcast_groups`` rows at most, and joined by shuffling otherwise.
    """
    large = checkpoint(members.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > size))
    if not (any_large := large.count()):
        return part_links(members.withColumn("part", F.xxhash64("group")), forest)
    sizes = F.broadcast(large) if any_large <= broadcast_groups else large
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(n / F.lit(size))).cast("int")
    placed = members.join(sizes, "group", "left").withColumn("block", F.coalesce(spread(F.col("n"), 0), F.lit(0)))
    found = checkpoint(part_links(placed.withColumn("part", F.xxhash64("group", "block")), forest))
    split = checkpoint(members.join(sizes, "group").withColumn("block", spread(F.col("n"), 0)))

    def standing(links: DataFrame) -> DataFrame:
        """The members of large groups with their components so far."""
        roots = components(links).withColumnsRenamed({"u": "id", "root": "component"})
        return split.select("group", "id", "block").join(roots, "id", "left").withColumn("component", F.coalesce("component", "id"))

    salt, left = 0, math.inf
    while True:
        state = checkpoint(standing(found))
        heads = state.groupBy("group", "component").agg(F.min("id").alias("id"), F.count("*").alias("k"))
        apart = checkpoint(heads.join(bounded(heads.groupBy("group").agg(F.count("*").alias("heads")).where("heads > 1"), broadcast_groups), "group"))
        n = apart.count()
        if not n:
            return found
        if n > left / 2:
            break
        # One member of each component for it, in new parts.
        salt, left = salt + 1, n
        chosen = split.select("group", "id", "body").join(apart.select("group", "id", "heads"), ["group", "id"])
        more = part_links(chosen.withColumn("block", spread(F.col("heads"), salt)).withColumn("part", F.xxhash64("group", "block")), forest)
        found = checkpoint(found.union(more).coalesce(shuffle_partitions(members.sparkSession)))
    # The largest component of each group stays; all others meet every member of the group.
    sums = apart.groupBy("group").agg(F.max(F.struct("k", "component"))["component"].alias("main"), F.sum("k").alias("all"), F.max("k").alias("most"))
    sums = sums.select("group", "main", "all", (F.col("all") - F.col("most")).alias("strays"), F.ceil(F.col("all") / F.lit(size)).cast("int").alias("blocks"))
    rest = checkpoint(state.join(bounded(sums, broadcast_groups), "group").withColumn("stray", spread(F.col("strays"), -1)))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Where most are strays, every two blocks meet; otherwise the strays' blocks meet all blocks.
    many = F.col("strays") * 2 > F.col("all")
    pairs = rest.where(many).withColumn("other", others).select("group", "id", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    strays = rest.where(~many & (F.col("component") != F.col("main"))).select("group", "id", "stray", others.alias("block"))
    every = rest.where(~many).select("group", "id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("strays") / F.lit(size)).cast("int") - 1)).alias("stray"), "block")
    places = pairs.union(strays).union(every).distinct()
    met = places.join(split.select("group", "id", "body"), ["group", "id"]).withColumn("part", F.xxhash64("group", "low", "high"))
    return found.union(part_links(met, forest))
