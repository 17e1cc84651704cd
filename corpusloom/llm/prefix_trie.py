"""Prefix trie of conversations, with sums over subtrees by heavy-path decomposition.

A node is a distinct sequence of first turns (role, text).  Nodes are named by depth and a 122-bit polynomial hash of
the turns' digests, which a two-pass scan makes for all prefixes of all conversations, however long; texts don't travel.

Heavy paths: a node's heavy child is the one with most members (ties: the smallest conversation), the others are
light, so there are at most log2(conversations) light nodes above any node.  A path ends in a node without children,
and has that node's smallest conversation for a name: its nodes are those of that conversation from its last light
node on.  Own values are summed by path; path totals go up to the paths they hang from, a level of light nodes a
round; then one scan makes the suffix sums along all path arrays, with the totals of light children at their places.

Keys that many rows share (the root, a common first turn, a long conversation) are few, as each holds a share of the
rows: their rows meet a broadcast table of at most ``HOT`` keys, the others a shuffle join.

Defined results: turns are in order of turn (null first), then role, then the text's SHA-256, so repeated rows are
turns of their own; null role or text is empty; rows without a conv_id take no part; a conversation of which no turn
is left ends at the root; an empty table gives no nodes; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, quoted, scratch, shuffle_partitions
from corpusloom.operators import scans

#: Keys with more than 1 / HOT of all rows are broadcast, so there are fewer than HOT.
HOT = 4096
_PRIME = (1 << 61) - 1
_BASES = (1_152_921_504_606_846_883 % _PRIME, 1_734_723_475_976_807_077 % _PRIME)
#: Ids that are joined before they are hashed.
_IDS = 4096
KEY = ["depth", "ha", "hb"]
PARENT = ["parent_depth", "parent_ha", "parent_hb"]


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Numbered turns of each conversation: conv_id, position (from 0), two 60-bit halves of the turn's digest, and the text's code points."""
    role_, text_ = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(quoted(conv_id).cast("bigint").alias("conv_id"), quoted(turn).alias("turn"), role_.alias("role"), F.sha2(text_, 256).alias("digest"), F.length(text_).cast("bigint").alias("chars"))
    numbered = scans.numbered(rows.where("conv_id is not null"), ["conv_id"], [F.asc_nulls_first("turn"), F.col("role"), F.col("digest")])
    whole = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "digest"), 256)
    half = lambda at: F.conv(F.substring(whole, at, 15), 16, 10).cast("bigint")
    return numbered.select("conv_id", F.col("__position").alias("position"), half(1).alias("a"), half(16).alias("b"), "chars")


def heads_for(conv_id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return (F.crc32(conv_id.cast("string")) % 6).cast("int")


def rebuilt(turns: DataFrame, spacing: int = 100) -> DataFrame:
    """Each conversation c as the first turns of conversation c - c % spacing, ``heads_for`` of them, and its own turns after as many; with a row of part -1 for the root."""
    convs = turns.select("conv_id").distinct().withColumns({"h": heads_for(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % spacing})
    # Five turns at most, for fewer than ``spacing`` conversations.
    first = turns.where((F.col("conv_id") % spacing == 0) & (F.col("position") < 5)).select(F.col("conv_id").alias("base"), "position", "a", "b", "chars")
    taken = convs.join(first, "base").where("position < h").select("conv_id", F.lit(0).alias("part"), "position", "a", "b", "chars")
    own = turns.where(F.col("position") >= heads_for(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "position", "a", "b", "chars")
    zero = F.lit(0).cast("bigint")
    return taken.unionByName(own).unionByName(convs.select("conv_id", F.lit(-1).alias("part"), *(zero.alias(c) for c in ("position", "a", "b", "chars"))))


def prefixes(sequence: DataFrame) -> DataFrame:
    """A row for each prefix of each conversation: its node, the node's parent (null for the root), and the code points of its last text."""
    order = [F.col(c) for c in ("conv_id", "part", "position")]
    rows = scans.in_ranges(sequence.select("conv_id", "part", "position", "a", "b", "chars"), order)

    def walk(state: tuple, batches: Iterable[pa.RecordBatch], out: list | None) -> Iterator[tuple]:
        """Rows of (conversation, turns so far, two hashes), from the state before the range."""
        conv, depth, ha, hb = state
        for batch in batches:
            ids, parts, a, b, chars = (batch.column(c).to_pylist() for c in ("conv_id", "part", "a", "b", "chars"))
            made = []
            for i, part in enumerate(parts):
                before = (depth, ha, hb) if part >= 0 else (None, None, None)
                if part < 0:
                    conv, depth, ha, hb = ids[i], 0, 0, 0
                else:
                    # A range may begin inside a conversation: its hash is then of the turns in the range.
                    conv, depth = ids[i], depth + 1
                    ha, hb = (ha * _BASES[0] + a[i] + 1) % _PRIME, (hb * _BASES[1] + b[i] + 1) % _PRIME
                if out is None:
                    made.append((conv, depth, ha, hb, *before, chars[i]))
            if out is None:
                yield made
        if out is not None:
            out.append((conv, depth, ha, hb))

    def summary(batches: Iterable[pa.RecordBatch]) -> tuple:
        """What the range ends with, and whether a conversation begins in it."""
        begins, out = [False], []

        def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                begins[0] = begins[0] or -1 in batch.column("part").to_pylist()
                yield batch

        for _ in walk((None, 0, 0, 0), seen(batches), out):
            pass
        return (*out[0], begins[0])

    def carry(state: tuple, part: tuple) -> tuple:
        *found, begins = part
        conv, depth, ha, hb = found
        if conv is None:
            return state
        if begins:
            return tuple(found)
        return conv, state[1] + depth, (state[2] * pow(_BASES[0], depth, _PRIME) + ha) % _PRIME, (state[3] * pow(_BASES[1], depth, _PRIME) + hb) % _PRIME

    names = ["conv_id", *KEY, *PARENT, "chars"]

    def emit(state: tuple, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in walk(state, batches, None):
            columns = list(zip(*made, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return scans.two_passes(rows, (None, 0, 0, 0), summary, carry, emit, ", ".join(f"{c} bigint" for c in names))


def lookup(rows: DataFrame, keys: list[str], table: DataFrame, own: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with the row of ``table`` (unique in ``own``) that their keys name.

    ``weight`` says how many rows have a key at most, ``total`` their sum: the keys with more than a
    share of 1 / HOT are broadcast.
    """
    named = table.withColumnsRenamed({o: f"__{o}" for o in own})
    same = [F.col(k) == F.col(f"__{o}") for k, o in zip(keys, own, strict=True)]
    hot = F.col(weight) * HOT > total
    gone = [f"__{o}" for o in own] + [weight]
    few = F.broadcast(named.where(hot))
    often = rows.join(few, same).drop(*gone)
    return often.unionByName(rows.join(few.select(*(f"__{o}" for o in own)), same, "left_anti").join(named.where(~hot), same).drop(*gone))


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's conversations in ascending order, comma-joined: ids are joined in sorted ranges, and a node's pieces hashed one after the other."""
    n = shuffle_partitions(ends.sparkSession)
    ranged = ends.select(*KEY, "conv_id").repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids = None, []

        def piece() -> pa.RecordBatch:
            return pa.record_batch([*(pa.array([k], pa.int64()) for k in here), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], [*KEY, "first", "ids"])

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != here or len(ids) == _IDS:
                    if ids:
                        yield piece()
                    here, ids = key, []
                ids.append(conv)
        if ids:
            yield piece()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, going, made = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == here:
                    going.update(b"," + ids.encode())
                    continue
                if here is not None:
                    made.append((*here, going.hexdigest()))
                here, going = key, hashlib.sha256(ids.encode())
            if made:
                yield rows_of(made)
                made = []
        if here is not None:
            yield rows_of([(*here, going.hexdigest())])

    def rows_of(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], names=[*KEY, "ends_sha256"])

    pieces = ranged.mapInArrow(join, "depth bigint, ha bigint, hb bigint, first bigint, ids string")
    return pieces.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, "depth bigint, ha bigint, hb bigint, ends_sha256 string")


def _suffix_sums(placed: DataFrame) -> DataFrame:
    """``n_leaves`` and ``saved_tokens`` of each node: sums of ``leaves`` and ``saved`` from it to the end of its path, by a scan of all path arrays backwards."""
    rows = scans.in_ranges(placed, [F.col("path"), F.desc("depth")])
    own = [c for c in rows.columns if c not in ("leaves", "saved")]

    def along(state: tuple, path: list, leaves: list, saved: list) -> Iterator[tuple]:
        here, x, y = state
        for p, a, b in zip(path, leaves, saved, strict=True):
            here, x, y = (p, x + a, y + b) if p == here else (p, a, b)
            yield here, x, y

    def summary(batches: Iterable[pa.RecordBatch]) -> tuple:
        first, state = None, (None, 0, 0)
        for batch in batches:
            path, leaves, saved = (batch.column(c).to_pylist() for c in ("path", "leaves", "saved"))
            first = path[0] if first is None and path else first
            for state in along(state, path, leaves, saved):  # noqa: B007
                pass
        return first, state

    def carry(state: tuple, part: tuple) -> tuple:
        first, (here, x, y) = part
        if here is None:
            return state
        return (here, x + state[1], y + state[2]) if first == here == state[0] else (here, x, y)

    def emit(state: tuple, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = list(along(state, *(batch.column(c).to_pylist() for c in ("path", "leaves", "saved"))))
            if sums:
                state = sums[-1]
            columns = list(zip(*sums, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *(pa.array(c, pa.int64()) for c in columns[1:])], names=[*own, "n_leaves", "saved_tokens"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in own) + ", n_leaves bigint, saved_tokens bigint"
    return scans.two_passes(rows, (None, 0, 0), summary, carry, emit, schema)


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the ``prefixes``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; ha and hb name a node, path its heavy path."""
    spark = rows.sparkSession
    rows = checkpoint(rows)
    none = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, ha bigint, hb bigint, path bigint"
    total = rows.count()
    if not total:
        return spark.createDataFrame([], none)

    # Nodes, and each one's heavy child: that with most members, of those the one with the smallest conversation.
    nodes = checkpoint(rows.groupBy(*KEY, *PARENT).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("node_conv"), F.max("chars").alias("chars")))
    n_nodes = nodes.count()
    best = F.max_by(F.struct(*KEY), F.struct("n_convs", -F.col("node_conv"))).alias("heavy")
    parents = checkpoint(nodes.where("parent_depth is not null").groupBy(*PARENT).agg(F.count("*").alias("n_children"), best))
    heavy = parents.select(*(F.col(f"heavy.{k}").alias(k) for k in KEY), F.lit(False).alias("light"))
    counts = parents.select(*(F.col(p).alias(k) for k, p in zip(KEY, PARENT, strict=True)), "n_children")
    nodes = nodes.join(heavy, KEY, "left").join(counts, KEY, "left")
    light = F.coalesce("light", F.lit(True)) & (F.col("depth") > 0)
    nodes = checkpoint(nodes.withColumn("light", light).fillna(0, ["n_children"]))

    # Each conversation's light nodes; it names a path if it is the smallest that ends in a node without children.
    flags = nodes.select(*KEY, "light", F.when(F.col("n_children") == 0, F.col("node_conv")).alias("leaf_conv"), "n_convs")
    flagged = lookup(rows.select("conv_id", *KEY), KEY, flags, KEY, "n_convs", total)
    depth = F.when(F.col("light"), F.col("depth")).otherwise(0)
    named = flagged.groupBy("conv_id").agg(F.max(depth).alias("head"), F.count_if("light").alias("level"), F.max(F.coalesce(F.col("leaf_conv") == F.col("conv_id"), F.lit(False))).alias("names"), F.count("*").alias("__rows"))
    paths = checkpoint(named.where("names").select(F.col("conv_id").alias("path"), "head", "level", "__rows"))
    on_path = lookup(rows.select("conv_id", *KEY), ["conv_id"], paths, ["path"], "__rows", total).where("depth >= head").withColumnRenamed("conv_id", "path")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
    placed = checkpoint(nodes.join(on_path, KEY).withColumns({"leaves": leaf, "saved": saved}).drop("light", "chars"))
    above = placed.select(*(F.col(k).alias(f"up_{k}") for k in KEY), F.col("node_conv").alias("parent_conv_id"), F.col("path").alias("parent_path"), F.col("n_children").alias("__children"))
    below = lookup(placed.where("depth > 0"), PARENT, above, [f"up_{k}" for k in KEY], "__children", n_nodes)
    top = placed.where("depth = 0").withColumns({"parent_conv_id": F.lit(None).cast("bigint"), "parent_path": F.lit(None).cast("bigint")})
    placed = checkpoint(below.unionByName(top))

    light_sums = _path_totals(placed).groupBy(*PARENT).agg(F.sum("leaves").alias("light_leaves"), F.sum("saved").alias("light_saved"))
    light_sums = light_sums.withColumnsRenamed(dict(zip(PARENT, KEY, strict=True)))
    valued = placed.join(light_sums, KEY, "left").withColumns({c: F.col(c) + F.coalesce(f"light_{c}", F.lit(0)) for c in ("leaves", "saved")})
    summed = _suffix_sums(valued.select(*KEY, "path", "node_conv", "parent_conv_id", "n_convs", "n_children", "leaves", "saved"))

    ends = rows.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("end")).select("conv_id", *(F.col(f"end.{k}").alias(k) for k in KEY))
    out = summed.join(digests(ends), KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    return out.select(F.col("node_conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "ha", "hb", "path")


def _path_totals(placed: DataFrame) -> DataFrame:
    """Totals of all light paths (``leaves``, ``saved``) with the node they hang from, the deepest level first: each round adds the totals below to the paths above."""
    spark = placed.sparkSession
    sums = placed.groupBy("path", "level").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    heads = placed.where("depth = head").select("path", "parent_path", *PARENT)
    table = checkpoint(sums.join(heads, "path"))
    folder, deepest = scratch(spark, "paths"), table.agg(F.max("level")).first()[0]
    for level in range(deepest, 0, -1):
        own = table.where(F.col("level") == level).drop("level")
        if level < deepest:
            hung = spark.read.schema(own.schema).parquet(f"{folder}/{level + 1}").groupBy(F.col("parent_path").alias("path")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            own = own.join(hung, "path", "left").select("path", "parent_path", *PARENT, *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")))
        own.select("path", "leaves", "saved", "parent_path", *PARENT).write.parquet(f"{folder}/{level}")
    whole = table.drop("level").select("path", "leaves", "saved", "parent_path", *PARENT)
    return spark.read.schema(whole.schema).parquet(*(f"{folder}/{level}" for level in range(1, deepest + 1))) if deepest else whole.limit(0)


def build(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(prefixes(rebuilt(checkpoint(turns_of(conversations)))))
