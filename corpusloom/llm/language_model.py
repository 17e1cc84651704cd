"""Language-model scoring by context-tree weighting, beside an exact unigram baseline.

Texts are bytes (A-Z lower-cased) with an end mark.  Each byte is eight binary
decisions; each decision has a tree over the preceding bytes down to ``depth``.
Every node holds a Krichevsky-Trofimov estimate, and the tree weights them: half
to the node's own estimate, half to its children's product, bottom up.  A text's
score is the sum of the log10 probabilities of its bytes; a context that training
has not seen is judged at the deepest one that it has.

Counts come from all training texts: substring counts are made per task and summed
in a shuffle that grows with the corpus.  The tree keeps all of them: contexts of up to
two bytes are in one table (UTF-8 has a bounded number of them), longer ones in shards
by their last three bytes, which are weighted shard by shard; the driver holds none of it.
The ``max_grams`` most frequent substrings are looked up in the task; all others are
shuffled to their shards, with the same values.

The baseline needs each token's corpus count.  The most frequent tokens, as many as
``hot_words`` bytes hold, are looked up in the task; all other tokens are shuffled to
the counts, exactly.

Defined results: null counts as the empty text, which consists of its end; repeated
rows get equal results and each counts in training; without training texts every
bit has probability 1/2; given columns with the names of results are replaced, all
others stay, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import LOWER_BYTES, checkpoint, chunks, encoded, plus, quoted, scratch, shuffle_partitions

MARK = 0xFF  #: never in UTF-8: stands before and at the end of each text
WORD_COST = 64  #: bytes that a word in a table costs beside its own
TOP = 2  #: contexts of up to so many bytes are in one table, longer ones in shards
SHARDS = 4  #: for each shuffle partition
_NONE = np.uint64(2**64 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def keys_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The last ``depth`` bytes and the byte itself, as one number, for each byte and end of the texts; where each text begins."""
    lead = bytes([MARK]) * depth
    x = np.frombuffer(b"".join(lead + t.translate(LOWER_BYTES) + bytes([MARK]) for t in texts), np.uint8).astype(np.uint64)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(size) - size
    keys = x[depth:].copy()
    for back in range(1, depth + 1):
        keys |= x[depth - back : len(x) - back] << np.uint64(8 * back)
    whole = size + depth
    at = np.repeat(np.cumsum(whole) - whole - starts, size) + np.arange(size.sum())
    return keys[at], starts


def counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if n is not None and len(first) else np.diff(np.append(first, len(keys)))


def gram_counts(texts: DataFrame, depth: int, top: int, shards: int, chunk: int = 2 << 20) -> DataFrame:
    """``shard``, ``gram`` and ``n`` over all texts (the frame's only column); a shard's rows are in one partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["gram", "n"])
        for batch in batches:
            part = encoded(batch.column(0))
            for a, b in chunks(part, chunk):
                k, m = counted(keys_of(part[a:b], depth)[0])
                keys, n = counted(np.concatenate([keys, k]), np.concatenate([n, m]))
            if len(keys) > 1 << 20:
                yield out()
                keys, n = keys[:0], n[:0]
        yield out()

    rows = texts.mapInArrow(run, "gram bigint, n bigint").withColumn("shard", shard_of(F.col("gram"), top, shards))
    return rows.repartition(shuffle_partitions(texts.sparkSession), "shard").groupBy("shard", "gram").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts; words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array([*counts.keys()], pa.binary()), pa.array([*counts.values()], pa.int64())], names=["word", "n"])
        for batch in batches:
            for text in encoded(batch.column(0)):
                counts.update(text.translate(LOWER_BYTES).split())
                if len(counts) > 250_000:
                    yield out()
                    counts.clear()
        yield out()

    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma by Stirling's series, shifted to 8 and above; a piece at a time, to spare memory."""
    if len(x) > 1 << 17:
        return np.concatenate([_log_gamma(x[i : i + (1 << 17)]) for i in range(0, len(x), 1 << 17)])
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


@dataclass
class Tree:
    """For each depth the nodes (context, bits so far) and the probability of a 1 where no deeper node is known."""

    nodes: list[np.ndarray]
    ones: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.nodes) - 1

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 P(last byte | bytes before) for each gram."""
        byte = grams & np.uint64(255)
        total = np.zeros(len(grams))
        for b in range(8):
            node = np.uint64(1 << b) | (byte >> np.uint64(8 - b))
            p, open_ = np.full(len(grams), 0.5), np.arange(len(grams))
            for d in reversed(range(self.depth + 1)):
                if not len(open_) or not len(self.nodes[d]):
                    continue
                context = (grams[open_] >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)
                key = (context << np.uint64(8)) | node[open_]
                at = np.minimum(np.searchsorted(self.nodes[d], key), len(self.nodes[d]) - 1)
                there = self.nodes[d][at] == key
                p[open_[there]] = self.ones[d][at[there]]
                open_ = open_[~there]
            bit = (byte >> np.uint64(7 - b)) & np.uint64(1)
            total += np.log10(np.clip(np.where(bit == 1, p, 1 - p), 1e-12, 1))
        return total


def node_counts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes (context, bits so far) of substrings of one length, ascending, with their counts of zeros and ones."""
    parts = []
    for b in range(8):
        byte = keys & np.uint64(255)
        key = ((keys >> np.uint64(8)) << np.uint64(8)) | np.uint64(1 << b) | (byte >> np.uint64(8 - b))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        one = n * ((byte >> np.uint64(7 - b)) & np.uint64(1)).astype(np.int64)
        parts.append((key[first], np.add.reduceat(n, first) if len(first) else n, np.add.reduceat(one, first) if len(first) else one))
    key, all_n, one = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key)
    ones = one[order].astype(np.float64)
    return key[order], all_n[order].astype(np.float64) - ones, ones


def _places(nodes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted nodes stand among ``nodes``, which must have them all."""
    at = np.minimum(np.searchsorted(nodes, wanted), max(0, len(nodes) - 1))
    if len(wanted) and (not len(nodes) or (nodes[at] != wanted).any()):
        raise ValueError("a node of the context tree has no parent")
    return at


class Levels:
    """Consecutive depths of the tree, from ``first`` on, with their weights.

    ``below`` has the sums of the weighted logarithms of deeper nodes that are held
    elsewhere, by their parents in the last depth.
    """

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], first: int = 0, below: tuple[np.ndarray, np.ndarray] | None = None):
        self.first = first
        self.nodes, self.zeros, self.ones = (list(x) for x in zip(*(node_counts(*g) for g in grams), strict=True))
        last = len(grams) - 1
        self.parent: list[np.ndarray] = [np.zeros(0, np.int64)] * len(grams)
        self.stay: list[np.ndarray] = [np.zeros(0)] * len(grams)
        for d in reversed(range(len(grams))):
            a, b, size = self.zeros[d], self.ones[d], len(self.nodes[d])
            own = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)
            if d < last:
                at = self.parent[d + 1] = _places(self.nodes[d], self.above(d + 1))
                deeper = self.weighted
            else:
                at, deeper = (_places(self.nodes[d], below[0]), below[1]) if below else (np.zeros(0, np.int64), np.zeros(0))
            under = np.bincount(at, deeper, minlength=size) if size else np.zeros(0)
            inner = np.bincount(at, minlength=size) > 0 if size else np.zeros(0, bool)
            both = np.logaddexp(own, under) - math.log(2)
            self.weighted = np.where(inner, both, own)
            self.stay[d] = np.where(inner, np.exp(np.minimum(0, own - math.log(2) - both)), 1.0)

    def above(self, d: int) -> np.ndarray:
        """The parents of the nodes of the ``d``-th depth held."""
        return self.nodes[d] & np.uint64((1 << (8 * (self.first + d))) - 1)

    def final(self, given: np.ndarray | None = None, left: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The probability of a 1 at each node, and what each node of the last depth hands to deeper ones: the share ``given`` by shallower nodes, and the weight ``left``."""
        given = np.zeros(len(self.nodes[0])) if given is None else given
        left = np.ones(len(self.nodes[0])) if left is None else left
        out = []
        for d in range(len(self.nodes)):
            if d:
                given, left = given[self.parent[d]], left[self.parent[d]]
            kt = (self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1)
            out.append(given + left * kt)
            given, left = given + left * self.stay[d] * kt, left * (1 - self.stay[d])
        return out, given, left


def tree(levels: list[tuple[np.ndarray, np.ndarray]]) -> Tree:
    """The weighted tree of the substring counts of each length (index: number of context bytes), keys ascending."""
    built = Levels(levels)
    return Tree(built.nodes, built.final()[0])


class Lookup:
    """Gram to log10 probability: a table with open addressing for grams seen in training, the tree for others."""

    def __init__(self, grams: np.ndarray, values: np.ndarray, fallback: Tree | None):
        self.fallback, self.shift = fallback, np.uint64(64 - max(10, int(4 * len(grams)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), _NONE)
        self.values = np.zeros(len(self.keys), np.float32)
        self.mask = np.int64(len(self.keys) - 1)
        waiting, slot = np.arange(len(grams)), ((grams * _SPREAD) >> self.shift).astype(np.int64)
        while len(waiting):
            free = np.flatnonzero(self.keys[slot] == _NONE)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = grams[waiting[put]], values[waiting[put]]
            rest = np.ones(len(waiting), bool)
            rest[put] = False
            waiting, slot = waiting[rest], (slot[rest] + 1) & self.mask

    def known(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values from the table, 0 for grams that it doesn't hold, and the places of those."""
        slot = ((grams * _SPREAD) >> self.shift).astype(np.int64)
        there = self.keys[slot]
        out = self.values[slot].astype(np.float64)
        wrong = np.flatnonzero(there != grams)
        new: list[np.ndarray] = [np.zeros(0, np.int64)]
        slot = slot[wrong]
        while len(wrong):
            there = self.keys[slot]
            hit, gone = there == grams[wrong], there == _NONE
            out[wrong[hit]] = self.values[slot[hit]]
            new.append(wrong[gone])
            wrong, slot = wrong[~hit & ~gone], (slot[~hit & ~gone] + 1) & self.mask
        at = np.concatenate(new)
        out[at] = 0
        return out, at

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        out, at = self.known(grams)
        if len(at):
            distinct, back = np.unique(grams[at], return_inverse=True)
            out[at] = self.fallback.log10(distinct)[back]
        return out


def shard_of(gram: Column, top: int, shards: int) -> Column:
    """The shard of a substring: by the ``top`` + 1 bytes before its last, so that a subtree below depth ``top`` is in one shard."""
    return F.pmod(F.hash(F.shiftrightunsigned(gram, 8).bitwiseAND((1 << (8 * (top + 1))) - 1)), F.lit(shards))


def write_levels(grams: DataFrame, folder: str, top: int) -> None:
    """The substring counts of each length up to ``top`` bytes of context, as tables in ``folder``."""
    for d in range(top + 1):
        grams.groupBy(F.col("gram").bitwiseAND((1 << (8 * (d + 1))) - 1).alias("gram")).agg(F.sum("n").alias("n")).write.parquet(f"{folder}/level-{d}")


def _by_shard(batches: Iterable[pa.RecordBatch], top: int, depth: int) -> Iterator[tuple[int, Levels, np.ndarray, np.ndarray]]:
    """The shards of a task's rows (``shard``, ``gram``, ``n``): the depths below ``top``, and the substrings with their counts."""
    table = pa.Table.from_batches(batches) if (batches := [*batches]) else None
    if table is None or not table.num_rows:
        return
    shards, keys, n = table["shard"].to_numpy(), table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    order = np.lexsort((keys, shards))
    shards, keys, n = shards[order], keys[order], n[order]
    first = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
    for a, b in zip(first, [*first[1:], len(shards)], strict=True):
        levels = [counted(keys[a:b] & np.uint64((1 << (8 * (d + 1))) - 1), n[a:b]) for d in range(top + 1, depth)]
        yield int(shards[a]), Levels([*levels, (keys[a:b], n[a:b])], top + 1), keys[a:b], n[a:b]


def _array(folder: str, name: str) -> np.ndarray:
    filesystem, root = pafs.FileSystem.from_uri(folder)
    return pq.read_table(f"{root}/{name}.parquet", filesystem=filesystem)["x"].to_numpy()


def _top(folder: str, top: int) -> Tree:
    return Tree([_array(folder, f"model/nodes-{d}") for d in range(top + 1)], [_array(folder, f"model/ones-{d}") for d in range(top + 1)])


def build(grams: DataFrame, folder: str, top: int, depth: int) -> DataFrame:
    """The weighted tree of all substrings, written to ``folder``: the depths up to ``top`` by one task, all deeper ones by shards.

    One to three bytes of UTF-8 make a bounded number of substrings, whatever the
    corpus; everything longer stays in shards, whose number grows with it.
    Returned are ``gram``, ``n``, ``value`` (log10 of its probability), and a row for each shard with the ``file`` that has its nodes.
    """
    spark = grams.sparkSession

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, _, _ in _by_shard(batches, top, depth):
            above, back = np.unique(part.above(0), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(above.astype(np.int64)), pa.array(np.bincount(back, part.weighted))], names=["node", "below"])

    grams.mapInArrow(sums, "node bigint, below double").groupBy("node").agg(F.sum("below").alias("below")).write.parquet(f"{folder}/below")

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            filesystem, root = pafs.FileSystem.from_uri(folder)
            levels = []
            for d in range(top + 1):
                table = pq.read_table(f"{root}/level-{d}", filesystem=filesystem)
                keys = table["gram"].to_numpy().astype(np.uint64)
                order = np.argsort(keys)
                levels.append((keys[order], table["n"].to_numpy()[order]))
            table = pq.read_table(f"{root}/below", filesystem=filesystem)
            built = Levels(levels, 0, (table["node"].to_numpy().astype(np.uint64), table["below"].to_numpy()))
            ones, given, left = built.final()
            tables = {"given": given, "left": left} | {f"nodes-{d}": x for d, x in enumerate(built.nodes)} | {f"ones-{d}": x for d, x in enumerate(ones)}
            attempt = uuid.uuid4().hex
            filesystem.create_dir(f"{root}/model-{attempt}")
            for name, x in tables.items():
                pq.write_table(pa.table({"x": x}), f"{root}/model-{attempt}/{name}.parquet", filesystem=filesystem)
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    # Which attempt counts is what the accepted task says; another attempt's files are left aside.
    attempt = spark.range(1).coalesce(1).mapInArrow(first, "attempt string").first().attempt
    filesystem, root = pafs.FileSystem.from_uri(folder)
    filesystem.move(f"{root}/model-{attempt}", f"{root}/model")
    filesystem.create_dir(f"{root}/shards")

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        name, tables, above = uuid.uuid4().hex, [], None
        for shard, part, keys, n in _by_shard(batches, top, depth):
            if above is None:
                above, given, left = _top(folder, top), _array(folder, "model/given"), _array(folder, "model/left")
            at = _places(above.nodes[top], part.above(0))
            ones = part.final(given[at], left[at])[0]
            value = Tree([*above.nodes, *part.nodes], [*above.ones, *ones]).log10(keys)
            for d, (nodes, x) in enumerate(zip(part.nodes, ones, strict=True)):
                tables.append(pa.table({"shard": np.full(len(nodes), shard, np.int32), "depth": np.full(len(nodes), d, np.int8), "node": nodes, "one": x}))
            none, size = pa.nulls(len(keys), pa.string()), len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, shard, np.int32)), none, pa.array(keys.astype(np.int64)), pa.array(n), pa.array(value)], names=["shard", "file", "gram", "n", "value"])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([name]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64())], names=["shard", "file", "gram", "n", "value"])
        if tables:
            pq.write_table(pa.concat_tables(tables), f"{root}/shards/{name}.parquet", filesystem=filesystem)

    return checkpoint(grams.mapInArrow(rest, "shard int, file string, gram bigint, n bigint, value double"))


def most_frequent(counts: DataFrame, size: Column, limit: int) -> DataFrame:
    """The rows with the largest ``n`` whose sizes have a sum of ``limit`` at most: those from a threshold on, found in a histogram of 64 cells an octave."""
    cell = F.floor(F.log2("n") * 64)
    sums = sorted(((r.cell, r.size) for r in counts.groupBy(cell.alias("cell")).agg(F.sum(size).alias("size")).collect()), reverse=True)
    least, kept = math.inf, 0
    for at, more in sums:
        kept += more
        if kept > limit:
            break
        least = at
    return counts.where(cell >= least) if least < math.inf else counts.limit(0)


def judged(asked: DataFrame, folder: str, files: dict[int, str], top: int, depth: int) -> DataFrame:
    """``row`` and the sum ``add`` of ``k`` times the log10 probability, for rows of ``shard``, ``row``, ``gram``, ``k``, which meet their shards' subtrees."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        above, held = None, {}

        def subtree(shard: int) -> Tree:
            if shard not in held:
                part = pq.read_table(f"{root}/shards/{files[shard]}.parquet", filesystem=filesystem, filters=[("shard", "=", shard)]) if shard in files else None
                deeper = [(np.zeros(0, np.uint64), np.zeros(0))] * (depth - top)
                if part is not None:
                    at, node, one = part["depth"].to_numpy(), part["node"].to_numpy(), part["one"].to_numpy()
                    deeper = [(node[at == d], one[at == d]) for d in range(depth - top)]
                held[shard] = Tree([*above.nodes, *(x for x, _ in deeper)], [*above.ones, *(x for _, x in deeper)])
            return held[shard]

        for batch in batches:
            above = above or _top(folder, top)
            shards, grams, k = batch.column(0).to_numpy(), batch.column(2).to_numpy().astype(np.uint64), batch.column(3).to_numpy()
            add = np.zeros(len(k))
            for shard in np.unique(shards):
                at = np.flatnonzero(shards == shard)
                distinct, back = np.unique(grams[at], return_inverse=True)
                add[at] = subtree(int(shard)).log10(distinct)[back]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(add * k)], names=["row", "add"])

    return asked.select("shard", "row", "gram", "k").repartition(shuffle_partitions(asked.sparkSession), "shard").mapInArrow(run, "row binary, add double")


def load(folder: str) -> tuple[Lookup, dict[bytes, int], np.ndarray]:
    """The frequent substrings' values, and the hot words' numbers and logarithms, read from the shared folder by a worker."""
    filesystem, root = pafs.FileSystem.from_uri(folder)
    grams = pq.read_table(f"{root}/hot-grams", filesystem=filesystem)
    hot = pq.read_table(f"{root}/hot", filesystem=filesystem)
    n = hot["n"].to_numpy()
    look = Lookup(grams["gram"].to_numpy().astype(np.uint64), grams["value"].to_numpy(), None)
    return look, dict(zip(hot["word"].to_pylist(), range(len(n)), strict=True)), np.log10(np.append(n, 0) + 1.0)


_held: dict[str, object] = {}


def _once(name: str, make):  # noqa: ANN001, ANN202
    """``make()``, kept for later tasks of this Python worker; only the latest is kept."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


RESULTS = ["n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def score(docs: DataFrame, teaches: str, columns: list[str], text: str = "text", depth: int = 5, max_grams: int = 1 << 19, hot_words: int = 24 << 20, chunk: int = 2 << 20) -> DataFrame:
    """``columns`` with ``RESULTS``, in place of any such columns.

    Texts where the boolean column ``teaches`` holds are the training corpus.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "language-model")
    train = docs.where(quoted(teaches)).select(F.coalesce(quoted(text), F.lit("")).alias("text"))
    n_train = train.count()
    top = min(TOP, depth - 1)
    shards = SHARDS * shuffle_partitions(spark)
    grams = checkpoint(gram_counts(train, depth, top, shards))
    write_levels(grams, folder, top)
    valued = build(grams, folder, top, depth)
    files = {r.shard: r.file for r in valued.where("file is not null").select("shard", "file").collect()}
    most_frequent(valued.where("gram is not null"), F.lit(1), max_grams).select("gram", F.col("value").cast("float").alias("value")).repartition(8).write.parquet(f"{folder}/hot-grams")
    counts = checkpoint(word_counts(train))
    kinds, words = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tokens, kinds = words + n_train, kinds + (n_train > 0)
    most_frequent(counts, F.octet_length("word") + WORD_COST, hot_words).repartition(8).write.parquet(f"{folder}/hot")

    kept = [c for c in columns if c not in RESULTS]
    given = docs.select(F.struct(*map(quoted, kept)).alias("given"), quoted(text).alias("text"))
    schema = plus(given.select("given"), "row binary, n_bytes bigint, n_words bigint, known bigint, logs double, score double, rest array<struct<word:binary,n:bigint>>, grams array<struct<gram:bigint,n:bigint>>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, hot_at, hot_log = _once(folder, lambda: load(folder))
        for batch in batches:
            texts = encoded(batch.column(1))
            for a, b in chunks(texts, chunk):
                keys, starts = keys_of(texts[a:b], depth)
                values, miss = look.known(keys)
                total = np.add.reduceat(values, starts)
                text_of = np.searchsorted(starts, miss, side="right") - 1
                order = np.lexsort((keys[miss], text_of))
                missed, text_of = keys[miss][order], text_of[order]
                first = np.flatnonzero(np.append(True, (missed[1:] != missed[:-1]) | (text_of[1:] != text_of[:-1]))) if len(miss) else miss
                grams = pa.StructArray.from_arrays([pa.array(missed[first].astype(np.int64)), pa.array(np.diff(np.append(first, len(missed))))], ["gram", "n"])
                gram_ends = np.searchsorted(text_of[first], np.arange(b - a + 1)).astype(np.int32)
                n_words, known, logs, cold_words, cold_n, ends = [], [], [], [], [], [0]
                for t in texts[a:b]:
                    words = t.translate(LOWER_BYTES).split()
                    at = np.fromiter(map(hot_at.get, words, repeat(-1)), np.int64, len(words))
                    cold = np.flatnonzero(at < 0)
                    n_words.append(len(words))
                    known.append(len(words) - len(cold))
                    logs.append(float(hot_log[at].sum()))
                    rest = Counter(words[i] for i in cold)
                    cold_words += rest.keys()
                    cold_n += rest.values()
                    ends.append(len(cold_n))
                ids = uuid.uuid4().bytes
                rest = pa.StructArray.from_arrays([pa.array(cold_words, pa.binary()), pa.array(cold_n, pa.int64())], ["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b], pa.array([ids + i.to_bytes(4, "big") for i in range(b - a)], pa.binary()), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(n_words, pa.int64()),
                        pa.array(known, pa.int64()), pa.array(logs, pa.float64()), pa.array(total), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest),
                        pa.ListArray.from_arrays(pa.array(gram_ends), grams),
                    ],
                    names=schema.names,
                )

    # The rows' own ids are written once, here, and never made again.
    part = checkpoint(given.mapInArrow(run, schema))
    cold = part.select("row", F.explode("rest").alias("x")).select("row", F.col("x.word").alias("word"), F.col("x.n").alias("k")).join(counts, "word")
    cold = cold.select("row", F.col("k").alias("known"), (F.col("k") * F.log10(F.col("n") + 1.0)).alias("logs"), F.lit(0.0).alias("add"))
    asked = part.select("row", F.explode("grams").alias("x")).select("row", "x.gram", F.col("x.n").alias("k")).withColumn("shard", shard_of(F.col("gram"), top, shards))
    cold = cold.union(judged(asked, folder, files, top, depth).select("row", F.lit(0).cast("bigint"), F.lit(0.0), "add"))
    cold = cold.groupBy("row").agg(F.sum("known").alias("cold_known"), F.sum("logs").alias("cold_logs"), F.sum("add").alias("cold_score"))
    end_log = math.log10(n_train + 1)
    n_tokens = F.col("n_words") + 1
    logs = F.col("logs") + F.coalesce("cold_logs", F.lit(0.0)) + F.lit(end_log)
    score = F.col("score") + F.coalesce("cold_score", F.lit(0.0))
    return part.drop("rest", "grams").join(cold, "row", "left").select(
        *(F.col(f"given.`{c}`") for c in kept), "n_bytes", n_tokens.alias("n_tokens"), (F.col("known") + F.coalesce("cold_known", F.lit(0)) + F.lit(int(n_train > 0))).cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), (logs - n_tokens * F.lit(math.log10(tokens + kinds + 1))).alias("base_score"), score.alias("score"),
        (-score * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
