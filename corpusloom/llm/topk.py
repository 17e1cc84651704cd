"""Exact top-k by inner product: norm-sorted blocks, partial sums in rotated coordinates, Cauchy-Schwarz bounds.

Vectors are rows of whole numbers.  The Gram matrix of all vectors, summed over partitions, gives a rotation (its
eigenvectors, the right singular vectors of the table), after which the first coordinates hold most of the length.
Candidates are sorted by descending length and packed in blocks, queries are packed in blocks too, and blocks meet:

1. every query block meets the block of the longest vectors, which gives each query a score that its k-th best
   reaches at least;
2. it then meets the ranges of candidates whose longest vector, times the query's length, can reach that score.

Where blocks meet, candidates come in descending length, a chunk at a time: queries whose score no length of the rest
can reach are done; the others take partial sums over the first coordinates, to which the product of the residual
lengths is added as a bound; what passes gets its exact inner product.  Bounds have a margin well above the rounding
of doubles, and scores are doubles below 2^53 or Python's integers beyond, so results are exact.

Defined results: vectors null, or with null or non-finite components, take no part, nor do rows without an id;
missing components of shorter vectors count as 0, so empty vectors score 0; components beyond a long are cut to its
range; scores beyond 2^114 are equal, and those beyond a long are cut to its range after ranking; repeated rows each
take a rank, and each repeated query row gets ranks of its own, but a query never meets rows of its own id; ties go to
the smaller id; an empty table, or one without queries, gives no rows.  Other columns of the table aren't read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, groups_of, quoted, shuffle_partitions, summed

#: Rows of a block and its components at most, and rows of a chunk of candidates.
BLOCK, BLOCK_PARTS, CHUNK = 4096, 1 << 19, 512
#: Coordinates that are rotated; further ones stay as they are, and bounds hold all the same.
ROTATED = 1024
#: Sums of whole numbers below this are exact as doubles.
EXACT = 2.0**53
_LOW = 52
_PACKED = "longest double, ids binary, sizes binary, parts binary"
_ASK = "q_ids binary, q_sizes binary, q_parts binary"


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component x as a double; null if the vector, or a component, is missing or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many components each vector of an Arrow column has, and all components."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _matrix(sizes: np.ndarray, parts: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(sizes), width), parts.dtype)
    out[np.arange(width) < sizes[:, None]] = parts
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns, by descending share of the table's length; the table's Gram matrix is summed over its partitions."""
    size = min(width, ROTATED)

    def gram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            sizes, parts = _rows_of(batch.column(0))
            for at in range(0, len(sizes), CHUNK):
                ends = np.append(0, np.cumsum(sizes))
                x = _matrix(sizes[at : at + CHUNK], parts[ends[at] : ends[min(at + CHUNK, len(sizes))]], width)[:, :size].astype(np.float64)
                total += x.T @ x
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["blob"])

    blob = summed(vectors.select("v").mapInArrow(gram, "blob binary"), "blob") if size else None
    if blob is None:
        return np.eye(size)
    values, directions = np.linalg.eigh(blob.reshape(size, size))
    return directions[:, np.argsort(-values)]


def _packed(rows: DataFrame, width: int) -> DataFrame:
    """The rows of each partition, in their order, in blocks: the greatest length, and ids, sizes and components as bytes."""
    most = max(1, min(BLOCK, BLOCK_PARTS // max(1, width)))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            ids, (sizes, parts) = batch.column(0).to_numpy(zero_copy_only=False), _rows_of(batch.column(1))
            ends, at = np.append(0, np.cumsum(sizes)), 0
            while at < len(ids):
                to = min(len(ids), at + most - n)
                held.append((ids[at:to], sizes[at:to], parts[ends[at] : ends[to]]))
                n += to - at
                at = to
                if n == most:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    def block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, sizes, parts = (np.concatenate(x) for x in zip(*held, strict=True))
        longest = float(np.linalg.norm(_matrix(sizes, parts, width).astype(np.float64), axis=1).max())
        blobs = [ids.astype(np.int64).tobytes(), sizes.astype(np.int32).tobytes(), parts.astype(np.int64).tobytes()]
        return pa.record_batch([pa.array([longest]), *(pa.array([b], pa.binary()) for b in blobs)], ["longest", "ids", "sizes", "parts"])

    return rows.select("id", "v").mapInArrow(pack, _PACKED)


def _unpacked(ids: bytes, sizes: bytes, parts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), _matrix(np.frombuffer(sizes, np.int32), np.frombuffer(parts, np.int64), width)


class Search:
    """The best k of each query of a block, over any number of candidate blocks; ``least`` are scores that are known to be reached."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray, turned: np.ndarray, head: int, k: int) -> None:
        self.ids, self.whole, self.least, self.turned, self.head, self.k = ids, vectors, least.copy(), turned, head, k
        self.vectors = vectors.astype(np.float64)
        self.lengths, self.heads, self.rests = self._parts(self.vectors)
        # Scores as high and low bits, so that they sort as whole numbers; unfilled places are below all scores.
        self.high = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.low, self.names = np.zeros((len(ids), k), np.int64), np.zeros((len(ids), k), np.int64)
        #: Pairs that came to their partial sums, and to their exact products.
        self.summed = self.multiplied = 0

    def _parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, first rotated coordinates, and lengths of the rest."""
        size = len(self.turned)
        heads = x[:, :size] @ self.turned[:, : self.head]
        lengths = np.linalg.norm(x, axis=1)
        return lengths, heads, np.sqrt(np.maximum(0.0, lengths**2 - np.einsum("ij,ij->i", heads, heads)) + 1e-9 * lengths**2)

    def meet(self, ids: np.ndarray, whole: np.ndarray) -> None:
        """Takes in a block of candidates, sorted by descending length."""
        vectors = whole.astype(np.float64)
        lengths, heads, rests = self._parts(vectors)
        for at in range(0, len(ids), CHUNK):
            cut = slice(at, at + CHUNK)
            live = np.flatnonzero(self.lengths * lengths[at:].max() * (1 + 1e-6) + 1 >= self.least)
            if not len(live):
                return
            self.summed += len(live) * len(ids[cut])
            bound = self.heads[live] @ heads[cut].T + np.outer(self.rests[live], rests[cut])
            bound += 1e-6 * np.outer(self.lengths[live], lengths[cut]) + 1
            q, c = np.nonzero((bound >= self.least[live, None]) & (self.ids[live, None] != ids[cut]))
            if len(q):
                self.multiplied += len(q)
                q, c = live[q], c + at
                self._take(q, ids[c], *self._products(q, vectors, whole, c))

    def _products(self, q: np.ndarray, vectors: np.ndarray, whole: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """High and low bits of the exact inner products."""
        if self.lengths.max() * np.linalg.norm(vectors[c[0] - c[0] % CHUNK :], axis=1).max() < EXACT:
            first = int(c.min())
            if 4 * len(q) > len(self.ids) * (int(c.max()) + 1 - first):
                x = (self.vectors @ vectors[first : int(c.max()) + 1].T)[q, c - first]
            else:
                x = np.concatenate([np.einsum("ij,ij->i", self.vectors[q[s : s + 65536]], vectors[c[s : s + 65536]]) for s in range(0, len(q), 65536)])
            x = x.astype(np.int64)
            return x >> _LOW, x & ((1 << _LOW) - 1)
        most = 1 << 114
        exact = [max(-most, min(most, sum(a * b for a, b in zip(self.whole[i].tolist(), whole[j].tolist(), strict=True)))) for i, j in zip(q.tolist(), c.tolist(), strict=True)]
        return np.array([x >> _LOW for x in exact], np.int64), np.array([x & ((1 << _LOW) - 1) for x in exact], np.int64)

    def _take(self, q: np.ndarray, names: np.ndarray, high: np.ndarray, low: np.ndarray) -> None:
        """Puts pairs into the best of their queries."""
        asked = np.unique(q)
        q = np.concatenate([q, np.repeat(asked, self.k)])
        names, high, low = (np.concatenate([x, own[asked].ravel()]) for x, own in ((names, self.names), (high, self.high), (low, self.low)))
        order = np.lexsort((names, -low, -np.maximum(high, -(1 << 63) + 1), q))
        first, sizes = groups_of(q[order])
        place = np.arange(len(order)) - np.repeat(first, sizes)
        kept, place = order[place < self.k], place[place < self.k]
        self.high[q[kept], place], self.low[q[kept], place], self.names[q[kept], place] = high[kept], low[kept], names[kept]
        full = asked[self.high[asked, -1] != np.iinfo(np.int64).min]
        self.least[full] = np.maximum(self.least[full], below(self.high[full, -1], self.low[full, -1]))

    def best(self) -> list[np.ndarray]:
        """Numbers and ids of the queries, ids of their best, and the scores' bits."""
        i, place = np.nonzero(self.high != np.iinfo(np.int64).min)
        return [i.astype(np.int32), self.ids[i], self.names[i, place], self.high[i, place], self.low[i, place]]


def below(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Doubles that are at most the scores."""
    x = high.astype(np.float64) * 2.0**_LOW + low
    return x - np.abs(x) * 4e-16


def search(table: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, head_share: float = 0.25) -> DataFrame:
    """The best ``k`` rows of ``table`` for each row that ``queries`` marks: query_id, rank (from 1), vec_id, score.

    ``head_share`` of the rotated coordinates make the partial sums.
    """
    spark, n = table.sparkSession, shuffle_partitions(table.sparkSession)
    named = table.select(quoted(key).alias("id"), whole_numbers(quoted(vector)).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = checkpoint(named.where("id is not null and v is not null").withColumn("row", F.monotonically_increasing_id()))
    width, asking = rows.agg(F.max(F.size("v")), F.count_if("asks")).first()
    if not asking:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    turned = rotation(rows, width)
    head = min(len(turned), max(1, int(len(turned) * head_share)))

    # A range of candidates is a partition in descending length; its blocks have ascending numbers c.
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    by_length = rows.withColumn("length", length).repartitionByRange(n, F.desc("length"), "row").sortWithinPartitions(F.desc("length"), "row")
    blocks = checkpoint(_packed(by_length, width).withColumns({"p": F.spark_partition_id(), "c": F.monotonically_increasing_id()}))
    ranges = sorted(blocks.groupBy("p").agg(F.max("longest").alias("longest"), F.min("c").alias("c")).collect())
    first = ranges[0].c
    asked = rows.where("asks").repartition(-(-asking // BLOCK), "row")
    asked = checkpoint(_packed(asked, width).select(F.monotonically_increasing_id().alias("q"), *(F.col(c).alias(f"q_{c}") for c in ("ids", "sizes", "parts"))))

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a query block, the block first (without ``c``) and then candidates' blocks, follow one another."""
        here, held = None, None
        for batch in batches:
            for q, _, c, least, ids, sizes, parts in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c is None:
                    if held is not None:
                        yield found(here, held)
                    ids, vectors = _unpacked(ids, sizes, parts, width)
                    here, held = q, Search(ids, vectors, np.frombuffer(least) if least else np.full(len(ids), -np.inf), turned, head, k)
                else:
                    held.meet(*_unpacked(ids, sizes, parts, width))
        if held is not None:
            yield found(here, held)

    def found(q: int, held: Search) -> pa.RecordBatch:
        best = held.best()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(best[0]), q)), *map(pa.array, best)], names=["q", "i", "query_id", "vec_id", "high", "low"])

    def met(asks: DataFrame, pairs: DataFrame) -> DataFrame:
        """``asks`` are query blocks by range, ``pairs`` the candidates' blocks that each of them meets."""
        own = asks.select("q", "p", F.lit(None).cast("bigint").alias("c"), "least", "q_ids", "q_sizes", "q_parts")
        others = pairs.select("q", "p", "c", F.lit(None).cast("binary").alias("least"), "ids", "sizes", "parts")
        dealt = own.union(others).repartition(n, "q", "p").sortWithinPartitions("q", "p", F.asc_nulls_first("c"))
        return dealt.mapInArrow(meet, "q bigint, i int, query_id bigint, vec_id bigint, high bigint, low bigint")

    # One block, of BLOCK_PARTS components at most, is broadcast.
    longest = F.broadcast(blocks.where(F.col("c") == first).drop("longest"))
    seeds = checkpoint(met(asked.withColumns({"p": F.lit(ranges[0].p), "least": F.lit(None).cast("binary")}), asked.select("q").crossJoin(longest)))
    reached = _reached(asked, seeds, width, k)
    # Ranges descend in length, so a query block meets the first of them, as many as are long enough.
    lengths = F.split(F.lit(",".join(repr(r.longest) for r in ranges)), ",").cast("array<double>")
    numbers = F.split(F.lit(",".join(str(r.p) for r in ranges)), ",").cast("array<int>")
    meets = F.slice(numbers, F.lit(1), F.size(F.filter(lengths, lambda x: x >= F.col("needs"))))
    asks = reached.withColumn("p", F.explode(meets))
    later = met(asks, asks.select("q", "p").join(blocks.where(F.col("c") != first), "p"))

    order = Window.partitionBy("q", "i").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    within = F.when(F.col("high") >= 2048, F.lit(2**63 - 1)).when(F.col("high") < -2048, F.lit(-(2**63))).otherwise(F.shiftleft("high", _LOW).bitwiseOR(F.col("low")))
    best = seeds.unionByName(later).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", within.alias("score"))


def _reached(asked: DataFrame, seeds: DataFrame, width: int, k: int) -> DataFrame:
    """The query blocks with ``least``, the scores their queries' k-th best reach, and ``needs``, the least length of a candidate that can matter to one of them."""
    kth = seeds.groupBy("q", "i").agg(F.count("*").alias("n"), F.min(F.struct("high", "low")).alias("x")).where(F.col("n") >= k)
    by_block = kth.groupBy("q").agg(F.collect_list(F.struct("i", "x.high", "x.low")).alias("seen"))

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, needs = [], []
            for ids, sizes, parts, seen in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_sizes", "q_parts", "seen")), strict=True):
                _, vectors = _unpacked(ids, sizes, parts, width)
                known = np.full(len(vectors), -np.inf)
                for x in seen or ():
                    known[x["i"]] = below(np.int64(x["high"]), np.int64(x["low"]))
                # A query needs candidates of at least this length; without k scores, or for one of 1 or less, any length.
                lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
                need = np.where(known > 1, (known - 1) * (1 - 2e-6) / np.maximum(lengths, 1.0), -1.0)
                least.append(known.tobytes())
                needs.append(float(need.min()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(least, pa.binary()), pa.array(needs, pa.float64())], names=["q", "q_ids", "q_sizes", "q_parts", "least", "needs"])

    return checkpoint(asked.join(by_block, "q", "left").mapInArrow(bound, f"q bigint, {_ASK}, least binary, needs double"))
