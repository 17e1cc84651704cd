"""Helpers shared by the operators: folds, byte buffers, word and window hashes, sums of partition blobs."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.plans.storage import checkpoint, scratch, shared_folder  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Bytes that separate words written as ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_BYTES = bytes(range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))

_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(buckets)).cast("int")


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(f"`{name}`")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def plus(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with further fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def encoded(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null becomes the empty text."""
    return [x or b"" for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``, independent of where it stands."""
    power, inverse = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte buffer, where its whitespace-separated words start and end, and where each text's words begin (one more at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=bounds[1:])
    return data, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (one more at the end)."""
    data, starts, ends, bounds = word_places(texts)
    return hashes_at(data, starts, ends), bounds


def hashes_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words at these places."""
    return spans_hash(_BYTE_VALUE[data], starts, ends)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on, as far as there are so many."""
    n = max(0, len(words) - length + 1)
    return spans_hash(words, np.arange(n), np.arange(n) + length)


def text_tie(text: Column) -> Column:
    """The first 60 bits of the text's (or bytes') SHA-256, which orders rows of one id."""
    return digest_tie(F.sha2(text, 256))


def digest_tie(digest: Column) -> Column:
    """The first 60 bits of a digest in hex."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def at_or_below(edges: list[tuple[int, int]], place: Column, tie: Column) -> tuple[Column, Column, Column]:
    """How many of the ascending edges are at or below (place, tie), by binary search, one step a bit; and the edges' two halves as arrays."""
    literal = lambda values: F.split(F.lit(",".join(map(str, values)) or "0"), ",").cast("array<bigint>")
    places, ties = literal([p for p, _ in edges]), literal([t for _, t in edges])
    below = lambda k: (F.get(places, k) < place) | ((F.get(places, k) == place) & (F.get(ties, k) <= tie))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(max(1, len(edges)).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= len(edges)) & below(n + step - 1), n + step).otherwise(n)), places, ties


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Evenly spread numbers from 0 to ``buckets`` - 1."""
    return (((mixed(values) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def groups_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of equal neighbours."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(keys)))


def by_bucket(df: DataFrame, make, schema: str, buckets: int) -> DataFrame:  # noqa: ANN001
    """``make(rows)`` for all rows of each ``bucket`` (numbers below ``buckets``, dealt evenly); a bucket is in memory at a time.

    ``rows`` are tuples of the other columns.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for bucket, *packet in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != here and held:
                    yield make(held)
                    held = []
                here = bucket
                held.append(packet)
        if held:
            yield make(held)

    tasks = min(buckets, shuffle_partitions(df.sparkSession))
    return df.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket").mapInArrow(run, schema)


def summed(df: DataFrame, column: str, fan_in: int = 16) -> np.ndarray | None:
    """The sum of the float64 blobs in ``column`` (one a partition), added up on the executors in rounds.

    The driver gets at most ``fan_in`` blobs, whatever the number of partitions.
    """

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                x = np.frombuffer(blob, np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["blob"])

    blobs = df.select(F.col(column).alias("blob"))
    middle = math.isqrt(shuffle_partitions(df.sparkSession))
    if middle > fan_in:
        blobs = blobs.repartition(middle).mapInArrow(add, "blob binary")
    out = blobs.repartition(fan_in).mapInArrow(add, "blob binary").collect()
    return sum(np.frombuffer(r.blob, np.float64) for r in out) if out else None
