"""Periodic runs of words: maximal stretches that repeat with a smallest period, found by bit-parallel lags.

A text's words are numbered, and bit b of all numbers together is one big integer, a bit plane.  A plane XOR
itself shifted by a lag has a bit wherever words that far apart differ in it; OR over the planes gives all
mismatches of the lag.  Doubling shifts, ANDed, leave only the places from which the required number of words
match on, so that a lag costs a few operations over n / 64 machine words.

What can hold no run isn't searched, by two exact rules.  A run of 12 words or more with two periods or more
consists of words of six-grams that occur twice in it, so the search is within stretches of such words.  And for
a lag q of 64 or more, with l the power of two in (q/4, q/2], one of the places divisible by l begins l words that
stand again q words on; only lags for which hashes say so are tried.

Defined results: null and empty texts have no words and no runs; equal rows have equal results; a text may be of
any length, and one text is worked on in one task, in memory proportional to it; columns named ``n_words``,
``runs`` or ``collapsed`` are replaced, all others pass through; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import encoded, plus, quoted, spans_hash, window_hashes

LEAST_WORDS = 12
#: Runs have at least two periods and LEAST_WORDS words, so at least this many words of a run recur one period on.
GRAM = LEAST_WORDS // 2
#: Lags below this are all tried.
ALL_LAGS = 64
RUNS = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)


def planes_of(ids: np.ndarray) -> list[int]:
    """The bits of all numbers as big integers; the numbers are scrambled first, so that few planes tell most words apart."""
    bits = max(1, int(ids.max()).bit_length())
    order = np.random.default_rng(bits).permutation(1 << bits)[ids]
    return [int.from_bytes(np.packbits((order >> b) & 1, bitorder="little").tobytes(), "little") for b in range(bits)]


def stretches(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the stretches of ones."""
    flags = np.unpackbits(np.frombuffer(bits.to_bytes(bits.bit_length() // 8 + 1, "little"), np.uint8), bitorder="little")
    step = np.diff(np.concatenate(([0], flags, [0])).astype(np.int8))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1


def long_matches(planes: list[int], lag: int, n: int, need: int) -> int:
    """A bit for each place from which ``need`` words equal the words ``lag`` places on."""
    differ, inside, at = 0, (1 << (n - lag)) - 1, 0
    while True:
        for plane in planes[at : at + 3]:
            differ |= plane ^ (plane >> lag)
        at += 3
        left, have = ~differ & inside, 1
        while have < need and left:
            step = min(have, need - have)
            left &= left >> step
            have += step
        if not left or at >= len(planes):
            return left


def likely_lags(ids: np.ndarray) -> np.ndarray:
    """The lags that can be periods: the small ones, and those at which an anchor's words stand again."""
    n = len(ids)
    found = [np.arange(1, min(ALL_LAGS, n // 2 + 1))]
    size = ALL_LAGS // 2
    while 2 * size <= n // 2:
        # Lags from 2 * size to 4 * size - 1: anchors stand every ``size`` words, and their words recur in the second or third block after theirs.
        hashes = window_hashes((ids.astype(np.uint64) + np.uint64(1)) * _SCRAMBLE, size)
        blocks = len(hashes) // size + 1
        padded = np.zeros((blocks + 3) * size, np.uint64)
        padded[: len(hashes)] = hashes
        padded = padded.reshape(-1, size)
        present = np.zeros((blocks + 3) * size, bool)
        present[: len(hashes)] = True
        present = present.reshape(-1, size)
        for apart in (2, 3):
            same = (padded[apart : apart + blocks] == padded[:blocks, :1]) & present[apart : apart + blocks]
            found.append(apart * size + np.flatnonzero(same.any(axis=0)))
        size *= 2
    lags = np.concatenate(found)
    return lags[lags <= n // 2]


def runs_within(ids: np.ndarray) -> dict[tuple[int, int], int]:
    """(start, end) of the runs of one stretch of words, and their smallest periods."""
    n, out = len(ids), {}
    planes = planes_of(np.unique(ids, return_inverse=True)[1])
    for lag in map(int, likely_lags(ids)):
        need = max(LEAST_WORDS - lag, lag)
        if lag + need > n:
            continue
        if left := long_matches(planes, lag, n, need):
            for first, last in zip(*stretches(left), strict=True):
                # A multiple of the smallest period has the same bounds; lags ascend, so the smallest is here already.
                out.setdefault((int(first), int(last) + need + lag), lag)
    return out


def islands(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches (start, end) of words of six-grams that occur twice in the stretch; every run lies in one."""
    open_ends = [(0, len(ids))]
    while open_ends:
        start, end = open_ends.pop()
        if end - start < LEAST_WORDS:
            continue
        part = (ids[start:end].astype(np.uint64) + np.uint64(1)) * _SCRAMBLE
        n = len(part) - GRAM + 1
        grams = spans_hash(part, np.arange(n), np.arange(n) + GRAM)
        order = np.argsort(grams)
        again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
        if not len(again):
            continue
        step = np.zeros(len(part) + 1, np.int64)
        at = np.zeros(n, bool)
        at[order[again]] = at[order[again + 1]] = True
        np.add.at(step, np.flatnonzero(at), 1)
        np.add.at(step, np.flatnonzero(at) + GRAM, -1)
        edge = np.diff(np.concatenate(([0], np.cumsum(step[:-1]) > 0, [0])).astype(np.int8))
        found = list(zip((np.flatnonzero(edge == 1) + start).tolist(), (np.flatnonzero(edge == -1) + start).tolist(), strict=True))
        if found == [(start, end)]:
            yield start, end
        else:
            open_ends += found


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and then period."""
    if len(words) < LEAST_WORDS:
        return []
    number = dict(zip(words, range(len(words)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out = [(start + a, b - a, q) for start, end in islands(ids) for (a, b), q in runs_within(ids[start:end]).items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, all ``runs`` by start and period, and the text ``collapsed`` to the first period of each run, its words joined by one space."""
    own = ["n_words", "runs", "collapsed"]
    named = docs.withColumn("__text", quoted(text)).drop(*own)
    passed = named.columns[:-1]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, kept = [], [], []
            for x in encoded(batch.column(len(passed))):
                words = x.split()
                found = runs_of(words)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                kept.append(b" ".join(kept_words(words, found)).decode())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.string())], names=[*passed, *own])

    return named.mapInArrow(search, plus(named.drop("__text"), RUNS))


def with_periods(key: Column, text: Column) -> Column:
    """The text with a periodic tail where the key's CRC-32 is divisible by ten: a third to a tenth of the tail's words, repeated to its end.

    A null key has the CRC-32 of the empty text.
    """
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")))
    g = F.floor(h / 10).cast("bigint")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " "))

    # The words are an element of an array, so that they are split once and not for each word.
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, F.coalesce(F.get(F.transform(F.array(words), repeated), 0), text)).otherwise(text)


def longest(runs: Column) -> Column:
    """The run with greatest length, smallest start, smallest period; null if there is none."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def lines(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))), "")
