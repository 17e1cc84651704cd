"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents in one task.  Its text is indexed as a sequence of
word numbers: suffix array, Burrows-Wheeler transform, wavelet-tree ranks and
sampled suffix positions.  The windows of all benchmark items search it backwards
together; located occurrences are merged into spans per document.

Words outside the benchmark's vocabulary can't be part of an occurrence, so the
index holds the runs of known words that are as long as the shortest window, with
separators between them; this leaves out no occurrence.

The benchmark is a stated query set.  It is written to the shared folder in blocks of
about ``block_bytes``, which the tasks read: few blocks stay in memory, more are streamed for
each shard.  A shard's texts are tokenised and indexed once, and all blocks search that index,
so neither text nor results are shuffled and the driver holds no benchmark text.

Defined results: null and empty texts have no words; an item without words
occurs nowhere; items that repeat a text all count; items with a
null id are searched, and count as one null item; repeated documents get equal results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import chunks, encoded, plus, quoted, scratch

#: So many blocks stay in a worker's memory.
HELD_BLOCKS = 4

#: A-Z become a-z; digits, letters and bytes from 0x80 on stay; everything else separates words.
_WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_TABLE).split()


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the last symbol must be the least and unique.

    The first round compares as many symbols as fit in 62 bits; later ones sort only
    suffixes that are not yet told apart.
    """
    n, width = len(s), max(1, int(s.max()).bit_length())
    k = max(1, 62 // width)
    padded = np.append(s, np.zeros(k, np.int64))
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = (key << width) | padded[j : j + n]
    order = np.argsort(key)
    open_, sub, sub_key = np.arange(n), order, key[order]
    rank = np.zeros(n, np.int64)
    while len(open_):
        new = np.append(True, sub_key[1:] != sub_key[:-1])
        first = np.flatnonzero(new)
        rank[sub] = open_[first][np.cumsum(new) - 1]  # the place of a group's first suffix
        alone = np.repeat(np.diff(np.append(first, len(sub))) == 1, np.diff(np.append(first, len(sub))))
        open_, sub = open_[~alone], sub[~alone]
        sub_key = rank[sub] * (n + 1) + np.where(sub + k < n, rank[np.minimum(sub + k, n - 1)] + 1, 0)
        by = np.argsort(sub_key)
        sub, sub_key = sub[by], sub_key[by]
        order[open_] = sub
        k *= 2
    return order


class FMIndex:
    """Backward search and locate over a sequence of symbols from 1 on (0 is kept for the end)."""

    def __init__(self, symbols: np.ndarray, sample: int = 8):
        s = np.append(symbols.astype(np.int64), 0)
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.n, self.levels = len(s), max(1, int(s.max()).bit_length())
        self.before = np.zeros((1 << self.levels) + 1, np.int64)
        np.cumsum(np.bincount(s, minlength=1 << self.levels), out=self.before[1:])
        # The wavelet tree, level by level from the highest bit; zeros go left, ones right.
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        at = bwt
        for level in reversed(range(self.levels)):
            bit = (at >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(self.n - self.ones[-1][-1]))
            at = np.concatenate([at[bit == 0], at[bit == 1]])
        self.bwt = bwt
        marked = sa % sample == 0
        self.marked, self.marks = marked, np.cumsum(marked) - 1
        self.positions = sa[marked]

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first ``end`` places of the transform."""
        start, end = np.zeros_like(end), end.copy()
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros, strict=True):
            bit = (symbol >> level) & 1
            a, b = ones[start], ones[end]
            start, end = np.where(bit, zeros + a, start - a), np.where(bit, zeros + b, end - b)
        return end - start

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the suffix array that begin with each pattern (a row of ``patterns``, filled up behind its length)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            c = patterns[live, lengths[live] - 1 - back]
            fits = c < 1 << self.levels
            high[live[~fits]] = low[live[~fits]]
            live, c = live[fits], c[fits]
            low[live] = self.before[c] + self.rank(c, low[live])
            high[live] = self.before[c] + self.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a sampled suffix, all rows together."""
        out, walked = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            done = self.marked[at]
            out[live[done]] = self.positions[self.marks[at[done]]] + walked[live[done]]
            live, at = live[~done], at[~done]
            c = self.bwt[at]
            at = self.before[c] + self.rank(c, at)
            walked[live] += 1
        return out


def _null_last(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


class Block:
    """Items of the benchmark: their words as numbers from 1 on, item by item, with a 0 behind each, and their windows."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.items = [k for k, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        numbers = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(t)] for _, t in items]
        size = np.array([len(x) for x in numbers], np.int64)
        self.tokens = np.array([n for x in numbers for n in (*x, 0)], np.int64)
        offset = np.cumsum(size + 1) - size - 1
        n = np.where(size > 0, np.maximum(1, size - window + 1), 0)
        self.owner = np.repeat(np.arange(len(items)), n)
        self.starts = np.repeat(offset, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.lengths = np.minimum(size, window)[self.owner]

    def patterns(self, symbol_of: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows all of whose words have a symbol: symbols (filled up behind each length), lengths, and items."""
        symbol = np.zeros(len(self.vocabulary) + 1, np.int64)
        symbol[1:] = np.fromiter((symbol_of.get(w, 0) for w in self.vocabulary), np.int64, len(self.vocabulary))
        tokens = symbol[self.tokens]
        absent = np.concatenate([[0], np.cumsum(tokens == 0)])
        there = np.flatnonzero(absent[self.starts + self.lengths] == absent[self.starts])
        lengths = self.lengths[there]
        place = np.arange(int(lengths.max(initial=0)))
        at = np.minimum(self.starts[there][:, None] + place, max(0, len(tokens) - 1))
        return np.where(place < lengths[:, None], tokens[at] if len(tokens) else 0, 0), lengths, self.owner[there]


def stretches(known: np.ndarray, bounds: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known words that stand in runs of ``least`` or more within a document, each run followed by -1."""
    gaps = np.searchsorted(bounds, np.arange(len(known)), side="right")  # a gap before each document
    spread = np.zeros(len(known) + len(bounds) + 1, np.int8)
    place = np.arange(len(known)) + gaps
    spread[place] = known
    step = np.diff(spread)
    starts, ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    back = np.zeros(len(spread), np.int64)
    back[place] = np.arange(len(known))
    size = ends - starts + 1
    offset = np.cumsum(size) - size
    at = np.repeat(starts - offset, size) + np.arange(int(size.sum()))
    last = np.zeros(len(at), bool)
    last[offset + size - 1] = True
    return np.where(last, -1, back[np.where(last, 0, at)]), last


def searched(texts: list[bytes], blocks: Callable[[], Iterable[Block]]) -> Iterator[tuple[int, np.ndarray, list[str | None]]]:
    """For each text of a shard: its number of words, merged spans (pairs of word places), and the items with occurring windows."""
    number: dict[bytes, int] = {}
    parts = [[number.setdefault(w, len(number)) for w in words_of(t)] for t in texts]
    bounds = np.cumsum([0, *map(len, parts)])
    words = np.fromiter((n for p in parts for n in p), np.int64, int(bounds[-1]))
    known, least = np.zeros(len(number) + 1, bool), math.inf
    for block in blocks():
        known[[n for w, n in number.items() if w in block.vocabulary]] = True
        least = min(least, block.lengths.min(initial=len(words) + 1))
    place, last = stretches(known[words], bounds[:-1], least)
    found: list[list[np.ndarray]] = [[], [], []]
    items: dict[str | None, int] = {}
    if len(place):
        # Symbols from 2 on for known words; 1 separates runs.
        symbol = np.cumsum(known) + 1
        index = FMIndex(np.where(last, 1, symbol[words[np.maximum(place, 0)]]))
        symbol_of = {w: int(symbol[n]) for w, n in number.items() if known[n]}
        for block in blocks():
            patterns, lengths, owner = block.patterns(symbol_of)
            if not len(patterns):
                continue
            low, high = index.search(patterns, lengths)
            n = high - low
            which = np.repeat(np.arange(len(n)), n)
            rows = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            begin = place[index.locate(rows)]
            name = np.array([items.setdefault(k, len(items)) for k in block.items], np.int64)
            for x, y in zip(found, (begin, begin + lengths[which], name[owner[which]]), strict=True):
                x.append(y)
    begin, end, item = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    order = np.argsort(begin, kind="stable")
    begin, end, item = begin[order], end[order], item[order]
    cut, names = np.searchsorted(begin, bounds), [*items]
    for i, part in enumerate(parts):
        a, b = cut[i], cut[i + 1]
        yield len(part), merged(np.column_stack([begin[a:b], end[a:b]]) - bounds[i]), sorted((names[k] for k in np.unique(item[a:b])), key=_null_last)


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans made one, in order."""
    if len(spans) < 2:
        return spans.reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]])


_held: dict[str, list[Block]] = {}


def blocks_of(folder: str, n: int, window: int) -> Iterator[Block]:
    """The blocks in ``folder``, read by a worker, which keeps them if they are few."""
    filesystem, root = pafs.FileSystem.from_uri(folder)

    def read(k: int) -> Block:
        if filesystem.get_file_info(f"{root}/block={k}").type == pafs.FileType.NotFound:
            return Block([], window)
        table = pq.read_table(f"{root}/block={k}", filesystem=filesystem, columns=["item", "text"])
        return Block([*zip(table["item"].to_pylist(), table["text"].to_pylist(), strict=True)], window)

    if n > HELD_BLOCKS:
        yield from map(read, range(n))
    else:
        if folder not in _held:
            _held.clear()
            _held[folder] = [*map(read, range(n))]
        yield from _held[folder]


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_key: str = "item_id", item_text: str = "text", block_bytes: int = 8 << 20, shard_bytes: int = 6 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word places, end exclusive) and ``hit_items`` (ids as strings, ascending; one null, last, for items without an id), in place of any such columns.

    A shard is about ``shard_bytes`` of a task's texts; a longer text is a shard of its own.
    """
    docs = docs.drop("n_words", "hit_spans", "hit_items")
    names = docs.columns
    schema = plus(docs, "n_words bigint, hit_spans array<array<int>>, hit_items array<string>")
    text_at = names.index(text)
    items = benchmark.select(quoted(item_key).cast("string").alias("item"), F.encode(F.coalesce(quoted(item_text), F.lit("")), "UTF-8").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = -(-total // block_bytes)
    folder = f"{scratch(docs.sparkSession, 'benchmark')}/blocks"
    items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n))).cast("int")).write.partitionBy("block").parquet(folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = partial(blocks_of, folder, n, window)
        for batch in batches:
            texts, found = encoded(batch.column(text_at)), []
            for a, b in chunks(texts, shard_bytes):
                found += searched(texts[a:b], blocks)
            arrays = [pa.array([x for x, _, _ in found], pa.int64()), pa.array([x.tolist() for _, x, _ in found], pa.list_(pa.list_(pa.int32()))), pa.array([x for _, _, x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=schema.names)

    return docs.mapInArrow(run, schema)


def n_hit(spans: str = "hit_spans"):  # noqa: ANN201
    """Number of words in the spans."""
    return F.aggregate(F.col(spans), F.lit(0).cast("bigint"), lambda acc, s: acc + (s[1] - s[0]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no window of the benchmark occurs."""
    inner = docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns})
    clean = find(inner, benchmark, window, "doc__text").where(F.size("hit_spans") == 0)
    return clean.select(*(F.col(f"doc__{c}").alias(c) for c in docs.columns))
