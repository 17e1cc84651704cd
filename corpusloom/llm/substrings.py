"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

A word is repeated if it lies in a window of ``length`` words whose sequence also
begins anywhere else.  The corpus is its own reference.  Parsing every document
against every block would cost blocks times corpus, so windows are routed: a window
belongs to the block of its anchor, the least ``anchor``-word sequence in it by hash,
and equal windows have equal anchors.

1. Anchors are counted.  One that stands in one place only has no repeated window, so
   only windows of the other anchors go on.  A hash clash lets more go on, never less.
2. Runs of windows with one anchor place are segments; their words travel, compressed, to the block.
   Before the shuffle each task finds windows that repeat within its own chunk, compared
   word by word, and ships one place of each: a passage that a third of all rows share
   costs a block as many places as there are chunks.
3. A block numbers its words (words, not hashes) and indexes them in a suffix array.  Each
   segment is parsed greedily: a factor begins where the longest match with another
   place of the block has ``length`` words or more, and takes all of that match.  At the
   factor's end the parse goes back to the first window that crosses it, as that one may
   match another source.  A segment's windows all hold its anchor, so it has up to
   2 * length - anchor words (62 for 35 and 8), and no factor is longer than that.
4. Factors are duplicate spans.  A repeat that runs over the end of a segment goes on as
   a factor of the next one, perhaps in another block; spans that overlap or touch are
   merged per document.

Defined results: null and empty texts have no words; texts with fewer words than
``length`` lose none; equal rows, and rows with equal or null ids, are documents like
any others, so repeated rows of enough words lose all their words; an empty table
gives no rows.  Columns ``n_words``, ``n_removed``, ``kept_sha256`` and
``repeated_spans`` of the input are replaced; all others stay, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bucket_of, by_bucket, checkpoint, chunks, encoded, groups_of, hashes_at, mixed, plus, quoted, shuffle_partitions, window_hashes, word_hashes, word_places
from corpusloom.llm.decontaminate import merged, suffix_array

_PLACE_BITS = 30
BLOCKS_A_TASK = 4
SIGNATURE = 16
ANCHORS = "bucket int, told boolean, owners binary, anchors binary"
ROUTED = "block int, idents binary, signatures binary, starts binary, counts binary, words binary"
SPANS = "ident bigint, signature binary, start int, stop int"


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` neighbouring values stands (the first of equal ones)."""
    place = np.arange(len(values), dtype=np.uint64)
    low = ((values >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS)) | place
    reach = 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    return (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs: the last of ``keys`` goes up by one, the others stay."""
    n = len(keys[-1])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.diff(keys[-1]) != 1
    for k in keys[:-1]:
        cut |= k[1:] != k[:-1]
    first = np.flatnonzero(np.append(True, cut))
    return first, np.append(first[1:], n) - 1


def anchored(words: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows' starts, the documents they are in, and the places of their anchors; then anchors are ``phrases``."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = least_in_windows(mixed(phrases(words, anchor) ^ np.uint64(0x5BD1E9955BD1E995)), length - anchor + 1)
    start = np.flatnonzero(doc[: len(at)] == doc[length - 1 :])
    return start, doc[start], at[start]


def phrases(words: np.ndarray, anchor: int) -> np.ndarray:
    """Hashes of the ``anchor``-word sequences; the lowest bit is free."""
    return window_hashes(words, anchor) & ~np.uint64(1)


def _pairs(bucket: np.ndarray, told: bool, owners: np.ndarray, anchors: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    first, _ = groups_of(bucket[order])
    cut = np.append(first, len(bucket))
    owners, anchors = owners[order], anchors[order]
    bytes_ = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(bucket[order][first].astype(np.int32)), pa.array(np.full(len(first), told)), bytes_(owners), bytes_(anchors)], names=["bucket", "told", "owners", "anchors"])


def counted_anchors(texts: list[bytes], owners: np.ndarray, length: int, anchor: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """One place of each anchor, the lowest bit set if there are more in these texts; and, told already, the owners of all of those."""
    words, bounds = word_hashes(texts)
    _, doc, at = anchored(words, bounds, length, anchor)
    if not len(at):
        return
    first, _ = groups_of(at)
    doc, value = doc[first], phrases(words, anchor)[at[first]]
    order = np.argsort(value, kind="stable")
    doc, value = doc[order], value[order]
    first, n = groups_of(value)
    several = np.repeat(n, n) > 1
    yield _pairs(bucket_of(value[first], buckets), False, owners[doc[first]], value[first] | (n > 1))
    owner, value = owners[doc[several]], value[several]
    if len(owner):
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
        yield _pairs(bucket_of(owner[new].view(np.uint64), buckets), True, owner[new], value[new])


def repeated_anchors(rows: DataFrame, length: int, anchor: int, chunk: int) -> DataFrame:
    """``owner`` and ``told``, arrays of the anchors of its texts that stand in more than one place (``rows``: ``owner``, ``text``)."""
    buckets = BLOCKS_A_TASK * shuffle_partitions(rows.sparkSession)

    def ship(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, owners = encoded(batch.column(1)), batch.column(0).to_numpy()
            for a, b in chunks(texts, chunk):
                yield from counted_anchors(texts[a:b], owners[a:b], length, anchor, buckets)

    def tell(packets: list[tuple]) -> pa.RecordBatch:
        owners, anchors = (np.concatenate([np.frombuffer(p[i], t) for p in packets]) for i, t in ((1, np.int64), (2, np.uint64)))
        told = np.repeat([p[0] for p in packets], [len(p[1]) // 8 for p in packets])
        known_owner, known = owners[told], anchors[told]
        owners, anchors = owners[~told], anchors[~told]
        order = np.argsort(anchors, kind="stable")
        owners, anchors = owners[order], anchors[order]
        _, n = groups_of(anchors & ~np.uint64(1))
        # What a chunk has several times, its owners know already.
        new = (np.repeat(n, n) > 1) & (anchors & np.uint64(1) == 0)
        owners, anchors = np.concatenate([owners[new], known_owner]), np.concatenate([anchors[new], known])
        order = np.argsort(owners, kind="stable")
        owners, anchors = owners[order], anchors[order]
        first, n = groups_of(owners)
        return pa.RecordBatch.from_arrays([pa.array(owners[first]), pa.array([anchors[a : a + k].tobytes() for a, k in zip(first, n, strict=True)], pa.binary())], names=["owner", "anchors"])

    found = by_bucket(rows.mapInArrow(ship, ANCHORS), tell, "owner bigint, anchors binary", buckets)
    return found.groupBy("owner").agg(F.collect_list("anchors").alias("told"))


def locally_repeated(hashes: np.ndarray, start: np.ndarray, numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows equal the first one of their hash, or are equalled, word by word; and which are to be shipped."""
    order = np.argsort(hashes, kind="stable")
    first, n = groups_of(hashes[order])
    head = np.zeros(len(hashes), np.int64)
    head[order] = np.repeat(order[first], n)
    copy = np.flatnonzero(head != np.arange(len(hashes)))
    for j in range(length):
        copy = copy[numbers[start[copy] + j] == numbers[start[head[copy]] + j]]
    twice, ship = np.zeros(len(hashes), bool), np.ones(len(hashes), bool)
    twice[copy] = twice[head[copy]] = True
    ship[copy] = False
    return twice, ship


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers, from 1 on, for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int64, len(words))


def routed(texts: list[bytes], idents: np.ndarray, signatures: list[bytes], told: np.ndarray, length: int, anchor: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of ``ROUTED``: the segments of the ``told`` anchors.  A count below 0 is that of a span already known: minus its stop."""
    data, begins, ends, bounds = word_places(texts)
    words = hashes_at(data, begins, ends)
    start, doc, at = anchored(words, bounds, length, anchor)
    value = phrases(words, anchor)[at] if len(at) else np.zeros(0, np.uint64)
    there = np.isin(value, told)
    start, doc, at, value = start[there], doc[there], at[there], value[there]
    if not len(start):
        return
    raw = data.tobytes()
    twice, ship = locally_repeated(window_hashes(words, length)[start], start, numbered(raw.split()), length)
    known = np.flatnonzero(twice)
    a, b = runs(doc[known], start[known])
    known_doc, known_start, known_stop = doc[known[a]], start[known[a]], start[known[b]] + length
    sent = np.flatnonzero(ship)
    c, d = runs(doc[sent], at[sent], start[sent])
    first, last = start[sent[c]], start[sent[d]] + length - 1
    owner = np.concatenate([doc[sent[c]], known_doc])
    place = np.concatenate([first, known_start]) - bounds[owner]
    count = np.concatenate([last - first + 1, -(known_stop - bounds[known_doc])])
    bodies = [raw[x:y] for x, y in zip(begins[first], ends[last], strict=True)] + [b""] * len(known_doc)
    block = np.concatenate([bucket_of(value[sent[c]], blocks), bucket_of(idents[known_doc].view(np.uint64), blocks)])
    order, press = np.argsort(block, kind="stable"), zstandard.ZstdCompressor(level=1)
    f, n = groups_of(block[order])
    groups = [order[x : x + k] for x, k in zip(f, n, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(block[order][f].astype(np.int32)), pa.array([idents[owner[g]].tobytes() for g in groups], pa.binary()), pa.array([b"".join(signatures[owner[i]] for i in g) for g in groups], pa.binary()),
            *(pa.array([x[g].astype(np.int32).tobytes() for g in groups], pa.binary()) for x in (place, count)), pa.array([press.compress(b"\n".join(bodies[i] for i in g)) for g in groups], pa.binary()),
        ],
        names=["block", "idents", "signatures", "starts", "counts", "words"],
    )


def longest_matches(symbols: np.ndarray, least: int) -> np.ndarray:
    """For each place the length of its longest match with any other place, as far as that is ``least`` or more, else 0.

    The last symbol is unique; a match ends before any unique symbol.
    """
    order = suffix_array(symbols)
    a, b = order[:-1], order[1:]
    live = np.flatnonzero(np.maximum(a, b) + least <= len(symbols))
    for j in reversed(range(least)):
        live = live[symbols[a[live] + j] == symbols[b[live] + j]]
    common, size = np.zeros(len(order) + 1, np.int64), least
    while len(live):
        common[live + 1] = size
        live = live[symbols[a[live] + size] == symbols[b[live] + size]]
        size += 1
    out = np.zeros(len(symbols), np.int64)
    out[order] = np.maximum(common[:-1], common[1:])
    return out


def factors(matches: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The greedy parse: starts and ends of the factors of ``length`` or more; each begins at the first such match among the windows that cross the end of the one before or follow it."""
    places = np.flatnonzero(matches >= length)
    stops, at, starts, ends = (places + matches[places]).tolist(), 0, [], []
    places = places.tolist()
    while at < len(places):
        starts.append(places[at])
        ends.append(stops[at])
        at = bisect_left(places, stops[at] - length + 1, at + 1)
    return np.array(starts, np.int64), np.array(ends, np.int64)


def parsed_block(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Factors of all segments of a block relative to its other places, as rows of ``SPANS``."""
    idents, starts, counts = (np.frombuffer(b"".join(x), t) for x, t in zip(([r[0] for r in rows], [r[2] for r in rows], [r[3] for r in rows]), (np.int64, np.int32, np.int32), strict=True))
    signatures = b"".join(r[1] for r in rows)
    unpack = zstandard.ZstdDecompressor()
    numbers = numbered(b"\n".join(unpack.decompress(r[4]) for r in rows).split())
    size = np.maximum(counts, 0).astype(np.int64)
    segment = np.flatnonzero(size)
    # A symbol of its own behind each segment; 0 ends it all.
    symbols = np.zeros(len(numbers) + len(segment) + 1, np.int64)
    offset = np.cumsum(size[segment] + 1) - size[segment] - 1
    inside = np.ones(len(symbols), bool)
    inside[offset + size[segment]] = inside[-1] = False
    symbols[inside] = numbers
    symbols[offset + size[segment]] = numbers.max(initial=0) + 1 + np.arange(len(segment))
    begin, end = factors(longest_matches(symbols, length), length)
    which = np.searchsorted(offset, begin, side="right") - 1
    own = segment[which]
    place = starts[own] + begin - offset[which]
    known = np.flatnonzero(counts < 0)
    owner = np.concatenate([known, own])
    start, stop = np.concatenate([starts[known], place]), np.concatenate([-counts[known], place + end - begin])
    return pa.RecordBatch.from_arrays(
        [pa.array(idents[owner]), pa.array([signatures[SIGNATURE * i : SIGNATURE * (i + 1)] for i in owner.tolist()], pa.binary()), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["ident", "signature", "start", "stop"]
    )


def _keys(key: str, text: str, types: dict[str, str]) -> tuple[Column, Column]:
    """A row's id (whole numbers as they are) and 128 bits of its text's SHA-256, which tell rows of one id apart."""
    ident = quoted(key).cast("bigint") if types[key] in ("bigint", "int", "smallint", "tinyint") else F.xxhash64(quoted(key).cast("string"))
    signature = F.substring(F.unhex(F.sha2(F.coalesce(quoted(text), F.lit("")), 256)), 1, SIGNATURE)
    return F.coalesce(ident, F.lit(-(2**63))), signature


def owner_of(ident: Column, signature: Column) -> Column:
    """A number for a row's text; what different texts with equal numbers are told is too much, and harmless."""
    return F.xxhash64(ident, signature)


def spans(docs: DataFrame, key: str, text: str, length: int = 35, anchor: int = 8, chunk: int = 4 << 20, broadcast_anchors: int = 200_000) -> DataFrame:
    """``ident``, ``signature`` (of ``_keys``) and ``spans``, an array of (start, stop) word places, for documents that have any.

    Up to ``broadcast_anchors`` anchors (8 bytes each) are broadcast, so that texts stay where they are; more are joined by shuffling.
    """
    blocks = BLOCKS_A_TASK * shuffle_partitions(docs.sparkSession)
    ident, signature = _keys(key, text, dict(docs.dtypes))
    rows = docs.select(ident.alias("ident"), signature.alias("signature"), quoted(text).alias("text")).withColumn("owner", owner_of(F.col("ident"), F.col("signature")))
    told = checkpoint(repeated_anchors(rows.select("owner", "text"), length, anchor, chunk))
    few = (told.agg(F.sum(F.expr("aggregate(told, 8L, (n, x) -> n + octet_length(x) div 8)"))).first()[0] or 0) <= broadcast_anchors
    asked = rows.join(F.broadcast(told) if few else told, "owner").select("ident", "signature", "text", "told")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idents, signatures, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist(), encoded(batch.column(2))
            anchors = [np.frombuffer(b"".join(x), np.uint64) for x in batch.column(3).to_pylist()]
            for a, b in chunks(texts, chunk):
                yield from routed(texts[a:b], idents[a:b], signatures[a:b], np.unique(np.concatenate(anchors[a:b])), length, anchor, blocks)

    found = by_bucket(asked.mapInArrow(cut, ROUTED).withColumnRenamed("block", "bucket"), lambda packets: parsed_block(packets, length), SPANS, blocks)
    return found.groupBy("ident", "signature").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35, broadcast_spans: int = 50_000, broadcast_anchors: int = 200_000) -> DataFrame:
    """``docs`` with ``repeated_spans`` (null if there are none), in place of any such column.

    Up to ``broadcast_spans`` spans are broadcast, so that texts stay where they are; more are joined by shuffling.
    """
    docs = docs.drop("repeated_spans")
    found = checkpoint(spans(docs, key, text, length, broadcast_anchors=broadcast_anchors))
    few = (found.agg(F.sum(F.size("spans") + 6)).first()[0] or 0) <= broadcast_spans
    ident, signature = _keys(key, text, dict(docs.dtypes))
    keyed = docs.select(F.struct("*").alias("row"), ident.alias("ident"), signature.alias("signature"))
    joined = keyed.join(F.broadcast(found) if few else found, ["ident", "signature"], "left")
    return joined.select(*(F.col(f"row.`{c}`") for c in docs.columns), F.col("spans").alias("repeated_spans"))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_sha256``; a text that lost words becomes its kept words, joined by a space.

    Without ``keep_text`` the text itself is left out.  Columns of these names are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256", "repeated_spans")
    names = [c for c in docs.columns if keep_text or c != text]
    schema = plus(docs.select(*map(quoted, names)), "n_words bigint, n_removed bigint, kept_sha256 string")
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            had = batch.column(len(others))
            n_words, n_removed, sha, new = [], [], [], []
            for t, cut in zip(encoded(had), batch.column(len(others) + 1).to_pylist(), strict=True):
                words = t.split()
                kept, at = [], 0
                for start, stop in merged(np.array([(s["start"], s["stop"]) for s in cut or ()], np.int64).reshape(-1, 2)).tolist():
                    kept += words[at:start]
                    at = stop
                kept += words[at:]
                body = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(body).hexdigest())
                new.append(body.decode() if len(kept) < len(words) else None)
            columns = dict(zip(others, batch.columns, strict=False))
            if keep_text:
                columns[text] = pa.array([x if x is not None else old for x, old in zip(new, had.to_pylist(), strict=True)], had.type)
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays([*(columns[c] for c in names), *arrays], names=schema.names)

    return with_spans(docs, key, text, length).select(*map(quoted, others), quoted(text), "repeated_spans").mapInArrow(run, schema)
