"""Document fingerprints by a randomised edit embedding.

Walks over the characters of all texts share their random bits: at step j a walk
writes the character it stands on and moves on, or stays, by a bit that depends on
j and the character.  A few edits shift a walk that soon falls into step again, so
edit distance becomes Hamming distance of what was written.

The written sequence is sampled at shared steps, ``per_octave`` in each octave
(all steps of the first ones), one random bit of each written character; so whole
texts count, and the last half of a text has its own octave whatever its length.
A fingerprint is the walk's length and its sampled bits, in hex.  Likeness compares
two fingerprints octave by octave, weighted with the octaves' lengths.

Near-duplicates are documents joined by links.  An edit puts a walk out of step for a while, so texts with 5 % of edits
are in step for some third of the way.  A link has likeness ``LEAST`` or more; or, from ``SHORT`` steps on, likeness ``SPREAD``
or more, of which ``LATE`` is found in the walks' second half as well (texts that share only their beginning are in step only there); or
edit similarity (one less the edit distance's share of the longer text) ``LEAST_EDIT`` or more.  Walks that are in step
write alike without a break, so a band is ``BAND_BITS`` bits of consecutive steps, at shared places in a walk's last
octaves; texts that don't resemble each other meet with a chance of 2^-40 a band.  Documents that meet form groups
(``spanning``), in which each link is verified: by whole fingerprints, and what they leave open (likeness of ``DOUBT`` or
more, clusters still apart) by the exact edit distance of the texts, unless their six-grams differ too much for it.
``clusters(..., exact=True)`` compares all texts of a length level instead.

Defined results: null counts as the empty text, whose fingerprint is that of a walk
of length 0; two empty texts have likeness 1, an empty and another 0; ids are whole
numbers, ordered with null first, equal ids by their texts' SHA-256; the last document's
next is the first; a table of one document has itself as next; documents with equal ids are one
vertex of a cluster; empty texts link with nothing, and a null id has a null cluster; texts of any length are walked
whole, and an exact check of the edit distance of two texts of n characters takes n * n / 640 machine words' work.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import at_or_below, checkpoint, mixed, plus, quoted, scratch, shuffle_partitions, text_tie, window_hashes
from corpusloom.llm.spanning import LINKS, PACKET, Sets, components, group_links, pair_batch, star_edges, star_packets

LEAST, SPREAD, LATE, LEAST_EDIT = 0.75, 0.4, 0.35, 0.95
#: Texts of less likeness aren't measured: unrelated ones have up to some 0.2.
DOUBT = 0.25
#: Bands begin at so many steps of an octave, in a walk's last octaves.
BANDS, BAND_OCTAVES, BAND_BITS = 16, 4, 40
GRAM, SHORT = 6, 1024
RANGE_BYTES = 64 << 20
OCTAVES = 40
ALONE = 12  #: so few walks go one by one, in plain integers, instead of all together
_MASK = (1 << 32) - 1


@cache
def sampled_steps(per_octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shared steps, their octaves, and a random multiplier for each, which gives the bit that is written there."""
    rng = np.random.default_rng(71)
    steps, octave = [np.array([0])], [np.array([0])]
    for o in range(1, OCTAVES):
        low, n = 1 << (o - 1), 1 << (o - 1)
        steps.append(np.arange(low, low + n) if n <= per_octave else low + np.unique(rng.integers(0, n, per_octave * 2))[:: 2][:per_octave])
        octave.append(np.full(len(steps[-1]), o))
    s = np.concatenate(steps)
    return s, np.concatenate(octave), rng.integers(0, 1 << 31, len(s), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


@cache
def band_steps() -> np.ndarray:
    """The shared steps at which bands begin, and their octaves (two rows); all steps of the first octaves."""
    rng = np.random.default_rng(73)
    steps, octave = [np.array([0])], [np.array([0])]
    for o in range(1, OCTAVES):
        low = n = 1 << (o - 1)
        steps.append(np.arange(low, low + n) if n <= BANDS else low + np.sort(rng.choice(n, BANDS, replace=False) if n < 1 << 20 else rng.integers(0, n, BANDS)))
        octave.append(np.full(len(steps[-1]), o))
    return np.stack([np.concatenate(steps), np.concatenate(octave)])


def characters(points: np.ndarray) -> np.ndarray:
    """A scrambled number for each code point, another for each; the highest bit of its product with a step's multiplier is the code point's random bit at that step."""
    h = points.astype(np.uint32) + np.uint32(1)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def _moves(first: int, n: int) -> np.ndarray:
    """Shared odd multipliers of ``n`` steps from ``first`` on: does a walk on a character move on?"""
    h = np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _writes(first: int, n: int) -> np.ndarray:
    """Shared odd multipliers for the bits of bands that are written at ``n`` steps from ``first`` on."""
    return mixed(np.arange(first, first + n, dtype=np.uint64) + np.uint64(0x5BD1E9955BD1E995)).astype(np.uint32) | np.uint32(1)


def walks(texts: list[str], per_octave: int = 128, block: int = 256, banded: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the walks over all texts, and their sampled bits (a row a text, 0 behind the end); for the first ``banded`` texts the bands: whose, and a key."""
    steps, _, written = sampled_steps(per_octave)
    begin, octave = band_steps()
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + 1) - size - 1
    here_of = characters(np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32))
    here_of[start + size] = 0  # the end: all its bits are 0, so a walk stays there
    out = np.zeros((len(texts), int(np.searchsorted(steps, 4 * size.max(initial=0) + 64))), np.uint8)
    length = np.zeros(len(texts), np.int64)
    places = np.zeros((banded, int(np.searchsorted(begin, 8 * size[:banded].max(initial=0) + 64))), np.int64)
    live, step = np.flatnonzero(size > 0), 0
    at = start[live]
    while len(live):
        moves = _moves(step, block)
        a, b = np.searchsorted(steps, (step, step + block))
        if b > out.shape[1]:
            out = np.hstack([out, np.zeros((len(texts), int(b) - out.shape[1] + 1024), np.uint8)])
        samples = [*zip((steps[a:b] - step).tolist(), range(a, b), written[a:b].tolist(), strict=True), (block, -1, 0)]
        # A band's beginning is a sample without a bit: its column, negative, says where the place is written.
        a, b = np.searchsorted(begin, (step, step + block))
        if banded and a < places.shape[1]:
            samples = sorted([*samples, *((int(x) - step, -2 - k, 0) for k, x in enumerate(begin[a:b], a) if k < places.shape[1])], key=lambda x: x[0])
        entered = at.copy()
        if len(live) <= ALONE:
            view, factors = memoryview(here_of), moves.tolist()
            for k in range(len(live)):
                at[k] = _alone(view, int(at[k]), factors, samples, out[live[k]], places[live[k]] if live[k] < banded else None)
        else:
            here, j = np.empty(len(live), np.uint32), 0
            for stop, column, factor in samples:
                for m in moves[j:stop]:
                    np.take(here_of, at, out=here, mode="clip")
                    np.multiply(here, m, out=here)
                    np.right_shift(here, 31, out=here)
                    np.add(at, here, out=at)
                j = stop
                if column >= 0:
                    out[live, column] = (here_of[at] * np.uint32(factor)) >> np.uint32(31)
                elif column < -1:
                    first = int(np.searchsorted(live, banded))
                    places[live[:first], -2 - column] = at[:first]
        ended = here_of[at] == 0
        if ended.any():
            # The exact length: the block again, for walks that ended in it.
            again, counted = entered[ended], np.zeros(int(ended.sum()), np.int64)
            for m in moves:
                here = here_of[again]
                counted += here != 0
                again += (here * m) >> np.uint32(31)
            length[live[ended]] = step + counted
            live, at = live[~ended], at[~ended]
        step += block
    return length, out, *_bands(here_of, places, length[:banded], begin, octave)


def _bands(here_of: np.ndarray, places: np.ndarray, length: np.ndarray, begin: np.ndarray, octave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whose band, and its key: the bits that the walk writes from its beginning on, ``BAND_BITS`` of them."""
    top = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)[:, None]
    n = places.shape[1]
    owner, band = np.nonzero((begin[:n] < length[:, None]) & (octave[:n] > top - BAND_OCTAVES))
    at, key = places[owner, band], np.zeros(len(owner), np.uint64)
    moves, bits = (np.stack([f(int(x), BAND_BITS) for x in begin[:n]]).reshape(n, BAND_BITS) if n else np.zeros((0, BAND_BITS), np.uint32) for f in (_moves, _writes))
    for k in range(BAND_BITS):
        here = here_of[at]
        key = (key << np.uint64(1)) | ((here * bits[band, k]) >> np.uint32(31)).astype(np.uint64)
        at = at + ((here * moves[band, k]) >> np.uint32(31))
    return owner, mixed(key + (band.astype(np.uint64) << np.uint64(BAND_BITS)))


def _alone(view: memoryview, at: int, moves: list[int], samples: list[tuple[int, int, int]], out: np.ndarray, places: np.ndarray | None = None) -> int:
    """One walk through a block of steps."""
    j = 0
    for stop, column, factor in samples:
        for m in moves[j:stop]:
            at += (view[at] * m & _MASK) >> 31
        j = stop
        if column >= 0:
            out[column] = (view[at] * factor & _MASK) >> 31
        elif column < -1 and places is not None:
            places[-2 - column] = at
    return at


class Fingerprints:
    """Walk lengths and sampled bits of many texts."""

    def __init__(self, length: np.ndarray, bits: np.ndarray, per_octave: int = 128):
        self.per_octave, self.length, self.bits = per_octave, length, bits
        self.samples = np.searchsorted(sampled_steps(per_octave)[0], length)

    @classmethod
    def walked(cls, texts: list[str], per_octave: int = 128) -> Fingerprints:
        return cls(*walks(texts, per_octave)[:2], per_octave)

    @classmethod
    def of(cls, prints: list[bytes], per_octave: int = 128) -> Fingerprints:
        """Read again what ``print`` has written."""
        length = np.array([int.from_bytes(x[:5], "big") for x in prints], np.int64)
        out = cls(length, np.zeros((len(prints), int(np.searchsorted(sampled_steps(per_octave)[0], length.max(initial=0)))), np.uint8), per_octave)
        for i, x in enumerate(prints):
            out.bits[i, : out.samples[i]] = np.unpackbits(np.frombuffer(x, np.uint8, offset=5))[: out.samples[i]]
        return out

    def print(self, i: int) -> bytes:
        return int(self.length[i]).to_bytes(5, "big") + np.packbits(self.bits[i, : self.samples[i]]).tobytes()

    def linked(self, i: np.ndarray, j: np.ndarray, like: np.ndarray) -> np.ndarray:
        """Do fingerprints of this likeness link them?  Empty texts link with nothing."""
        found = (like >= LEAST) & (np.minimum(self.length[i], self.length[j]) > 0)
        # Short walks have too few samples to tell.
        unsure = np.flatnonzero((like >= SPREAD) & (like < LEAST) & (np.minimum(self.length[i], self.length[j]) >= SHORT))
        if len(unsure):
            a, b = i[unsure], j[unsure]
            steps = sampled_steps(self.per_octave)[0][: self.bits.shape[1]]
            reach, short = np.maximum(self.length[a], self.length[b])[:, None], np.minimum(self.samples[a], self.samples[b])[:, None]
            half = (2 * steps >= reach) & (steps < reach)
            # Behind the shorter walk's end samples agree as often as by chance.
            agree = np.where(np.arange(len(steps)) < short, self.bits[a] == self.bits[b], 0.5)
            found[unsure] = 2 * (agree * half).sum(1) / np.maximum(half.sum(1), 1) - 1 >= LATE
        return found

    def likeness(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Weighted share of agreeing samples, with what chance gives taken off; 1 for equal, 0 for unrelated fingerprints."""
        bits, there, low = self._octaves
        if not len(low):
            return np.ones(len(i))
        both, either = there[i] & there[j], there[i] | there[j]
        short, long, differ = (np.bitwise_count(x).sum(axis=2, dtype=np.int64) for x in (both, either, (bits[i] ^ bits[j]) & both))
        # Behind the shorter walk's end samples agree as often as by chance.
        share = (short - differ + 0.5 * (long - short)) / np.maximum(long, 1)
        reach = np.maximum(self.length[i], self.length[j])[:, None]
        weight = np.clip(reach - low, 0, np.maximum(1, low))
        mean = (share * weight).sum(1) / np.maximum(weight.sum(1), 1)
        return np.where(reach[:, 0] == 0, 1.0, np.where(np.minimum(self.samples[i], self.samples[j]) == 0, 0.0, np.clip(2 * mean - 1, 0, 1)))

    @cached_property
    def _octaves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The samples, and which there are, as machine words by octave; and the octaves' first steps."""
        width = self.bits.shape[1]
        octave = sampled_steps(self.per_octave)[1][:width]
        first = np.flatnonzero(np.append(True, octave[1:] != octave[:-1])) if width else np.zeros(0, np.int64)
        wide = -(-self.per_octave // 64) * 64
        out = []
        for x in (self.bits, (np.arange(width) < self.samples[:, None]).astype(np.uint8)):
            words = np.zeros((len(x), len(first), wide), np.uint8)
            for k, (a, b) in enumerate(zip(first, np.append(first[1:], width), strict=True)):
                words[:, k, : b - a] = x[:, a:b]
            out.append(np.packbits(words, axis=2).view(np.uint64))
        return *out, (1 << octave[first]) >> 1


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many characters, or all, of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_LEAST_ID = -(2**63)


def beside_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``part``, ``echo``, ``id``, ``tie`` (of the text's hash), ``packed`` (the text, compressed): sorted within partitions so that each document's next follows it.

    Ids are cut into ranges at actual ids (quantiles, for ranges of about ``RANGE_BYTES`` or as many
    as there are shuffle partitions); an id that several quantiles hit is cut by the texts' hashes.
    The document at a cut goes to its own range and, as an echo, to the end of the range
    before; the very first also to the end of the last.  Texts are shuffled once.
    """
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(quoted(key).alias("id"), body.alias("text")).withColumns({"place": F.coalesce(F.col("id").cast("bigint"), F.lit(_LEAST_ID)), "tie": text_tie(F.col("text"))})
    total, first = rows.agg(F.sum(F.octet_length("text")), F.min("place")).first()
    n = max(shuffle_partitions(docs.sparkSession), (total or 0) // RANGE_BYTES)
    found = [] if first is None else [first, *rows.agg(F.percentile_approx("place", [i / n for i in range(1, n)], max(10_000, 4 * n))).first()[0]] if n > 1 else [first]
    often = {p: k for p in {*found} if (k := found.count(p)) > 2}
    cuts = [(p, -1) for p in sorted({*found})]
    if often:
        # Parts of an id's texts, by their hash; the cut is at the first hash that is there.
        share = F.element_at(F.create_map(*(F.lit(x) for pair in often.items() for x in pair)), F.col("place"))
        parts = rows.where(F.col("place").isin([*often])).groupBy("place", F.floor(F.col("tie") * share / F.lit(2.0**60)).alias("k")).agg(F.min("tie").alias("tie")).where("k > 0").collect()
        cuts = sorted([*cuts, *((r.place, r.tie) for r in parts)])
    part, places, ties = at_or_below(cuts, F.col("place"), F.col("tie"))
    rows = rows.withColumn("part", part)
    own = F.col("part") - 1
    at_cut = (F.get(places, own) == F.col("place")) & ((F.get(ties, own) == F.col("tie")) | (F.get(ties, own) == -1))
    before = F.when(F.col("part") == 1, F.lit(len(cuts))).otherwise(own)
    here = F.struct(F.col("part"), F.lit(False).alias("echo"))
    copies = F.when(at_cut, F.array(here, F.struct(before.alias("part"), F.lit(True).alias("echo")))).otherwise(F.array(here))
    spread = rows.select(F.explode(copies).alias("c"), "id", "place", "tie", "text").select("c.part", "c.echo", "id", "place", "tie", "text")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([press.compress(t.encode()) for t in batch.column(5).to_pylist()], pa.binary())], names=[*batch.schema.names[:-1], "packed"])

    sent = spread.mapInArrow(pack, plus(spread.drop("text"), "packed binary"))
    return sent.repartitionById(max(1, len(cuts)), F.col("part") - 1).sortWithinPartitions("part", "echo", "place", "tie").select("part", "echo", "id", "tie", "packed")


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text", per_octave: int = 128, lanes: int = 4096, chars: int = 8 << 20) -> DataFrame:
    """One row a document: its id, ``n_chars``, ``edited_sha256``, ``print`` and ``edited_print`` (bytes), their likeness and that of the next one's; ``tie`` and the ``bands``' keys.

    Walks of up to ``lanes`` texts, or ``chars`` characters, are taken together.
    """
    rows = beside_next(docs, key, text)
    schema = plus(docs.select(quoted(key)), "n_chars bigint, edited_sha256 binary, print binary, edited_print binary, near_edited double, near_next double, tie bigint, bands binary")

    def made(held: list[tuple[object, int, str]], following: list[str], types: pa.DataType) -> pa.RecordBatch:
        n = len(held)
        texts = [t for _, _, t in held]
        new = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        length, bits, owner, key = walks([*texts, following[-1], *new], per_octave, banded=n)
        found = Fingerprints(length, bits, per_octave)
        ends = np.searchsorted(owner, np.arange(n + 1))
        i = np.arange(n)
        arrays = [
            pa.array([k for k, _, _ in held], types), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in new], pa.binary()),
            pa.array([found.print(k) for k in range(n)], pa.binary()), pa.array([found.print(n + 1 + k) for k in range(n)], pa.binary()), pa.array(found.likeness(i, i + n + 1)), pa.array(found.likeness(i, i + 1)),
            pa.array([x for _, x, _ in held], pa.int64()), pa.array([key[ends[k] : ends[k + 1]].tobytes() for k in range(n)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, int, str]] = []
        unpack = zstandard.ZstdDecompressor()
        size, here, over, types = 0, None, False, None
        for batch in batches:
            types = batch.schema.types[2]
            for part, echo, k, tie, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != here:
                    held, size, here, over = [], 0, part, False
                if over:  # further documents with the id of the echo
                    continue
                t = unpack.decompress(t).decode()
                if echo or len(held) >= lanes or size >= chars:
                    if held:
                        yield made(held, [*(x for _, _, x in held[1:]), t], types)
                    held, size, over = [], 0, echo
                if not echo:
                    held.append((k, tie, t))
                    size += len(t)

    return rows.mapInArrow(run, schema)


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both texts without the beginning and the end that they share."""
    front = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[front:], b[front:]
    back = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    return a[: len(a) - back], b[: len(b) - back]


def edit_similarity(a: str, b: str) -> float:
    """One less the edit distance's share of the longer text: bit-parallel, a column of the table a big integer."""
    if a == b:
        return 1.0
    whole = max(len(a), len(b))
    a, b = sorted(_trimmed(a, b), key=len)
    if not a:
        return 1 - len(b) / whole
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, last, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = mask, 0
    for c in b:
        same = where.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        rise, fall = down | ~(across | up) & mask, up & across
        distance += bool(rise & last) - bool(fall & last)
        rise, fall = (rise << 1 | 1) & mask, fall << 1 & mask
        kept = same | down
        up, down = fall | ~(kept | rise) & mask, rise & kept
    return 1 - distance / whole


def within_edits(a: str, b: str, most: int) -> bool:
    """Is the edit distance ``most`` at most?  Exact: a column of the table's diagonals up to ``most`` away is a big integer, which moves down a row a column.

    Ends where the lowest of the diagonals, on which distances only grow, is too far away for the rest.
    """
    short, long = sorted(_trimmed(a, b), key=len)
    if len(long) - len(short) > most:
        return False
    if len(long) <= most:
        return True
    top = 2 * most + 1
    last, mask = 1 << top, (1 << (top + 1)) - 1
    where: dict[str, tuple[int, int]] = {}  # of a character, a column and its rows among those of that column
    for i, c in enumerate(long[:most]):
        where[c] = 0, where.get(c, (0, 0))[1] | 1 << (i + top - most)
    up, down, distance = mask >> (top - most) << (top - most), 0, most
    lowest = len(long) - most
    limit = most + len(short) - lowest
    for j, (c, new) in enumerate(zip(short, long[most:], strict=False)):
        at, rows = where.get(new, (j, 0))
        where[new] = j, rows >> (j - at) | last
        at, rows = where.get(c, (j, 0))
        same = rows >> (j - at)
        across = (((same & up) + up) ^ up | same | down) & mask
        if not across & last:
            distance += 1
            if distance > limit:
                return False
        rise, fall = (down | ~(across | up)) & mask, across & up
        across >>= 1
        up, down = (fall | ~(across | rise)) & mask, across & rise
    here = last >> 1
    for j in range(lowest, len(short)):
        at, rows = where.get(short[j], (j, 0))
        same = rows >> (j - at)
        across = (((same & up) + up) ^ up | same | down) & mask
        rise, fall = (down | ~(across | up)) & mask, across & up
        distance += bool(rise & here) - bool(fall & here)
        if distance > most + len(short) - 1 - j:
            return False
        here >>= 1
        across >>= 1
        up, down = (fall | ~(across | rise)) & mask, across & rise
    return distance <= most


def forest(near: Callable[[int, int], bool] | None = None, doubt: float = DOUBT, bodies_of: Callable[[list[bytes]], list[bytes]] = list):  # noqa: ANN201
    """A function that connects the ids of a part: pairs of its ids, from fingerprints that link them.

    Pairs that fingerprints leave in doubt are linked if ``near`` (made of the bodies) says so; without it, an id that is in
    doubt with one still apart from it is paired with itself.
    """

    def link(ids: list[int], bodies: list[bytes]) -> list[tuple[int, int]]:
        found, sets, out, pivots = Fingerprints.of(bodies_of(bodies)), Sets(), set(), []
        asked = near and near(bodies)

        def compare(i: int, others: np.ndarray) -> bool:
            """Links ``i`` with those of the others that it is near to and that are still apart from it."""
            at, hit = np.full(len(others), i), False
            like = found.likeness(at, others)
            sure = found.linked(at, others, like)
            some = np.flatnonzero(sure | (like >= doubt))
            for k in some[np.argsort(-(like + sure)[some])].tolist():
                j = int(others[k])
                if sets.root(ids[i]) == sets.root(ids[j]):
                    hit = True
                elif sure[k] or (asked and asked(i, j)):
                    hit = True
                    sets.join(ids[i], ids[j])
                    out.add((ids[i], ids[j]))
                elif not asked:
                    out.update(((ids[i], ids[i]), (ids[j], ids[j])))
            return hit

        for i in range(len(ids)):
            met = [compare(i, np.array(pivots[k : k + 1024])) for k in range(0, len(pivots), 1024)]
            if not any(met):
                pivots.append(i)
        # All have met the pivots before them; what is still apart meets the others too.
        if len({sets.root(ids[p]) for p in pivots}) > 1:
            others = sorted({*range(len(ids))} - {*pivots})
            for i in range(len(ids)):
                root = sets.root(ids[i])
                apart = np.array([j for j in others if j < i and sets.root(ids[j]) != root], np.int64)
                for k in range(0, len(apart), 1024):
                    compare(i, apart[k : k + 1024])
        return sorted(out)

    return link


def _print_of(body: bytes) -> bytes:
    return body[4 : 4 + int.from_bytes(body[:4], "big")]


def by_edits(least: float = LEAST_EDIT) -> Callable[[list[bytes]], Callable[[int, int], bool]]:
    """Of bodies (a fingerprint's length, the fingerprint, the compressed text): are texts i and j of edit similarity ``least`` or more?"""

    def of(bodies: list[bytes]) -> Callable[[int, int], bool]:
        unpack = zstandard.ZstdDecompressor()

        @lru_cache(maxsize=256)
        def text(i: int) -> str:
            return unpack.decompress(bodies[i][4 + int.from_bytes(bodies[i][:4], "big") :]).decode()

        @lru_cache(maxsize=1024)
        def grams(i: int) -> np.ndarray:
            return np.sort(window_hashes(np.frombuffer(text(i).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1), GRAM))

        def near(i: int, j: int) -> bool:
            short, long = sorted((i, j), key=lambda k: (len(text(k)), k))
            most = int((1 - least) * len(text(long)) + 1e-9)
            if len(text(long)) - len(text(short)) > most:
                return False
            # An edit changes GRAM of the longer text's grams at most; what isn't in the shorter one has been changed.
            a, b = grams(long), grams(short)
            if len(b) and len(a) - np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a) > GRAM * most:
                return False
            return within_edits(text(short), text(long), most)

        return near

    return of


def clusters(table: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", part: int = 1024, broadcast_ids: int = 500_000, exact: bool = False) -> DataFrame:
    """``u``, ``root`` for each id that near-duplicates link to a lesser one, the least of its cluster.

    ``table`` has the ``prints`` of ``docs`` and is read twice.  Groups are first linked by fingerprints alone; texts are read
    for documents that these leave in doubt.  Up to ``broadcast_ids`` ids are broadcast; more are joined by shuffling.
    ``exact`` compares all documents whose lengths are of one level (a tenth apart) or of neighbouring ones, without bands.
    """
    buckets = shuffle_partitions(table.sparkSession)
    rows = table.select(quoted(key).cast("bigint").alias("id"), "tie", "print", "bands", "n_chars").where("id is not null and n_chars > 0")

    def ship(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least_of: dict[bytes, tuple[int, bytes]] = {}
            for i, p, b in zip(*(batch.column(c).to_pylist() for c in ("id", "print", "bands")), strict=True):
                least_of[p] = min((i, b), least_of.get(p, (i, b)))
            owner = np.repeat([i for i, _ in least_of.values()], [len(b) // 8 for _, b in least_of.values()]).astype(np.int64)
            yield star_packets(owner, np.frombuffer(b"".join(b for _, b in least_of.values()), np.uint64), buckets)

    def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal fingerprints of a batch are links already."""
        for batch in batches:
            least_of: dict[bytes, int] = {}
            pairs = [*zip(batch.column("id").to_pylist(), batch.column("print").to_pylist(), strict=True)]
            for i, p in pairs:
                least_of[p] = min(i, least_of.get(p, i))
            yield pair_batch(*np.array(sorted({(i, least_of[p]) for i, p in pairs if least_of[p] != i}), np.int64).reshape(-1, 2).T)

    if exact:
        level = F.floor(F.ln(F.col("n_chars").cast("double")) / math.log(1.1)).cast("bigint")
        grouped = rows.select("id", "tie", "print", F.explode(F.array(level, level + 1)).alias("group"))
    else:
        # A group is a document and those that have a band of which it is the least owner; so all that share a band share a group.
        met = checkpoint(star_edges(rows.mapInArrow(ship, PACKET), buckets).where("u <> v").distinct())
        member = checkpoint(met.select(F.col("u").alias("id"), F.col("v").alias("group")).union(met.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct()))
        few = member.count() <= broadcast_ids
        grouped = rows.join(F.broadcast(member) if few else member, "id").select("id", "tie", "print", "group")
    # One document for each fingerprint of a group, to which the others are linked: those that their batches shipped.
    grouped = checkpoint(grouped)
    heads = checkpoint(grouped.groupBy("group", "print").agg(F.min(F.struct("id", "tie")).alias("head")).select("group", "print", "head.*"))
    alike = grouped.select("group", "print", F.col("id").alias("u")).join(heads.select("group", "print", F.col("id").alias("v")), ["group", "print"]).select("u", "v").where("u <> v")
    doubt = -1.0 if exact else DOUBT
    first = checkpoint(group_links(heads.select("group", "id", F.col("print").alias("body")), forest(doubt=doubt), part))
    sure = first.union(alike).union(rows.mapInArrow(copies, LINKS))
    roots = components(sure)

    # Texts of those that fingerprints leave in doubt, in groups that aren't one cluster yet; clusters stand for their documents.
    unsure = first.where("u = v").select(F.col("u").alias("id")).distinct()
    placed = heads.join(unsure, "id").join(roots.withColumnRenamed("u", "id"), "id", "left").withColumn("cluster", F.coalesce("root", "id")).drop("root")
    apart = placed.groupBy("group").agg((F.min("cluster") < F.max("cluster")).alias("apart")).where("apart").select("group")
    placed = checkpoint(placed.join(apart, "group"))
    ids = placed.select("id", "tie").distinct()
    few = ids.count() <= broadcast_ids
    texts = docs.select(quoted(key).cast("bigint").alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text")).withColumn("tie", text_tie(F.col("text")))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [press.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(packed, pa.binary())], names=["id", "tie", "packed"])

    sent = texts.join(F.broadcast(ids) if few else ids, ["id", "tie"], "left_semi").select("id", "tie", "text").mapInArrow(pack, "id bigint, tie bigint, packed binary")
    length = F.unhex(F.lpad(F.hex(F.length("print")), 8, "0"))
    asked = checkpoint(sent.join(placed, ["id", "tie"]).select("group", F.col("cluster").alias("id"), F.concat(length, "print", "packed").alias("body")))
    more = group_links(asked, forest(by_edits(), doubt, lambda bodies: [_print_of(x) for x in bodies]), part)
    return components(sure.union(more))


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_ids: int = 500_000) -> DataFrame:
    """One row a document: its id, ``n_chars``, ``edited_sha256``, both fingerprints (in hex), their likeness, that of the next one's, and ``cluster_id``.

    ``cluster_id`` is the least id that near-duplicates connect, the document's own included.  The fingerprints are
    written to the shared folder once; up to ``broadcast_ids`` clustered ids are broadcast, more are joined by shuffling.
    """
    spark = docs.sparkSession
    folder = f"{scratch(spark, 'fingerprints')}/prints"
    prints(docs, key, text).write.option("compression", "zstd").parquet(folder)
    table = spark.read.parquet(folder)
    roots = clusters(table, docs, key, text)
    roots = F.broadcast(roots) if roots.count() <= broadcast_ids else roots
    shown = lambda c: F.lower(F.concat(F.hex(F.substring(c, 1, 5)), F.lit(":"), F.hex(F.expr(f"substring({c}, 6)"))))
    out = table.withColumn("u", quoted(key).cast("bigint")).join(roots, "u", "left")
    return out.select(
        quoted(key), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), shown("print").alias("fingerprint"), shown("edited_print").alias("edited_fingerprint"), "near_edited", "near_next",
        F.coalesce("root", "u").alias("cluster_id"),
    )
