"""Pieces without Spark, each against a plain version."""

from __future__ import annotations

import gzip
import io
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import decontaminate, fingerprints, jaccard, language_model, quality, substrings, warc
from corpusloom.llm.common import LOWER_BYTES, chunks, window_hashes, word_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.lists(st.text(alphabet="ab é\n\x0b\x1c ", max_size=30), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_and_hashes(texts):
    hashes, bounds = word_hashes([t.encode() for t in texts])
    words = [WORDS.findall(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    by_hash = {}
    assert all(by_hash.setdefault(h, w) == w for h, w in zip(hashes.tolist(), flat, strict=True))
    windows = window_hashes(hashes, 3).tolist()
    assert len(set(windows)) == len({tuple(flat[i : i + 3]) for i in range(len(flat) - 2)})


def test_chunks_keep_long_texts_whole():
    assert [*chunks([b"a" * 3, b"b" * 50, b"c", b"d"], 8)] == [(0, 1), (1, 2), (2, 4)]
    assert [*chunks([], 8)] == []


@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=6))
@settings(max_examples=80, deadline=None)
def test_fm_index(symbols, patterns):
    s = np.array(symbols)
    index = decontaminate.FMIndex(s, 4)
    lengths = np.array([len(p) for p in patterns])
    padded = np.array([p + [0] * (4 - len(p)) for p in patterns])
    low, high = index.search(padded, lengths)
    for p, a, b in zip(patterns, low, high, strict=True):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(len(symbols)) if symbols[i : i + len(p)] == p]


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 6)), max_size=12))
def test_merged_spans(pairs):
    spans = decontaminate.merged(np.array([(a, a + n) for a, n in pairs], np.int64).reshape(-1, 2)).tolist()
    covered = {i for a, n in pairs for i in range(a, a + n)}
    assert {i for a, b in spans for i in range(a, b)} == covered
    assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


@given(st.lists(st.floats(0, 1), min_size=1, max_size=30))
def test_isotonic(values):
    out = quality.isotonic(np.array(values), np.ones(len(values)))
    assert len(out) == len(values) and all(a <= b + 1e-12 for a, b in zip(out, out[1:], strict=False))
    assert math.isclose(sum(out), sum(values), abs_tol=1e-9)


def test_statistics_of_odd_texts():
    for text in (b"", b" ", b"\n\n", "é".encode(), b"A", b"x" * 300_000):
        assert len(quality.statistics(text)) == len(quality.STATISTICS) and np.isfinite(quality.statistics(text)).all()


def brute_components(sets):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = label[i], label[j]
                label = [y if v == x else v for v in label]
    return label


@pytest.mark.parametrize("seed", range(25))
def test_forest_connects_what_links_connect(seed):
    r = random.Random(seed)
    base = [r.sample(range(1, 400), r.randint(1, 60)) for _ in range(6)]
    sets = []
    for _ in range(40):
        s = set(r.choice(base))
        for _ in range(r.randint(0, max(1, len(s) // 5))):
            s.symmetric_difference_update({r.randint(1, 400)})
        if s:
            sets.append(np.array(sorted(s), np.uint64))
    wanted = brute_components(sets)
    got = list(range(len(sets)))
    for u, v in jaccard.forest(list(range(len(sets))), [x.tobytes() for x in sets]):
        x, y = got[u], got[v]
        got = [y if g == x else g for g in got]
    same = lambda label: {frozenset(i for i in range(len(label)) if label[i] == k) for k in label}
    assert same(got) == same(wanted)


def test_required_is_exact_for_small_sets_and_never_too_much():
    n = np.arange(1, 2000)
    need = jaccard.required(n)
    assert (need[:128] == np.ceil(0.75 * n[:128])).all() and (need >= 1).all() and (need <= np.ceil(0.75 * n)).all()
    r = np.random.default_rng(3)
    for size in (130, 171, 172, 400, 1500):
        for _ in range(40):
            x = np.unique(r.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            y = np.unique(np.append(x[np.sort(r.choice(len(x), int(0.87 * len(x)), replace=False))], r.integers(0, 2**63, int(0.12 * size), dtype=np.uint64)))
            if 4 * len(np.intersect1d(x, y)) >= 3 * len(np.union1d(x, y)):
                shared = len(np.intersect1d(jaccard.selected(x), jaccard.selected(y)))
                assert shared >= jaccard.required(np.array([len(x)]))[0] and shared >= jaccard.required(np.array([len(y)]))[0]


def test_divide_skip_finds_the_required_overlap():
    r = random.Random(5)
    index, sets = jaccard.Pivots(50), []
    for _ in range(60):
        s = sorted(r.sample(range(50), r.randint(1, 30)))
        sets.append(s)
        index.add(np.array(s))
    for _ in range(40):
        q = sorted(r.sample(range(50), r.randint(1, 30)))
        least = r.randint(1, len(q))
        found, common = index.search(np.array(q), least)
        wanted = {i: len(set(s) & set(q)) for i, s in enumerate(sets) if len(set(s) & set(q)) >= least}
        assert dict(zip(found.tolist(), common.tolist(), strict=True)) == wanted


def brute_removed(texts, length):
    words = [t.split() for t in texts]
    starts = {}
    for d, w in enumerate(words):
        for i in range(len(w) - length + 1):
            starts.setdefault(tuple(w[i : i + length]), []).append((d, i))
    out = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                out[d].update(range(i, i + length))
    return out


def packets_of(batches):
    out = {}
    for batch in batches:
        for bucket, *packet in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out.setdefault(bucket, []).append(packet)
    return out


@pytest.mark.parametrize("bits", [64, 4])
@pytest.mark.parametrize("seed", range(20))
def test_blocks_find_all_repeats(seed, bits, monkeypatch):
    """Whatever clashes in 4 bits of a hash, the removed words are those of equal windows."""
    if bits < 64:
        monkeypatch.setattr(substrings, "window_hashes", lambda *a: window_hashes(*a) & np.uint64((1 << bits) - 1))
    r = random.Random(seed)
    passages = [[str(r.randint(0, 30)) for _ in range(r.randint(5, 40))] for _ in range(5)]
    texts = [" \n".join(sum((r.choice([r.choice(passages), [str(r.randint(0, 30)) for _ in range(12)], ["7"] * 15]) for _ in range(r.randint(0, 5))), [])).encode() for _ in range(12)]
    length, ids, signatures = 9, np.arange(12), [bytes([i]) * substrings.SIGNATURE for i in range(12)]
    halves = (slice(0, 6), slice(6, 12))
    told = np.unique(substrings.phrases(word_hashes(texts)[0], 4))
    got = [set() for _ in texts]
    for held in packets_of(b for h in halves for b in substrings.routed(texts[h], ids[h], signatures[h], told, length, 4, 3)).values():
        for d, s, a, b in zip(*(c.to_pylist() for c in substrings.parsed_block(held, length).columns), strict=True):
            assert s == signatures[d] and b - a >= length
            got[d].update(range(a, b))
    assert got == brute_removed(texts, length)


@given(st.lists(st.lists(st.integers(1, 3), max_size=25), min_size=1, max_size=5), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_greedy_parse(texts, length):
    """Matches are the longest ones with any other place, and factors cover every place of a match of ``length``."""
    symbols = [x for i, t in enumerate(texts) for x in [*t, 10 + i]] + [0]
    n = len(symbols)

    def common(i, j):
        k = 0
        while max(i, j) + k < n and symbols[i + k] == symbols[j + k]:
            k += 1
        return k

    longest = [max(common(i, j) for j in range(n) if j != i) if n > 1 else 0 for i in range(n)]
    got = substrings.longest_matches(np.array(symbols), length)
    assert got.tolist() == [k if k >= length else 0 for k in longest]
    begin, end = (x.tolist() for x in substrings.factors(got, length))
    assert all(e - b == longest[b] for b, e in zip(begin, end, strict=True)) and all(c >= e - length + 1 for e, c in zip(end, begin[1:], strict=False))
    assert {i for b, e in zip(begin, end, strict=True) for i in range(b, e)} == {i for b in range(n) if longest[b] >= length for i in range(b, b + longest[b])}


def test_least_in_windows():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 8):
        v = r.integers(0, 2**63, 50, dtype=np.uint64)
        assert substrings.least_in_windows(v, width).tolist() == [i + int(np.argmin(v[i : i + width] >> np.uint64(30))) for i in range(51 - width)]


def test_walks_are_shared_and_cover_whole_texts():
    texts = ["", "a", "abc" * 400, "abc" * 400, "abc" * 300 + "xyz" * 100, "é😀" * 50]
    found = fingerprints.Fingerprints.walked(texts)
    prints = [found.print(i) for i in range(len(texts))]
    assert prints[2] == prints[3] and len(set(prints)) == 5 and prints[0] == bytes(5)
    i, j = np.array([2, 0, 0, 2, 2]), np.array([3, 0, 1, 4, 5])
    alike = found.likeness(i, j).tolist()
    assert alike[:3] == [1.0, 1.0, 0.0] and 0.3 < alike[3] < 1 and alike[4] < 0.3
    again = fingerprints.Fingerprints.walked(texts[::-1])
    assert [again.print(i) for i in range(len(texts))] == prints[::-1]
    assert fingerprints.Fingerprints.of(prints).likeness(i, j).tolist() == alike


def test_every_code_point_has_its_own_bits():
    """Runs of characters that the texts don't share are seen, whatever the characters."""
    pairs = [("the quick " + " " * 40 + " brown", "the quick " + c * 40 + " brown") for c in "Wçв日eC0gA\U0001f600"]
    found = fingerprints.Fingerprints.walked([t for p in pairs for t in p])
    assert (found.likeness(np.arange(0, 20, 2), np.arange(1, 20, 2)) < 0.9).all()


def walk(text, steps):
    """One walk, character by character, as the definition says: its length and what is written at the sampled steps."""
    codes = fingerprints.characters(np.array([ord(c) for c in text], np.uint32)).tolist()
    moves, i, out, bits = fingerprints._moves(0, steps).tolist(), 0, 0, []
    sampled, _, written = (x.tolist() for x in fingerprints.sampled_steps(128))
    factor = dict(zip(sampled, written, strict=True))
    for j in range(steps):
        if i == len(codes):
            break
        if j in factor:
            bits.append((codes[i] * factor[j] & 0xFFFFFFFF) >> 31)
        out += 1
        i += (codes[i] * moves[j] & 0xFFFFFFFF) >> 31
    return out, bits


@pytest.mark.parametrize("alone", [0, 2, 100])
def test_walks_are_those_of_the_definition(alone, monkeypatch):
    monkeypatch.setattr(fingerprints, "ALONE", alone)
    texts = ["hello world", "x", "zq" * 300, "", "日本語 text " * 40]
    length, bits, *_ = fingerprints.walks(texts)
    for k, t in enumerate(texts):
        n, wanted = walk(t, 8 * len(t) + 64)
        assert length[k] == n and bits[k, : len(wanted)].tolist() == wanted and not bits[k, len(wanted) :].any()


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=12), st.text("abé", max_size=12))
def test_edit_similarity(a, b):
    whole = max(len(a), len(b))
    assert fingerprints.edit_similarity(a, b) == (1.0 if a == b else 1 - levenshtein(a, b) / whole)


@given(st.text(alphabet="abc", max_size=20), st.lists(st.tuples(st.integers(0, 19), st.sampled_from(["", "a", "bc"]), st.integers(0, 2)), max_size=6), st.integers(0, 9))
@settings(max_examples=400, deadline=None)
def test_within_edits(a, changes, most):
    b = a
    for at, new, gone in changes:
        b = b[:at] + new + b[at + gone :]
    assert fingerprints.within_edits(a, b, most) == fingerprints.within_edits(b, a, most) == (levenshtein(a, b) <= most)


def test_edits_of_long_texts_are_not_counted_to_the_end():
    rng = random.Random(3)
    a = "".join(rng.choices("abcdefgh ", k=20_000))
    b = "".join(rng.choice("abcdefgh ") if rng.random() < 0.3 else c for c in a)
    seen = 0

    class Counted(str):
        def __iter__(self):
            for c in str(self):
                nonlocal seen
                seen += 1
                yield c

    real = fingerprints._trimmed
    try:
        fingerprints._trimmed = lambda x, y: tuple(map(Counted, real(x, y)))
        assert not fingerprints.within_edits(a, b, 1000)
    finally:
        fingerprints._trimmed = real
    assert 0 < seen < 10_000


def test_bands_are_consecutive_bits_of_the_walk():
    """A band's key is made of the bits that the walk writes from its beginning on."""
    texts = ["hello world, " * 9, "x", "", "日本語 text " * 40]
    for alone in (0, 100):
        before, fingerprints.ALONE = fingerprints.ALONE, alone
        length, _, owner, key = fingerprints.walks([*texts, "another one"], banded=4)
        fingerprints.ALONE = before
        begin, octave = fingerprints.band_steps()
        for i, text in enumerate(texts):
            codes = [*fingerprints.characters(np.array([ord(c) for c in text], np.uint32)).tolist(), *([0] * 99)]
            moves, at, where = fingerprints._moves(0, 9000).tolist(), 0, {}
            for j in range(int(length[i])):
                where[j] = at
                at += (codes[at] * moves[j] & 0xFFFFFFFF) >> 31
            top, wanted = max(0, int(length[i]) - 1).bit_length(), []
            for band, (j, o) in enumerate(zip(begin.tolist(), octave.tolist(), strict=True)):
                if j < length[i] and o > top - fingerprints.BAND_OCTAVES:
                    at, bits = where[j], 0
                    for move, write in zip(fingerprints._moves(j, fingerprints.BAND_BITS).tolist(), fingerprints._writes(j, fingerprints.BAND_BITS).tolist(), strict=True):
                        bits = bits << 1 | (codes[at] * write & 0xFFFFFFFF) >> 31
                        at += (codes[at] * move & 0xFFFFFFFF) >> 31
                    wanted.append(bits + (band << fingerprints.BAND_BITS))
            assert key[owner == i].tolist() == fingerprints.mixed(np.array(wanted, np.uint64)).tolist()


def edits(r, text, share):
    """The text after so many insertions, deletions and substitutions at random places."""
    out = list(text)
    for _ in range(int(share * len(text))):
        at, kind = r.randrange(len(out)), r.randrange(3)
        out[at : at + (kind > 0)] = [r.choice("abcdefgh ")] if kind < 2 else []
    return "".join(out)


def test_bands_meet_after_edits():
    """Texts with up to 5 % of edits meet in a band; texts that have nothing to do with each other don't."""
    r = random.Random(8)
    texts = []
    for k in range(300):
        text = "".join(r.choice("abcdefghij klmnop") for _ in range(r.randint(200, 6000)))
        texts += [text, edits(r, text, 0.05 * k / 300)]
    _, _, owner, key = fingerprints.walks(texts, banded=600)
    keys = [set(key[owner == i].tolist()) for i in range(600)]
    assert np.mean([bool(keys[2 * k] & keys[2 * k + 1]) for k in range(300)]) >= 0.9
    assert not any(keys[2 * k] & keys[2 * k + 2] for k in range(299))


def test_edited():
    assert fingerprints.edited("abcde", "XYZ") == "abcXY" and fingerprints.edited("abcdef", "X") == "abcX" and fingerprints.edited("", "x") == ""


def levels_of(texts, depth):
    keys, _ = language_model.keys_of(texts, depth)
    return [language_model.counted(keys & np.uint64((1 << (8 * (d + 1))) - 1)) for d in range(depth + 1)]


def test_context_tree_is_a_distribution_and_matches_a_plain_one():
    texts = [b"abracadabra", b"abra", b""]
    built = language_model.tree(levels_of(texts, 2))
    for context in (0x6162, 0x7A7A, 0xFFFF):
        grams = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert math.isclose(float((10 ** built.log10(grams)).sum()), 1, rel_tol=1e-9)

    # Plain: counts by context and bit prefix, mixed from the deepest known node up.
    counts = {}
    for t in texts:
        x = b"\xff\xff" + t + b"\xff"
        for i in range(2, len(x)):
            for d in range(3):
                node = 1
                for b in range(8):
                    bit = x[i] >> (7 - b) & 1
                    c = counts.setdefault((x[i - d : i], node), [0, 0])
                    c[bit] += 1
                    node = node * 2 + bit

    def own(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)

    def weighted(context, node):
        below = [k for k in counts if k[1] == node and len(k[0]) == len(context) + 1 and k[0].endswith(context)]
        if not below:
            return own(counts[context, node]), 1.0
        inner = sum(weighted(*k)[0] for k in below)
        e = own(counts[context, node])
        w = np.logaddexp(e, inner) - math.log(2)
        return w, math.exp(e - math.log(2) - w)

    def one(history, node, d=0):
        context = history[len(history) - d :]
        c = counts[context, node]
        kt = (c[1] + 0.5) / (sum(c) + 1)
        deeper = history[len(history) - d - 1 :]
        if d == 2 or (deeper, node) not in counts:
            return kt
        stay = weighted(context, node)[1]
        return stay * kt + (1 - stay) * one(history, node, d + 1)

    for history, byte in ((b"br", ord("a")), (b"zz", ord("a")), (b"xb", ord("r"))):
        wanted, node = 0.0, 1
        for b in range(8):
            bit = byte >> (7 - b) & 1
            p = one(history, node) if (b"", node) in counts else 0.5
            wanted += math.log10(p if bit else 1 - p)
            node = node * 2 + bit
        got = float(built.log10(np.array([int.from_bytes(history, "big") << 8 | byte], np.uint64))[0])
        assert math.isclose(got, wanted, rel_tol=1e-9)


def test_context_tree_in_parts_weighs_all_children():
    texts = [b"the cat sat on the mat", b"that hat", b"a rat", b""]
    levels = levels_of(texts, 4)
    whole = language_model.tree(levels)
    part = language_model.Levels(levels[2:], 2)
    top = language_model.Levels(levels[:2], 0, (part.above(0), part.weighted))
    ones, given, left = top.final()
    at = np.searchsorted(top.nodes[-1], part.above(0))
    for got, wanted in zip([*ones, *part.final(given[at], left[at])[0]], whole.ones, strict=True):
        assert np.allclose(got, wanted, rtol=1e-12)


def test_context_tree_refuses_nodes_without_parents():
    levels = levels_of([b"the cat sat on the mat", b"that hat"], 3)
    levels[2] = tuple(a[:-4] for a in levels[2])
    with pytest.raises(ValueError, match="no parent"):
        language_model.tree(levels)


def test_lookup_agrees_with_the_tree():
    texts = [b"the cat sat on the mat", b"The dog"]
    built = language_model.tree(levels_of(texts, 3))
    grams = language_model.counted(language_model.keys_of(texts, 3)[0])[0]
    look = language_model.Lookup(grams, built.log10(grams).astype(np.float32), built)
    asked = language_model.keys_of([b"the rat sat", b"zzz", b""], 3)[0]
    assert np.allclose(look(asked), built.log10(asked), atol=1e-6)


def test_gram_keys_lower_case_and_end():
    keys, starts = language_model.keys_of([b"Ab", b""], 1)
    assert keys.tolist() == [0xFF61, 0x6162, 0x62FF, 0xFFFF] and starts.tolist() == [0, 3] and len(LOWER_BYTES) == 256


@given(st.lists(st.binary(max_size=200), max_size=6), st.integers(1, 50))
def test_members_of_a_stream(parts, size):
    data = b"".join(gzip.compress(p) for p in parts)
    assert [*warc.members(io.BytesIO(data), size)] == parts


def test_records_round_trip_and_damage_is_seen():
    whole = warc.record(7, "http://x/\r\nEvil: 1", "é".encode(), None, False, warc.EMPTY_DATE)
    assert warc.parsed(whole) == {"page_id": 7, "payload_bytes": 2, "payload_digest": warc.digest("é".encode()), "record_type": "response", "refers_to": None}
    again = warc.record(3, None, b"abc", 7, True, warc.EMPTY_DATE)
    assert warc.parsed(again)["refers_to"] == 7 and warc.parsed(again)["payload_bytes"] == 3 and b"abc" not in again
    with pytest.raises(ValueError):
        warc.parsed(whole.replace("é".encode(), b"xx"))
    with pytest.raises(EOFError):
        list(warc.members(io.BytesIO(gzip.compress(whole)[:-9])))
