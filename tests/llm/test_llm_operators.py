"""Operators on small tables with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, fingerprints, jaccard, language_id, language_model, mixing, quality, spanning, substrings, urls, warc
from corpusloom.llm.common import checkpoint, fold

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(r, n, stem=""):
    return " ".join(stem + r.choice(["the", "of", "and", "rent", "tion", "house", "water", "stone", "bird"]) + str(r.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    passage = sentence(r, 50)
    out = [(i, sentence(r, r.randint(0, 120)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(40)]
    out += [(100 + i, f"{sentence(r, 30)} {passage} {sentence(r, 30)}", "en", "s0") for i in range(4)]
    base = sentence(r, 200).split()
    out += [(200 + i, " ".join(w if j != 7 * i else "changed" for j, w in enumerate(base)), "en", None) for i in range(6)]
    out += [(300, None, "en", "s1"), (301, "", None, "s1"), (302, " \t\n", "en", "s1"), (303, "one two", "en", "s1"), (304, "one TWO", "de", "s1"), (305, "12 34 !!", "en", "s1"), (306, "long word " * 60_000, "en", "s2"), (None, "no id at all", "en", "s2"), (303, "one two", "en", "s1"), (307, "x" * 200_000, None, "s2")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(frame, key="doc_id"):
    out = {}
    for r in frame.collect():
        out.setdefault(r[key], []).append(r)
    return out


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORDS.findall(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    label = {i: i for i, _ in sets}
    for a, x in sets:
        for b, y in sets:
            if x and y and 100 * len(x & y) >= 75 * len(x | y) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_jaccard(rows, docs, none):
    out = by_id(jaccard.join(docs), "id")
    wanted = brute_components(rows)
    assert sum(map(len, out.values())) == len(rows)
    for i, t, *_ in rows:
        assert {r.n_shingles for r in out[i]} >= {len(shingles(t))}
        if i is not None:
            assert {r.component_id for r in out[i]} == {wanted[i]}
    assert jaccard.join(none).count() == 0
    kept = {r.doc_id for r in jaccard.one_of_each(docs).collect()}
    assert kept == {i for i, *_ in rows if i is None or wanted[i] == i}


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("group_sets", [2, 5, 1000])
def test_jaccard_in_parts(spark, rows, group_sets, exact):
    """Groups beyond the bound are dealt to parts, frequent shingles looked up, candidates beyond theirs joined: with the same result."""
    r = random.Random(2)
    base = sentence(r, 300).split()
    copies = [(i, " ".join(w if r.random() > 0.02 else "x" for w in base)) for i in range(24)]
    copies += [(100 + i, " ".join(base[: 150 + 10 * i])) for i in range(9)]
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in copies], DOCS)
    out = {x.id: x.component_id for x in jaccard.join(frame, group_sets=group_sets, broadcast_ids=0, hot=3, exact=exact).collect()}
    assert out == brute_components(copies)


def test_jaccard_keeps_columns_of_any_name(spark):
    names = "id row __id component_id group body n s1 s2".split()
    frame = spark.createDataFrame([(1, "one two", *names), (1, "one two", *names), (2, "ONE two", *names), (None, "x", *names)], "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    out = jaccard.one_of_each(frame)
    assert out.columns == frame.columns and sorted((str(x.doc_id), x.id, x.component_id) for x in out.collect()) == [("1", "id", "component_id")] * 2 + [("None", "id", "component_id")]


@pytest.mark.parametrize("size", [3, 7, 50])
@pytest.mark.parametrize("seed", range(2))
def test_group_links(spark, seed, size):
    """Chains, stars and strays in groups of any size are connected as all pairs connect them."""
    r = random.Random(seed)
    points = [(g, 100 * g + k, r.choice([1000 * g, r.randint(0, 90), k * 2])) for g in range(3) for k in range(r.choice([2, 12, 30]))]

    def forest(ids, bodies):
        sets = spanning.Sets()
        return [(i, j) for k, (i, a) in enumerate(zip(ids, bodies, strict=True)) for j, b in zip(ids[:k], bodies, strict=False) if abs(int(a) - int(b)) <= 2 and sets.join(i, j)]

    members = checkpoint(spark.createDataFrame([(g, i, str(p).encode()) for g, i, p in points], "group bigint, id bigint, body binary"))
    got, wanted = spanning.Sets(), spanning.Sets()
    for x in spanning.group_links(members, forest, size).collect():
        got.join(x.u, x.v)
    for g, i, a in points:
        for h, j, b in points:
            if g == h and abs(a - b) <= 2:
                wanted.join(i, j)
    assert all(got.root(i) == wanted.root(i) for _, i, _ in points)


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components(spark, one_task):
    r = random.Random(4)
    pairs = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    label = {k: k for p in pairs for k in p}
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    got = {x.u: x.root for x in spanning.components(spark.createDataFrame(pairs, "u bigint, v bigint"), one_task).collect()}
    assert got == {k: v for k, v in label.items() if k != v}


def brute_removed(rows, length):
    words = [WORDS.findall(t or "") for _, t, *_ in rows]
    starts = {}
    for d, w in enumerate(words):
        for i in range(len(w) - length + 1):
            starts.setdefault(tuple(w[i : i + length]), []).append((d, i))
    gone = [set() for _ in words]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + length))
    return [(len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest()) for w, g in zip(words, gone, strict=True)]


@pytest.mark.parametrize("limit", [0, 2_000_000])
def test_substrings(rows, docs, none, limit):
    """Joined by shuffling or by broadcast, spans cover what brute force removes."""
    wanted = brute_removed(rows, 35)
    cut = by_id(substrings.with_spans(docs, broadcast_spans=limit, broadcast_anchors=limit))
    assert sum(map(len, cut.values())) == len(rows)
    for (i, t, *_), (_, n, _) in zip(rows, wanted, strict=True):
        assert n in {len({k for s in r.repeated_spans or () for k in range(s.start, s.stop)}) for r in cut[i] if r.text == t}
    out = by_id(substrings.removed(docs))
    for (i, t, *_), numbers in zip(rows, wanted, strict=True):
        assert numbers in {(r.n_words, r.n_removed, r.kept_sha256) for r in out[i]}
        if not numbers[1]:
            assert t in {r.text for r in out[i]}
    assert substrings.removed(none).count() == 0


def test_substrings_with_rows_of_one_id_and_clashing_names(spark, monkeypatch):
    r = random.Random(9)
    passage = sentence(r, 60)
    made = [(None, f"{sentence(r, 20)} {passage} {sentence(r, k)}") for k in range(8)] + [(None, sentence(r, 80)) for _ in range(40)] + [(3, passage)] * 2
    names = "__id __body ident signature row owner told spans start stop block".split()
    frame = spark.createDataFrame([(i, t, *[str(k) + n for n in names]) for k, (i, t) in enumerate(made)], "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names)).withColumns({"n_words": F.lit("mine"), "repeated_spans": F.lit(1)})
    # What the texts of one owner are told is a superset, whatever owners clash.
    monkeypatch.setattr(substrings, "owner_of", lambda ident, signature: F.pmod(F.xxhash64(ident, signature), F.lit(4)))
    out = substrings.removed(frame)
    assert out.columns == ["doc_id", "text", *names, "n_words", "n_removed", "kept_sha256"]
    wanted = sorted(zip(brute_removed(made, 35), [str(k) for k in range(len(made))], strict=True))
    assert sorted(((x.n_words, x.n_removed, x.kept_sha256), x.owner.removesuffix("owner")) for x in out.collect()) == wanted
    assert {x[n].lstrip("0123456789") for x in out.collect() for n in ("__id", "__body", "ident")} == {"__id", "__body", "ident"}


def brute_hits(text, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    w, hit, found = words(text), set(), set()
    for k, t in items:
        x = words(t)
        for i in range(max(1, len(x) - window + 1) if x else 0):
            part = x[i : i + window]
            for j in range(len(w) - len(part) + 1):
                if w[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add(str(k))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [40, 300, 8 << 20])
def test_decontaminate(spark, rows, docs, none, block):
    texts = {i: t for i, t, *_ in rows}
    items = [(1, texts[100][150:600]), (2, texts[5][:200]), (30, "ONE, two"), (4, None), (5, "?!"), (6, texts[5][:200]), (7, "absent words here"), (8, "é" + texts[201][:300])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    out = by_id(decontaminate.find(docs, benchmark, block_bytes=block, shard_bytes=3000).withColumn("n_hit", decontaminate.n_hit()))
    for i, t, *_ in rows:
        if len(t or "") < 100_000:
            assert brute_hits(t, items, 10) in [(r.n_words, r.n_hit, r.hit_items) for r in out[i]]
    assert decontaminate.find(none, benchmark).count() == 0
    assert decontaminate.decontaminated(docs, benchmark.where("false")).count() == len(rows)
    kept = decontaminate.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, t, *_ in rows if not any("0" not in r.hit_items and r.n_hit for r in out[i])}


@pytest.mark.parametrize("block", [60, 8 << 20])
def test_decontaminate_searches_items_without_an_id(spark, block):
    passage = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "clean text"), (3, passage[:90])], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(None, passage), (None, passage), (7, passage[:90])], "item_id bigint, text string")
    out = {r.doc_id: (r.n_hit, r.hit_items) for r in decontaminate.find(docs, benchmark, block_bytes=block).withColumn("n_hit", decontaminate.n_hit()).collect()}
    assert out[1][0] == 30 and out[1][1] == ["7", None] and out[2] == (0, [])
    assert {r.doc_id for r in decontaminate.decontaminated(docs, benchmark.where("item_id is null")).collect()} == {2}


def test_language_id(spark, docs, rows, none):
    r = random.Random(3)
    made = [(i, sentence(r, 30, "sch") if i % 2 else sentence(r, 30, "qu"), "de" if i % 2 else "fr", None, 0) for i in range(80)]
    train = spark.createDataFrame(made[:60], DOCS)
    model = language_id.fit(train, landmarks_per_label=5)
    out = language_id.predict(spark.createDataFrame(made[60:], DOCS), model).collect()
    assert all(x.lang_pred == x.lang for x in out) and all(0 <= x.score <= 1 for x in out)
    odd = by_id(language_id.predict(docs, model))
    assert sum(map(len, odd.values())) == len(rows)
    for i in (300, 301, 302, 305):
        assert {(x.lang_pred, x.score) for x in odd[i]} == {("und", 0.0)}
    assert {x.lang_pred for x in language_id.predict(docs, language_id.fit(none)).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0
    clash = language_id.predict(docs.withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(1)), model)
    assert dict(clash.dtypes)["score"] == "double" and len(clash.columns) == len({*clash.columns})


def test_language_id_is_kernel_ridge(spark):
    """The scores are those of a plain kernel ridge regression on Nystrom features of gram sets."""
    r = random.Random(13)
    made = [(i, sentence(r, r.randint(1, 12), ["sch", "qu", "zh"][i % 3]) + "é" * (i % 2), ["de", "fr", "pl"][i % 3], None, 0) for i in range(45)] + [(100, "x" * 500, "zz", None, 0)]
    frame = spark.createDataFrame(made, DOCS)
    model = language_id.fit(frame, landmarks_per_label=4, landmark_bytes=300)
    got = {x.doc_id: (x.lang_pred, x.score) for x in language_id.predict(frame, model).collect()}

    def grams(text):
        b = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode()
        return {b[i : i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    # The landmarks are those texts whose sets the model holds.
    columns = {tuple(np.flatnonzero(c)) for c in model.landmarks.T}
    chosen = sorted(t for _, t, *_ in made if len(t) <= 300 and tuple(np.searchsorted(model.grams, np.unique(language_id._grams(t.encode())))) in columns and np.isin(language_id._grams(t.encode()), model.grams).all())
    assert 6 <= len(chosen) == model.landmarks.shape[1] <= 12 and model.labels == ["de", "fr", "pl", "zz"]
    known = set().union(*map(grams, chosen))
    kernel = lambda a, b: len(grams(a) & grams(b)) / (max(1, len(grams(a) & known)) * len(grams(b))) ** 0.5
    k = np.array([[kernel(a, b) for b in chosen] for a in chosen])
    values, vectors = np.linalg.eigh(k)
    good = values > 1e-6 * values.max()
    x = np.array([[kernel(t, b) for b in chosen] for _, t, *_ in made]) @ vectors[:, good] / np.sqrt(values[good])
    x = np.column_stack([x, np.ones(len(x))])
    y = np.array([[float(lang == c) for c in model.labels] for _, _, lang, *_ in made])
    penalty = np.diag([1e-3 * len(made)] * (x.shape[1] - 1) + [1e-9])
    out = np.clip(x @ np.linalg.solve(x.T @ x + penalty, x.T @ y), 1e-6, 1)
    for (i, *_), row in zip(made, out, strict=True):
        assert got[i][0] == model.labels[int(row.argmax())] and abs(got[i][1] - row.max() / row.sum()) < 1e-3
    with pytest.raises(ValueError, match="labels"):
        language_id.fit(frame, most_labels=2)
    long = language_id.fit(frame, landmark_bytes=0)
    assert {x.lang_pred for x in language_id.predict(frame, long).collect()} <= set(long.labels)


def test_quality_is_ridge_on_random_features(spark):
    """Weights, out-of-fold scores and calibration are those of plain least squares and of the min-max formula of isotonic regression."""
    r = random.Random(21)
    stats = [[*map(float, quality.statistics((sentence(r, r.randint(1, 40)) + "!" * (i % 7)).encode()))] for i in range(150)]
    train = [(s, int(r.random() < 0.2 + 0.6 * (i % 7 < 3)), i % 3) for i, s in enumerate(stats)]
    frame = spark.createDataFrame(train, "stats array<double>, label int, fold int").repartition(6)
    features, folds, bins = 12, 3, 40
    model = quality.fit(frame, features=features, folds=folds, bins=bins)
    z = np.array(stats)
    scale = np.maximum(z.std(0), 1e-6)
    x = np.column_stack([np.cos(np.clip((z - z.mean(0)) / scale, -8, 8) @ model.omega + model.phase) * np.sqrt(2 / features), np.ones(len(z))])
    y, k = np.array([t[1] for t in train], float), np.array([t[2] for t in train])

    def ridge(at):
        penalty = np.diag([1e-4 * at.sum()] * features + [1e-9 * 1e-4 * at.sum()])
        return np.linalg.lstsq(np.vstack([x[at], np.sqrt(penalty)]), np.concatenate([y[at], np.zeros(features + 1)]), rcond=None)[0]

    assert np.allclose(model.weights, ridge(np.ones(len(y), bool)), atol=1e-5)
    raw = np.array([x[i] @ ridge(k != k[i]) for i in range(len(y))])
    cell = np.clip(np.rint((raw + 0.5) / 2 * bins), 0, bins).astype(int)
    there = np.unique(cell)
    n, ones = (np.array([w[cell == c].sum() for c in there]) for w in (np.ones(len(y)), y))
    mean = (ones + 0.5 * y.mean()) / (n + 0.5)
    average = lambda a, b: (mean[a : b + 1] * n[a : b + 1]).sum() / n[a : b + 1].sum()
    level = [max(min(average(a, b) for b in range(i, len(there))) for a in range(i + 1)) for i in range(len(there))]
    knots = {}
    for c, v in zip(there, level, strict=True):
        knots.setdefault(round(v, 9), []).append(c / bins * 2 - 0.5)
    assert np.allclose(model.knots, [np.mean(v) for v in knots.values()]) and np.allclose(model.levels, [*knots])
    assert np.allclose(model.score(z), np.clip(np.interp(x @ model.weights, model.knots, model.levels), 0, 1))


def test_quality_keeps_columns_of_any_name(spark):
    frame = spark.createDataFrame([(i, "good words " * (i % 4), i % 4 != 1, *["mine"] * 5, "old") for i in range(20)] + [(None, None, True, *["mine"] * 5, "old")], "doc_id bigint, body string, train boolean, stats string, label string, fold string, row string, key string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1)], "doc_id bigint, quality int")
    out = quality.classify(frame, labels, "train", frame.columns, text="body")
    assert out.columns == [*frame.columns[:-1], "score", "predicted"]
    found = out.collect()
    assert len(found) == 21 and {x.stats for x in found} == {x.key for x in found} == {"mine"} and all(0 <= x.score <= 1 for x in found)


def test_quality(spark, docs, rows, none):
    r = random.Random(8)
    made = [(i, sentence(r, 60) if i % 3 else " | ".join(sentence(r, 40).upper().split()), None, None, 0) for i in range(300)]
    frame = spark.createDataFrame(made, DOCS).withColumn("held_out", fold(F.col("doc_id"), 5) == 0).withColumn("teaches", ~F.col("held_out"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(7, None), (9999, 1)], "doc_id bigint, quality int")
    out = quality.classify(frame, labels, "teaches", ["doc_id", "held_out", "teaches"]).where("held_out").collect()
    assert out and all(x.predicted == int(x.doc_id % 3 > 0) for x in out) and all(0 <= x.score <= 1 for x in out)
    taught = docs.withColumn("teaches", F.lit(True))
    blank = quality.classify(taught, labels.where("false"), "teaches", ["doc_id", "teaches"]).collect()
    assert len(blank) == len(rows) and {x.score for x in blank} == {0.5}
    assert quality.classify(none.withColumn("teaches", F.lit(True)), labels, "teaches", ["doc_id", "teaches"]).count() == 0


def test_language_model(rows, docs, none):
    import math
    from collections import Counter

    frame = docs.withColumn("teaches", fold(F.col("doc_id"), 7) != 2)
    taught = {r.doc_id for r in frame.where("teaches").select("doc_id").collect()}
    counts = Counter(w for i, t, *_ in rows if i in taught for w in [*WORDS.findall(lowered(t)), None])
    n, v = sum(counts.values()), len(counts)
    for hot in (300, 24 << 20):
        out = by_id(language_model.score(frame, "teaches", ["doc_id"], hot_words=hot, max_grams=400))
        for i, t, *_ in rows:
            w = [*WORDS.findall(lowered(t)), None]
            wanted = (len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 5))
            assert wanted in {(x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5)) for x in out[i]}
            assert all(x.score < 0 and math.isfinite(x.score) for x in out[i])
        assert len({x.score for x in out[303]}) == 1
    assert language_model.score(none.withColumn("teaches", F.lit(True)), "teaches", ["doc_id"]).count() == 0
    untaught = language_model.score(docs.withColumn("teaches", F.lit(False)), "teaches", ["doc_id"]).where("doc_id = 303").first()
    assert untaught.train_tokens == 0 and untaught.n_known == 0 and math.isclose(untaught.score, 8 * 8 * math.log10(0.5), rel_tol=1e-6)


@pytest.mark.parametrize("table", [0, 60, 1 << 19])
def test_language_model_keeps_every_context(docs, table):
    """The scores are those of one tree of all substrings, whatever number of them fits in a task's table."""
    frame = docs.withColumn("teaches", F.col("doc_id") % 3 != 0)
    given = [(r.doc_id, r.teaches, (r.text or "").encode()) for r in frame.select("doc_id", "teaches", "text").collect()]
    keys = language_model.keys_of([t for _, teaches, t in given if teaches], 5)[0]
    built = language_model.tree([language_model.counted(keys & np.uint64((1 << (8 * (d + 1))) - 1)) for d in range(6)])
    wanted = sorted((i is None, i or 0, float(built.log10(language_model.keys_of([t], 5)[0]).sum())) for i, _, t in given)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in language_model.score(frame, "teaches", ["doc_id"], max_grams=table).collect())
    assert [x[:2] for x in got] == [x[:2] for x in wanted]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in wanted], rel=1e-5)


def test_language_model_keeps_columns_of_any_name(spark):
    names = "row logs known rest n_words grams given text x word k gram shard".split()
    frame = spark.createDataFrame([(i, i % 3 > 0, "a word or two " * (i % 4), *names, "old") for i in range(12)], "doc_id bigint, train boolean, body string, " + ", ".join(f"{n} string" for n in names) + ", score string")
    out = language_model.score(frame, "train", frame.columns, text="body")
    assert out.columns == [*frame.columns[:-1], *language_model.RESULTS]
    assert {tuple(x[n] for n in names) for x in out.collect()} == {tuple(names)} and out.where("score < 0").count() == 12


def test_language_model_beats_a_shallower_tree(spark):
    """Held-out texts take no more bits a byte than under a whole tree of depth 3."""
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(r.choice(words[: 30 * (1 + k % 10)]) for _ in range(120)) for k in range(120)]
    frame = spark.createDataFrame([(k, t, k % 4 > 0) for k, t in enumerate(texts)], "doc_id bigint, text string, teaches boolean")
    got = [x.score for x in language_model.score(frame, "teaches", ["doc_id", "teaches"], max_grams=500).where("not teaches").collect()]
    keys = language_model.keys_of([t.encode() for k, t in enumerate(texts) if k % 4], 3)[0]
    three = language_model.tree([language_model.counted(keys & np.uint64((1 << (8 * (d + 1))) - 1)) for d in range(4)])
    assert sum(got) >= sum(float(three.log10(language_model.keys_of([t.encode()], 3)[0]).sum()) for k, t in enumerate(texts) if k % 4 == 0)


def in_order(rows):
    """By id, null first, and the texts' hashes."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()[:15]))


def brute_likeness(a, b, per_octave=128):
    """Octave by octave, sample by sample, for two walks as the definition has them."""
    steps, octaves, written = (x.tolist() for x in fingerprints.sampled_steps(per_octave))
    walked = []
    for text in (a, b):
        codes = fingerprints.characters(np.array([ord(c) for c in text], np.uint32)).tolist()
        moves, at, places = fingerprints._moves(0, 8 * len(text) + 64).tolist(), 0, []
        while at < len(codes):
            places.append(codes[at])
            at += (codes[at] * moves[len(places) - 1] & 0xFFFFFFFF) >> 31
        walked.append(places)
    x, y = walked
    if not x or not y:
        return float(x == y)
    score = total = 0.0
    for o in sorted(set(octaves)):
        low = 0 if o == 0 else 1 << (o - 1)
        weight = min(max(len(x), len(y)) - low, max(1, low))
        if weight <= 0:
            break
        same = [1.0 * ((x[s] * w >> 31) & 1 == (y[s] * w >> 31) & 1) if s < min(len(x), len(y)) else 0.5 for s, k, w in zip(steps, octaves, written, strict=True) if k == o and s < max(len(x), len(y))]
        score += weight * sum(same) / max(1, len(same))
        total += weight
    return min(1.0, max(0.0, 2 * score / total - 1))


def test_fingerprints(rows, docs, none):
    order = in_order(rows)
    texts = [t or "" for _, t, *_ in order]
    out = by_id(fingerprints.fingerprint(docs))
    assert sum(map(len, out.values())) == len(rows)
    for (i, t, *_), following in zip(order, texts[1:] + texts[:1], strict=True):
        new = fingerprints.edited(t or "", following)
        found = [r for r in out[i] if (r.n_chars, r.edited_sha256) == (len(t or ""), hashlib.sha256(new.encode()).hexdigest())]
        assert found and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out[i])
        if len(t or "") + len(following) < 5000:
            assert any(abs(r.near_edited - brute_likeness(t or "", new)) < 1e-6 and abs(r.near_next - brute_likeness(t or "", following)) < 1e-6 for r in found)
    assert len({r.fingerprint for r in out[303]}) == 1 and {r.near_next for r in out[300]} == {1.0} and {r.near_next for r in out[301]} == {0.0}
    assert fingerprints.fingerprint(none).count() == 0
    one = fingerprints.fingerprint(docs.where("doc_id = 304")).collect()
    assert [r.near_next for r in one] == [1.0]


def test_fingerprints_of_one_id_are_in_many_ranges(spark, monkeypatch):
    """An id that a third of the rows share is cut into ranges, and each document's next is still the next one."""
    r = random.Random(3)
    made = [(None if k % 3 == 0 else k, sentence(r, 1 + k % 9)) for k in range(120)]
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 300)
    frame = spark.createDataFrame(made, "doc_id bigint, text string").repartition(5)
    parts = fingerprints.beside_next(frame, "doc_id", "text").where("id is null and not echo").select("part").distinct().count()
    out = sorted((x.n_chars, x.edited_sha256) for x in fingerprints.prints(frame).withColumn("edited_sha256", F.lower(F.hex("edited_sha256"))).collect())
    texts = [t for _, t in in_order(made)]
    assert parts > 3 and out == sorted((len(t), hashlib.sha256(fingerprints.edited(t, n).encode()).hexdigest()) for t, n in zip(texts, texts[1:] + texts[:1], strict=True))


def linked(prints, given, a, b):
    """The link of two texts, straight from its definition."""
    x, y = (given[k][1] or "" for k in (a, b))
    i, j = np.array([a]), np.array([b])
    like = prints.likeness(i, j)
    return bool(x and y) and (bool(prints.linked(i, j, like)[0]) or (like[0] >= fingerprints.DOUBT and fingerprints.edit_similarity(x, y) >= fingerprints.LEAST_EDIT))


def brute_clusters(given):
    prints = fingerprints.Fingerprints.walked([t or "" for _, t in given])
    sets = spanning.Sets()
    for a, (i, _) in enumerate(given):
        for b, (j, _) in enumerate(given[:a]):
            if i is not None and j is not None and linked(prints, given, a, b):
                sets.join(i, j)
    return {i: None if i is None else sets.root(i) for i, _ in given}


@pytest.mark.parametrize("limit", [0, 1000])
def test_near_duplicates_by_fingerprint(spark, limit):
    """Clusters are those of all pairs' links: copies, near copies, chains, empty texts, and ids that are null or repeat."""
    r = random.Random(6)
    texts = [sentence(r, 150) for _ in range(12)]
    given = [(k, t) for k, t in enumerate(texts)] + [(20 + k, texts[k][:-3] + "xyz") for k in range(8)] + [(40, texts[1]), (41, texts[1]), (42, ""), (43, None), (None, texts[2]), (44, "a"), (45, "a"), (3, texts[5])]
    for k in range(6):
        given.append((60 + k, given[-1][1][:-12] + sentence(r, 2)[:12] if k else texts[9]))
    given += [(70, texts[10][: len(texts[10]) // 2] + sentence(r, 75))]  # half of another text is no near-duplicate
    frame = spark.createDataFrame(given, "doc_id bigint, text string").repartition(4)
    table = fingerprints.fingerprint(frame, broadcast_ids=limit)
    wanted = brute_clusters(given)
    assert wanted[70] == 70 and {x.doc_id: x.cluster_id for x in table.collect()} == wanted


def test_clusters_reach_what_edits_leave_alike(spark):
    """Recall among texts of all lengths with insertions, deletions and substitutions at random places, against their true edit similarity; exact mode finds all."""
    r = random.Random(16)
    given = []
    for k in range(150):
        text = sentence(r, r.randint(5, 400))
        out = list(text)
        for _ in range(int(len(text) * 0.07 * k / 150) + 1):
            at, kind = r.randrange(len(out)), r.randrange(3)
            out[at : at + (kind > 0)] = [r.choice("abcdefgh ")] if kind < 2 else []
        given += [(2 * k, text), (2 * k + 1, "".join(out))]
    similar = np.array([fingerprints.edit_similarity(given[2 * k][1], given[2 * k + 1][1]) for k in range(150)])
    frame = spark.createDataFrame(given, "doc_id bigint, text string")
    out = {x.doc_id: x.cluster_id for x in fingerprints.fingerprint(frame).collect()}
    near = np.flatnonzero(similar >= 0.95)
    assert len(near) > 80 and np.mean([out[2 * k] == out[2 * k + 1] for k in near]) >= 0.9
    prints = fingerprints.Fingerprints.walked([t for _, t in given])
    far = [k for k in range(150) if not linked(prints, given, 2 * k, 2 * k + 1)]
    assert far and all(out[2 * k + 1] == 2 * k + 1 for k in far)
    some = frame.where("doc_id < 120")
    exact = {r.u: r.root for r in fingerprints.clusters(fingerprints.prints(some), some, exact=True).collect()}
    assert all(exact.get(2 * k + 1) == 2 * k for k in near if k < 60)


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://A.Example.net/en/1?x#y", "a.example.net", "/en/1", "example.net/en/"), ("http://a.example.net/fr/1", "a.example.net", "/fr/1", "net/"), ("http://anet/x", "anet", "/x", None), ("http://x.net", "x.net", "", None),
        ("https://x.example.com/de/", "x.example.com", "/de/", "example.com/de/"), ("http://org/fr/?", "org", "/fr/", "org/fr/"), ("no scheme/en", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c/d", "b:", "//c/d", None), ("x://é/\n?", "é", "/\n", None),
    ],
)
def test_url_rules(spark, url, host, path, rule):
    out = urls.judge(spark.createDataFrame([(1, url, "mine")], "page_id bigint, url string, verdict string"), RULES).first()
    assert (out.host, out.path, out.rule) == (host, path, rule)
    assert out.verdict == (dict((r, v) for v, r in RULES).get(rule) or "allow")


@pytest.mark.parametrize("grams", [0, 200_000])
def test_url_model_learns_from_rules(spark, grams):
    r = random.Random(1)
    word = lambda s: "".join(r.choice(s) for _ in range(8))
    made = [(i, f"http://{word('abc')}.net/{word('abc')}") for i in range(60)] + [(100 + i, f"http://{word('xyz')}.org/fr/{word('xyz')}") for i in range(60)] + [(200 + i, f"http://{word('abc' if i % 2 else 'xyz')}.com/{word('abc' if i % 2 else 'xyz')}") for i in range(40)]
    pages = spark.createDataFrame([*made, made[-1]], "page_id bigint, url string")
    out = urls.judge(pages, RULES, broadcast_grams=grams).where("rule is null").collect()
    assert len(out) == 41 and all(x.verdict == ("block" if x.page_id % 2 else "allow") for x in out)
    assert urls.judge(pages.where("false"), RULES).count() == 0


def test_urls_that_are_long_or_at_the_threshold(spark):
    """A very long URL counts whole; where models tell nothing apart, all scores are the threshold and allowed."""
    long = "http://x.com/" + "ab" * 40_000
    made = [(1, long), (2, "http://a.net/"), (3, "http://a.org/fr/"), (4, "http://same.com/p"), (4, "http://same.com/p")]
    out = {x.page_id: x for x in urls.judge(spark.createDataFrame(made, "page_id bigint, url string"), RULES).collect()}
    assert len(out[1].path) == 80_001 and out[1].verdict in ("allow", "block")
    alike = [(i, "http://q.com/z") for i in range(3)] + [(9, None)]
    assert {(x.verdict, x.score) for x in urls.judge(spark.createDataFrame(alike, "page_id bigint, url string"), RULES).collect()} == {("allow", 0.0)}


def test_mixing(spark, docs, rows, none):
    assert mixing.mix(none).count() == 0
    frame = spark.range(6000).selectExpr("id as doc_id", "case when id < 5000 then 'big' when id < 5900 then null else 'small' end as source", "'x' as copy", "id as rate", "id as first")
    out = mixing.mix(frame, {"big": 1.0, None: 1.0, "small": 2.0, "absent": 3.0, "zero": 0.0})
    assert out.columns == ["doc_id", "source", "rate", "first", "copy"]
    n = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = 6000
    for s, share in (("big", 1 / 4), (None, 1 / 4), ("small", 1 / 2)):
        assert abs(n[s] - share * total) < 6 * (share * total) ** 0.5 + 1
    again = mixing.mix(frame.repartition(3), {"big": 1.0, None: 1.0, "small": 2.0}, broadcast_sources=0)
    assert out.exceptAll(again).count() == 0 and again.exceptAll(out).count() == 0
    assert [r.doc_id for r in out.collect()] == [r.doc_id for r in again.collect()]
    assert mixing.mix(docs).where("source is null").count() > 0


def test_mixing_has_no_condition_but_the_source(spark, docs):
    """Counts stay out of the join, whose other side doesn't have what they need."""
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    out = mixing.mix(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() > 0 and "!Filter" not in plan and "Inner, BuildRight, false" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)


@pytest.mark.parametrize("rate", [0.01, 1.0, 30.0, 2000.0])
def test_poisson_table(spark, rate):
    import math

    packed = spark.createDataFrame([("s",)], "__source string")
    r = mixing.rates(packed, None, rate).first()
    k, total = r.first, 0.0
    for i, c in enumerate(r.cdf[:50]):
        total += math.exp((k + i) * math.log(rate) - rate - math.lgamma(k + i + 1))
        assert math.isclose(c, total, rel_tol=1e-6, abs_tol=1e-12)
    assert math.isclose(r.cdf[-1], 1, abs_tol=1e-9)


def test_warc(spark, tmp_path, none):
    made = [(5, "http://a/", "same"), (9, "http://b/", "same"), (7, "http://c/", "same"), (1, None, None), (2, "u", ""), (3, "u", "é" * 70_000), (None, "n", "same"), (None, "n", "only"), (9, "http://b/", "same"), (10**15, "far", "far")]
    pages = spark.createDataFrame(made, "page_id bigint, url string, html string")

    def archive(frame, name, **given):
        folder = f"file://{tmp_path}/{name}"
        manifest = warc.write(frame, folder, **given)
        files = {f.name: f.read_bytes() for f in (tmp_path / name).glob("*.warc.gz")}
        assert {r.name for r in manifest.collect()} == {*files} and (tmp_path / name / "_SUCCESS").exists() and not (tmp_path / name / "_temporary").exists()
        return files, sorted(map(tuple, warc.read(manifest, folder).collect()), key=str)

    files, got = archive(pages, "one", roll_bytes=600, shard_bytes=2000)
    wanted = [(i, len((h or "").encode()), warc.digest((h or "").encode()), *(("revisit", 9) if h == "same" and i != 9 else ("revisit", 2) if h is None else ("response", None))) for i, _, h in made]
    assert got == sorted(wanted, key=str) and len(files) > 2
    again, _ = archive(pages.repartition(7), "two", roll_bytes=600, shard_bytes=2000)
    assert again == files
    _, all_responses = archive(pages, "three", least_bytes=5)
    assert sum(r[3] == "revisit" for r in all_responses) == 0
    assert archive(pages.where("false"), "four") == ({}, [])


def test_shard_boundaries_are_exact_sums(spark):
    """Whatever the ids and the partitions, and in a number of jobs that doesn't grow with the shards."""
    sha = F.unhex(F.sha2(F.concat(F.lit("x"), F.col("k").cast("string")), 256))
    ids = "case when k % 3 = 0 then null when k < 1500 then k else 100000000000000000 + k end as page_id"
    narrow = spark.range(3000).withColumnRenamed("id", "k").selectExpr("k", ids, "cast(k % 50 as bigint) as bytes").withColumn("sha", sha).select("page_id", "sha", "bytes")
    sc, jobs = spark.sparkContext, []
    for size in (20_000, 600):
        sc.setJobGroup(f"boundaries-{size}", "")
        edges = warc.boundaries(narrow, size)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boundaries-{size}")))
        rows = sorted((-(2**63) if r.page_id is None else r.page_id, int(r.sha.hex()[:15], 16), r.bytes + 512) for r in narrow.collect())
        wanted, total, last = [], 0, 0
        for place, tie, n in rows:
            if total // size > last:
                last = total // size
                wanted.append((place, tie))
            total += n
        assert edges == wanted == warc.boundaries(narrow.repartition(9), size)
    sc.setJobGroup("none", "")
    assert jobs[0] == jobs[1] and len(edges) > 2000 and sum(p == -(2**63) for p, _ in edges) > 500


def test_warc_rolls_the_shards_of_one_id(spark, tmp_path):
    r = random.Random(5)
    made = [(7, f"http://x/{k}", "".join(r.choice("abcdefghijklmnop<>/ ") for _ in range(3000))) for k in range(60)]
    folder = f"file://{tmp_path}/one"
    manifest = warc.write(spark.createDataFrame(made, "page_id bigint, url string, html string"), folder, shard_bytes=20_000, roll_bytes=4000).collect()
    assert len({x.name.split("-")[1] for x in manifest}) > 5 and len(manifest) > 15
    assert sorted(x.payload_digest for x in warc.read(spark.createDataFrame(manifest), folder).collect()) == sorted(warc.digest(h.encode()) for _, _, h in made)


def test_pipeline(spark, rows, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit(1), "n_words": F.lit("x"), "first": F.lit(2), "__row": F.lit("r"), "__id": F.lit("i"), "id": F.lit(3)}).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: t for i, t, *_ in rows}
    spark.createDataFrame([(1, texts[4] if len(texts[4].split()) > 12 else texts[6])], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [rows]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "mix_sources":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.collect())
    ids = [{r[0] for r in s} for s in seen]
    assert ids[1] == ids[0] - {300, 301, 302, 305}
    components = brute_components([tuple(r) for r in seen[1]])
    assert ids[2] == {i for i in ids[1] if i is None or components[i] == i}
    removed = brute_removed([tuple(r) for r in seen[2]], 35)
    assert ids[3] == {r[0] for r, (n, gone, _) in zip(seen[2], removed, strict=True) if gone < n or not n}
    assert ids[4] < ids[3] and ids[5] <= ids[4]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen[5])
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path)).select(*[c.split()[0] for c in DOCS.split(", ")])
    assert empty.count() == 0
