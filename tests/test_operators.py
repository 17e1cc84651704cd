from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import now_iso
from corpusloom.operators import curate, dedup, discovery, extract, sequence, tasks, training


def test_range_merge_and_labels(spark):
    lines = spark.createDataFrame([("f", 0, "GEN 1:1", "a", "x"), ("f", 1, "GEN 1:2", "<range>", "<range>"), ("f", 2, "GEN 1:3", "b", "<range>"), ("f", 3, "GEN 1:4", "c", "y")], "file string, line_no int, ref string, t string, w string")
    out = sequence.merge_ranges(lines, ["file"], "line_no", "ref", ["t", "w"], ["t", "w"]).withColumn("label", sequence.range_label(F.col("refs"))).orderBy("line_no").collect()
    assert [(r.label, r.t, r.w) for r in out] == [("GEN 1:1-3", "a b", "x"), ("GEN 1:4", "c", "y")]


def test_a_leading_marker_starts_a_group(spark):
    lines = spark.createDataFrame([("f", 0, "GEN 1:1", "<range>"), ("f", 1, "GEN 1:2", "b")], "file string, line_no int, ref string, t string")
    out = sequence.merge_ranges(lines, ["file"], "line_no", "ref", ["t"], ["t"]).orderBy("line_no").collect()
    assert [(r.refs, r.t) for r in out] == [(["GEN 1:1"], ""), (["GEN 1:2"], "b")]


@pytest.mark.parametrize(("a", "b", "ok"), [("xx", "xxxxx", False), ("xxx", "xxxxx", True), ("x" * 15, "x" * 5, False), ("x" * 14, "x" * 5, True), ("xx", "", True)])
def test_length_ratio_is_strict(spark, a, b, ok):
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    assert rows.select(training.length_ratio_ok(F.col("a"), F.col("b"))).first()[0] is ok


def test_lexicon(spark):
    pairs = spark.createDataFrame([(str(i), "inn khat", "one house") for i in range(9)] + [("x", "rare", "word")], "id string, a string, b string")
    found = training.lexicon(training.cooccurrence(pairs, "id")).orderBy("x").collect()
    assert [(r.x, r.y, r.n) for r in found] == [("inn", "house", 9), ("khat", "house", 9)]
    assert training.lexicon_rows(training.lexicon(training.cooccurrence(pairs, "id"))).first().dice == "1.000"


def test_record_errors(spark):
    good = '{"messages":[{"role":"system","content":"a"},{"role":"user","content":"b"},{"role":"assistant","content":"c"}]}'
    lines = [good, good.replace('"role":"user",', ""), '{"messages":[]}', "{no", "{}"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    assert [r.error for r in training.record_errors(rows).orderBy("i").collect()] == [None, "bad_message", "bad_count", "bad_json", "bad_json"]


def segments(spark):
    return spark.createDataFrame([(1, "GEN 1:1", "abc", "one", "s", "train", "approved", ""), (2, "GEN 1:2", "xAb", "two", "t", "train", "unreviewed", "")], "id bigint, ref string, a_text string, b_text string, source_id string, split string, status string, notes string")


def test_curation(spark):
    s = segments(spark)
    assert [r.id for r in curate.search(s, " AB ").orderBy("id").collect()] == [1, 2]
    assert [r.id for r in curate.search(s, "ab", status="approved").collect()] == [1]
    page, total = curate.page(s, 1, 1)
    assert [r.id for r in page.collect()] == [2] and total == 2
    for bad in ((0, 0), (501, 0), (1, -1)):
        with pytest.raises(ValueError):
            curate.page(s, *bad)
    with pytest.raises(LookupError):
        curate.get(s, 9)
    batch = spark.createDataFrame([(1, "abc ", "one", None), (2, "new", "n​ew", "r"), (3, "new", "new", "r2"), (4, "", "x", "")], "line_no bigint, a_text string, b_text string, ref string")
    fresh = curate.import_batch(s, batch, "s", ["line_no"])
    assert [(r.id, r.a_text, r.b_text, r.status) for r in fresh.collect()] == [(3, "new", "new", "unreviewed")]
    assert tuple(curate.import_counts(batch, fresh).first()) == (1, 2)
    updates = spark.createDataFrame([(2, "  n  ", None, None, "corrected", None)], "id bigint, a_text string, b_text string, split string, status string, notes string")
    assert tuple(curate.review(s, updates)[0].where("id = 2").select("a_text", "b_text", "status").first()) == ("n", "two", "corrected")
    assert curate.export_reviewed(s).count() == 1


def test_reviews_that_are_refused(spark):
    """What the service answers with an error isn't written, and comes back with the reason."""
    s = segments(spark)
    schema = "id bigint, a_text string, b_text string, split string, status string, notes string"
    bad = [(1, None, None, None, "maybe", None), (1, None, None, "dev", None, None), (2, " \u200b ", None, None, None, None), (2, None, "", "train", None, None), (77, "x", "y", "train", "approved", ""), (None, "x", None, None, None, None)]
    held, refused = curate.review(s, spark.createDataFrame(bad, schema))
    assert sorted(map(repr, held.collect())) == sorted(map(repr, s.collect()))
    assert sorted((r.id or 0, r.reason) for r in refused.collect()) == [(0, "unknown"), (1, "split"), (1, "status"), (2, "a_text"), (2, "b_text"), (77, "unknown")]
    good, none = curate.review(s.withColumn("notes", F.lit("old")), spark.createDataFrame([(1, None, None, "test", "rejected", "  why\n")], schema))
    assert none.count() == 0 and [r.notes for r in good.orderBy("id").collect()][0] == "why"


def test_imports_meet_by_digests(spark):
    """Equal rows of a batch are one, ties in the order too; texts go through no sort, and a batch is cleaned once."""
    s = segments(spark)
    batch = spark.createDataFrame([(1, "a", "b", "r")] * 3 + [(1, "c", "d", "r"), (2, "a", "b", "x"), (0, "ab", "", "n"), (3, "1:a", "b", "y")], "line_no bigint, a_text string, b_text string, ref string")
    fresh = curate.import_batch(s, batch, "s", ["line_no"])
    assert sorted((r.a_text, r.b_text) for r in fresh.collect()) == [("1:a", "b"), ("a", "b"), ("c", "d")]
    assert sorted(r.id for r in fresh.collect()) == [3, 4, 5]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("FileScan") <= 4
    assert not re.search(r"(Sort|Window|SortAggregate|hashpartitioning\()[^\n]*\ba_text", plan)


def test_updates_are_stamped(spark):
    """A review and a change of state carry the time; what isn't changed keeps its own."""
    old = "2001-01-01 00:00:00"
    s = segments(spark).withColumn("updated_at", F.lit(old).cast("timestamp"))
    out = {r.id: str(r.updated_at) for r in curate.review(s, spark.createDataFrame([(2, "n", None, None, "corrected", None)], "id bigint, a_text string, b_text string, split string, status string, notes string"))[0].collect()}
    assert out[1].startswith("2001") and not out[2].startswith("2001")
    state = spark.createDataFrame([("k1", "verified", "t"), ("k2", "failed", "t")], "k string, status string, updated_at string")
    found = {r.k: r.updated_at for r in tasks.upsert_state(state, spark.createDataFrame([("k2", "verified"), ("k3", None)], "k string, status string"), ["k"]).collect()}
    stamp = spark.range(1).select(now_iso().alias("t")).first().t
    assert found["k1"] == "t" and found["k2"][:13] == found["k3"][:13] == stamp[:13] and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00", stamp)


def test_duplicates_of_null_keys_and_equal_rows(spark):
    rows = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 1, "x"), ("k", 1, "x"), ("k", 1, "x"), ("z", 1, "y"), ("", None, "n"), ("", 3, "m")], "k string, o int, s string")
    out = sorted((r.k or "", r.kept, r.dropped) for r in dedup.duplicates(rows, ["k"], [F.col("o")], "s").collect())
    assert out == [("", "a", "b"), ("", "n", "m"), ("k", "x", "x"), ("k", "x", "x")]


def test_upsert_overwrites_all_columns(spark):
    had = spark.createDataFrame([("a", "x"), ("b", "y")], "source_id string, title string")
    new = spark.createDataFrame([("b", None), ("c", "z")], "source_id string, title string")
    assert {tuple(r) for r in curate.upsert_sources(had, new).collect()} == {("a", "x"), ("b", None), ("c", "z")}


def test_state(spark):
    state = spark.createDataFrame([("k1", "verified", 1), ("k2", "failed", 2)], "k string, status string, attempts int")
    changes = spark.createDataFrame([("k2", None, 3), ("k3", None, 1)], "k string, status string, attempts int")
    assert {tuple(r) for r in tasks.upsert_state(state, changes, ["k"]).collect()} == {("k1", "verified", 1), ("k2", "failed", 3), ("k3", "discovered", 1)}
    seeds = spark.createDataFrame([("k1", "discovered", 0), ("k4", "discovered", 0)], "k string, status string, attempts int")
    assert {tuple(r) for r in tasks.seed_state(state, seeds, ["k"]).collect()} == {("k1", "verified", 1), ("k2", "failed", 2), ("k4", "discovered", 0)}
    all_tasks = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "k string")
    assert {r.k for r in tasks.remaining(all_tasks, state, spark.createDataFrame([], "k string"), ["k"]).collect()} == {"k1", "k2", "k3"}
    assert {r.k for r in tasks.remaining(all_tasks, state, all_tasks, ["k"]).collect()} == {"k2", "k3"}


def test_discovery_checks(spark):
    canon = spark.createDataFrame([("GEN", 2), ("EXO", 1)], "code string, expected int")
    books = spark.createDataFrame([("GEN", "Genesis", "V", 1, 2), ("XXX", "", "V", 1, 1)], "code string, name string, version_code string, first int, groups int")
    out = {r.check: r.ok for r in discovery.checks(books, canon, "V").collect()}
    assert out == {"books_non_empty": True, "codes_unique": True, "version_uniform": True, "expected_count": True, "groups_positive": True, "names_present": False, "canon_present": False}
    assert discovery.status(discovery.checks(books, canon, "V")).first().status == "UNCERTAIN"
    assert {tuple(r) for r in discovery.missing_and_extra(books, canon, "code").collect()} == {("EXO", "missing"), ("XXX", "extra")}


def test_numbered_is_consecutive_and_ordered(spark):
    rows = spark.range(500).selectExpr("id % 37 as a", "id as b")
    out = dedup.numbered(rows, ["a", "b"], "n", spark.createDataFrame([(10,)], "s int")).orderBy("n").collect()
    assert [r.n for r in out] == list(range(11, 511))
    assert [(r.a, r.b) for r in out] == sorted((r.a, r.b) for r in out)


PAGE = """<html lang="en"><head><title>Genesis 1 | V Bible</title><link rel="canonical" href="http://x/"><meta property="og:url" content="o"></head><body><h1>Genesis 1</h1><a href="/versions/11-v">v</a>
<script>var t="</p>"</script><div class="q__chapter" data-usfm="GEN.1"><div class="q__label">1</div><div class="q__heading">The  start</div>
<span class="q__{verse}" data-usfm="GEN.1.1"><span class="q__label">1</span><span class="q__content">In the</span><span class="q__note"><span class="q__ref" data-usfm="GEN.1.1">#</span><span class="q__content">no</span></span><span class="q__content">, end</span></span>
<span class="q__{verse}" data-usfm="GEN.1.2"><span class="q__content">Two</span></span><span class="q__{verse}" data-usfm="EXO.1.1"><span class="q__content">no</span></span></div></body></html>"""


@pytest.mark.parametrize(("verse", "fallback"), [("verse", False), ("v9", True)])
def test_chapter_spans(verse, fallback):
    root = extract.parse(PAGE.replace("{verse}", verse))
    meta, out = extract.page_meta(root), extract.chapter_spans(root, "GEN", 1)
    assert (meta["title"], meta["canonical"], meta["og_url"], meta["lang"], meta["h1"], meta["version_links"]) == ("Genesis 1 | V Bible", "http://x/", "o", "en", "Genesis 1", ["/versions/11-v"])
    assert (out["container_found"], out["selector_fallback"], out["chapter_label"], out["heading"]) == (True, fallback, "1", "The start")
    assert [s["usfm"] for s in out["spans"]] == ["GEN.1.1", "GEN.1.2"]
    assert out["spans"][0] == {"usfm": "GEN.1.1", "label": "1", "parts": [{"text": "In the", "note_before": False}, {"text": ", end", "note_before": True}]}
    assert not extract.chapter_spans(root, "GEN", 2)["container_found"]


def test_deep_pages_do_not_recurse():
    assert extract.page_meta(extract.parse("<div>" * 5000 + "<h1>x</h1>"))["h1"] == "x"


@pytest.mark.parametrize(("blank", "status"), [(1, "verified"), (2, "LANGUAGE_UNCERTAIN")])
def test_coverage_gate(spark, blank, status):
    verses = [{"reference": f"GEN.1.{i}", "text": "" if i <= blank else "zub lor vem"} for i in range(1, 11)]
    url = "http://r/11/GEN.1.V"
    rows = spark.createDataFrame(
        [("Genesis 1 | V Bible", "Genesis 1", url, url, url + "/", ["/versions/11"], "genesis", True, "GEN", 1, verses)],
        "title string, h1 string, url string, expected_url string, canonical string, version_links array<string>, mapping_name string, container_found boolean, book_code string, chapter int, verses array<struct<reference:string,text:string>>",
    )
    out = extract.validate(rows, "11", "V", "a", "http://r").first()
    assert out.status == status and (out.failing == ([] if status == "verified" else ["text_coverage_ok"]))


def test_foreign_spans(spark):
    rows = spark.createDataFrame([("GEN.1.1", "GEN.1"), ("GEN.10.1", "GEN.1"), (None, "GEN.1")], "usfm string, group_usfm string")
    assert [r.anomaly for r in extract.foreign_spans(rows).collect()] == [None, "unexpected_usfm:GEN.10.1", "unexpected_usfm:"]
