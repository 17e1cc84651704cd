from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import align, dedup, normalize
from corpusloom.plans import storage, verify
from corpusloom.queries import alignment

SF = "/root/testdata/sf0.001"

SIDE = "reference string, grp string, text string, language_status string, label string"
KEY = ["reference", "grp"]


def decided(spark, a, b):
    frames = [spark.createDataFrame([(r, r.rsplit(".", 1)[0], t, s, lab) for r, t, s, lab in rows], SIDE) for rows in (a, b)]
    return {r.reference: r for r in align.decide(align.join_sides(*frames, KEY), ["grp"]).collect()}


def row(ref, text, status="verified", label=None):
    return ref, text, status, label


def test_pairs_by_key_not_by_place(spark):
    out = decided(spark, [row("G.1.2", "b"), row("G.1.1", "a")], [row("G.1.1", "x"), row("G.1.2", "y")])
    assert {k: (r.a_text, r.b_text, r.alignment_status) for k, r in out.items()} == {"G.1.1": ("a", "x", "aligned"), "G.1.2": ("b", "y", "aligned")}


@pytest.mark.parametrize(
    ("a", "b", "status", "a_status", "b_status"),
    [
        (row("G.1.1", "a"), None, "missing_b", "present", "missing"),
        (None, row("G.1.1", "b"), "missing_a", "missing", "present"),
        (row("G.1.1", "a", "LANGUAGE_UNCERTAIN"), row("G.1.1", "b"), "language_uncertain", "present", "present"),
        (row("G.1.1", "a", None), row("G.1.1", "b"), "language_uncertain", "present", "present"),
        (row("G.1.1", " "), row("G.1.1", "b"), "missing_a", "present_no_text", "present"),
        (row("G.1.1", "a"), row("G.1.1", ""), "missing_b", "present", "present_no_text"),
        (row("G.1.1", ""), row("G.1.1", None), "extraction_error", "present_no_text", "present_no_text"),
        (row("G.1.1", "same"), row("G.1.1", "same"), "aligned", "present", "present"),
    ],
)
def test_decisions(spark, a, b, status, a_status, b_status):
    out = decided(spark, [a] if a else [], [b] if b else [])["G.1.1"]
    assert (out.alignment_status, out.a_status, out.b_status) == (status, a_status, b_status)


def test_bracketed_label_is_in_the_reason(spark):
    out = decided(spark, [row("G.1.2", "", label="[2]")], [row("G.1.2", "b")])["G.1.2"]
    assert "bracketed/omitted" in out.reason and "[2]" in out.reason


def test_contamination_needs_three(spark):
    same = [row(f"G.1.{i}", "x") for i in range(1, 4)]
    assert {r.alignment_status for r in decided(spark, same, same).values()} == {"language_uncertain"}
    one = decided(spark, same[:1], same[:1])["G.1.1"]
    assert one.alignment_status == "aligned" and one.identical_text_flag


def test_duplicate_and_survivor_are_both_audited(spark):
    rows = spark.createDataFrame([("G.1.1", "G.1", "a", "f1", 0), ("G.1.1", "G.1", "b", "f2", 0)], "reference string, grp string, text string, file string, pos int")
    order = [F.col("file"), F.col("pos")]
    kept = dedup.keep_first(rows, ["reference"], order).select("reference", "grp", "text", F.lit("verified").alias("language_status"))
    lost = dedup.duplicates(rows, ["reference"], order, "file").withColumn("side", F.lit("a"))
    out = align.audit(align.decide(align.join_sides(kept, kept.withColumn("text", F.lit("z")), ["reference", "grp"]), ["grp"]), ["reference"], lost).collect()
    assert sorted(r.alignment_status for r in out) == ["aligned", "duplicate_a"]
    assert [(r.kept, r.dropped) for r in lost.collect()] == [("f1", "f2")]


def test_histogram_has_zero_rows(spark):
    frame = spark.createDataFrame([("aligned",), (None,)], "alignment_status string")
    out = {r.alignment_status: r.n for r in align.status_histogram(frame).collect()}
    assert out["aligned"] == 1 and out["missing_a"] == 0 and out["unknown"] == 1 and len(out) == 8


def captures(spark, rows):
    from corpusloom.schemas import CAPTURE

    full = [dict(version="A", version_id=1, book_code="GEN", book_name="Genesis", chapter=1, url="u", content_hash=h, source_file=f, language_verification={"status": s, "failing": []}, verses=[{"verse": "1", "reference": r, "label": None, "text": t, "span_count": 1, "parts": []} for r, t in v]) for f, h, s, v in rows]
    return spark.createDataFrame(full, f"{CAPTURE}, source_file string")


def test_normalize(spark):
    c = captures(spark, [("f2", "h", "verified", [("GEN.1.1", "late"), ("GEN.1.10", "ten")]), ("f1", "h", None, [("GEN.1.1", " first one "), ("GEN.1", "bad"), ("GEN.1.2", "  ")])])
    out = normalize.normalized(c).collect()
    assert [(r.reference, r.text, r.language_status) for r in out] == [("GEN.1.1", "first one", "UNKNOWN"), ("GEN.1.2", "", "UNKNOWN"), ("GEN.1.10", "ten", "verified")]
    assert [(r.kept_file, r.dropped_file) for r in normalize.dropped(c).collect()] == [("f1", "f2")]
    assert [r.reference for r in normalize.rejects(normalize.segments(c)).collect()] == ["GEN.1"]
    assert normalize.repeated_pages(c).count() == 1
    s = normalize.summary(c).first()
    assert (s.captures, s.uncertain, s.segments, s.rejected, s.empty, s.kept, s.duplicates) == (2, 1, 5, 1, 1, 3, 1)


def test_same_text_under_different_keys_is_no_duplicate(spark):
    c = captures(spark, [("f1", "h", "verified", [("GEN.1.1", "x"), ("GEN.1.2", "x")])])
    assert normalize.dropped(c).count() == 0 and normalize.normalized(c).count() == 2


def test_verify_rules(spark):
    rows = spark.createDataFrame(
        [("1", "GEN.1.1", "GEN.1.1", "GEN", "a", "b", "u", "v"), ("2", "x", "GEN.1.2", "EXO", " ", "b", "", "v"), ("3", "BAD", "BAD", "GEN", "", "", "", ""), ("4", None, "GEN.1.3", "GEN", "a", "b", "u", "v")],
        "row_id string, id string, reference string, book_code string, a_text string, b_text string, a_url string, b_url string",
    )
    required = ["id", "reference", "book_code", "a_text", "b_text"]
    found = {(r.row_id, r.error) for r in verify.schema_errors(rows, required).collect()}
    assert found == {("2", "id_mismatch"), ("2", "book_mismatch"), ("2", "empty_a"), ("2", "missing_url_a"), ("3", "bad_reference"), ("4", "missing_fields")}
    assert dedup.repeated_keys(rows.union(rows), ["id"]).count() == 4
    assert dedup.repeated_keys(verify.countable(rows.union(rows), required), ["id"]).count() == 2
    empty = rows.where("false")
    good = verify.check("all", empty.agg(F.count("*").alias("n")), F.col("n") == 0, F.lit(""))
    v = verify.verdict(good, rows, empty, empty).first()
    assert v.ok and not v.complete


def test_empty_sides(spark):
    assert decided(spark, [], []) == {}


PAIR_ROWS = "grp bigint, seg int, o1 bigint, shown bigint, in_a boolean, in_b boolean, a_text string, a_label string, a_language_status string, b_text string, b_label string, b_language_status string"


def test_one_pass_pairs_as_the_joins_do(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        a, b = rng.choice([(True, False), (False, True), (True, True)])
        o = rng.randrange(5) if i % 3 else 7  # equal rows, too
        rows.append((rng.randrange(30), rng.choice([1, 2, 3, None]), o, o * 10, a, b, "" if o == 3 else f"x{o % 2}", "1", "LANGUAGE_UNCERTAIN" if o == 4 else "verified", "" if o % 4 == 1 else f"x{o // 2 % 2}", "1", "verified"))
    frame = spark.createDataFrame(rows, PAIR_ROWS)
    side = lambda s: frame.where(f"in_{s}").select("grp", "seg", "o1", "shown", *(F.col(f"{s}_{c}").alias(c) for c in ("text", "label", "language_status")))
    kept = [dedup.keep_first(side(s), ["grp", "seg"], [F.col("o1")]).drop("o1", "shown") for s in "ab"]
    lost = [dedup.duplicates(side(s), ["grp", "seg"], [F.col("o1")], "shown").withColumn("side", F.lit(s)) for s in "ab"]
    wanted = align.audit(align.decide(align.join_sides(*kept, ["grp", "seg"]), ["grp"]), ["grp", "seg"], lost[0].unionByName(lost[1]))
    decided = align.decide(align.paired(frame, ["grp", "seg"], ["o1"], "shown"), ["grp"])
    got = align.audit_paired(decided, ["grp", "seg"])
    text = lambda f: sorted(map(repr, f.select(sorted(wanted.columns)).collect()))
    assert text(got) == text(wanted) and {r.alignment_status for r in got.collect()} >= {"aligned", "missing_a", "missing_b", "duplicate_a", "duplicate_b", "language_uncertain"}
    only = align.audit_paired(decided, ["grp", "seg"], ["alignment_status"])
    assert only.columns == ["grp", "seg", "alignment_status"] and only.count() == wanted.count()


def scans(frame) -> int:
    """How often the plan reads lineitem."""
    return sum("l_orderkey" in f for f in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in f)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize(("name", "most"), [("audit_reconcile_red", 2), ("audit_reason", 1), ("ref_duplicate_audit", 1), ("verify_checks", 0), ("verify_leaked", 0), ("quality_metrics", 0)])
def test_the_audit_is_made_in_one_pass(spark, name, most):
    assert scans(alignment.QUERIES[name](spark, SF)) <= most


def sorted_rows(frame) -> list[str]:
    return sorted(map(repr, frame.collect()))


def test_reasons_counted_by_their_parts_are_those_of_the_audit(spark):
    rng = random.Random(6)
    made = lambda i: (rng.randrange(20), rng.randrange(3), i % 7, rng.choice([None, 10, 20]), i % 3 != 1, i % 3 != 2, rng.choice(["", "x", "y"]), "[1]", rng.choice(["verified", "LANGUAGE_UNCERTAIN"]), rng.choice(["", "x"]), "1", "verified")
    decided = align.decide(align.paired(spark.createDataFrame([made(i) for i in range(300)], PAIR_ROWS), ["grp", "seg"], ["o1"], "shown"), ["grp"])
    wanted = align.audit_paired(decided, ["grp", "seg"]).groupBy("alignment_status", "reason").agg(F.count("*").alias("n"))
    got = sorted_rows(align.reason_counts(align.reason_parts(decided)))
    assert got == sorted_rows(wanted) and any("duplicate_a', reason=None" in r for r in got) and any("kept 10, dropped 20" in r for r in got)


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.splitlines() if "/shuffle_" in f}


def test_stored_parts_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    seen = []

    def parts():
        for i in range(3):
            seen.append(shuffle_files(spark) - before)
            yield spark.range(1000).where(f"id % 3 = {i}").groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))

    rows = storage.stored(parts(), "counts")
    assert seen == [set()] * 3 and shuffle_files(spark) <= before
    assert rows.count() == 21 and rows.agg(F.sum("n")).first()[0] == 1000


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
def test_reasons_come_from_what_is_stored(spark):
    assert scans(alignment.audit_reason(spark, SF)) == 0


def test_small_frames_in_turn(spark):
    before = shuffle_files(spark)
    frames = [spark.range(100).select(F.lit(k).alias("name"), (F.col("id") % k).alias("n")).groupBy("name").agg(F.countDistinct("n").alias("n")) for k in "357"]
    frames[1] = frames[1].select(F.col("n") * 2, "name").toDF("n", "name").where("n > 0")
    out = storage.in_turn(frames)
    assert shuffle_files(spark) <= before and out.schema == frames[0].unionByName(frames[1]).schema
    assert [tuple(r) for r in out.collect()] == [("3", 3), ("5", 10), ("7", 7)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("name", ["verify_leaked", "quality_metrics"])
def test_a_run_is_judged_check_by_check(spark, name):
    before = shuffle_files(spark)
    out = alignment.QUERIES[name](spark, SF)
    assert shuffle_files(spark) <= before and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
