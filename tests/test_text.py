from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.functions import text as tx


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_white_space_class_is_that_of_python(spark):
    points = [chr(c) for c in range(1, 0x3100)]
    rows = spark.createDataFrame([(c,) for c in points], "x string").select("x", F.col("x").rlike(f"^{tx.WS}\\z").alias("y")).collect()
    assert {r.x for r in rows if r.y} == {c for c in points if c.isspace()}


@pytest.mark.parametrize(("value", "wanted"), [("a  b", "a b"), ("  x\n\ty ", "x y"), ("é e", "é e"), ("", ""), (None, None), ("a​b", "a​b")])
def test_squeeze(spark, value, wanted):
    assert one(spark, tx.squeeze, value) == wanted


@pytest.mark.parametrize("value", ["é x​y", "plain  text", "", None])
def test_normalize_text(spark, value):
    wanted = None if value is None else " ".join(unicodedata.normalize("NFC", value).replace(" ", " ").replace("​", "").split())
    assert one(spark, tx.normalize_text, value) == wanted


def test_normalize_line_keeps_line_ends(spark):
    assert one(spark, tx.normalize_line, " a \t b\nc d \n") == "a b\nc d"


@pytest.mark.parametrize(
    ("parts", "wanted"),
    [
        ([("one", False), ("two", False)], "one two"), ([("one ", False), ("two", False)], "one two"), ([("one", False), (" two", False)], "one two"), ([("one", False), ("two", True)], "onetwo"),
        ([("", False), (None, False), ("x", True)], "x"), ([], ""), ([("one", False), (",", True), (" two", False)], "one, two"),
    ],
)
def test_merge_parts(spark, parts, wanted):
    rows = spark.createDataFrame([(parts,)], "p array<struct<text:string,note_before:boolean>>")
    assert rows.select(tx.merge_parts(F.col("p"))).first()[0] == wanted


@pytest.mark.parametrize(("value", "wanted"), [("the and of", 1.0), ("zub lor vem", 0.0), ("the house", 0.5), ("", 0.0), ('"The," (and)', 1.0)])
def test_stop_word_ratio(spark, value, wanted):
    assert one(spark, tx.stop_word_ratio, value) == wanted


@pytest.mark.parametrize(("value", "ok"), [("GEN.1.1", True), ("1SA.10.2a", True), ("GEN.1", False), ("gen.1.1", False), ("GEN.1.1\n", False), ("GEN.1.1ab", False), ("", False)])
def test_reference_grammar(spark, value, ok):
    assert one(spark, refs.is_reference, value) is ok


def test_canonical_order(spark):
    wanted = ["GEN.2.3", "GEN.10.1", "GEN.10.1a", "GEN.10.2", "MAT.1.1", "REV.2.1", "ZZZ.1.1"]
    rows = spark.createDataFrame([(x,) for x in sorted(wanted, key=hash)], "r string")
    assert [r.r for r in rows.orderBy(*refs.canonical_order(F.col("r"))).collect()] == wanted


def test_split_covers_all_collections(spark):
    rows = refs.collections(spark).select("book_code", refs.split_label(F.col("book_code")).alias("s")).collect()
    counts = {s: sum(r.s == s for r in rows) for s in ("train", "validation", "test")}
    assert counts == {"train": 55, "validation": 7, "test": 4}
    assert refs.collections(spark).agg(F.sum("expected_chapters")).first()[0] == 1189


def test_title_and_names(spark):
    assert one(spark, tx.title_code, "Matthew 17 | XYZ Bible - App") == "XYZ"
    assert one(spark, tx.title_code, "The Beginning - App") is None
    assert one(spark, lambda c: tx.page_book_name(c, F.lit("Matthew 1")), "The Beginning - App") == "Matthew"
    assert one(spark, lambda c: tx.page_book_name(c, F.lit("")), "1 John 3a | V Bible") == "1 John"


def test_unescape_and_labels(spark):
    assert one(spark, tx.unescape, "a&amp;b &eacute;�s") == "a&b é's"
    assert one(spark, tx.is_bracketed, "[2]") and not one(spark, tx.is_bracketed, "2")
    assert one(spark, tx.digits, "12a") == 12 and one(spark, tx.digits, "none") == 0


def test_versions(spark):
    versions = spark.createDataFrame([("A", 1), ("B", 2)], "key string, id int")
    assert refs.side(versions, " b ").first().id == 2
    assert refs.side(versions, None).count() == 2
    with pytest.raises(KeyError):
        refs.side(versions, "c")


def test_lines_of_an_array_are_normal_forms(spark):
    """Each element as ``normalize_line`` has it, decomposed letters composed."""
    lines = ["e\u0301", " a\u00a0\tb ", None, "", "\u200bx", "\uac00\u11a8", "plain"]
    df = spark.createDataFrame([(lines,), (["plain", " b "],), (None,), ([],)], "x array<string>")
    got = [r[0] for r in df.select(tx.normalize_lines(F.col("x"))).collect()]
    one = [r[0] for r in spark.createDataFrame([(x or "",) for x in lines], "x string").select(tx.normalize_line(F.col("x"))).collect()]
    assert got == [one, ["plain", "b"], None, []] and got[0][0] == "\u00e9"


def test_case_folding_is_that_of_python(spark):
    """All code points, and words whose letters fold to several or by place."""
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(points[i : i + 4096]) for i in range(0, len(points), 4096)] + ["STRASSE", "Stra\u00dfe", "\u03a3\u0391\u03a3", "\u0130", "\ufb03", "Plain ASCII"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", tx.casefold(F.col("x")).alias("y")).collect()
    assert {r.i: r.y for r in got} == {i: x.casefold() for i, x in enumerate(texts)}
