from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.plans import report, runner, verify
from corpusloom.sources import readers, sinks
from corpusloom.streaming.incremental import import_new_files


def test_lines_split_at_line_feeds_only(spark, tmp_path):
    (tmp_path / "v.txt").write_bytes("a b\r\nc\n".encode())
    out = readers.lines(spark, str(tmp_path / "v.txt")).orderBy("line_no").collect()
    assert [(r.line_no, r.text) for r in out] == [(0, "a b\r"), (1, "c"), (2, "")]
    assert readers.lines(spark, str(tmp_path / "none"), required=False).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.lines(spark, str(tmp_path / "none"))


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\n  \n{"a":null}\n')
    assert [r.a for r in readers.jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect()] == [1, None]
    assert readers.jsonl(spark, str(tmp_path / "no.jsonl"), "a int").count() == 0
    sinks.jsonl(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"))
    assert json.loads(written(tmp_path / "out")) == {"a": 1, "b": None}


def test_captures(spark, tmp_path):
    folder = tmp_path / "raw" / "x"
    folder.mkdir(parents=True)
    for name, text in {"good.json": '{"version": "A", "chapter": 1,\n "verses": []}', "bad.json": "{nope", "list.json": "[1]", ".hid.json": "{}", "x._001.json": "{}"}.items():
        (folder / name).write_text(text)
    good, bad = readers.captures(spark, str(tmp_path / "raw"))
    assert [r.version for r in good.collect()] == ["A"]
    assert sorted(r.source_file.rsplit("/", 1)[-1] for r in bad.collect()) == ["bad.json", "list.json"]


def test_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('﻿ref\tthadou\tenglish\nr1\t"a\tb\nc"\t"say ""x"""\n', encoding="utf-8")
    assert [tuple(r) for r in readers.authorized(spark, str(tmp_path / "t.tsv")).collect()] == [("r1", "a\tb\nc", 'say "x"')]
    (tmp_path / "u.tsv").write_text("left\tright\nx\ty\n")
    with pytest.raises(ValueError):
        readers.import_file(spark, str(tmp_path / "u.tsv"))
    assert tuple(readers.import_file(spark, str(tmp_path / "u.tsv"), {"left": "a_text", "right": "b_text"}).select("a_text", "b_text", "ref").first()) == ("x", "y", "")


def test_registry_and_small_json(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"id": "a", "publisher": "P", "rights": "OPEN_LICENSE", "url": "u"}, {"title": "no id"}]))
    assert [(r.source_id, r.provider, r.rights_status, r.canonical_url) for r in readers.registry(spark, str(tmp_path / "r.json")).collect()] == [("a", "P", "OPEN_LICENSE", "u")]
    (tmp_path / "s.json").write_text("{broken")
    assert readers.registry(spark, str(tmp_path / "s.json")).count() == 0
    assert readers.small_json(spark, str(tmp_path / "s.json")) is None and readers.small_json(spark, str(tmp_path / "no.json")) is None
    sinks.small_json({"books": {"GEN": {"a_name": "x"}}}, str(tmp_path / "m.json"))
    assert (tmp_path / "m.json").read_text().endswith("}\n") and readers.mapping(spark, str(tmp_path / "m.json")).first().a_name == "x"
    assert readers.mapping(spark, str(tmp_path / "none.json")).count() == 0 and readers.state(spark, str(tmp_path / "none")).count() == 0


def test_containment(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("")
    assert readers.within(str(tmp_path / "in"), "x").name == "x"
    with pytest.raises(PermissionError):
        readers.within(str(tmp_path / "in"), "../y")
    with pytest.raises(FileNotFoundError):
        readers.within(str(tmp_path / "in"), "z")


def written(folder):
    """What the part files hold, in the order of their names."""
    return "".join(f.read_text() for f in sorted(folder.glob("part-*")))


def side_rows(spark):
    return spark.createDataFrame([("r", 'a\tb "q"', None, "train"), ("s", "c", "d", "test"), ("q", "", "e", "train")], "ref string, a string, b string, split string").repartition(3)


def test_plain_tsv_has_one_header(spark, tmp_path):
    rows = side_rows(spark)
    sinks.plain_tsv(rows.select("ref", "a", "b"), str(tmp_path / "plain"), ["ref", "x", "y"], ["ref"])
    assert written(tmp_path / "plain") == 'ref\tx\ty\nq\t\te\nr\ta b "q"\t\ns\tc\td\n'
    sinks.plain_tsv(rows.select("ref", "a"), str(tmp_path / "unsorted"))
    assert written(tmp_path / "unsorted").count("ref\ta\n") == 1 and len(written(tmp_path / "unsorted").splitlines()) == 4
    sinks.plain_tsv(rows.where("false").select("ref"), str(tmp_path / "empty"))
    assert written(tmp_path / "empty") == "ref\n"


def test_quoted_tsv(spark, tmp_path):
    rows = side_rows(spark)
    sinks.quoted_tsv(rows, str(tmp_path / "quoted"))
    assert {r.a for r in readers.tsv(spark, str(tmp_path / "quoted"), {"ref", "a"}).collect()} == {'a\tb "q"', "c", None}


def test_splits_have_their_folders(spark, tmp_path):
    sinks.splits(side_rows(spark), str(tmp_path / "splits"))
    assert {p.name for p in (tmp_path / "splits").glob("split=*")} == {"split=train", "split=test"}
    assert {json.loads(x)["ref"] for x in written(tmp_path / "splits" / "split=train").splitlines()} == {"r", "q"}


def test_aligned_lines(spark, tmp_path):
    sinks.aligned_lines(spark.createDataFrame([(1, "b"), (0, ""), (2, "c")], "line_no int, text string"), str(tmp_path / "lines"))
    assert written(tmp_path / "lines") == "\nb\nc\n"


def test_metrics_csv(spark, tmp_path):
    sinks.metrics_csv(spark.createDataFrame([("m", "1"), ("n", "2")], "metric string, value string"), str(tmp_path / "csv"))
    assert sorted(written(tmp_path / "csv").splitlines()) == ["m,1", "metric,value", "n,2"]


def test_chapter_manifest(spark, tmp_path):
    books = spark.createDataFrame([("A", 1, "Genesis", "GEN", "V", [1, 2])], "version string, version_id int, name string, code string, version_code string, chapters array<int>")
    sinks.chapter_manifest(books, "http://r", str(tmp_path / "manifest"))
    assert {r.url for r in readers.jsonl(spark, str(tmp_path / "manifest"), schemas.CHAPTER_TASK).collect()} == {"http://r/1/GEN.1.V", "http://r/1/GEN.2.V"}


def test_book_manifest(spark, tmp_path):
    books = spark.createDataFrame([("MRK", "Mark", "New Testament", [1, 2], None), ("GEN", "Genesis", "Old Testament", [1], "u")], "code string, name string, testament string, chapters array<int>, intro_url string")
    sinks.book_manifest(books, {"version": "A", "version_id": 1}, str(tmp_path / "books.json"))
    found = readers.small_json(spark, str(tmp_path / "books.json"))
    assert (found["version"], found["book_count"]) == ("A", 2) and found["books"][1] == {"code": "MRK", "name": "Mark", "testament": "New Testament", "chapter_count": 2, "intro_url": None}


def test_source_markdown(spark):
    files = spark.createDataFrame([(0, 0, "/x/raw.json", "s0"), (1, 1, "/x/b.jsonl", "s2"), (1, 0, "/x/a.jsonl", "s1")], "class int, ord int, path string, sha256 string")
    out = report.source_markdown("Sources", [{"side": "a", "version_id": 1, "publisher": "P|Q"}], spark.createDataFrame([("m", "1")], "metric string, value string"), files, ["No public release."])
    assert "| a | 1 |  |  |  | P\\|Q |" in out and out.index("| a.jsonl | s1 |") < out.index("| b.jsonl | s2 |") and "raw.json" not in out and out.endswith("* No public release.\n")


def test_checksums_and_markdown(spark, tmp_path):
    for name in ("b.json", "a.json", ".c.json", "d._x.json"):
        (tmp_path / name).write_text(name)
    (tmp_path / "final").write_text("f")
    rows = report.checksums(spark, str(tmp_path / "*.json"), [str(tmp_path / "final")])
    lines = [r.line for r in report.sha256sum(rows, ["one", "two"]).collect()]
    assert lines[:2] == ["# one", "# two"] and [x.rsplit("/", 1)[-1] for x in lines[2:]] == ["a.json", "b.json", "final"]
    assert report.file_digest(spark, str(tmp_path / "final")).first().length == 1
    assert "a\\|b c" in report.markdown("T", {"s": (["h"], [("a|b\nc",)])})
    assert report.retrieval_range(spark.createDataFrame([], "retrieved_at string")).first().range == "n/a"


def test_stage_codes():
    seen = []
    stages = lambda codes: [(str(i), lambda c=c: seen.append(c) or c) for i, c in enumerate(codes)]
    assert runner.run(stages([0, 1, 0])) == 1 and runner.run(stages([0, 2, 0])) == 2 and seen == [0, 1, 0, 0, 2]


def test_align_folder(spark, tmp_path):
    def put(side, status, texts):
        folder = tmp_path / side
        folder.mkdir()
        (folder / "GEN.1.json").write_text(json.dumps({"version": side, "book_code": "GEN", "chapter": 1, "language_verification": {"status": status}, "verses": [{"reference": f"GEN.1.{i}", "text": t} for i, t in enumerate(texts, 1)]}))

    assert runner.align_folder(spark, str(tmp_path), "a", "b") == 2
    put("a", "verified", ["x", "y", ""])
    put("b", "verified", ["one", "two", "three"])
    assert runner.align_folder(spark, str(tmp_path), "a", "b") == 0
    audit = spark.read.json(str(tmp_path / "audit"))
    assert {r.reference: r.alignment_status for r in audit.collect()} == {"GEN.1.1": "aligned", "GEN.1.2": "aligned", "GEN.1.3": "missing_a"}
    assert {r.id for r in spark.read.json(str(tmp_path / "aligned" / "ml")).collect()} == {"GEN.1.1", "GEN.1.2"}


def test_incremental_import(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()

    def run():
        import_new_files(spark, str(incoming), str(tmp_path / "out"), str(tmp_path / "cp"), "s")
        return spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()

    (incoming / "1.json").write_text('{"ref":"r","a_text":"a","b_text":"b","line_no":1}\n{"ref":"r","a_text":"a","b_text":"b","line_no":2}\n')
    assert [(r.id, r.a_text) for r in run()] == [(1, "a")]
    (incoming / "2.json").write_text('{"ref":"r","a_text":"a","b_text":"b","line_no":1}\n{"ref":"r","a_text":"c","b_text":"d","line_no":2}\n')
    assert [(r.id, r.a_text) for r in run()] == [(1, "a"), (2, "c")]
    assert len(run()) == 2


def test_line_corpus_checks(spark):
    lines = lambda *x: spark.createDataFrame(list(enumerate(x)), "line_no int, text string")
    sft = spark.createDataFrame([("{}",)], "value string")
    out = {r.check: r.ok for r in verify.line_corpus_checks({"a": lines("x"), "b": lines("x", "y")}, lines("h", "a\tb\tc\td\te", "a\tb\tc\td\te"), "h", sft).collect()}
    assert out == {"equal_line_counts": False, "header": True, "columns": True, "unique_references": False, "chat_records": False}


def test_spot_checks(spark):
    rows = spark.createDataFrame([("x",)], "reference string")
    assert {tuple(r) for r in verify.spot_checks(rows, ["x", "y"]).collect()} == {("x", True), ("y", False)}
    assert rows.select(F.lit(1)).count() == 1


@pytest.mark.parametrize("content", [b"a\n" * 40_000, b"\n\n", b"x" * 70_000, b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbfa\n\n", b"a\r\nb\r", bytes(range(256)) * 400, b"\xef\xbb\xbf\xef\xbb\xbfa\n"])
def test_digests_of_long_files(spark, tmp_path, content):
    (tmp_path / "a [1] %20.bin").write_bytes(content)
    (tmp_path / "b.bin").write_bytes(content[::-1])
    (tmp_path / "c.gz").write_bytes(content)
    cut = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = {r.path.rsplit("/", 1)[-1]: (r.length, r.sha256) for r in report.digests(spark, str(tmp_path), whole=0).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
    assert found == {f.name: (len(f.read_bytes()), hashlib.sha256(f.read_bytes()).hexdigest()) for f in tmp_path.iterdir()}
