"""Texts as line files: written in order over many parts, read back in ranges, numbered and scanned as one long file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import scans, sequence
from corpusloom.plans.storage import scratch
from corpusloom.sources import readers, sinks
from corpusloom.sources.readers import table


def _file(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` as one file of lines, written and read."""
    folder = scratch(rows.sparkSession, "lines")
    sinks.sorted_lines(rows, f"{folder}/file", order)
    return readers.lines(rows.sparkSession, f"{folder}/file", together=True).select("line_no", "text")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents, numbered through."""
    return _file(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last short line, as a header, up to each line of the one file, and a number that goes up as first letters change."""
    found = scans.forward_fill(numbered_lines(spark, sf_dir), [], ["line_no"], {"header": F.when((F.length("text") < 60) & (F.col("text") != ""), F.col("text"))})
    letter = F.when(F.col("text") != "", F.substring("text", 1, 1))
    return scans.change_index(found, [], ["line_no"], letter, "change").select("line_no", "header", "change")


def file_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels of headers over the one file: lines by their lengths."""
    outer, inner = (F.when(F.length("text") % k == 0, F.col("line_no")) for k in (7, 3))
    return scans.fill_within(numbered_lines(spark, sf_dir), [], ["line_no"], outer, inner).select("line_no", "outer", "inner")


def file_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the one file, of which two in five carry the range marker and join the line before."""
    marked = F.when(F.col("line_no") % 5 >= 3, sequence.RANGE).otherwise(F.col("text"))
    lines = numbered_lines(spark, sf_dir).select("line_no", F.concat(F.lit("L "), F.col("line_no").cast("string")).alias("ref"), marked.alias("t"))
    out = scans.merge_ranges(lines, "line_no", "ref", ["t"], ["t"], sequence.RANGE, lambda c: F.when(c == sequence.RANGE, "").otherwise(c))
    return out.select("island", "line_no", sequence.range_label(F.col("refs")).alias("label"), "t")


def line_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of all user turns with one of all assistant turns beside it, line by line."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.translate(F.coalesce("text", F.lit("")), "\n", " "))
    users, assistants = (_file(turns.where(F.col("role") == r).select("conv_id", "turn", "text"), ["conv_id", "turn"]) for r in ("user", "assistant"))
    return sequence.zip_lines(users.withColumnRenamed("text", "base"), {"beside": assistants})


NAMES = "numbered_lines file_headers file_sections file_ranges line_zip".split()
QUERIES = {n: globals()[n] for n in NAMES}

_L = """l AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS line_no, text
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents))"""
_F = "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS line_no, replace(coalesce(text, ''), chr(10), ' ') AS text FROM conversations WHERE role = '{}'"
SQL = {
    "numbered_lines": f"WITH {_L} SELECT line_no, text FROM l",
    "file_headers": f"""WITH {_L}, k AS (SELECT line_no, text, last_value(CASE WHEN text <> '' THEN left(text, 1) END IGNORE NULLS) OVER (ORDER BY line_no) AS letter FROM l),
c AS (SELECT *, CASE WHEN letter IS NOT NULL AND letter IS DISTINCT FROM lag(letter) OVER (ORDER BY line_no) THEN 1 ELSE 0 END AS changed FROM k)
SELECT line_no, last_value(CASE WHEN length(text) < 60 AND text <> '' THEN text END IGNORE NULLS) OVER w AS header, CASE WHEN letter IS NOT NULL THEN (sum(changed) OVER w - 1)::BIGINT END AS change FROM c WINDOW w AS (ORDER BY line_no)""",
    "file_sections": f"""WITH {_L} SELECT line_no, outer_ AS "outer", last_value(CASE WHEN length(text) % 3 = 0 THEN line_no END IGNORE NULLS) OVER (PARTITION BY section ORDER BY line_no) AS "inner"
FROM (SELECT line_no, text, last_value(CASE WHEN length(text) % 7 = 0 THEN line_no END IGNORE NULLS) OVER (ORDER BY line_no) AS outer_, count(CASE WHEN length(text) % 7 = 0 THEN 1 END) OVER (ORDER BY line_no) AS section FROM l)""",
    "file_ranges": f"""WITH {_L}, m AS (SELECT line_no, text, sum(CASE WHEN line_no % 5 >= 3 THEN 0 ELSE 1 END) OVER (ORDER BY line_no) AS island FROM l)
SELECT island::BIGINT AS island, min(line_no) AS line_no, 'L ' || min(line_no) || CASE WHEN count(*) > 1 THEN '-L ' || max(line_no) ELSE '' END AS label, coalesce(string_agg(text, ' ' ORDER BY line_no) FILTER (line_no % 5 < 3 AND text <> ''), '') AS t FROM m GROUP BY island""",
    "line_zip": f"SELECT line_no, u.text AS base, coalesce(a.text, '') AS beside FROM ({_F.format('user')}) AS u LEFT JOIN ({_F.format('assistant')}) AS a USING (line_no)",
}
