"""Writers.  Spark's committer makes them atomic; small driver-side files go by temporary name and rename."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain_tsv(rows: DataFrame, path: str, header: list[str] | None = None, order: list[str] | None = None) -> None:
    """Tab-separated without quoting: tabs in values become spaces.

    One file with one header line is what the format asks for; ``order`` names the
    columns by which its rows are sorted.
    """
    one = rows.repartition(1).sortWithinPartitions(*order) if order else rows.coalesce(1)
    clean = one.select(*(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "\t", " ").alias(n) for c, n in zip(rows.columns, header or rows.columns, strict=True)))
    clean.write.mode("overwrite").option("quote", "\u0000").option("emptyValue", "").csv(path, sep="\t", header=True)


def quoted_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, escape='"', emptyValue="")


def jsonl(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """One object a line, nulls written; partitioned by columns if asked for."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def splits(rows: DataFrame, path: str) -> None:
    jsonl(rows, path, ["split"])


def chapter_manifest(books: DataFrame, root: str, path: str) -> None:
    """A task a chapter of each discovered collection (version, version_id, name, code, version_code, chapters)."""
    one = books.select("version", F.col("name").alias("book"), F.col("code").alias("book_code"), F.explode("chapters").alias("chapter"), "version_id", "version_code")
    url = F.concat(F.lit(f"{root}/"), F.col("version_id").cast("string"), F.lit("/"), F.col("book_code"), F.lit("."), F.col("chapter").cast("string"), F.lit("."), F.col("version_code"))
    jsonl(one.select("version", "book", "book_code", "chapter", url.alias("url"), F.lit("discovered").alias("status")), path)


def book_manifest(books: DataFrame, header: dict, path: str) -> None:
    """One JSON object for a side: its header, the number of its collections, and a row for each (code, name, testament, chapters, intro_url), of which there are dozens."""
    rows = books.select("code", "name", "testament", F.size("chapters").alias("chapter_count"), "intro_url").orderBy("code").collect()
    small_json({**header, "book_count": len(rows), "books": [r.asDict() for r in rows]}, path)


def metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.select("metric", "value").coalesce(1).write.mode("overwrite").csv(path, header=True)


def aligned_lines(filled: DataFrame, path: str, line: str = "line_no", text: str = "text") -> None:
    """One line for each reference line, in order: one file is what the format asks for."""
    filled.select(line, text).repartitionByRange(1, line).sortWithinPartitions(line).select(text).write.mode("overwrite").text(path)


def sorted_lines(rows: DataFrame, path: str, order: list[str], text: str = "text") -> None:
    """A line for each row, in order, over as many part files as there are shuffle partitions: in order of name they are one file."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows.select(*order, F.coalesce(text, F.lit("")).alias("__line")).repartitionByRange(n, *order).sortWithinPartitions(*order).select("__line").write.mode("overwrite").option("lineSep", "\n").text(path)


def small_json(payload: object, path: str) -> None:
    """Pretty JSON by temporary name and rename."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    waiting = target.with_name(f".{target.name}.tmp")
    waiting.write_text(json.dumps(payload, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    os.replace(waiting, target)


def small_text(text: str, path: str) -> None:
    Path(path).write_text(text, encoding="utf-8")
