"""Readers with explicit schemas; a missing optional input is an empty frame."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import curate
from corpusloom.plans.storage import checkpoint

BOM = chr(0xFEFF)


def exists(spark: SparkSession, path: str) -> bool:
    """Is the path there, in whatever store Hadoop reads?  Wildcards count if anything matches."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


LINE = "file string, line_no bigint, text string"
#: Files that can't be cut: their lines are numbered in one task each.
COMPRESSED = r"(?i)\.(gz|bz2|zst|snappy|lz4|deflate|xz)$"


def lines(spark: SparkSession, path: str, required: bool = True, together: bool = False) -> DataFrame:
    """``file``, ``line_no`` from 0, ``text``: split at line feeds only, so that a final one makes an empty last line.

    Files are read in ranges of bytes, of any number for a file.  Lines are counted by range, the counts summed
    along each file, and each task numbers the lines of its ranges from what stands before them.  With ``together``
    the files of the path are one, in order of name: numbers go on from file to file, and a final line feed ends a
    file's last line (as in the part files of one sorted output).
    """
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], LINE)
    meta = lambda c: F.col(f"_metadata.{c}")
    plain = spark.read.text(path, lineSep="\n").select(meta("file_path").alias("file"), meta("file_block_start").alias("block"), meta("file_block_length").alias("size"), meta("file_size").alias("length"), F.col("value").alias("text")).where(~F.col("file").rlike(COMPRESSED))
    packed = spark.read.text(path, wholetext=True).select(meta("file_path").alias("file"), F.col("value").alias("text")).where(F.col("file").rlike(COMPRESSED))

    # A range's lines and bytes, each line with its line feed; what is left to the file's length says how it begins and ends.
    ranges = plain.groupBy("file", "block", "size").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint") + 1).alias("bytes"), F.max("length").alias("length"))
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    short = F.col("length") - F.sum("bytes").over(whole)  # -1 without a final line feed; 3 more with a byte order mark, which the reader takes away
    starts = checkpoint(ranges.select("file", "block", "size", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), short.isin(0, 3).alias("fed"), ((F.row_number().over(whole.orderBy("block")) == 1) & short.isin(2, 3)).alias("marked"), (F.row_number().over(whole.orderBy(F.desc("block"))) == 1).alias("ends")))
    text = F.when(F.col("marked") & (F.col("at") == 0), F.concat(F.lit(BOM), "text")).otherwise(F.col("text"))
    found = _joined(_within_ranges(plain.select("file", "block", "size", "text")), starts)
    numbered = found.select("file", (F.col("first") + F.col("at")).alias("line_no"), text.alias("text"))
    last = starts.where("ends and fed").select("file", (F.col("first") + F.col("n")).alias("line_no"), F.lit("").alias("text"))
    # Files without a row have one line: nothing, or a byte order mark alone.
    names = spark.createDataFrame([(f.replace("file:///", "file:/", 1),) for f in spark.read.text(path).inputFiles()], "file string").where(~F.col("file").rlike(COMPRESSED)).join(starts, "file", "left_anti")
    alone = spark.read.format("binaryFile").load(path).where("length = 3").select(meta("file_path").alias("file"), F.lit(BOM).alias("text"))
    empty = names.join(alone, "file", "left").select("file", F.lit(0).cast("bigint").alias("line_no"), F.coalesce("text", F.lit("")).alias("text"))
    unpacked = packed.select("file", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")).withColumn("line_no", F.col("line_no").cast("bigint"))
    if not together:
        return numbered.unionByName(last).unionByName(empty).unionByName(unpacked)
    if packed.limit(1).count():
        raise ValueError("compressed files can't be read together")
    # Lines before each file: a row a file, in order of name.
    files = starts.groupBy("file").agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(F.broadcast(files.select("file", "before")), "file").select("file", (F.col("line_no") + F.col("before")).alias("line_no"), "text")


def _within_ranges(rows: DataFrame) -> DataFrame:
    """``at``: each line's place among those of its range, which a task has one after the other."""
    names = [*rows.columns, "at"]

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n = None, 0
        for batch in batches:
            if not len(batch):
                continue
            new = np.zeros(len(batch), bool)
            new[1:] = np.logical_or(*(pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in (batch.column("file"), batch.column("block"))))
            first = (batch.column("file")[0].as_py(), batch.column("block")[0].as_py())
            n = n if first == here else 0
            at = np.arange(len(batch))
            start = np.maximum.accumulate(np.where(new, at, 0))
            place = at - start + np.where(start == 0, n, 0)
            here, n = (batch.column("file")[-1].as_py(), batch.column("block")[-1].as_py()), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=names)

    return rows.mapInArrow(number, "file string, block bigint, size bigint, text string, at bigint")


def _joined(rows: DataFrame, starts: DataFrame, most: int = 100_000) -> DataFrame:
    """Lines with their range's row: broadcast up to ``most`` ranges, else shuffled.  Ranges that were cut in another way meanwhile are an error, never wrong numbers."""
    table = starts.select("file", "block", F.col("size").alias("was"), "n", "first", "marked")
    out = rows.join(F.broadcast(table) if starts.count() <= most else table, ["file", "block"], "left")
    return out.where(F.when(F.col("was").eqNullSafe(F.col("size")) & (F.col("at") < F.col("n")), True).otherwise(F.raise_error(F.lit("the ranges of the files have changed")).cast("boolean")))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines don't count, a missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.text(path).where("trim(value) <> ''").select(F.from_json("value", schema).alias("r")).select("r.*")


def captures(spark: SparkSession, root: str, schema: str = schemas.CAPTURE) -> tuple[DataFrame, DataFrame]:
    """Captures below ``root/*/`` with their ``source_file``, and the files that can't be read as an object.

    Hidden files, and names with ``._``, are left out.
    """
    if not exists(spark, f"{root}/*/*.json"):
        return spark.createDataFrame([], f"{schema}, source_file string"), spark.createDataFrame([], "source_file string")
    whole = spark.read.text(f"{root}/*/*.json", wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("name"), "value")
    named = whole.where(~F.col("name").startswith(".") & ~F.contains("name", F.lit("._")))
    parsed = named.select("source_file", F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"), F.ltrim("value").startswith("{").alias("is_object"))
    good = F.col("is_object") & F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    return parsed.where(good).select("r.*", "source_file").drop("_corrupt"), parsed.where(~F.coalesce(good, F.lit(False))).select("source_file")


def tsv(spark: SparkSession, path: str, required: set[str], optional: dict[str, str] | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """A table with a header: quoted fields may hold tabs and line ends; a byte order mark before the header goes.

    ``names`` maps columns of the file to the required ones.
    """
    out = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, enforceSchema=False)
    out = out.toDF(*((names or {}).get(c.strip(BOM), c.strip(BOM)) for c in out.columns))
    if absent := required - set(out.columns):
        raise ValueError(f"columns are missing: {sorted(absent)}")
    for c, default in (optional or {}).items():
        out = out.withColumn(c, F.coalesce(c, F.lit(default)) if c in out.columns else F.lit(default))
    return out


#: The sides' columns in files of the authorized format.
SIDE_COLUMNS = {"thadou": "a_text", "english": "b_text"}


def authorized(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    return tsv(spark, path, {"ref", "a_text", "b_text"}, names=names or SIDE_COLUMNS)


def import_file(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    return tsv(spark, path, {"a_text", "b_text"}, {"ref": ""}, names or SIDE_COLUMNS)


def within(root: str, path: str) -> Path:
    """The resolved path, if it is below the root and there."""
    resolved, top = (Path(root) / path).resolve(), Path(root).resolve()
    if not resolved.is_relative_to(top):
        raise PermissionError(f"{path} leaves {root}")
    if not resolved.is_file():
        raise FileNotFoundError(path)
    return resolved


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Source rows of a registry file (a small one, which the driver reads): a list, or an object with ``sources``; a file that can't be read gives none."""
    try:
        content = json.loads("\n".join(r.value for r in spark.read.text(path).collect()))
        found = content.get("sources", []) if isinstance(content, dict) else content
        rows = [{k: None if v is None else str(v) for k, v in s.items()} for s in found if isinstance(s, dict)]
    except (ValueError, AttributeError):
        rows = []
    return curate.registry_rows(spark.createDataFrame([(rows,)], "sources array<map<string,string>>"))


def small_json(spark: SparkSession, path: str) -> dict | None:
    """A small object, or None if it isn't there or can't be read."""
    if not exists(spark, path):
        return None
    try:
        out = json.loads(spark.read.text(path, wholetext=True).first().value)
    except (ValueError, AttributeError):
        return None
    return out if isinstance(out, dict) else None


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """``code`` and names of the collection mapping; empty if there is none."""
    books = (small_json(spark, path) or {}).get("books", {})
    return spark.createDataFrame([(k, v.get("a_name"), v.get("b_name")) for k, v in books.items()], "code string, a_name string, b_name string")


def state(spark: SparkSession, path: str) -> DataFrame:
    """The state table; empty if there is none or it can't be read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.STATE)
    return spark.read.schema(schemas.STATE).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
