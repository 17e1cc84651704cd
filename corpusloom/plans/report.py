"""Quality metrics, checksums and Markdown reports.  Only metrics (a few dozen rows) reach the driver."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.storage import in_turn
from corpusloom.sources.readers import COMPRESSED


def metric(rows: DataFrame, name: str, value: Column) -> DataFrame:
    return rows.agg(value.cast("string").alias("value")).select(F.lit(name).alias("metric"), "value")


def metrics(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Metrics of one frame, by one aggregation."""
    one = rows.agg(*(v.cast("string").alias(k) for k, v in values.items()))
    pairs = F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in values))
    return one.select(F.explode(pairs).alias("m")).select("m.*")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quality_metrics(sides: dict[str, DataFrame], tasks: dict[str, DataFrame], captures: dict[str, DataFrame], audit: DataFrame, parallel: DataFrame, ml: DataFrame, splits: DataFrame, files: DataFrame, verdict: DataFrame, unreadable: DataFrame, failed: DataFrame) -> DataFrame:
    """The 30 metrics of a run: discovered, extracted and normalized counts by side, alignment, audit, splits, files and the verdict.

    Each frame is aggregated once, to one row, one after another.
    """
    status = lambda s: F.count_if(F.col("alignment_status") == s)
    blank = F.size(F.filter("verses", lambda v: F.trim(F.coalesce(v["text"], F.lit(""))) == ""))
    parts = [metrics(tasks[s], {f"books_discovered_{s}": F.countDistinct("book_code"), f"chapters_discovered_{s}": F.count("*")}) for s in "ab"]
    parts += [metric(captures[s], f"chapters_extracted_{s}", F.count("*")) for s in "ab"] + [metric(sides[s], f"segments_normalized_{s}", F.count("*")) for s in "ab"]
    parts += [metric(parallel, "aligned_pairs", F.count("*")), metric(ml, "ml_pairs", F.count("*"))]
    parts.append(metrics(audit, {s: status(s) for s in ("missing_a", "missing_b", "duplicate_a", "duplicate_b", "language_uncertain", "extraction_error")} | {"audit_records": F.count("*")}))
    both = union([captures[s].select("language_verification", "verses") for s in "ab"])
    parts.append(metrics(both, {"uncertain_chapters": F.count_if(~F.col("language_verification.status").eqNullSafe("verified")), "empty_segments": F.coalesce(F.sum(blank), F.lit(0))}))
    parts += [metric(failed, "failed_chapters", F.count("*")), metric(unreadable, "unreadable_files", F.count("*"))]
    parts.append(metrics(splits, {f"{s}_{k}": F.coalesce(F.max(F.when(F.col("split") == s, F.col(k))), F.lit(0)) for s in ("train", "validation", "test") for k in ("segments", "books")}))
    parts += [metric(files, "checksummed_files", F.count("*")), metrics(verdict, {"verification_ok": F.bool_and("ok"), "verification_complete": F.bool_and("complete")})]
    return in_turn(parts)


def retrieval_range(captures: DataFrame, at: str = "retrieved_at") -> DataFrame:
    """First and last time as one text, or n/a."""
    return captures.agg(F.coalesce(F.concat(F.min(at), F.lit(" to "), F.max(at)), F.lit("n/a")).alias("range"))


#: Files up to so many bytes are hashed as one value; of longer ones, chunks of about ``CHUNK`` bytes are.
WHOLE, CHUNK = 64 << 20, 8 << 10


def digests(spark: SparkSession, path: str | list[str], whole: int = WHOLE) -> DataFrame:
    """``path``, ``length``, ``sha256`` of files of any length.

    A long file is read in ranges and hashed chunk after chunk, in one task a file, as SHA-256 has one order of
    bytes; no task holds it.  Compressed files are opened by every reader but the one for whole values, which ends at 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    long = files.where(F.col("length") > whole).select("path", "length", F.col("_metadata.file_path").alias("file")).collect()
    packed = [r.path for r in long if re.search(COMPRESSED, r.path)]
    cut = [r for r in long if not re.search(COMPRESSED, r.path)]
    hashed = lambda f: f.select("path", "length", F.sha2("content", 256).alias("sha256"))
    out = hashed(files.where(F.col("length") <= whole))
    if packed:
        out = out.unionByName(hashed(spark.read.format("binaryFile").load([_literal(p) for p in packed])))
    if cut:
        out = out.unionByName(_streamed(spark, cut))
    return out


def _literal(path: str) -> str:
    """The path without wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _streamed(spark: SparkSession, files: list[Row]) -> DataFrame:
    """Digests of long files (``path``, ``length``, ``file``) from their bytes between line feeds, as text readers cut them."""
    meta = lambda c: F.col(f"_metadata.{c}")
    lines = spark.read.text([_literal(f.path) for f in files], lineSep="\n").select(meta("file_path").alias("file"), meta("file_block_start").alias("block"), meta("file_size").alias("length"), F.col("value").cast("binary").alias("bytes"))

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of a range, each with its line feed, in numbered chunks."""
        place, seq, held, size = None, 0, [], 0
        made = lambda: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*place, seq, b"\n".join([*held, b""])), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["file", "block", "length", "seq", "bytes"])
        for batch in batches:
            for *here, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != place or size >= CHUNK:
                    if held:
                        yield made()
                    seq, held, size = (seq + 1 if here == place else 0), [], 0
                    place = here
                held.append(line)
                size += len(line) + 1
        if held:
            yield made()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Readers take a byte order mark away and don't tell whether a line feed ends the file: the file's length does."""
        file, length, fed, plain, marked = None, 0, 0, None, None

        def end() -> pa.RecordBatch:
            left = length - fed
            if left not in (0, 1, 3, 4):
                raise ValueError(f"{file} has changed: {left} bytes of {length} are left")
            for h in (plain, marked):
                h.update(b"\n" * (left in (1, 4)))
            return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([(marked if left > 1 else plain).hexdigest()])], names=["file", "sha256"])

        for batch in batches:
            for f, size, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "length", "bytes")), strict=True):
                if f != file:
                    if file is not None:
                        yield end()
                    file, length, fed, plain, marked = f, size, 0, hashlib.sha256(), hashlib.sha256(b"\xef\xbb\xbf")
                else:
                    piece = b"\n" + piece
                for h in (plain, marked):
                    h.update(piece[:-1])
                fed += len(piece) - 1
        if file is not None:
            yield end()

    cut = lines.mapInArrow(chunks, "file string, block bigint, length bigint, seq bigint, bytes binary")
    found = cut.repartition(len(files), "file").sortWithinPartitions("file", "block", "seq").select("file", "length", "bytes").mapInArrow(digest, "file string, sha256 string")
    return spark.createDataFrame([(f.path, f.length, f.file) for f in files], "path string, length bigint, file string").join(found, "file").select("path", "length", "sha256")


def checksums(spark: SparkSession, raw: str | list[str], final: list[str]) -> DataFrame:
    """``class`` (0 raw, 1 final), ``ord``, ``path``, ``sha256``: raw files by path, then final ones as declared.

    Hidden files, and names with ``._``, are left out.
    """
    read = lambda p: digests(spark, p).select("path", "sha256")
    name = F.element_at(F.split("path", "/"), -1)
    out = read(raw).where(~name.startswith(".") & ~F.contains(name, F.lit("._"))).select(F.lit(0).alias("class"), F.lit(0).alias("ord"), "path", "sha256")
    for i, p in enumerate(final):
        out = out.unionByName(read(p).select(F.lit(1).alias("class"), F.lit(i).alias("ord"), "path", "sha256"))
    return out.orderBy("class", "ord", "path")


def file_digest(spark: SparkSession, path: str) -> DataFrame:
    return digests(spark, path)


def sha256sum(rows: DataFrame, header: list[str]) -> DataFrame:
    """Lines in the format of the sha256sum tool, below comment lines; ``ord`` keeps their order."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(-1, i, "", f"# {h}") for i, h in enumerate(header)], "class int, ord int, path string, line string")
    return head.unionByName(rows.select("class", "ord", "path", F.concat("sha256", F.lit("  "), "path").alias("line"))).orderBy("class", "ord", "path").select("line")


def cell(value: object) -> str:
    return str("" if value is None else value).replace("|", "\\|").replace("\n", " ")


def markdown(title: str, sections: dict[str, tuple[list[str], list[tuple]]]) -> str:
    """Tables with escaped cells, one a section."""
    out = [f"# {title}"]
    for name, (header, rows) in sections.items():
        out += ["", f"## {name}", "", "| " + " | ".join(map(cell, header)) + " |", "|" + " --- |" * len(header)]
        out += ["| " + " | ".join(map(cell, r)) + " |" for r in rows]
    return "\n".join(out) + "\n"


def quality_markdown(metric_rows: DataFrame, check_rows: DataFrame) -> str:
    found = [(r.metric, r.value) for r in metric_rows.collect()]
    return markdown("Quality report", {"Metrics": (["metric", "value"], found), "Checks": (["check", "ok", "detail"], [tuple(r) for r in check_rows.select("check", "ok", "detail").collect()])})


def source_markdown(title: str, sides: list[dict], metric_rows: DataFrame, files: DataFrame, notes: list[str], largest: int = 20) -> str:
    """The source manifest: what the corpus is made of, its counts, the rights notes given, and its ``largest`` final files' checksums.

    ``sides`` has a dict a side: side, version_id, version_code, language, url, publisher.
    """
    header = ["side", "version_id", "version_code", "language", "url", "publisher"]
    counts = [(r.metric, r.value) for r in metric_rows.collect()]
    final = [(r.path.rsplit("/", 1)[-1], r.sha256) for r in files.where("class = 1").orderBy("ord", "path").limit(largest).collect()]
    sections = {"Sources": (header, [tuple(s.get(h) for h in header) for s in sides]), "Counts": (["metric", "value"], counts), "Files": (["file", "sha256"], final)}
    return markdown(title, sections) + "".join(f"\n* {cell(n)}" for n in notes) + ("\n" if notes else "")
