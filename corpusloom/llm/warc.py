"""A deterministic, sharded WARC writer, and its reader.

1. Records with equal payloads (by SHA-256) elect the one with the largest id as
   the response; the others become revisits of it.
2. Shard boundaries come from exact running sums of payload bytes in the order of ids (and,
   for rows of one id, of digests): a function of the data alone, not of a sample or of the
   order of partitions.  Executors sum; the driver gets a number a partition and a shard.
3. Records are range-sorted: each shard is one sorted run in one task, which rolls
   its files by compressed size and writes every record as a gzip member of its
   own, with regenerated HTTP and WARC headers and digests.
4. A task writes under temporary names that no other attempt uses.  Only the
   manifest rows of attempts that Spark accepts reach the checkpointed manifest;
   those files are renamed (again on a retry, without harm), then the manifest and
   the success marker are written, and what lost attempts left is deleted.

Files go through ``pyarrow.fs``, so any shared store that it opens will do.

Defined results: ids are whole numbers; a null payload is empty; a null id sorts first, is never chosen
over another id, and repeats as null; of equal rows with the largest id each is a
response; a null url is written as an empty target; an empty table gives an
archive of no files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import at_or_below, checkpoint, digest_tie, quoted, shuffle_partitions

EMPTY_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    """The same for the same record, whenever and wherever it is written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head, which tells its payload's length, and no payload."""
    sha = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = "".join(c for c in url or "" if c >= " " and c != "\x7f")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, sha)), ("WARC-Date", date), ("WARC-Target-URI", target)]
    fields += [("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("WARC-Source-Id", "" if page_id is None else str(page_id))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha)), ("WARC-Refers-To-Source-Id", str(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def revisits(narrow: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id``, ``sha``, ``refers_to`` of the records that repeat another one's payload; payloads themselves stay where they are.

    The election pre-aggregates, and its result has one row a digest, so that the
    optimizer may split a digest that many rows share.
    """
    rows = narrow.where(F.col("bytes") >= least_bytes).select("page_id", "sha")
    chosen = rows.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").select("sha", "refers_to")
    return rows.join(chosen, "sha").where("page_id is null or page_id < refers_to").select("page_id", "sha", "refers_to").distinct()


def _body(payload: str) -> Column:
    return F.coalesce(F.encode(quoted(payload), "UTF-8"), F.lit(b""))


def _place(key: str) -> Column:
    return F.coalesce(quoted(key).cast("bigint"), F.lit(-(2**63)))


def boundaries(narrow: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """The first (id, digest's bits) of all shards but the first, ascending: a shard has about ``shard_bytes`` by running sums over ``bytes``.

    ``narrow`` (``page_id``, ``sha``, ``bytes``) is sorted over the partitions once; how it is cut into them doesn't matter.
    """
    places = narrow.select(_place("page_id").alias("place"), digest_tie(F.hex("sha")).alias("tie"), (F.col("bytes") + 512).alias("size"))
    ordered = places.repartitionByRange(shuffle_partitions(narrow.sparkSession), "place", "tie").sortWithinPartitions("place", "tie").withColumn("part", F.spark_partition_id())
    ordered = checkpoint(ordered)
    before, total = {}, 0
    for part, size in sorted(map(tuple, ordered.groupBy("part").agg(F.sum("size")).collect())):
        before[part] = total
        total += size

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if here is None:
                here = before[batch.column(3)[0].as_py()]
            size = batch.column(2).to_numpy()
            ends = here + np.cumsum(size)
            shard = (ends - size) // shard_bytes
            new = np.flatnonzero(np.append(shard[0] != last, shard[1:] != shard[:-1]))
            here, last = int(ends[-1]), shard[-1]
            yield pa.RecordBatch.from_arrays([pa.array(shard[new]), batch.column(0).take(pa.array(new)), batch.column(1).take(pa.array(new))], names=["shard", "place", "tie"])

    firsts = ordered.mapInArrow(cut, "shard bigint, place bigint, tie bigint").groupBy("shard").agg(F.min(F.struct("place", "tie")).alias("first"))
    found = sorted({(r["first"].place, r["first"].tie) for r in firsts.where("shard > 0").collect()})
    return found


@dataclass
class Roller:
    """Writes one shard's records to files that end once they reach ``roll_bytes`` of compressed data."""

    filesystem: pafs.FileSystem
    folder: str
    attempt: str
    shard: int
    roll_bytes: int
    level: int
    done: list[dict] = field(default_factory=list)
    stream: pa.NativeFile | None = None

    def add(self, raw: bytes) -> None:
        if self.stream is None:
            name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.entry = {"name": name, "temporary": f"_temporary/{self.attempt}/{name}", "records": 0, "bytes": 0}
            self.sum = hashlib.sha256()
            self.filesystem.create_dir(f"{self.folder}/_temporary/{self.attempt}", recursive=True)
            self.stream = self.filesystem.open_output_stream(f"{self.folder}/{self.entry['temporary']}", compression=None)
        member = gzip.compress(raw, self.level, mtime=0)
        self.stream.write(member)
        self.sum.update(member)
        self.entry["records"] += 1
        self.entry["bytes"] += len(member)
        if self.entry["bytes"] >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            self.done.append(self.entry | {"sha256": self.sum.hexdigest()})


MANIFEST = "name string, temporary string, records bigint, bytes bigint, sha256 string"


def write(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html", url: str = "url", least_bytes: int = 0, shard_bytes: int = 16 << 20, max_shards: int = 20_000, roll_bytes: int | None = None, level: int = 6, date: str = EMPTY_DATE) -> DataFrame:
    """Write the archive to ``folder`` (a URI) and return its manifest.

    A shard has ``shard_bytes``, or more where that would make more than ``max_shards``.  Its files are
    rolled at ``roll_bytes`` of compressed data: if none are given, at a 16th of the shard's bytes, between 1 MiB and 1 GiB.
    Equal tables give equal files, byte for byte, however they are partitioned.
    """
    spark = pages.sparkSession
    rows = pages.select(quoted(key).cast("bigint").alias("page_id"), _body(payload).alias("payload"), quoted(url).alias("url"))
    rows = rows.select("page_id", F.unhex(F.sha2("payload", 256)).alias("sha"), "url", "payload")
    narrow = checkpoint(rows.select("page_id", "sha", F.octet_length("payload").cast("bigint").alias("bytes")))
    total = narrow.agg(F.coalesce(F.sum(F.col("bytes") + 512), F.lit(0))).first()[0]
    shard_bytes = max(shard_bytes, total // max_shards)
    roll_bytes = roll_bytes or max(1 << 20, min(1 << 30, shard_bytes // 16))
    starts = boundaries(narrow, shard_bytes)
    shard = at_or_below(starts, _place("page_id"), digest_tie(F.hex("sha")))[0] if starts else F.lit(0)
    records = rows.select("page_id", "sha", F.lit(True).alias("whole"), "url", "payload", F.lit(None).cast("bigint").alias("refers_to"))
    # What is decided about a record comes right before it; only records' payloads are shuffled, and once.
    decided = revisits(narrow, least_bytes).select("page_id", "sha", F.lit(False).alias("whole"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    rows = records.union(decided).withColumn("shard", shard.cast("int"))
    rows = rows.repartitionById(len(starts) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "sha", "whole", "url")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        attempt, roller, done = uuid.uuid4().hex, None, []
        decision: tuple[tuple, int | None] = ((), None)
        for batch in batches:
            for page_id, sha, whole, target, body, refers_to, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not whole:
                    decision = (page_id, sha), refers_to
                    continue
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller = Roller(filesystem, root, attempt, shard, roll_bytes, level)
                original = decision[1] if decision[0] == (page_id, sha) else None
                roller.add(record(page_id, target, body, original, original is not None, date))
        if roller:
            roller.close()
            done += roller.done
        for entry in done:
            yield pa.RecordBatch.from_pylist([entry])

    manifest = checkpoint(rows.mapInArrow(run, MANIFEST))

    def commit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                final = filesystem.get_file_info(f"{root}/{entry['name']}")
                waiting = filesystem.get_file_info(f"{root}/{entry['temporary']}")
                if waiting.type != pafs.FileType.NotFound:
                    filesystem.move(waiting.path, final.path)
                elif final.size != entry["bytes"]:
                    raise OSError(f"{entry['name']} is neither written nor committed")
            yield batch

    committed = manifest.mapInArrow(commit, MANIFEST)
    files, records, size = committed.agg(F.count("*"), F.coalesce(F.sum("records"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    manifest.drop("temporary").orderBy("name").write.mode("overwrite").json(f"{folder}/_manifest")
    filesystem, root = pafs.FileSystem.from_uri(folder)
    if filesystem.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
        filesystem.delete_dir(f"{root}/_temporary")
    with filesystem.open_output_stream(f"{root}/_SUCCESS") as out:
        out.write(json.dumps({"files": files, "records": records, "bytes": size}).encode())
    return spark.read.schema(MANIFEST).json(f"{folder}/_manifest").drop("temporary")


def members(stream: BinaryIO, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    held = b""
    while True:
        held = held or stream.read(size)
        if not held:
            return
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            out.append(inflate.decompress(held))
            held = inflate.unused_data
            if not inflate.eof:
                held = stream.read(size)
                if not held:
                    raise EOFError("the last record is cut off")
        yield b"".join(out)


def parsed(raw: bytes) -> dict:
    """A record's contract row; digests and lengths that don't fit raise an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n" or f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != sha):
        raise ValueError(f"{fields['WARC-Record-ID']} has another payload")
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return {"page_id": number("WARC-Source-Id"), "payload_bytes": length, "payload_digest": sha, "record_type": kind, "refers_to": number("WARC-Refers-To-Source-Id")}


def read(manifest: DataFrame, folder: str, batch_rows: int = 4096) -> DataFrame:
    """The records of all files that the manifest names, each file streamed by one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with filesystem.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows: list[dict] = []
                    for raw in members(stream):
                        rows.append(parsed(raw))
                        if len(rows) == batch_rows:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("name").repartition(shuffle_partitions(manifest.sparkSession), "name").mapInArrow(run, RECORD)
