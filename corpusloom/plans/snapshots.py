"""Tables of immutable Parquet files that several writers can change: a manifest a version, optimistic commits.

A change rewrites only the files that hold its keys.  They are found by the key ranges in the manifest, then by a
read of the key column, which Parquet's own statistics and Bloom filters cut to the row groups that can match.  The
new files are written first; the change is there once its manifest has the next version's name, which only one
writer can give.  One who comes second compares: if versions in between took away files that it rewrote, or brought
files with its keys, the change is made anew on the newest version; else it is committed behind them.  Files stay,
so any version can be read; ``vacuum`` takes away those that no version names.

Manifests list all files of a version (name, rows, least and greatest first key), so a table should have up to some
100,000 files.  The store must rename without overwriting, as HDFS and local disks do.  Equal keys within one change
are an error, as is a null key.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.storage import checkpoint

#: Keys up to this number are looked up by Parquet's filters, more of them by a join.
FEW = 1000


class Conflict(Exception):
    """Another writer was first, and changed the same keys."""


@dataclass
class Change:
    """What one writer has written and not yet committed."""

    base: int
    removed: list[str]
    added: list[dict]
    keys: DataFrame


class Snapshots:
    """A table in a folder, unique in the columns ``key``."""

    def __init__(self, spark: SparkSession, folder: str, key: list[str], rows_a_file: int = 1_000_000) -> None:
        self.spark, self.folder, self.key, self.rows_a_file = spark, folder.rstrip("/"), key, rows_a_file
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # Versions.

    def _names(self, sub: str) -> list[str]:
        at = self._path(f"{self.folder}/{sub}")
        return sorted(s.getPath().getName() for s in self._store.listStatus(at)) if self._store.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and not n.startswith(("_", "."))]

    def manifest(self, version: int | None = None) -> dict:
        """A version's schema and files; the newest one's if none is given."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise LookupError(f"there is no version {version or ''} of {self.folder}")
        at = f"{self.folder}/versions/{version or known[-1]:012d}.json"
        return json.loads("\n".join(r.value for r in self.spark.read.text(at, wholetext=True).collect()))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given."""
        found = self.manifest(version)
        return self._rows([f["file"] for f in found["files"]], found["schema"])

    def _rows(self, files: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/data/{f}" for f in files)) if files else self.spark.createDataFrame([], schema)

    def _publish(self, version: int, manifest: dict) -> bool:
        """The manifest under its version's name; False if that is taken."""
        target, waiting = f"{self.folder}/versions/{version:012d}.json", f"{self.folder}/versions/_{uuid.uuid4().hex}"
        out = self._store.create(self._path(waiting), False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        try:
            if self._store.getUri().getScheme() == "file":  # a local rename would overwrite; a link doesn't
                local = lambda p: unquote(urlparse(p).path)
                os.link(local(waiting), local(target))
                return True
            hadoop = self.spark._jvm.org.apache.hadoop.fs
            context = hadoop.FileContext.getFileContext(self._store.getUri(), self.spark._jsc.hadoopConfiguration())
            context.rename(self._path(waiting), self._path(target), self.spark._gateway.new_array(hadoop.Options.Rename, 0))
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            self._store.delete(self._path(waiting), False)

    # Files.

    def _write(self, rows: DataFrame) -> list[dict]:
        """New files with the rows in ranges of the key, and what the manifest says of them."""
        folder = uuid.uuid4().hex
        n = rows.count()
        if not n:
            return []
        order = [F.col(f"`{k}`") for k in self.key]
        ranged = rows.repartitionByRange(-(-n // self.rows_a_file), *order).sortWithinPartitions(*order)
        options = {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.key}
        ranged.write.options(**options).parquet(f"{self.folder}/data/{folder}")
        lead = F.col(f"`{self.key[0]}`")
        found = self.spark.read.parquet(f"{self.folder}/data/{folder}").groupBy(F.col("_metadata.file_name").alias("file"))
        return [{"file": f"{folder}/{r.file}", "rows": r.n, "least": r.least, "most": r.most} for r in found.agg(F.count("*").alias("n"), F.min(lead).alias("least"), F.max(lead).alias("most")).collect()]

    def _touched(self, files: list[dict], keys: DataFrame, schema: str) -> list[str]:
        """The files that hold one of the keys."""
        lead = F.col(f"`{self.key[0]}`")
        least, most, n = keys.agg(F.min(lead), F.max(lead), F.count("*")).first()
        near = [f["file"] for f in files if n and f["least"] <= most and f["most"] >= least]
        if not near:
            return []
        rows = self._rows(near, schema).select(*(f"`{k}`" for k in self.key), F.col("_metadata.file_path").alias("__file"))
        if n <= FEW and len(self.key) == 1:
            rows = rows.where(lead.isin([r[0] for r in keys.collect()]))
        held = rows.join(keys, self.key, "left_semi").select("__file").distinct().collect()
        names = {"/".join(r[0].rsplit("/", 2)[1:]) for r in held}
        return [f for f in near if f in names]

    # Changes.

    def create(self, rows: DataFrame) -> int:
        """Version 1, with these rows."""
        self._check(rows)
        if self.versions() or not self._publish(1, {"schema": _ddl(rows), "files": self._write(rows), "removed": [], "added": []}):
            raise Conflict(f"{self.folder} has a table")
        return 1

    def _check(self, rows: DataFrame) -> None:
        null = reduce(lambda x, y: x | y, (F.col(f"`{k}`").isNull() for k in self.key))
        if rows.where(null).limit(1).count() or rows.groupBy(*(f"`{k}`" for k in self.key)).count().where("count > 1").limit(1).count():
            raise ValueError(f"{self.key} must be there and unique in a change")

    def prepare(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Change:
        """Writes the files that ``merge(rows of the touched files, rows)`` makes of the newest version."""
        self._check(rows)
        base = self.versions()[-1]
        now = self.manifest(base)
        keys = rows.select(*(f"`{k}`" for k in self.key))
        removed = self._touched(now["files"], keys, now["schema"])
        old = self._rows(removed, now["schema"])
        return Change(base, removed, self._write(merge(old, rows).select(*(f"`{c}`" for c in old.columns))), keys)

    def commit(self, change: Change) -> int:
        """The version that has the change; ``Conflict`` if it must be made anew."""
        newest = change.base
        while True:
            now = self.manifest(newest)
            kept = [f for f in now["files"] if f["file"] not in set(change.removed)]
            if self._publish(newest + 1, {"schema": now["schema"], "files": kept + change.added, "removed": change.removed, "added": [f["file"] for f in change.added]}):
                return newest + 1
            for version in (v for v in self.versions() if v > newest):
                other = self.manifest(version)
                came = [f for f in other["files"] if f["file"] in set(other["added"])]
                if set(other["removed"]) & set(change.removed) or self._touched(came, change.keys, other["schema"]):
                    raise Conflict(f"version {version} has changed the same rows")
                newest = version

    def _apply(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], tries: int) -> int:
        rows = checkpoint(rows)
        for _ in range(tries):
            try:
                return self.commit(self.prepare(rows, merge))
            except Conflict:
                continue
        raise Conflict(f"{tries} tries met changes of the same rows")

    def upsert(self, rows: DataFrame, tries: int = 20) -> int:
        """New rows, which replace those of their keys."""
        return self._apply(rows, lambda old, new: old.join(new, self.key, "left_anti").unionByName(new), tries)

    def insert_absent(self, rows: DataFrame, tries: int = 20) -> int:
        """New rows, but for those whose keys are there."""
        return self._apply(rows, lambda old, new: old.unionByName(new.join(old, self.key, "left_anti")), tries)

    def update(self, rows: DataFrame, values: dict[str, Callable[[Column, Column], Column]], tries: int = 20) -> int:
        """Rows that are there get ``values[c](old, new)`` in the named columns; keys that aren't there change nothing."""

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            renamed = new.select(*(f"`{k}`" for k in self.key), F.lit(True).alias("__new"), *(F.col(f"`{c}`").alias(f"__new_{c}") for c in values))
            joined = old.join(renamed, self.key, "left")
            return joined.select(*(F.when(F.col("__new"), values[c](F.col(f"`{c}`"), F.col(f"`__new_{c}`"))).otherwise(F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`") for c in old.columns))

        return self._apply(rows, merge, tries)

    def delete(self, keys: DataFrame, tries: int = 20) -> int:
        """Rows of these keys go."""
        return self._apply(keys, lambda old, new: old.join(new, self.key, "left_anti"), tries)

    def vacuum(self, keep: int = 1) -> int:
        """Older versions but for the last ``keep``, and files that no version names, go; how many folders did.  No writer may be at work."""
        for version in self.versions()[:-keep]:
            self._store.delete(self._path(f"{self.folder}/versions/{version:012d}.json"), False)
        named = {f["file"].split("/")[0] for v in self.versions() for f in self.manifest(v)["files"]}
        gone = [n for n in self._names("data") if n not in named]
        for n in gone:
            self._store.delete(self._path(f"{self.folder}/data/{n}"), True)
        return len(gone)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
