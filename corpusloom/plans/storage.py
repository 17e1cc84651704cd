"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting for shuffle files that go when their query ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share, named in ``spark.checkpoint.dir``.

    Without that setting a session on this machine alone gets a folder of its own; on a cluster it is an error.
    """
    context = spark.sparkContext
    found = context._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusloom-"))
        found = context._jsc.sc().getCheckpointDir()
    return found.get()


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a new folder in the shared one, which goes when the session's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is begun within leaves no shuffle files: for writes, and for frames that are made within and used once."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The frames written by column in one folder of the shared one and read again: cut from their lineage as by ``checkpoint``, on a fraction of the disk.

    They are written one after another, and each one's shuffle files go before the next is begun.
    """
    folder = None
    for df in parts:
        spark = df.sparkSession
        folder = folder or f"{scratch(spark, name)}/rows"
        with tidy(spark):
            df.write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def in_turn(frames: list[DataFrame]) -> DataFrame:
    """Frames of a few rows each as one: worked out one after another, each one's shuffle files gone before the next is begun."""
    spark = frames[0].sparkSession
    with tidy(spark):
        rows = [r for f in frames for r in f.select(*frames[0].columns).collect()]
    return spark.createDataFrame(rows, reduce(DataFrame.unionByName, frames).schema)
