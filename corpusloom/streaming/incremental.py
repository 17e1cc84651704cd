"""Incremental import: new files of a folder, each batch inserted only where its keys are absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import curate
from corpusloom.sources.readers import exists

BATCH = "ref string, a_text string, b_text string, line_no bigint"


def import_new_files(spark: SparkSession, incoming: str, target: str, checkpoint: str, source_id: str) -> None:
    """Import what ``incoming`` (JSON lines) holds that earlier runs didn't see, and stop.

    The stream's checkpoint knows the files; a batch that runs again inserts nothing
    twice: its folder is overwritten and its keys are looked up without it.
    """

    def insert(batch: DataFrame, number: int) -> None:
        folders = f"{target}/batch=*"
        known = "id bigint, ref string, a_text string, b_text string, source_id string, split string, status string"
        had = spark.read.schema(known).option("basePath", target).parquet(folders).where(F.col("batch") != number).drop("batch") if exists(spark, folders) else spark.createDataFrame([], known)
        new = curate.import_batch(had, batch, source_id, ["line_no", "ref"])
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(BATCH).json(incoming)
    stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
