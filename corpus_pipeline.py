"""A training-data pipeline over ``documents``: each stage works on all rows that the one before it kept.

1. ``language_id`` learns from the labelled documents outside the held-out fold; documents without a
   language (no text, no letter) go, and a missing ``lang`` becomes the predicted one.
2. ``jaccard_join`` keeps the document with the least id of each group of near-duplicates.
3. ``substring_dedup`` removes words in repeated windows of 35 words; a document of which nothing is left goes.
4. ``decontaminate`` drops documents in which a 10-word window of the benchmark occurs.
5. ``mix_sources`` repeats documents to equal source weights, in one global random order.

Nulls, empty texts, ties and empty tables have the results that the operators define.  Columns beyond
those of ``documents`` pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, jaccard, language_id, mixing, substrings
from corpusloom.llm.common import fold, scratch


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    judged = language_id.predict(docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns}), model, text="doc__text")
    kept = judged.where(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.select(*((F.coalesce("doc__lang", "lang_pred") if c == "lang" else F.col(f"doc__{c}")).alias(c) for c in docs.columns))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    cut = substrings.removed(docs.withColumnsRenamed({c: f"doc__{c}" for c in names}), "doc__doc_id", "doc__text")
    left = cut.where("n_removed < n_words or n_words = 0")
    length = F.when(F.col("n_removed") > 0, F.length("doc__text").cast("bigint")).otherwise(F.col("doc__n_chars"))
    return left.select(*((length if c == "n_chars" else F.col(f"doc__{c}")).alias(c) for c in names))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_stage),
    ("jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("decontaminate", decontamination_stage),
    ("mix_sources", mixing_stage),
]

#: SQL can't express the language model's decisions; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again; the one before it goes then."""
    folder, before = scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{before}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = name
    return docs
