"""Collection tasks and their state: filters, resume, upsert and seeding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import now_iso
from corpusloom.schemas import COMPLETE_STATES, VERIFIED


def filter_tasks(tasks: DataFrame, book: str | None = None, chapter: int | None = None) -> DataFrame:
    if book:
        tasks = tasks.where(F.upper("book_code") == book.upper())
    return tasks.where(F.col("chapter") == chapter) if chapter is not None else tasks


def missing(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done.select(*keys), keys, "left_anti")


def remaining(tasks: DataFrame, state: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks that aren't complete: a complete state counts only if its file is there."""
    complete = state.where(F.col("status").isin(COMPLETE_STATES)).join(files.select(*keys), keys, "left_semi")
    return missing(tasks, complete, keys)


def upsert_state(state: DataFrame, changes: DataFrame, keys: list[str], default: str = "discovered") -> DataFrame:
    """Each change's given fields over the entry's, with the time in ``updated_at``; a new entry begins as discovered."""
    fields = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, F.lit(True).alias("__new"), *(F.col(c).alias(f"new_{c}") for c in fields))
    out = state.join(new, keys, "full_outer").withColumns({c: F.coalesce(f"new_{c}", c) for c in fields})
    if "updated_at" in state.columns:
        out = out.withColumn("updated_at", F.when(F.col("__new"), now_iso()).otherwise(F.col("updated_at")))
    return out.withColumn("status", F.coalesce("status", F.lit(default))).select(*state.columns)


def seed_state(state: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """Entries for all seeds; what an entry has already stays."""
    fields = [c for c in seeds.columns if c not in keys]
    new = seeds.select(*keys, *(F.col(c).alias(f"seed_{c}") for c in fields))
    return state.join(new, keys, "full_outer").withColumns({c: F.coalesce(c, f"seed_{c}") for c in fields}).select(*state.columns)


def outcome(captures: DataFrame) -> DataFrame:
    """The state that a capture leads to: failed without segments, verified or else extracted."""
    return captures.withColumn("outcome", F.when(F.coalesce("verse_count", F.lit(0)) == 0, "failed").when(F.col("language_status") == VERIFIED, "verified").otherwise("extracted"))


def transitions(events: DataFrame, keys: list[str], order: list[str], status: str) -> DataFrame:
    """How often each state follows which, per entry in order."""
    from pyspark.sql import Window

    before = F.lag(status).over(Window.partitionBy(*keys).orderBy(*order))
    return events.withColumn("before", before).where("before is not null").groupBy("before", F.col(status).alias("after")).agg(F.count("*").alias("n"))
