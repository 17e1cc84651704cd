"""Stages with exit codes: 0 good, 1 not all good, 2 stop."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions import refs
from corpusloom.operators import align, normalize
from corpusloom.sources import readers, sinks

GOOD, PARTIAL, STOP = 0, 1, 2
log = logging.getLogger("corpusloom")


def audit_event(kind: str, **values: object) -> None:
    log.info("AUDIT event=%s %s", kind, " ".join(f"{k}={v}" for k, v in values.items()))


def setup_logging(folder: str | None = None) -> None:
    """To the console, and to one file a level if there is a folder."""
    log.setLevel(logging.DEBUG)
    log.addHandler(logging.StreamHandler())
    for level in ("INFO", "WARNING", "ERROR") if folder else ():
        handler = logging.FileHandler(f"{folder}/{level.lower()}.log", encoding="utf-8")
        handler.setLevel(level)
        log.addHandler(handler)


def run(stages: list[tuple[str, Callable[[], int]]]) -> int:
    """Each stage in turn; code 2 stops, otherwise the worst code counts."""
    worst = GOOD
    for name, stage in stages:
        code = stage()
        audit_event("stage", name=name, code=code)
        if code == STOP:
            return STOP
        worst = max(worst, code)
    return worst


def align_folder(spark: SparkSession, root: str, a: str, b: str) -> int:
    """Captures below ``root/a`` and ``root/b`` to normalized, aligned, audit and split outputs below ``root``."""
    if not readers.exists(spark, f"{root}/{a}") or not readers.exists(spark, f"{root}/{b}"):
        return STOP
    good, unreadable = readers.captures(spark, root)
    for side in (a, b):
        sinks.jsonl(normalize.normalized(good.where(good.version == side)), f"{root}/normalized/{side}")
    sides: list[DataFrame] = [normalize.normalized(good.where(good.version == s)) for s in (a, b)]
    lost = [normalize.dropped(good.where(good.version == s)).selectExpr("reference", f"'{k}' as side", "kept_file as kept", "dropped_file as dropped") for s, k in ((a, "a"), (b, "b"))]
    key = ["reference", "book_code", "chapter", "verse"]
    decided = align.decide(align.join_sides(sides[0], sides[1], key), ["book_code", "chapter"])
    pairs = align.with_split(align.parallel(decided), decided["book_code"])
    sinks.jsonl(pairs, f"{root}/aligned/parallel")
    sinks.jsonl(align.ml(pairs, refs.reference(pairs["book_code"], pairs["chapter"], pairs["verse"])), f"{root}/aligned/ml")
    sinks.jsonl(align.audit(decided, ["reference"], lost[0].unionByName(lost[1])), f"{root}/audit")
    sinks.splits(pairs.select("reference", "a_text", "b_text", "split"), f"{root}/aligned/splits")
    return GOOD if unreadable.isEmpty() and normalize.uncertain_groups(sides[0].unionByName(sides[1]), ["version", "book_code", "chapter"]).isEmpty() else PARTIAL


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    parser.add_argument("root")
    parser.add_argument("side_a")
    parser.add_argument("side_b")
    given = parser.parse_args(argv)
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    setup_logging()
    return run([("align", lambda: align_folder(spark, given.root, given.side_a, given.side_b))])
