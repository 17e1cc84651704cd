"""Ordered operators: forward fill, islands of range markers, ordered concatenation, folds of parts.

All windows are partitioned: by file, conversation or collection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import is_blank, merge_parts, strip

RANGE = "<range>"


def forward_fill(rows: DataFrame, by: list[str], order: list[str], columns: dict[str, Column]) -> DataFrame:
    """Each named value from its last non-null source up to the row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({name: F.last(c, ignorenulls=True).over(w) for name, c in columns.items()})


def fill_within(rows: DataFrame, by: list[str], order: list[str], outer: Column, inner: Column, names: tuple[str, str] = ("outer", "inner")) -> DataFrame:
    """Two levels of headers: a new outer header ends the reach of the inner one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({names[0]: F.last(outer, ignorenulls=True).over(w), "__segment": F.count(outer).over(w)})
    inside = Window.partitionBy(*by, "__segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(names[1], F.last(inner, ignorenulls=True).over(inside)).drop("__segment")


def change_index(rows: DataFrame, by: list[str], order: list[str], name: Column, out: str = "index") -> DataFrame:
    """A number that goes up by one wherever the (forward-filled) name changes; null before the first name."""
    w = Window.partitionBy(*by).orderBy(*order)
    filled = rows.withColumn("__name", F.last(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    changed = F.when(F.col("__name").isNotNull() & ~F.col("__name").eqNullSafe(F.lag("__name").over(w)), 1).otherwise(0)
    index = F.sum(F.col("__changed")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return filled.withColumn("__changed", changed).withColumn(out, F.when(F.col("__name").isNotNull(), index)).drop("__name", "__changed")


def islands(rows: DataFrame, by: list[str], order: list[str], continues: Column, out: str = "island") -> DataFrame:
    """Numbers of groups: a row goes on with the group before it if ``continues`` holds and there is one."""
    w = Window.partitionBy(*by).orderBy(*order)
    starts = F.when(F.coalesce(continues, F.lit(False)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return rows.withColumn("__starts", starts).withColumn(out, F.sum("__starts").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__starts")


def ordered_concat(text: Column, *order: str) -> Column:
    """The group's non-empty texts in order, joined by one space."""
    pairs = F.array_sort(F.collect_list(F.when(F.coalesce(text, F.lit("")) != "", F.struct(*order, text.alias("__t")))))
    return F.array_join(F.transform(pairs, lambda p: p["__t"]), " ")


def merge_ranges(lines: DataFrame, by: list[str], order: str, ref: str, markers: list[str], texts: list[str]) -> DataFrame:
    """Lines that carry a range marker in one of ``markers`` join the line before: ``refs``, and each text without markers."""
    marked = F.coalesce(*(F.when(F.col(m) == RANGE, True) for m in markers), F.lit(False))
    grouped = islands(lines, by, [order], marked)
    clean = lambda c: F.when(strip(F.col(c)) == RANGE, "").otherwise(F.col(c))
    refs_in_order = F.transform(F.array_sort(F.collect_list(F.struct(order, ref))), lambda s: s[ref])
    return grouped.groupBy(*by, "island").agg(F.min(order).alias(order), refs_in_order.alias("refs"), *(ordered_concat(clean(c), order).alias(c) for c in texts))


def range_label(refs: Column) -> Column:
    """One reference, or the first and the verse part of the last."""
    last = F.element_at(F.split(F.element_at(refs, -1), ":"), -1)
    return F.when(F.size(refs) == 1, refs[0]).otherwise(F.concat(refs[0], F.lit("-"), last))


def note_boundaries(rows: DataFrame, by: list[str], order: str, is_note: Column) -> DataFrame:
    """Content rows with ``note_before``: was there a note since the content row before, within the span?"""
    w = Window.partitionBy(*by).orderBy(order)
    flagged = rows.withColumn("__note", is_note)
    return flagged.withColumn("note_before", F.coalesce(F.lag("__note").over(w), F.lit(False))).where("not __note").drop("__note")


def group_parts(spans: DataFrame, by: list[str], order: str) -> DataFrame:
    """Spans (``label``, ``parts``) of equal references as one: parts in order, first label that isn't empty, ``span_count``, merged ``text``."""
    label = F.min(F.when(F.coalesce("label", F.lit("")) != "", F.struct(order, "label")))
    parts = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "parts"))), lambda s: s["parts"]))
    out = spans.groupBy(*by).agg(label["label"].alias("label"), parts.alias("parts"), F.count("*").alias("span_count"), F.min(order).alias(order))
    return out.withColumn("text", merge_parts(F.col("parts")))


def reference_fill(vref: DataFrame, parsed: DataFrame, ref: str = "ref", text: str = "text") -> DataFrame:
    """A row for each vref line, with the empty text where nothing was parsed."""
    return vref.join(parsed.select(ref, text), ref, "left").withColumn(text, F.coalesce(text, F.lit("")))


def zip_lines(base: DataFrame, others: dict[str, DataFrame], line: str = "line_no") -> DataFrame:
    """Line files beside each other by line number; a file that lacks a line has the empty text."""
    out = base
    for name, other in others.items():
        out = out.join(other.select(line, F.col("text").alias(name)), line, "left").withColumn(name, F.coalesce(name, F.lit("")))
    return out


def count_lines(lines: DataFrame, text: str = "text") -> DataFrame:
    """Lines that aren't blank."""
    return lines.agg(F.count_if(~is_blank(F.col(text))).alias("n"))
