"""Ordered scans over ranges: what a window without a partition, or with one huge one, would do in one task.

Rows are sorted into ranges of the whole order and stored.  The first pass gives a small summary of each range (row
count, last segment, last marked row, counts); summaries are carried forward in order on the driver, one a range;
the second pass starts each range with what was carried to it.  A segment, the rows of equal ``by``, may thus go
over any number of ranges.  Only numbers and digests are carried: values that rows take over from another range are
joined to them by the number of the row that has them.

Rows of equal order are in any order, so ``order`` should be total.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.plans.storage import checkpoint

AT, POSITION = "__at", "__position"


def in_ranges(rows: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """``rows`` stored in ranges of the order, as many as there are shuffle partitions, sorted within each."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # Rows that are equal in the order may be many: a number of their own deals them to several ranges.
    spread = rows.withColumn("__spread", F.monotonically_increasing_id())
    return checkpoint(spread.repartitionByRange(n, *order, "__spread").sortWithinPartitions(*order, "__spread").drop("__spread"))


def two_passes(rows: DataFrame, start: Any, summary: Callable[[Iterable[pa.RecordBatch]], Any], carry: Callable[[Any, Any], Any], emit: Callable[[Any, Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``emit(state, batches)`` for each of the stored ranges, with the state after all ranges before it.

    ``carry(state, summary)`` is the state after a range.  States and summaries are small: the driver has one a range.
    """

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob = pickle.dumps(summary(batches))
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([blob], pa.binary())], ["part", "blob"])

    found = {r.part: pickle.loads(r.blob) for r in rows.mapInArrow(first, "part int, blob binary").collect()}
    states, state = {}, start
    for part in sorted(found):
        states[part] = state
        state = carry(state, found[part])
    held = rows.sparkSession.sparkContext.broadcast(states)

    def second(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(held.value[TaskContext.get().partitionId()], batches)

    return rows.mapInArrow(second, schema)


def digest(columns: list[Column]) -> Column:
    """A digest of the values together, nulls included; equal for all rows if there are no columns."""
    if not columns:
        return F.lit("")
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


@dataclass
class Mark:
    """What is known of a marked column at a place: number of the last marked row of the segment (-1: none), its digest, marks so far."""

    last: int = -1
    key: str | None = None
    count: int = 0


@dataclass
class State:
    """After a row: rows so far, the segment and the rows of it so far, its marks; of a range also how it begins."""

    rows: int = 0
    segment: str | None = None
    position: int = 0
    marks: list[Mark] = field(default_factory=list)
    #: For a range: its first segment, whether it has no other, and for each mark the first digest there and whether the first row is marked.
    begins: str | None = None
    whole: bool = True
    firsts: list[tuple[str | None, bool]] = field(default_factory=list)


KINDS = ("value", "start", "change")


class _Scan:
    """Goes through the rows of a range.

    ``kinds`` says what a mark is: a ``value`` (not null); a ``start`` (true, and the first row of any segment);
    a ``change`` (not null and unequal to the last such value of the segment).
    """

    def __init__(self, kinds: list[str], state: State) -> None:
        self.kinds, self.state = kinds, state

    def take(self, segments: pa.Array, keys: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Numbers and positions of the rows, and for each mark its last row and the count up to each row (-1 and 0: none)."""
        state, n = self.state, len(segments)
        at = state.rows + np.arange(n)
        names = segments.to_pylist()
        same = np.ones(n, bool)
        same[0] = state.rows > 0 and names[0] == state.segment
        if n > 1:
            same[1:] = pc.equal(segments[1:], segments[:-1]).to_numpy(zero_copy_only=False)
        begin = np.where(same, -1, at)
        begin = np.maximum.accumulate(np.maximum(begin, state.rows - state.position if same[0] else -1))
        position = at - begin
        out = []
        for kind, key, mark in zip(self.kinds, keys, state.marks, strict=True):
            marked = pc.is_valid(key).to_numpy(zero_copy_only=False)
            if kind == "start":
                marked = marked | (position == 0)
            elif kind == "change":
                marked = self._changes(key, marked, begin, mark, same[0])
            last = np.maximum.accumulate(np.where(marked, at, mark.last if same[0] else -1))
            last = np.where(last >= begin, last, -1)
            total = np.cumsum(marked) + (mark.count if same[0] else 0)
            # What had been counted when the segment began doesn't belong to it.
            base = np.where(begin >= state.rows, total[np.maximum(begin - state.rows, 0)] - marked[np.maximum(begin - state.rows, 0)], 0)
            out.append((last, total - base))
        filled = [self._last_key(k, begin, m, same[0]) for k, m in zip(keys, state.marks, strict=True)]
        state.marks = [Mark(int(last[-1]), key, int(count[-1])) for (last, count), key in zip(out, filled, strict=True)]
        state.rows, state.segment, state.position = state.rows + n, names[-1], int(position[-1]) + 1
        return at, position, out

    def _changes(self, key: pa.Array, valid: np.ndarray, begin: np.ndarray, mark: Mark, goes_on: bool) -> np.ndarray:
        places = np.flatnonzero(valid)
        out = np.zeros(len(valid), bool)
        if len(places):
            values = key.take(pa.array(places))
            unequal = np.ones(len(places), bool)
            if len(places) > 1:
                unequal[1:] = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False) | (begin[places[1:]] != begin[places[:-1]])
            if goes_on and begin[places[0]] == begin[0] and mark.key is not None:
                unequal[0] = values[0].as_py() != mark.key
            out[places[unequal]] = True
        return out

    def _last_key(self, key: pa.Array, begin: np.ndarray, mark: Mark, goes_on: bool) -> str | None:
        places = np.flatnonzero(pc.is_valid(key).to_numpy(zero_copy_only=False) & (begin == begin[-1]))
        if len(places):
            return key[int(places[-1])].as_py()
        return mark.key if goes_on and begin[-1] == begin[0] else None


def _summary(kinds: list[str]) -> Callable[[Iterable[pa.RecordBatch]], State]:
    def run(batches: Iterable[pa.RecordBatch]) -> State:
        scan = _Scan(kinds, State(marks=[Mark() for _ in kinds], firsts=[(None, False)] * len(kinds)))
        for batch in batches:
            if not len(batch):
                continue
            segments, keys = batch.column("__segment"), [batch.column(f"__key{i}") for i in range(len(kinds))]
            if not scan.state.rows:
                scan.state.begins = segments[0].as_py()
                scan.state.firsts = [(None, k[0].is_valid) for k in keys]
            _, position, _ = scan.take(segments, keys)
            inside = position == np.arange(len(position)) + scan.state.rows - len(position)
            scan.state.whole = scan.state.whole and bool(inside.all())
            for i, key in enumerate(keys):
                if scan.state.firsts[i][0] is None:
                    found = np.flatnonzero(inside & pc.is_valid(key).to_numpy(zero_copy_only=False))
                    if len(found):
                        scan.state.firsts[i] = (key[int(found[0])].as_py(), scan.state.firsts[i][1])
        return scan.state

    return run


def _carry(kinds: list[str]) -> Callable[[State, State], State]:
    def run(before: State, part: State) -> State:
        if not part.rows:
            return before
        goes_on = before.rows > 0 and before.segment == part.begins
        out = State(before.rows + part.rows, part.segment, part.position, [])
        joined = goes_on and part.whole
        if joined:
            out.position += before.position
        for kind, mark, old, (key, marked) in zip(kinds, part.marks, before.marks, part.firsts, strict=True):
            last = mark.last + before.rows if mark.last >= 0 else -1
            count, name = mark.count, mark.key
            if joined:
                again = kind == "change" and key is not None and key == old.key
                forced = kind == "start" and not marked
                count += old.count - again - forced
                # A mark that the first row had only as the first of its range isn't one.
                if (forced or again) and mark.count == 1:
                    last = old.last
                last = last if last >= 0 else old.last
                name = name if name is not None else old.key
            out.marks.append(Mark(last, name, count))
        return out

    return run


def scan(rows: DataFrame, by: list[str], marks: list[tuple[str, Column]]) -> DataFrame:
    """``rows`` (in ranges) with the number of each row, its position in its segment, and ``__last<i>`` and ``__count<i>`` of each mark (kind, column).

    ``__last<i>`` is the number of the last marked row up to this one in the segment, null if there is none; ``__count<i>`` counts them.
    """
    kinds = [k for k, _ in marks]
    if wrong := set(kinds) - set(KINDS):
        raise ValueError(f"unknown kinds of marks: {sorted(wrong)}")
    keyed = rows.withColumns({"__segment": digest([F.col(f"`{c}`") for c in by]), **{f"__key{i}": F.when(c, "") if k == "start" else F.when(c.isNotNull(), digest([c])) for i, (k, c) in enumerate(marks)}})
    extra = [f"{AT} bigint", f"{POSITION} bigint", *(f"__{what}{i} bigint" for i in range(len(marks)) for what in ("last", "count"))]
    own = rows.columns

    def emit(state: State, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going = _Scan(kinds, State(state.rows, state.segment, state.position, [Mark(m.last, m.key, m.count) for m in state.marks]))
        for batch in batches:
            if not len(batch):
                continue
            at, position, found = going.take(batch.column("__segment"), [batch.column(f"__key{i}") for i in range(len(kinds))])
            columns = [pa.array(at), pa.array(position)]
            for last, count in found:
                columns += [pa.array(last, mask=last < 0), pa.array(count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), *columns], names=[*own, *(x.split(" ")[0] for x in extra)])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL(", ".join(extra)).fields])
    return two_passes(keyed, State(marks=[Mark() for _ in kinds]), _summary(kinds), _carry(kinds), emit, schema)


def numbered(rows: DataFrame, by: list[str], order: list[Column], ranges: int | None = None) -> DataFrame:
    """``rows`` in ranges, with the number of each row (``__at``, from 0) and its position in its segment (``__position``, from 0)."""
    return scan(in_ranges(rows, [*(F.col(f"`{c}`") for c in by), *order], ranges), by, [])


def forward_fill(rows: DataFrame, by: list[str], order: list[str], columns: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """Each named value from its last non-null source up to the row, within rows of equal ``by`` (all rows if there is none)."""
    taken = rows.withColumns({f"__value{i}": c for i, c in enumerate(columns.values())})
    stored = in_ranges(taken, [F.col(f"`{c}`") for c in [*by, *order]], ranges)
    marked = checkpoint(scan(stored, by, [("value", F.col(f"__value{i}")) for i in range(len(columns))]))
    out = marked
    for i, name in enumerate(columns):
        # A row without a value takes that of the row it names: one join of the rows that need one.
        source = marked.where(F.col(f"__value{i}").isNotNull()).select(F.col(AT).alias("__source"), F.col(f"__value{i}").alias(f"__filled{i}"))
        own = out.where(F.col(f"__value{i}").isNotNull() | F.col(f"__last{i}").isNull()).withColumn(f"__filled{i}", F.col(f"__value{i}"))
        other = out.where(F.col(f"__value{i}").isNull() & F.col(f"__last{i}").isNotNull()).join(source, F.col(f"__last{i}") == F.col("__source")).drop("__source")
        out = own.unionByName(other)
    return out.select(*(F.col(f"`{c}`") for c in rows.columns if c not in columns), *(F.col(f"__filled{i}").alias(n) for i, n in enumerate(columns)))


def change_index(rows: DataFrame, by: list[str], order: list[str], name: Column, out: str = "index", ranges: int | None = None) -> DataFrame:
    """A number that goes up by one wherever the last known name changes, from 0; null before the first name."""
    stored = in_ranges(rows.withColumn("__name", name), [F.col(f"`{c}`") for c in [*by, *order]], ranges)
    found = scan(stored, by, [("change", F.col("__name"))])
    return found.withColumn("__index", F.when(F.col("__count0") > 0, F.col("__count0") - 1)).select(*(F.col(f"`{c}`") for c in rows.columns if c != out), F.col("__index").alias(out))


def islands(rows: DataFrame, by: list[str], order: list[str], continues: Column, out: str = "island", ranges: int | None = None) -> DataFrame:
    """Numbers of groups from 1: a row goes on with the group before it if ``continues`` holds and there is one."""
    stored = in_ranges(rows.withColumn("__starts", ~F.coalesce(continues, F.lit(False))), [F.col(f"`{c}`") for c in [*by, *order]], ranges)
    found = scan(stored, by, [("start", F.col("__starts"))])
    return found.select(*(F.col(f"`{c}`") for c in rows.columns if c != out), F.col("__count0").alias(out))


def fill_within(rows: DataFrame, by: list[str], order: list[str], outer: Column, inner: Column, names: tuple[str, str] = ("outer", "inner"), ranges: int | None = None) -> DataFrame:
    """Two levels of headers: a new outer header ends the reach of the inner one."""
    # Outer headers and the inner ones below each are one numbered sequence: an inner header counts if it stands behind the last outer one.
    stored = in_ranges(rows.withColumns({"__value0": outer, "__value1": inner}), [F.col(f"`{c}`") for c in [*by, *order]], ranges)
    marked = checkpoint(scan(stored, by, [("value", F.col("__value0")), ("value", F.col("__value1"))]))
    near = F.when(F.col("__last1") >= F.coalesce("__last0", F.lit(-1)), F.col("__last1"))
    value = lambda i: marked.where(F.col(f"__value{i}").isNotNull()).select(F.col(AT).alias(f"__source{i}"), F.col(f"__value{i}").alias(f"__filled{i}"))
    joined = marked.withColumn("__near", near).join(value(0), F.col("__last0") == F.col("__source0"), "left").join(value(1), F.col("__near") == F.col("__source1"), "left")
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns if c not in names), *(F.col(f"__filled{i}").alias(n) for i, n in enumerate(names)))


def merge_ranges(lines: DataFrame, order: str, ref: str, markers: list[str], texts: list[str], marker: str, clean: Callable[[Column], Column], ranges: int | None = None) -> DataFrame:
    """Lines of one long file: those that carry ``marker`` in one of the columns ``markers`` join the line before; ``refs`` and each text, ``clean``ed, in order.

    An island's lines meet in one group, so it is their number, not the file's length, that a task has to hold.
    """
    marked = reduce(lambda x, y: x | y, (F.coalesce(F.col(m) == marker, F.lit(False)) for m in markers))
    grouped = islands(lines, [], [order], marked, "__island", ranges)
    pairs = lambda c: F.array_sort(F.collect_list(F.when(F.coalesce(c, F.lit("")) != "", F.struct(F.col(order), c.alias("__t")))))
    refs = F.transform(F.array_sort(F.collect_list(F.struct(order, ref))), lambda s: s[ref])
    out = grouped.groupBy("__island").agg(F.min(order).alias(order), refs.alias("refs"), *(F.array_join(F.transform(pairs(clean(F.col(c))), lambda p: p["__t"]), " ").alias(c) for c in texts))
    return out.withColumnRenamed("__island", "island")
