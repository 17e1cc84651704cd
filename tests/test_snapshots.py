"""Tables that several writers change: nothing is lost, only touched files are rewritten, old versions stay."""

from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import snapshots
from corpusloom.plans.snapshots import Conflict, Snapshots

SCHEMA = "id int, text string, n int"


@pytest.fixture
def table(spark, tmp_path):
    out = Snapshots(spark, f"file://{tmp_path}/a table", ["id"], rows_a_file=100)
    out.create(spark.createDataFrame([(i, f"t{i}", 0) for i in range(1000)], SCHEMA))
    return out


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def content(frame):
    return {r.id: (r.text, r.n) for r in frame.collect()}


def test_changes_and_old_versions(spark, table):
    state = content(table.read())
    states = {1: dict(state)}
    r = random.Random(1)
    for _ in range(6):
        kind, keys = r.choice(["upsert", "insert", "update", "delete"]), r.sample(range(1100), r.choice([1, 5, 40]))
        batch = rows(spark, *((k, f"new{k}", r.randint(1, 9)) for k in keys))
        if kind == "upsert":
            v = table.upsert(batch)
            state |= content(batch)
        elif kind == "insert":
            v = table.insert_absent(batch)
            state = content(batch) | state
        elif kind == "update":
            v = table.update(batch, {"n": lambda old, new: old + new})
            new = content(batch)
            state = {k: (t, n + (new[k][1] if k in new else 0)) for k, (t, n) in state.items()}
        else:
            v = table.delete(batch.select("id"))
            state = {k: x for k, x in state.items() if k not in keys}
        states[v] = dict(state)
    assert table.versions() == list(range(1, 8))
    for v, wanted in states.items():
        assert content(table.read(v)) == wanted
    assert table.read().count() == len(state)


def test_only_touched_files_are_rewritten(spark, table):
    before = {f["file"] for f in table.manifest()["files"]}
    assert len(before) == 10
    table.upsert(rows(spark, (5, "x", 1), (7, "y", 1), (5000, "z", 1)))
    after = {f["file"] for f in table.manifest()["files"]}
    assert len(before - after) == 1 and len(before & after) == 9


def test_interleaved_changes_of_the_same_rows(spark, table):
    """Both start from one version: the second is refused and, made anew, sees the first."""
    plus = lambda old, new: old.join(new.select("id", F.col("n").alias("more")), "id").withColumn("n", F.col("n") + F.col("more")).drop("more").unionByName(old.join(new, "id", "left_anti"))
    one, two = table.prepare(rows(spark, (3, "", 10)), plus), table.prepare(rows(spark, (3, "", 1)), plus)
    assert table.commit(one) == 2
    with pytest.raises(Conflict):
        table.commit(two)
    table.commit(table.prepare(rows(spark, (3, "", 1)), plus))
    assert content(table.read())[3] == ("t3", 11)


def test_interleaved_changes_of_other_rows(spark, table):
    """Changes of other files are committed behind each other; a key that is new to both is a conflict."""
    upsert = lambda old, new: old.join(new, "id", "left_anti").unionByName(new)
    one, two = table.prepare(rows(spark, (3, "one", 1)), upsert), table.prepare(rows(spark, (903, "two", 1)), upsert)
    assert (table.commit(two), table.commit(one)) == (2, 3)
    assert content(table.read())[3] == ("one", 1) and content(table.read())[903] == ("two", 1)
    three, four = table.prepare(rows(spark, (2000, "three", 1)), upsert), table.prepare(rows(spark, (2000, "four", 1)), upsert)
    table.commit(three)
    with pytest.raises(Conflict):
        table.commit(four)
    assert table.read().count() == 1001


def test_writers_at_the_same_time(spark, table):
    """Each of four writers adds to rows that all of them change: no addition is lost."""
    failed = []

    def add(k):
        try:
            for j in range(2):
                table.update(rows(spark, (1, "", 1), (100 * k, "", 1), (500 + j, "", 1)), {"n": lambda old, new: old + new})
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=add, args=(k,)) for k in range(2, 5)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    now = content(table.read())
    assert not failed and now[1][1] == 6 and [now[100 * k][1] for k in range(2, 5)] == [2, 2, 2] and now[500][1] == 3
    assert table.versions() == list(range(1, 8))


def test_many_keys_two_columns_and_wrong_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "FEW", 2)
    t = Snapshots(spark, str(tmp_path / "two"), ["a", "b"])
    with pytest.raises(LookupError):
        t.read()
    t.create(spark.createDataFrame([("x", 1, 1.5), ("x", 2, 2.5)], "a string, b int, c double"))
    t.upsert(spark.createDataFrame([("x", 2, 9.5), ("y", 1, 0.5)], "a string, b int, c double"))
    assert sorted(map(tuple, t.read().collect())) == [("x", 1, 1.5), ("x", 2, 9.5), ("y", 1, 0.5)]
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("x", 2, 9.5), ("x", 2, 0.5)], "a string, b int, c double"))
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("x", None, 9.5)], "a string, b int, c double"))
    with pytest.raises(Conflict):
        t.create(t.read())
    assert t.delete(t.read().select("a", "b")) == 3 and t.read().count() == 0
    assert t.vacuum() == 2 and t.versions() == [3]
