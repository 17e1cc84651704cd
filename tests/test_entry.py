"""The registered queries agree with their SQL on the smallest tables."""

from __future__ import annotations

import glob
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from corpusloom import queries as catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() == 7


def test_every_query_but_rows_only_ones_has_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"file_checksums"}
    assert set(catalog.SQL) <= set(catalog.QUERIES)


def plain(v):
    """Integers that pandas made floats because of nulls, as integers again; missing values as None."""
    if isinstance(v, float):
        return None if v != v else int(v) if v.is_integer() else v
    return v


def rows(frame):
    columns = sorted(frame.columns)
    return sorted(repr([plain(v) for v in r]) for r in frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.SQL:
        assert rows(got) == rows(duck.sql(catalog.SQL[name]).df())


def test_the_rest_works_without_the_optional_folders(tmp_path):
    root = Path(entry.__file__).parent
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", ".hypothesis"))
    said = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalog.QUERIES), sorted(e.oracle_sql()) == sorted(e.catalog.SQL))"
    for gone in ([], ["corpus_pipeline.py"]):
        for name in gone:
            (tmp_path / "copy" / name).unlink()
        out = subprocess.run([sys.executable, "-c", said], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
        assert out.stdout.split() == ["True", "True"]


def test_file_checksums(spark):
    import hashlib

    out = {r.file: r.sha256 for r in catalog.QUERIES["file_checksums"](spark, SF).collect()}
    assert out == {os.path.basename(f): hashlib.sha256(Path(f).read_bytes()).hexdigest() for f in glob.glob(f"{SF}/*.parquet")}
