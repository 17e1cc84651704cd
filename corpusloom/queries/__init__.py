"""Every operator as a query over the driver's tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.queries import alignment, curation, files, pages, pairs, references, texts

MODULES = (alignment, texts, pairs, references, curation, pages, files)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.SQL.items()}
