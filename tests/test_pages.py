"""Queries over pages agree with their SQL where a page is cut within a character reference, or is full of stop words."""

from __future__ import annotations

import pytest

from corpusloom import queries as catalog
from corpusloom.operators import extract

duckdb = pytest.importorskip("duckdb")
PAGE = '<html lang="en"><head><title>{0}</title></head><body><article><h1>{0}</h1><p>{1}</p></article></body></html>'
PAGES = [
    PAGE.format("The&amp;&amp;&amp", "a&amp;b"), PAGE.format("a&lt", "c&amp d"), PAGE.format("&ampfoo; &amp;amp;", "&quot"), PAGE.format("x&am", "&amp;lt; &gt;"), PAGE.format("&# x", "&"),
    *(PAGE.format("t", "and the of " * 20) for _ in range(7)), PAGE.format("t", ""),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pages"))
    spark.createDataFrame(list(enumerate(PAGES)), "page_id bigint, html string").write.parquet(f"{out}/pages.parquet")
    return out


def agree(spark, folder, name):
    got = catalog.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
        wanted = c.sql(f"SELECT {', '.join(columns)} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("name", ["html_blocks", "html_implied_ends", "html_page_meta", "chapter_validation"])
def test_query(spark, folder, name):
    agree(spark, folder, name)


@pytest.mark.parametrize(("supplementary", "failing"), [(True, ["stop_word_ratio_out_of_range"]), (False, [])])
def test_the_ratio_of_stop_words_withholds_the_status(spark, supplementary, failing):
    url = "http://r/11/GEN.1.V"
    rows = spark.createDataFrame(
        [("Genesis 1 | V Bible", "Genesis 1", url, url, url, ["/versions/11"], "genesis", True, "GEN", 1, [{"reference": "GEN.1.1", "text": "and the of zub"}])],
        "title string, h1 string, url string, expected_url string, canonical string, version_links array<string>, mapping_name string, container_found boolean, book_code string, chapter int, verses array<struct<reference:string,text:string>>",
    )
    out = extract.validate(rows, "11", "V", "a", "http://r", supplementary).first()
    assert (out.failing, out.stop_word_ratio, out.status) == (failing, 0.75, "LANGUAGE_UNCERTAIN" if failing else "verified")
