"""Curation over documents as segments, their labels as review states and their sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WS, normalize_text
from corpusloom.operators import align, curate, trigrams
from corpusloom.plans import snapshots
from corpusloom.plans.storage import scratch
from corpusloom.schemas import PUBLIC_RIGHTS
from corpusloom.sources.readers import table


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as segments: their halves as the two texts; status by labels."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    half = F.floor(F.length("text") / 2).cast("int")
    status = F.when(F.col("quality").isNull(), "unreviewed").when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("corrected")
    return rows.select(F.col("doc_id").alias("id"), F.concat(F.col("lang"), F.lit("."), F.col("doc_id").cast("string")).alias("ref"), F.substring(F.col("text"), F.lit(1), half).alias("a_text"), F.substring(F.col("text"), half + 1, F.length("text")).alias("b_text"), F.col("source").alias("source_id"), F.lit("unassigned").alias("split"), status.alias("status"), F.lit("").alias("notes"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    rights = F.when(k % 3 == 0, "OPEN_LICENSE").when(k % 3 == 1, "PUBLIC_DOMAIN").otherwise("UNKNOWN")
    return table(spark, sf_dir, "documents").select("source").distinct().select(F.col("source").alias("source_id"), F.concat(F.lit("Source "), F.col("source")).alias("title"), rights.alias("rights_status"))


def segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.search(segments(spark, sf_dir), "  TH ", "approved", "src1").select("id", "ref", "status", "source_id")


def segment_wildcard_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.search(segments(spark, sf_dir), "en.1_").select("id", "ref")


def _with_backslashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).withColumns({c: F.translate(c, ".", "\\") for c in ("a_text", "b_text")})


def segment_search_backslash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with backslashes: letters like others in a search, also before a wildcard or at the end."""
    rows = _with_backslashes(spark, sf_dir)
    return reduce(DataFrame.unionByName, (curate.search(rows, q).select("id", F.lit(q).alias("q")) for q in ("n\\ T", "e\\_d", "t\\")))


PATTERNS = ["%these%", "%t_e%and%", "%of.%the%", "%ouç%", "%a\\n%", "en.1%", "%th_", "%ZZZZ%", "_n%", "%tion% %ment%"]


def trigram_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns with and without wildcards, by an index of the segments' trigrams."""
    rows = segments(spark, sf_dir)
    index = trigrams.build(rows, "id", ["a_text", "b_text", "ref"], f"{scratch(spark, 'trigrams')}/index")
    return reduce(DataFrame.unionByName, (trigrams.search(rows, index, "id", ["a_text", "b_text", "ref"], p).select("id", F.lit(p).alias("pattern")) for p in PATTERNS))


def page_by_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of ``segment_page``, and one far behind, by counts of id ranges."""
    rows = curate.search(segments(spark, sf_dir), status="approved")
    pages = [(offset, *curate.page_by_counts(rows, 30, offset, few=50, cells=8)) for offset in (20, 100)]
    return reduce(DataFrame.unionByName, (page.select("id", "ref", F.lit(offset).alias("offset"), F.lit(total).cast("bigint").alias("total")) for offset, page, total in pages))


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in a table of versions: after reviews, an import of new rows and a deletion, and as they were at first."""
    rows = segments(spark, sf_dir).select("id", "b_text", "status")
    held = snapshots.Snapshots(spark, scratch(spark, "segments"), ["id"], rows_a_file=5000)
    held.create(rows)
    held.update(rows.where("id % 7 = 0").withColumn("status", F.lit("approved")), {"status": lambda old, new: new})
    held.upsert(rows.where("id % 100 = 3").withColumn("b_text", F.concat(F.lit("changed "), "b_text")))
    held.insert_absent(rows.where("id % 2 = 0").withColumns({"id": F.when(F.col("id") % 4 == 0, -F.col("id") - 1).otherwise(F.col("id")), "status": F.lit("unreviewed")}))
    held.delete(rows.where("id % 50 = 11").select("id"))
    return held.read().withColumn("version", F.lit("last")).unionByName(held.read(1).withColumn("version", F.lit("first")))


def segment_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 20 to 50 of the approved segments, with the total: a page is what the service returns."""
    page, total = curate.page(curate.search(segments(spark, sf_dir), status="approved"), 30, 20)
    return page.select("id", "ref", F.lit(total).cast("bigint").alias("total"))


def segment_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.get(segments(spark, sf_dir), 42).select("id", "ref", "a_text", "b_text")


def segment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.stats(segments(spark, sf_dir), sources(spark, sf_dir))


def reviewed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.export_reviewed(segments(spark, sf_dir))


def source_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    had = sources(spark, sf_dir)
    new = had.where("rights_status = 'UNKNOWN'").select("source_id", F.lit("New title").alias("title"), F.lit("OPEN_LICENSE").alias("rights_status")).unionByName(spark.createDataFrame([("fresh", "Fresh", "UNKNOWN")], "source_id string, title string, rights_status string"))
    return curate.upsert_sources(had, new)


def source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).orderBy("source_id")


def registry_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows from a registry whose fields have aliases."""
    one = F.create_map(F.lit("id"), F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))), F.lit("title"), F.col("n_name"), F.lit("publisher"), F.lit("P"), F.lit("rights"), F.when(F.col("n_nationkey") % 2 == 0, "OPEN_LICENSE"), F.lit("url"), F.lit("http://x/"))
    raw = table(spark, sf_dir, "nation").agg(F.collect_list(one).alias("sources"))
    return curate.registry_rows(raw)


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import: every third segment again, and others with changed texts."""
    s = segments(spark, sf_dir)
    changed = F.when(F.col("id") % 3 == 0, F.col("b_text")).otherwise(F.concat(F.lit("new "), F.col("b_text")))
    return s.select("id", F.col("id").alias("line_no"), F.when(F.col("id") % 2 == 0, F.col("ref")).alias("ref"), "a_text", changed.alias("b_text")).drop("id")


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).withColumns({"a_text": normalize_text(F.col("a_text")), "b_text": normalize_text(F.col("b_text")), "source_id": F.lit("batch")})


def segment_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.import_batch(_existing(spark, sf_dir), _batch(spark, sf_dir), "batch", ["line_no"]).select("id", "ref", "a_text", "b_text", "status")


def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.import_counts(_batch(spark, sf_dir), segment_import(spark, sf_dir))


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews, good ones and such as must be refused: of unknown segments, with unknown values, with blank texts."""
    none, k = F.lit(None).cast("string"), F.col("id") % 100
    rows = segments(spark, sf_dir).where("id % 10 = 0")
    text = F.when(k == 30, " \t ").otherwise(F.concat(F.lit("  new   "), F.col("id").cast("string")))
    good = rows.select("id", text.alias("a_text"), none.alias("b_text"), F.when(k == 50, "dev").otherwise("train").alias("split"), F.when(k == 70, "maybe").when(F.col("id") % 20 == 0, "approved").alias("status"), F.lit(" seen ").alias("notes"))
    return good.unionByName(good.where("id % 100 = 0").withColumn("id", -F.col("id") - 1))


def review_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.review(segments(spark, sf_dir), _updates(spark, sf_dir))[0].select("id", "a_text", "split", "status", "notes")


def review_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.review(segments(spark, sf_dir), _updates(spark, sf_dir))[1].select("id", "reason")


def update_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id") % 5
    updates = segments(spark, sf_dir).select("id", F.when(k == 0, " \t ").otherwise("x").alias("a_text"), F.lit("y").alias("b_text"), F.when(k == 1, "dev").otherwise("train").alias("split"), F.when(k == 2, "maybe").otherwise("approved").alias("status"))
    return curate.check_updates(updates).select("id", "wrong")


def rights_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.releasable(segments(spark, sf_dir), sources(spark, sf_dir)).select("id", "source_id")


def translation_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.translation_directions(spark)


NAMES = """segment_search segment_wildcard_search segment_search_backslash trigram_search page_by_counts snapshot_changes segment_page segment_get segment_stats reviewed_export source_upsert source_list registry_sync segment_import import_counts review_update review_refusals update_validation rights_gate
translation_directions""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_SEG = """WITH seg AS (SELECT doc_id AS id, lang || '.' || doc_id AS ref, substr(text, 1, length(text) // 2) AS a_text, substr(text, length(text) // 2 + 1) AS b_text, source AS source_id, 'unassigned' AS split,
  CASE WHEN quality IS NULL THEN 'unreviewed' WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'approved' ELSE 'corrected' END AS status FROM documents LEFT JOIN labels USING (doc_id)),
src AS (SELECT DISTINCT source AS source_id, 'Source ' || source AS title, CASE regexp_extract(source, '[0-9]+$')::INT % 3 WHEN 0 THEN 'OPEN_LICENSE' WHEN 1 THEN 'PUBLIC_DOMAIN' ELSE 'UNKNOWN' END AS rights_status FROM documents)"""
_NORM = lambda c: f"trim(regexp_replace(replace(replace(nfc_normalize({c}), chr(160), ' '), chr(8203), ''), '{WS}+', ' ', 'g'), ' ')"
_IMPORT = f"""{_SEG}, had AS (SELECT {_NORM('a_text')} AS a_text, {_NORM('b_text')} AS b_text FROM seg),
batch AS (SELECT id AS line_no, CASE WHEN id % 2 = 0 THEN ref ELSE '' END AS ref, {_NORM('a_text')} AS a_text, {_NORM("CASE WHEN id % 3 = 0 THEN b_text ELSE 'new ' || b_text END")} AS b_text FROM seg),
good AS (SELECT * FROM batch WHERE a_text <> '' AND b_text <> ''),
fresh AS (SELECT * FROM (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY a_text, b_text ORDER BY line_no) = 1) ANTI JOIN had USING (a_text, b_text)) """
_PATTERNS = ", ".join(f"('{p}')" for p in PATTERNS)
SQL = {
    "segment_search_backslash": f"{_SEG} SELECT id, q FROM seg, (VALUES ('n\\ T'), ('e\\_d'), ('t\\')) AS p(q) WHERE translate(a_text, '.', chr(92)) ILIKE '%' || q || '%' OR translate(b_text, '.', chr(92)) ILIKE '%' || q || '%' OR ref ILIKE '%' || q || '%'",
    "trigram_search": f"{_SEG} SELECT id, pattern FROM seg, (VALUES {_PATTERNS}) AS p(pattern) WHERE a_text ILIKE pattern OR b_text ILIKE pattern OR ref ILIKE pattern",
    "page_by_counts": f"""{_SEG}, a AS (SELECT id, ref, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS total FROM seg WHERE status = 'approved')
SELECT id, ref, "offset"::INT AS "offset", total FROM a, (VALUES (20), (100)) AS p("offset") WHERE i >= "offset" AND i < "offset" + 30""",
    "snapshot_changes": f"""{_SEG}, v1 AS (SELECT id, b_text, status FROM seg), v2 AS (SELECT id, CASE WHEN id % 100 = 3 THEN 'changed ' || b_text ELSE b_text END AS b_text, CASE WHEN id % 7 = 0 AND id % 100 <> 3 THEN 'approved' ELSE status END AS status FROM v1)
SELECT *, 'first' AS version FROM v1 UNION ALL SELECT *, 'last' FROM v2 WHERE id % 50 <> 11 UNION ALL SELECT -id - 1, b_text, 'unreviewed', 'last' FROM v1 WHERE id % 4 = 0""",
    "segment_search": f"{_SEG} SELECT id, ref, status, source_id FROM seg WHERE (a_text ILIKE '%TH%' OR b_text ILIKE '%TH%' OR ref ILIKE '%TH%') AND status = 'approved' AND source_id = 'src1'",
    "segment_wildcard_search": f"{_SEG} SELECT id, ref FROM seg WHERE a_text ILIKE '%en.1_%' OR b_text ILIKE '%en.1_%' OR ref ILIKE '%en.1_%'",
    "segment_page": f"{_SEG} SELECT id, ref, (SELECT count(*) FROM seg WHERE status = 'approved') AS total FROM seg WHERE status = 'approved' ORDER BY id LIMIT 30 OFFSET 20",
    "segment_get": f"{_SEG} SELECT id, ref, a_text, b_text FROM seg WHERE id = 42",
    "segment_stats": f"{_SEG} SELECT count(*) AS total, count(*) FILTER (status IN ('approved', 'corrected')) AS reviewed, count(*) FILTER (status = 'unreviewed') AS pending, count(*) FILTER (status = 'rejected') AS rejected, (SELECT count(*) FROM src) AS sources FROM seg",
    "reviewed_export": f"{_SEG} SELECT id, ref, a_text, b_text, source_id, status FROM seg WHERE status IN ('approved', 'corrected')",
    "source_upsert": f"{_SEG} SELECT source_id, CASE WHEN rights_status = 'UNKNOWN' THEN 'New title' ELSE title END AS title, CASE WHEN rights_status = 'UNKNOWN' THEN 'OPEN_LICENSE' ELSE rights_status END AS rights_status FROM src UNION ALL SELECT 'fresh', 'Fresh', 'UNKNOWN'",
    "source_list": f"{_SEG} SELECT * FROM src",
    "registry_sync": "SELECT 'n' || n_nationkey AS source_id, n_name AS title, 'P' AS provider, '' AS license, CASE WHEN n_nationkey % 2 = 0 THEN 'OPEN_LICENSE' ELSE 'UNKNOWN' END AS rights_status, 'http://x/' AS canonical_url, '' AS notes FROM nation WHERE n_nationkey % 5 <> 0",
    "segment_import": f"{_IMPORT} SELECT row_number() OVER (ORDER BY line_no) + (SELECT max(id) FROM seg) AS id, ref, a_text, b_text, 'unreviewed' AS status FROM fresh",
    "import_counts": f"{_IMPORT} SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM good) - (SELECT count(*) FROM fresh) AS duplicates",
    "review_update": f"""{_SEG}, r AS (SELECT *, id % 10 = 0 AND id % 100 NOT IN (30, 50, 70) AS good FROM seg)
SELECT id, CASE WHEN good THEN 'new ' || id ELSE a_text END AS a_text, CASE WHEN good THEN 'train' ELSE split END AS split, CASE WHEN good AND id % 20 = 0 THEN 'approved' ELSE status END AS status, CASE WHEN good THEN 'seen' ELSE '' END AS notes FROM r""",
    "review_refusals": f"{_SEG} SELECT id, CASE id % 100 WHEN 30 THEN 'a_text' WHEN 50 THEN 'split' ELSE 'status' END AS reason FROM seg WHERE id % 100 IN (30, 50, 70) UNION ALL SELECT -id - 1, 'unknown' FROM seg WHERE id % 100 = 0",
    "update_validation": f"{_SEG} SELECT id, CASE id % 5 WHEN 0 THEN 'a_text' WHEN 1 THEN 'split' WHEN 2 THEN 'status' END AS wrong FROM seg",
    "rights_gate": f"{_SEG} SELECT id, source_id FROM seg JOIN src USING (source_id) WHERE rights_status IN ({', '.join(f"'{r}'" for r in PUBLIC_RIGHTS)})",
    "translation_directions": "SELECT * FROM (VALUES ('a-b', 'a', 'b'), ('b-a', 'b', 'a')) AS t(direction, source, target)",
}
