"""Reference grammar and order, dimensions, discovery checks and task state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.operators import align, dedup, discovery, extract, tasks
from corpusloom.sources.readers import table

ROOT = "https://example.org/bible"


def made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References made from orders, some of them malformed."""
    codes = F.array(*map(F.lit, [*refs.COLLECTIONS, "ZZZ"]))
    k = F.col("o_orderkey")
    code = F.element_at(codes, (k % 67 + 1).cast("int"))
    suffix = F.when(k % 11 == 0, "a").otherwise("")
    good = F.concat(code, F.lit("."), (k % 40 + 1).cast("string"), F.lit("."), (k % 90 + 1).cast("string"), suffix)
    ref = F.when(k % 13 == 1, F.concat(code, F.lit("."), (k % 40 + 1).cast("string"))).when(k % 13 == 2, F.lower(good)).when(k % 13 == 3, F.concat(good, F.lit("\n"))).otherwise(good)
    return table(spark, sf_dir, "orders").select(k.alias("k"), code.alias("code"), ref.alias("ref"))


def ref_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir).where(~refs.is_reference(F.col("ref"))).select("k", "ref")


def ref_lenient_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("ref")
    return made(spark, sf_dir).select("k", refs.book(r).alias("book"), refs.chapter(r).alias("chapter"), refs.verse(r).alias("verse"))


def ref_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("ref")
    rows = made(spark, sf_dir).where(refs.is_reference(r))
    return rows.select("k", refs.reference(refs.book(r), refs.chapter(r), refs.verse(r)).alias("again"), (refs.reference(refs.book(r), refs.chapter(r), refs.verse(r)) == r).alias("same"))


def usfm_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir).groupBy(refs.is_reference(F.col("ref")).alias("valid")).agg(F.count("*").alias("n"))


def canonical_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sort keys of each distinct reference."""
    r = F.col("ref")
    o = refs.canonical_order(r)
    return made(spark, sf_dir).where(refs.is_reference(r)).select("ref").distinct().select("ref", o[0].alias("ordinal"), o[1].alias("chapter"), o[2].alias("segment"), o[3].alias("suffix"))


def group_segment_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of each collection and group, in numeric order."""
    r = F.col("ref")
    v = refs.verse(r)
    rows = made(spark, sf_dir).where(refs.is_reference(r)).select(refs.book(r).alias("book"), refs.chapter(r).alias("chapter"), F.struct(refs.segment_number(v).alias("n"), refs.segment_suffix(v).alias("s"), v.alias("v")).alias("o")).distinct()
    return rows.groupBy("book", "chapter").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o")), lambda x: x["v"]), ",").alias("segments"))


def foreign_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir).select("k", F.col("ref").alias("usfm"), F.concat(F.col("code"), F.lit("."), (F.col("k") % 20 + 1).cast("string")).alias("group_usfm"))
    return extract.foreign_spans(rows).where("anomaly is not null").select("k", "anomaly")


def dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation: the nation dimension (25 rows) is broadcast, customers join as planned."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").where("n_nationkey <> 7").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("*").alias("n"))


def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name by version: the region's for one side, the nation's for the other."""
    nations = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).otherwise(F.col("n_name")).alias("name"))


def version_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), "n_nationkey")
    first = table(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    return refs.side(nations, f"  {first.lower()} ")


def chapter_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir).select("k", refs.chapter_url(ROOT, F.lit(111), F.col("code"), F.col("k") % 40 + 1, F.lit("XYZ")).alias("url"))


def _nation_books(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """Customers or suppliers by nation, as collections with groups."""
    key = {"customer": "c_nationkey", "supplier": "s_nationkey"}[side]
    rows = table(spark, sf_dir, side).where(F.col(key) % 6 != (0 if side == "customer" else 1))
    return discovery.group_counts(rows.select(F.col(key).alias("code")), ["code"])


def dim_missing_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.missing_and_extra(_nation_books(spark, sf_dir, "customer"), _nation_books(spark, sf_dir, "supplier"), "code")


def dim_count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    canon = _nation_books(spark, sf_dir, "supplier").withColumnRenamed("groups", "expected")
    return discovery.count_mismatches(_nation_books(spark, sf_dir, "customer"), canon, "code", "groups", "expected")


def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_books(spark, sf_dir, "customer").select("code").union(_nation_books(spark, sf_dir, "supplier").select("code")).distinct()


def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.assigned_differences(_nation_books(spark, sf_dir, "customer").select("code"), _nation_books(spark, sf_dir, "supplier").select("code"))


def discovery_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = _nation_books(spark, sf_dir, "customer").select("code", F.col("code").cast("string").alias("name"), F.lit("V").alias("version_code"), F.lit(1).alias("first"))
    return discovery.checks(books, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code")), "V")


FAULTS = ("none", "twice", "version", "group", "name", "empty")


def discovery_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks on collections with one fault put in at a time: each check fails for its own."""
    code = F.col("code")
    base = _nation_books(spark, sf_dir, "customer").select("code", code.cast("string").alias("name"), F.lit("V").alias("version_code"), F.lit(1).alias("first"))
    books = {
        "none": base, "twice": base.unionByName(base.where("code < 3")), "version": base.withColumn("version_code", F.when(code % 5 == 0, "W").otherwise("V")),
        "group": base.withColumn("first", F.when(code % 4 == 0, 0).otherwise(1)), "name": base.withColumn("name", F.when(code % 7 == 0, "").otherwise(F.col("name"))), "empty": base.where("false"),
    }
    canon = base.select("code").distinct()
    return reduce(DataFrame.unionByName, (discovery.checks(books[f], canon, "V").withColumn("fault", F.lit(f)) for f in FAULTS))


def discovery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.status(discovery_checks(spark, sf_dir))


def mapping_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    side = lambda s, name: _nation_books(spark, sf_dir, s).join(F.broadcast(nations), F.col("code") == F.col("n_nationkey")).select("code", F.col("n_name").alias("name"), "groups", F.when(F.col("code") % 3 != 0, name).alias("testament"))
    return discovery.merge_mapping({"a": side("customer", "old"), "b": side("supplier", "new")})


TASK = ["user_id", "event_type"]


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*TASK).distinct()


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(*TASK).agg(F.max("event_id").alias("last"))
    status = F.when(F.col("last") % 4 == 0, "verified").when(F.col("last") % 4 == 1, "extracted").when(F.col("last") % 4 == 2, "failed").otherwise("discovered")
    return e.where("last % 5 <> 0").select(*TASK, status.alias("status"), F.col("last").alias("attempts"))


def missing_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.missing(_tasks(spark, sf_dir), _state(spark, sf_dir), TASK)


def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _tasks(spark, sf_dir).where("user_id % 3 <> 0")
    return tasks.remaining(_tasks(spark, sf_dir), _state(spark, sf_dir), files, TASK)


def task_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("book_code"), (F.col("o_orderkey") % 50).cast("int").alias("chapter"))
    first = table(spark, sf_dir, "orders").agg(F.min("o_orderpriority")).first()[0]
    return tasks.filter_tasks(rows, first.lower(), 7)


def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.transitions(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type")


def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _tasks(spark, sf_dir).where("user_id % 2 = 0").select(*TASK, F.when(F.col("user_id") % 4 == 0, "fetching").alias("status"), F.lit(9).cast("bigint").alias("attempts"))
    return tasks.upsert_state(_state(spark, sf_dir), changes, TASK)


def state_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _tasks(spark, sf_dir).select(*TASK, F.lit("discovered").alias("status"), F.lit(0).cast("bigint").alias("attempts"))
    return tasks.seed_state(_state(spark, sf_dir), seeds, TASK)


def collect_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("value") > 50).cast("int").alias("verse_count"), F.when(F.max("event_id") % 2 == 0, "verified").otherwise("LANGUAGE_UNCERTAIN").alias("language_status"))
    return tasks.outcome(rows).select("user_id", "outcome")


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive numbers after the largest key, in order of the orders' price and key."""
    rows = table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    return dedup.numbered(rows, ["o_totalprice", "o_orderkey"], "id", rows.agg(F.max("o_orderkey").alias("m"))).select("o_orderkey", "id")


NAMES = """ref_parse_rejects ref_lenient_parse ref_format_roundtrip usfm_shape canonical_sort_rank group_segment_sort foreign_spans dim_lookup display_name version_lookup chapter_url dim_missing_extra dim_count_mismatch
key_union set_differences discovery_checks discovery_faults discovery_status mapping_merge missing_tasks resume_plan task_filter status_transitions state_upsert state_seed collect_outcome numbered_rows""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_CODES = ", ".join(f"'{c}'" for c in [*refs.COLLECTIONS, "ZZZ"])
_VALID = "regexp_full_match(ref, '[0-9A-Z]{3}\\.[0-9]+\\.[0-9]+[a-z]?')"
_MADE = f"""WITH m0 AS (SELECT o_orderkey AS k, ([{_CODES}])[(o_orderkey % 67 + 1)::INT] AS code FROM orders),
m1 AS (SELECT k, code, code || '.' || (k % 40 + 1) || '.' || (k % 90 + 1) || CASE WHEN k % 11 = 0 THEN 'a' ELSE '' END AS good FROM m0),
m AS (SELECT k, code, CASE k % 13 WHEN 1 THEN code || '.' || (k % 40 + 1) WHEN 2 THEN lower(good) WHEN 3 THEN good || chr(10) ELSE good END AS ref FROM m1),
v AS (SELECT k, code, ref, string_split(ref, '.')[1] AS book, string_split(ref, '.')[2]::INT AS chapter, string_split(ref, '.')[3] AS verse, regexp_extract(string_split(ref, '.')[3], '^[0-9]+')::INT AS n, regexp_extract(string_split(ref, '.')[3], '[a-z]*$') AS s FROM m WHERE {_VALID}) """
_C = "c AS (SELECT c_nationkey AS code, count(*) AS groups FROM customer WHERE c_nationkey % 6 <> 0 GROUP BY 1), s AS (SELECT s_nationkey AS code, count(*) AS groups FROM supplier WHERE s_nationkey % 6 <> 1 GROUP BY 1)"
_T = """WITH t AS (SELECT DISTINCT user_id, event_type FROM events), s AS (SELECT user_id, event_type, CASE last % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'extracted' WHEN 2 THEN 'failed' ELSE 'discovered' END AS status, last AS attempts
  FROM (SELECT user_id, event_type, max(event_id) AS last FROM events GROUP BY ALL) WHERE last % 5 <> 0) """
_CHECKS = f"""WITH {_C} SELECT 'books_non_empty' AS "check", count(*) > 0 AS ok FROM c UNION ALL SELECT 'codes_unique', true UNION ALL SELECT 'version_uniform', true UNION ALL SELECT 'expected_count', (SELECT count(*) FROM c) = (SELECT count(*) FROM nation)
UNION ALL SELECT 'groups_positive', true UNION ALL SELECT 'names_present', true UNION ALL SELECT 'canon_present', count(*) = 0 FROM nation WHERE n_nationkey NOT IN (SELECT code FROM c)"""
_FAULTS = """SELECT fault, code, CASE WHEN fault = 'name' AND code % 7 = 0 THEN '' ELSE code::VARCHAR END AS name, CASE WHEN fault = 'version' AND code % 5 = 0 THEN 'W' ELSE 'V' END AS version_code, CASE WHEN fault = 'group' AND code % 4 = 0 THEN 0 ELSE 1 END AS first
FROM c, (VALUES ('none'), ('twice'), ('version'), ('group'), ('name')) AS v(fault) UNION ALL SELECT 'twice', code, code::VARCHAR, 'V', 1 FROM c WHERE code < 3 UNION ALL SELECT 'empty', NULL, NULL, NULL, NULL"""
SQL = {
    "ref_parse_rejects": f"{_MADE} SELECT k, ref FROM m WHERE NOT {_VALID}",
    "ref_lenient_parse": f"{_MADE} SELECT k, coalesce(book, '') AS book, coalesce(chapter, 0) AS chapter, coalesce(verse, '0') AS verse FROM m LEFT JOIN (SELECT k, book, chapter, verse FROM v) USING (k)",
    "ref_format_roundtrip": f"{_MADE} SELECT k, ref AS again, true AS same FROM v",
    "usfm_shape": f"{_MADE} SELECT {_VALID} AS valid, count(*) AS n FROM m GROUP BY 1",
    "canonical_sort_rank": f"{_MADE} SELECT DISTINCT ref, CASE WHEN code = 'ZZZ' THEN 999 ELSE list_position([{_CODES}], code) - 1 END::INT AS ordinal, chapter, n AS segment, s AS suffix FROM v",
    "group_segment_sort": f"{_MADE} SELECT book, chapter, string_agg(verse, ',' ORDER BY n, s) AS segments FROM (SELECT DISTINCT book, chapter, verse, n, s FROM v) GROUP BY ALL",
    "foreign_spans": f"{_MADE} SELECT k, 'unexpected_usfm:' || ref AS anomaly FROM m WHERE NOT ({_VALID} AND starts_with(ref, code || '.' || (k % 20 + 1) || '.'))",
    "dim_lookup": "SELECT n_name, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey GROUP BY 1",
    "display_name": "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE n_name END AS name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "version_lookup": "SELECT n_name AS key, n_nationkey FROM nation WHERE n_name = (SELECT min(n_name) FROM nation)",
    "chapter_url": f"{_MADE} SELECT k, '{ROOT}/111/' || code || '.' || (k % 40 + 1) || '.XYZ' AS url FROM m",
    "dim_missing_extra": f"WITH {_C} SELECT code, 'missing' AS kind FROM s WHERE code NOT IN (SELECT code FROM c) UNION ALL SELECT code, 'extra' FROM c WHERE code NOT IN (SELECT code FROM s)",
    "dim_count_mismatch": f"WITH {_C} SELECT code, s.groups AS expected, c.groups AS groups FROM c JOIN s USING (code) WHERE c.groups <> s.groups",
    "key_union": f"WITH {_C} SELECT code FROM c UNION SELECT code FROM s",
    "set_differences": f"WITH {_C} SELECT code, 'left' AS only_in FROM (SELECT code FROM c EXCEPT SELECT code FROM s) UNION ALL SELECT code, 'right' FROM (SELECT code FROM s EXCEPT SELECT code FROM c)",
    "discovery_checks": _CHECKS,
    "discovery_faults": f"WITH {_C}, f AS ({_FAULTS}), g AS (SELECT fault, count(code) AS n, count(DISTINCT code) AS codes, count(*) FILTER (version_code <> 'V') AS other, count(*) FILTER (first < 1) AS low, count(*) FILTER (name = '') AS nameless FROM f GROUP BY fault), "
    """h AS (SELECT g.*, (SELECT count(*) FROM c) AS expected, (SELECT count(*) FROM c WHERE code NOT IN (SELECT code FROM f WHERE f.fault = g.fault AND code IS NOT NULL)) AS absent FROM g)
SELECT fault, 'books_non_empty' AS "check", n > 0 AS ok FROM h UNION ALL SELECT fault, 'codes_unique', n = codes FROM h UNION ALL SELECT fault, 'version_uniform', n > 0 AND other = 0 FROM h UNION ALL SELECT fault, 'expected_count', n = expected FROM h
UNION ALL SELECT fault, 'groups_positive', low = 0 FROM h UNION ALL SELECT fault, 'names_present', nameless = 0 FROM h UNION ALL SELECT fault, 'canon_present', absent = 0 FROM h""",
    "discovery_status": f"SELECT CASE WHEN bool_and(ok) THEN 'verified' ELSE 'UNCERTAIN' END AS status FROM ({_CHECKS})",
    "mapping_merge": f"""WITH {_C} SELECT code, CASE WHEN c.groups IS NOT NULL THEN n_name END AS a_name, c.groups AS a_groups, CASE WHEN s.groups IS NOT NULL THEN n_name END AS b_name, s.groups AS b_groups,
  CASE WHEN code % 3 <> 0 THEN CASE WHEN s.groups IS NOT NULL THEN 'new' ELSE 'old' END END AS testament FROM c FULL JOIN s USING (code) JOIN nation ON n_nationkey = code""",
    "missing_tasks": f"{_T} SELECT * FROM t ANTI JOIN s USING (user_id, event_type)",
    "resume_plan": f"{_T} SELECT * FROM t ANTI JOIN (SELECT * FROM s WHERE status IN ('extracted', 'verified') AND user_id % 3 <> 0) AS done USING (user_id, event_type)",
    "task_filter": "SELECT o_orderkey AS k, o_orderpriority AS book_code, (o_orderkey % 50)::INT AS chapter FROM orders WHERE o_orderpriority = (SELECT min(o_orderpriority) FROM orders) AND o_orderkey % 50 = 7",
    "status_transitions": "SELECT before, event_type AS after, count(*) AS n FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NOT NULL GROUP BY ALL",
    "state_upsert": f"{_T} SELECT user_id, event_type, coalesce(CASE WHEN user_id % 4 = 0 THEN 'fetching' END, status, 'discovered') AS status, CASE WHEN user_id % 2 = 0 THEN 9 ELSE attempts END AS attempts FROM t LEFT JOIN s USING (user_id, event_type) WHERE user_id % 2 = 0 OR status IS NOT NULL",
    "state_seed": f"{_T} SELECT user_id, event_type, coalesce(status, 'discovered') AS status, coalesce(attempts, 0) AS attempts FROM t LEFT JOIN s USING (user_id, event_type)",
    "collect_outcome": "SELECT user_id, CASE WHEN count(*) FILTER (value > 50) = 0 THEN 'failed' WHEN max(event_id) % 2 = 0 THEN 'verified' ELSE 'extracted' END AS outcome FROM events GROUP BY user_id",
    "numbered_rows": "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) + (SELECT max(o_orderkey) FROM orders) AS id FROM orders",
}
