"""The thin ``opN_<name>`` queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, fingerprints, jaccard, language_id, language_model, mixing, periodic, prefix_trie, quality, substrings, topk, urls, warc
from corpusloom.llm.common import fold, scratch


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 5) == 0).alias("held_out")).withColumn("teaches", ~F.col("held_out"))
    out = quality.classify(docs, _read(spark, sf_dir, "labels"), "teaches", ["doc_id", "held_out", "teaches"])
    return out.select("doc_id", "held_out", "score", "predicted")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    return warc.read(warc.write(_read(spark, sf_dir, "pages"), folder), folder)


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(_read(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 7) == 2).alias("held_out")).withColumn("teaches", ~F.col("held_out"))
    return language_model.score(docs, "teaches", ["doc_id", "held_out"]).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = language_id.fit(docs.where("not held_out"))
    return language_id.predict(docs, model, batch_columns=[F.col("doc_id"), F.col("held_out")])


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_trie.build(_read(spark, sf_dir, "conversations"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", periodic.with_periods(F.col("doc_id"), F.col("text")).alias("text"))
    best = periodic.longest(F.col("runs"))
    found = periodic.find(docs).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(periodic.lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_fingerprint": op5_fingerprint,
    "op6_lm_score": op6_lm_score,
    "op7_mix_sources": op7_mix_sources,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_language_id": op9_language_id,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_exact_topk": op12_exact_topk,
    "op13_periodic_runs": op13_periodic_runs,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"



def _url_sql() -> str:
    """The rules and, for the rest, the two character models, their ratio and its threshold."""
    fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
    rules = sorted(URL_RULES, key=lambda r: (len(r[1]), r[1]), reverse=True)
    case = lambda k: "CASE " + " ".join(f"WHEN {fits.format(h=r.partition('/')[0], p=r.partition('/')[2])} THEN '{(v, r)[k]}'" for v, r in rules) + " END"
    chance = "1 / 256"
    columns = {"a": chance, "r": chance}
    for n in range(1, 6):
        for k in columns:
            columns[k] = f"CASE WHEN m{n}.all_{k} > 0 THEN (m{n}.{k} + m{n}.kinds_{k} * ({columns[k]})) / (m{n}.all_{k} + m{n}.kinds_{k}) ELSE {columns[k]} END"
    joins = " ".join(f"JOIN m AS m{n} ON m{n}.tail = right(c.gram, {n})" for n in range(1, 6))
    return f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
u AS (SELECT host, path, {case(1)} AS rule, {case(0)} AS verdict, ('0x' || substr(sha256(host || ' ' || path), 1, 8))::BIGINT % 5 = 0 AS kept FROM (SELECT DISTINCT host, path FROM q)),
g AS (SELECT host, path, verdict, kept, substr(repeat(chr(2), 4) || host || path || chr(3), i, 5) AS gram FROM (SELECT *, unnest(generate_series(1, length(host || path) + 1)) AS i FROM u)),
c AS (SELECT gram, count(*) FILTER (verdict = 'allow' AND NOT kept) AS a, count(*) FILTER (verdict = 'block' AND NOT kept) AS r FROM g GROUP BY gram),
t AS (SELECT right(gram, n) AS tail, sum(a) AS a, sum(r) AS r FROM c, (SELECT unnest(generate_series(1, 5)) AS n) GROUP BY 1),
x AS (SELECT left(tail, length(tail) - 1) AS context, length(tail) AS n, sum(a) AS all_a, count(*) FILTER (a > 0) AS kinds_a, sum(r) AS all_r, count(*) FILTER (r > 0) AS kinds_r FROM t GROUP BY 1, 2),
m AS (SELECT tail, a, r, all_a, kinds_a, all_r, kinds_r FROM t JOIN x ON context = left(tail, length(tail) - 1) AND n = length(tail)),
d AS (SELECT c.gram, round(1000000 * (ln({columns["a"]}) - ln({columns["r"]}))) AS ratio FROM c {joins}),
s AS (SELECT host, path, verdict, sum(ratio) / count(*) / 1000000 AS score FROM g JOIN d USING (gram) WHERE verdict IS NULL OR kept GROUP BY ALL),
h AS (SELECT least(greatest(floor(score * 100), -2000), 2000) AS cell, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r FROM s WHERE verdict IS NOT NULL GROUP BY 1),
e AS (SELECT cell, coalesce((lag(cell) OVER w + 1 + cell) / 2, cell) / 100 AS edge, (sum(a) OVER () - sum(a) OVER w + a) / sum(a) OVER () + (sum(r) OVER w - r) / sum(r) OVER () AS value FROM h WINDOW w AS (ORDER BY cell)),
b AS (SELECT coalesce((SELECT edge FROM e WHERE value IS NOT NULL AND NOT isnan(value) ORDER BY value DESC, abs(edge), cell LIMIT 1), 0) AS least)
SELECT page_id, q.host, q.path, rule, coalesce(u.verdict, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM q JOIN u ON q.host = u.host AND q.path = u.path LEFT JOIN s ON s.host = q.host AND s.path = q.path CROSS JOIN b"""


ORACLE_SQL: dict[str, str] = {
    "op4_url_filter": _url_sql(),
    "op7_mix_sources": """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source), r AS (SELECT source, sum(n) OVER () / count(*) OVER () / n AS rate FROM n),
k AS (SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT)) AS k FROM r),
c AS (SELECT source, list(cdf) AS cdf FROM (SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k) GROUP BY source),
d AS (SELECT documents.*, len(list_filter(cdf, lambda x: x <= ('0x' || substr(sha256('17:' || doc_id), 1, 13))::BIGINT / 4503599627370496)) AS times FROM documents JOIN c ON documents.source IS NOT DISTINCT FROM c.source)
SELECT * EXCLUDE (times), unnest(generate_series(0, times - 1))::INT AS copy FROM d WHERE times > 0""",
    "op3_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS chosen FROM pages)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(flatten([[substr({_DIGITS}, 1 + ((('0x' || substr(h, (5 * k + 1)::INT, 5))::BIGINT >> s) & 31)::INT, 1) for s in [15, 10, 5, 0]] for k in range(8)]), '') AS payload_digest,
  CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM p""",
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 9))) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, i, grams.n FROM grams JOIN windows USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, i, hash(array_to_string(w[i : i + 34], ' ')) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS k FROM starts) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM hits),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS k
  FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0) AS words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(b) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN reach ON a = doc_id GROUP BY doc_id""",
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN t ON t.conv_id = c.base WHERE i < h UNION ALL SELECT conv_id, 1, i, role, text FROM t JOIN c USING (conv_id) WHERE i >= h),
s AS (SELECT conv_id, row_number() OVER w AS depth, list(sha256(length(role) || ':' || role || text)) OVER w AS seq, length(text) AS chars FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, [], 0 FROM c),
n AS (SELECT depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved FROM s GROUP BY ALL),
k AS (SELECT n.*, p.conv_id AS parent_conv_id FROM n LEFT JOIN n AS p ON p.depth = n.depth - 1 AND p.seq = n.seq[1 : n.depth - 1]),
f AS (SELECT depth - 1 AS depth, seq[1 : depth - 1] AS seq, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
x AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN f ON f.depth = k.depth AND f.seq = k.seq),
u AS (SELECT s.depth, s.seq, sum(x.saved) AS saved_tokens, count(*) FILTER (x.n_children = 0) AS n_leaves FROM x JOIN s ON s.conv_id = x.conv_id AND s.depth <= x.depth GROUP BY ALL),
l AS (SELECT conv_id, max(depth) AS depth FROM s GROUP BY conv_id),
e AS (SELECT s.depth, s.seq, string_agg(s.conv_id, ',' ORDER BY s.conv_id) AS ids FROM s JOIN l USING (conv_id, depth) GROUP BY ALL)
SELECT x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, u.n_leaves, u.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM x JOIN u ON u.depth = x.depth AND u.seq = x.seq LEFT JOIN e ON e.depth = x.depth AND e.seq = x.seq""",
    "op12_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
}
