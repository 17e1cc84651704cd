"""Text functions, deduplication and stop words over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import dedup, sequence
from corpusloom.sources.readers import table


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _text_query(function):  # noqa: ANN001, ANN202
    return lambda spark, sf_dir: docs(spark, sf_dir).select("doc_id", function(F.col("text")).alias("text"))


def _spaced() -> F.Column:
    """The text with spaces, a no-break space, a zero-width space, tabs and a decomposed accent put in."""
    return F.concat(F.lit(f" \t{tx.NBSP}"), F.regexp_replace("text", "e ", f"e{chr(0x301)}{tx.ZWSP}  \t"), F.lit(f"{chr(0x2003)}\n "))


def text_whitespace_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.squeeze(_spaced()).alias("text"))


def text_nfc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.normalize_text(_spaced()).alias("text"))


def text_line_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.normalize_line(_spaced()).alias("text"))


def strip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a text stripped of white space."""
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split(_spaced(), "\n", -1)).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", tx.strip(F.col("line")).alias("line"))


def normalize_line_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.array_join(tx.normalize_lines(F.split(_spaced(), "\n", -1)), "|").alias("lines"))


def pair_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each (text, source), and how many there were."""
    rows = docs(spark, sf_dir)
    counts = rows.groupBy("text", "source").agg(F.count("*").alias("n"))
    return dedup.keep_first(rows, ["text", "source"], [F.col("doc_id")]).join(counts, ["text", "source"]).select("doc_id", "source", "n")


def duplicate_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.equal_contents(docs(spark, sf_dir).select("doc_id", "text"), F.col("text"), [F.col("doc_id")], "doc_id")


def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.sha256(F.when(F.col("doc_id") % 7 != 0, F.col("text"))).alias("hash"))


def stopword_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop words and words of each document: the ratio's two numbers."""
    return docs(spark, sf_dir).select("doc_id", tx.stop_word_count(F.col("text")).cast("bigint").alias("stop_words"), F.size(tx.words(F.col("text"))).cast("bigint").alias("words"))


def token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(tx.tokens(F.col("text"))), " ").alias("tokens"))


def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a document as parts, every third one behind a note."""
    parts = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("text"), (i % 3 == 2).alias("note_before")))
    return docs(spark, sf_dir).select("doc_id", tx.merge_parts(parts).alias("text"))


def group_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source and thousand as spans of one reference."""
    parts = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("text"), (i == 1).alias("note_before")))
    label = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("doc_id").cast("string"))
    spans = docs(spark, sf_dir).select("source", F.floor(F.col("doc_id") / 100).alias("block"), "doc_id", label.alias("label"), parts.alias("parts"))
    return sequence.group_parts(spans, ["source", "block"], "doc_id").select("source", "block", "label", "span_count", "text")


def html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.unescape(F.concat(F.lit("&lt;&amp;&nbsp;&eacute;"), F.col("text"))).alias("text"))


def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios of two small numbers, rounded as thresholds see them."""
    return spark.range(1, 200).select(F.col("id").alias("k"), tx.round4(F.col("id") / 256).alias("rounded"))


def label_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("a]"))).when(F.col("doc_id") % 3 == 1, "none").otherwise(F.col("doc_id").cast("string"))
    rows = docs(spark, sf_dir).select("doc_id", label.alias("label"))
    return rows.select("doc_id", tx.is_bracketed(F.col("label")).alias("bracketed"), tx.digits(F.col("label")).alias("number"))


NAMES = """text_whitespace_normalize text_nfc_normalize text_line_normalize strip_lines normalize_line_array pair_dedup duplicate_content_hash text_hash stopword_ratio token_sets merge_parts group_parts
html_unescape rounding label_checks""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_WS = tx.WS
_SPACED = "' ' || chr(9) || chr(160) || regexp_replace(text, 'e ', 'e' || chr(769) || chr(8203) || '  ' || chr(9), 'g') || chr(8195) || chr(10) || ' '"
_STOP = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+\\z', '')"


_PLAIN = "replace(replace({}, chr(160), ' '), chr(8203), '')"
_PART = """CASE WHEN x.t = '' THEN acc WHEN acc.t = '' THEN x WHEN x.note OR regexp_matches(right(acc.t, 1), '{ws}') OR regexp_matches(left(x.t, 1), '{ws}') THEN {{'t': acc.t || x.t, 'note': false}} ELSE {{'t': acc.t || ' ' || x.t, 'note': false}} END""".format(ws=_WS)
SQL = {
    "text_whitespace_normalize": f"SELECT doc_id, trim(regexp_replace({_SPACED}, '{_WS}+', ' ', 'g'), ' ') AS text FROM documents",
    "text_nfc_normalize": f"SELECT doc_id, trim(regexp_replace({_PLAIN.format(f'nfc_normalize({_SPACED})')}, '{_WS}+', ' ', 'g'), ' ') AS text FROM documents",
    "text_line_normalize": f"SELECT doc_id, {_strip(f'''regexp_replace({_PLAIN.format(f'nfc_normalize({_SPACED})')}, '[ \\t\\r\\f\\x0B]+', ' ', 'g')''')} AS text FROM documents",
    "strip_lines": f"SELECT doc_id, (i - 1)::INT AS line_no, {_strip('ls[i]')} AS line FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split({_SPACED}, chr(10)) AS ls FROM documents))",
    "normalize_line_array": "SELECT doc_id, array_to_string(list_transform(string_split(" + _SPACED + ", chr(10)), lambda x: " + _strip(f"regexp_replace({_PLAIN.format('nfc_normalize(x)')}, '[ \\t\\r\\f\\x0B]+', ' ', 'g')") + "), '|') AS lines FROM documents",
    "pair_dedup": "SELECT min(doc_id) AS doc_id, source, count(*) AS n FROM documents GROUP BY text, source",
    "duplicate_content_hash": "SELECT sha256(text) AS content_hash, first AS first_seen, doc_id AS repeated FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM documents) WHERE doc_id <> first",
    "text_hash": "SELECT doc_id, sha256(CASE WHEN doc_id % 7 <> 0 THEN text ELSE '' END) AS hash FROM documents",
    "stopword_ratio": f"SELECT doc_id, len(list_filter(w, lambda x: trim(lower(x), '{tx.TOKEN_PUNCTUATION.replace(chr(39), chr(39) * 2)}') IN ({_STOP}))) AS stop_words, len(w) AS words FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '{_WS}+'), lambda x: x <> '') AS w FROM documents)",
    "token_sets": "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-zA-Z'']+'))), ' ') AS tokens FROM documents",
    "merge_parts": f"""SELECT doc_id, list_reduce(list_prepend({{'t': '', 'note': false}}, list_transform(string_split(text, chr(10)), lambda s, i: {{'t': s, 'note': (i - 1) % 3 = 2}})), lambda acc, x: {_PART}).t AS text FROM documents""",
    "group_parts": f"""SELECT source, block, min(CASE WHEN doc_id = first THEN label END) AS label, count(*) AS span_count,
  list_reduce(list_prepend({{'t': '', 'note': false}}, flatten(list(parts ORDER BY doc_id))), lambda acc, x: {_PART}).t AS text
FROM (SELECT *, min(doc_id) FILTER (label IS NOT NULL) OVER (PARTITION BY source, block) AS first FROM (SELECT source, doc_id // 100 AS block, doc_id, CASE WHEN doc_id % 2 <> 0 THEN doc_id::VARCHAR END AS label,
  list_transform(string_split(text, chr(10)), lambda s, i: {{'t': s, 'note': i = 2}}) AS parts FROM documents)) GROUP BY source, block""",
    "html_unescape": "SELECT doc_id, '<& é' || replace(replace(text, chr(65533), chr(39)), chr(160), ' ') AS text FROM documents",
    "rounding": "SELECT k, round_even(k / 256, 4) AS rounded FROM (SELECT unnest(generate_series(1, 199))::BIGINT AS k)",
    "label_checks": "SELECT doc_id, doc_id % 3 = 0 AS bracketed, CASE WHEN doc_id % 3 = 1 THEN 0 ELSE doc_id END::INT AS number FROM documents",
}
