"""Training sets, lexicon and sequence operators over conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import refs
from corpusloom.functions import text as tx
from corpusloom.operators import align, extract, sequence, training
from corpusloom.sources.readers import table

SYSTEM = "You translate between two languages."
FORWARD = ["Translate this:", "In the other language:", "What does this mean?"]
BACKWARD = ["Translate back:", "In the first language:", "Say this:"]


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns beside the assistant turns that follow them."""
    t = turns(spark, sf_dir)
    a = t.where("role = 'user'").select("conv_id", "turn", "text")
    b = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), "text")
    return align.join_sides(a, b, ["conv_id", "turn"])


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id``, ``conv_id``, ``a``, ``b``, ``split``: pairs with text on both sides."""
    rows = joined(spark, sf_dir).where("has_a and has_b").where(training.both_sides(F.col("a_text"), F.col("b_text")))
    code = F.col("conv_id").cast("string")
    return rows.select(F.concat_ws(".", code, F.col("turn").cast("string")).alias("id"), "conv_id", "turn", F.col("a_text").alias("a"), F.col("b_text").alias("b"), refs.split_label(code).alias("split"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark, sf_dir).select("conv_id", "turn", "has_a", "has_b", "a_text", "b_text")


def length_ratio_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).where(training.length_ratio_ok(F.col("a"), F.col("b"))).select("id", "a", "b")


def ml_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.ml(pairs(spark, sf_dir), F.col("id"), "a", "b")


def rag_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.retrieval_documents(pairs(spark, sf_dir), "id", ("User", "Assistant"))


def _flat(rows: DataFrame) -> DataFrame:
    m = F.col("messages")
    return rows.select("id", "split", "kind", m[0]["content"].alias("system"), m[1]["content"].alias("user"), m[2]["content"].alias("assistant"), F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"))


def sft_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(training.sft_examples(pairs(spark, sf_dir), SYSTEM, FORWARD, BACKWARD))


def sft_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a further text of side b for a sample, and a second one of side a."""
    rows = pairs(spark, sf_dir).withColumns({"extra": F.concat(F.lit("Again: "), F.col("b")), "second": F.when(F.col("turn") % 4 == 0, F.lower("a")).otherwise("")})
    return _flat(training.sft_examples(rows, SYSTEM, FORWARD, BACKWARD, extra="extra", second="second"))


def hash_shuffle_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.shuffled(pairs(spark, sf_dir), F.col("id"), "48").select("id", "shuffle_key")


def sft_record_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat records, some of them broken, with what is wrong."""
    rows = training.sft_examples(pairs(spark, sf_dir), SYSTEM, FORWARD, BACKWARD).where("kind = 'forward'").select("id", F.pmod(F.col("id").substr(1, 1).cast("int"), F.lit(5)).alias("k"), "messages")
    whole = F.to_json(F.struct("messages"))
    line = F.when(F.col("k") == 1, F.to_json(F.struct(F.slice("messages", 1, 2).alias("messages")))).when(F.col("k") == 2, F.lit("{broken")).when(F.col("k") == 3, F.regexp_replace(whole, '"role":"user",', "")).otherwise(whole)
    return training.record_errors(rows.select("id", line.alias("value"))).select("id", "error")


def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return training.document_frequency(p, "a").withColumn("side", F.lit("a")).unionByName(training.document_frequency(p, "b").withColumn("side", F.lit("b")))


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.cooccurrence(pairs(spark, sf_dir), "id")


def lexicon_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.lexicon(cooccurrence(spark, sf_dir)).select("x", "y", "n", "cx", "cy")


def lexicon_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty lines of the lexicon's file: a top list is what it is."""
    return training.lexicon(cooccurrence(spark, sf_dir)).orderBy(F.desc("dice"), "x").limit(50).select("x", "y", "n", "cx", "cy")


def lexicon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.lexicon_rows(training.lexicon(cooccurrence(spark, sf_dir)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lines: a reference, the text, and range markers on every third turn."""
    marked = F.when(F.col("turn") % 3 == 2, sequence.RANGE).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", F.when(F.col("turn") == 4, "").otherwise(F.concat(F.lit("BK"), F.col("conv_id").cast("string"), F.lit(" 1:"), (F.col("turn") + 1).cast("string"))).alias("ref"), marked.alias("t"), F.col("role").alias("w"))


def range_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequence.merge_ranges(_lines(spark, sf_dir).where("ref <> ''"), ["conv_id"], "turn", "ref", ["t", "w"], ["t", "w"])
    return out.select("conv_id", "turn", F.array_join("refs", ",").alias("refs"), "t", "w")


def group_label_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequence.merge_ranges(_lines(spark, sf_dir).where("ref <> ''"), ["conv_id"], "turn", "ref", ["t"], ["t"])
    label = sequence.range_label(F.col("refs"))
    return out.select("conv_id", "turn", label.alias("label"), F.split(label, " ")[0].alias("book"))


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user text up to each turn, and a number that goes up as roles change."""
    filled = sequence.forward_fill(turns(spark, sf_dir), ["conv_id"], ["turn"], {"heard": F.when(F.col("role") == "user", F.col("text"))})
    return sequence.change_index(filled, ["conv_id"], ["turn"], F.col("role"), "change").select("conv_id", "turn", "heard", F.col("change").cast("bigint").alias("change"))


def forward_fill_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth turn is an outer header, other even ones are inner headers."""
    t = turns(spark, sf_dir)
    outer, inner = F.when(F.col("turn") % 4 == 0, F.col("turn")), F.when(F.col("turn") % 4 == 2, F.col("turn"))
    return sequence.fill_within(t, ["conv_id"], ["turn"], outer, inner).select("conv_id", "turn", "outer", "inner")


def fragment_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).groupBy("conv_id", "role").agg(sequence.ordered_concat(F.col("text"), "turn").alias("text"))


def note_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.note_boundaries(turns(spark, sf_dir), ["conv_id"], "turn", F.col("turn") % 3 == 1).select("conv_id", "turn", "note_before")


def merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation folded into one text."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: F.struct(s["text"].alias("text"), (s["turn"] % 3 == 2).alias("note_before")))
    return turns(spark, sf_dir).groupBy("conv_id").agg(parts.alias("parts")).select("conv_id", tx.merge_parts(F.col("parts")).alias("text"))


def vref_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir)
    ref = F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return sequence.reference_fill(t.select("conv_id", "turn", ref.alias("ref")), t.where("role = 'user'").select(ref.alias("ref"), "text")).select("conv_id", "turn", "ref", "text")


def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turns as lines, with second and third turns of other lengths beside them."""
    part = lambda n: turns(spark, sf_dir).where(F.col("turn") == n).select(F.col("conv_id").alias("line_no"), "text")
    return sequence.zip_lines(part(0).withColumnRenamed("text", "base"), {"second": part(1), "third": part(2)})


def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = turns(spark, sf_dir).select(F.explode(F.split("text", "\n", -1)).alias("text"))
    return sequence.count_lines(lines)


def chapter_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).withColumn("text", F.when(F.length("text") % 5 == 0, "").otherwise(F.col("text")))
    return extract.coverage(rows, ["conv_id"]).drop("coverage")


def group_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of each conversation's references and ASCII letters."""
    rows = turns(spark, sf_dir).select("conv_id", "turn", F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("reference"), F.regexp_replace("text", "[^a-zA-Z ]", "").alias("text"))
    return extract.content_hash(rows, ["conv_id"], ["turn"])


NAMES = """turn_pairs length_ratio_filter ml_pairs rag_docs sft_examples sft_sampled hash_shuffle_rank sft_record_check doc_frequency cooccurrence lexicon_dice lexicon_top lexicon_rows range_merge group_label_merge forward_fill
forward_fill_headers fragment_concat note_boundary merge_fold vref_fill positional_zip line_count chapter_coverage group_content_hash""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_WS = tx.WS
_LIST = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
_FRACTION = "(('0x' || substr(sha256('{salt}' || id), 1, 8))::BIGINT % 1000)"


def _pick(xs: list[str], salt: str) -> str:
    return f"({_LIST(xs)})[({_FRACTION.format(salt=salt)} % {len(xs)} + 1)::INT]"


def _example(kind: str, xs: list[str], source: str, target: str, where: str = "true") -> str:
    return f"SELECT id, split, '{kind}' AS kind, '{SYSTEM}' AS system, {_pick(xs, kind)} || chr(10) || chr(10) || {source} AS \"user\", {target} AS assistant, 'system,user,assistant' AS roles FROM p2 WHERE {where}"


_BASE = """j AS (SELECT coalesce(u.conv_id, s.conv_id) AS conv_id, coalesce(u.turn, s.turn - 1) AS turn, u.conv_id IS NOT NULL AS has_a, s.conv_id IS NOT NULL AS has_b, u.text AS a_text, s.text AS b_text
  FROM (SELECT * FROM conversations WHERE role = 'user') AS u FULL JOIN (SELECT * FROM conversations WHERE role = 'assistant') AS s ON u.conv_id = s.conv_id AND s.turn - 1 = u.turn),
p AS (SELECT conv_id || '.' || turn AS id, conv_id, turn, a_text AS a, b_text AS b, ('0x' || substr(sha256(conv_id::VARCHAR), 1, 8))::BIGINT % 10 AS bucket FROM j WHERE has_a AND has_b AND a_text <> '' AND b_text <> ''),
p2 AS (SELECT *, CASE WHEN bucket < 8 THEN 'train' WHEN bucket = 8 THEN 'validation' ELSE 'test' END AS split, 'Again: ' || b AS extra, CASE WHEN turn % 4 = 0 THEN lower(a) ELSE '' END AS second FROM p),
ta AS (SELECT id, unnest(list_distinct(regexp_extract_all(lower(a), '[a-zA-Z'']+'))) AS x FROM p), tb AS (SELECT id, unnest(list_distinct(regexp_extract_all(lower(b), '[a-zA-Z'']+'))) AS y FROM p),
ca AS (SELECT x, count(*) AS cx FROM ta GROUP BY x), cb AS (SELECT y, count(*) AS cy FROM tb GROUP BY y),
co AS (SELECT x, y, count(*) AS n FROM ta JOIN tb USING (id) GROUP BY ALL HAVING count(*) >= 8), co2 AS (SELECT x, y, n, cx, cy, 2 * n / (cx + cy) AS dice FROM co JOIN ca USING (x) JOIN cb USING (y)),
lex AS (SELECT x, y, n, cx, cy, dice FROM co2 QUALIFY row_number() OVER (PARTITION BY x ORDER BY dice DESC, y) = 1 AND dice >= 0.3),
l0 AS (SELECT conv_id, turn, CASE WHEN turn = 4 THEN '' ELSE 'BK' || conv_id || ' 1:' || (turn + 1) END AS ref, CASE WHEN turn % 3 = 2 THEN '<range>' ELSE text END AS t, role AS w FROM conversations),
l1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM l0 WHERE ref <> ''),
l2 AS (SELECT *, sum(CASE WHEN t = '<range>' AND rn > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM l1),
l3 AS (SELECT conv_id, min(turn) AS turn, list(ref ORDER BY turn) AS refs, coalesce(string_agg(t, ' ' ORDER BY turn) FILTER (t <> '<range>' AND t <> ''), '') AS t, coalesce(string_agg(w, ' ' ORDER BY turn) FILTER (w <> ''), '') AS w FROM l2 GROUP BY conv_id, island)"""
_W = f"WITH {_BASE} "
_LABEL = "CASE WHEN len(refs) = 1 THEN refs[1] ELSE refs[1] || '-' || string_split(refs[len(refs)], ':')[-1] END"
_PART = """CASE WHEN x.t = '' THEN acc WHEN acc.t = '' THEN x WHEN x.note OR regexp_matches(right(acc.t, 1), '{ws}') OR regexp_matches(left(x.t, 1), '{ws}') THEN {{'t': acc.t || x.t, 'note': false}} ELSE {{'t': acc.t || ' ' || x.t, 'note': false}} END""".format(ws=_WS)
_SECOND = "second <> '' AND length(second) / greatest(1, length(b)) > 0.4 AND length(second) / greatest(1, length(b)) < 3.0"
SQL = {
    "turn_pairs": f"{_W} SELECT * FROM j",
    "length_ratio_filter": f"{_W} SELECT id, a, b FROM p WHERE length(a) / greatest(1, length(b)) > 0.4 AND length(a) / greatest(1, length(b)) < 3.0",
    "ml_pairs": f"{_W} SELECT id, a AS source, b AS target FROM p",
    "rag_docs": f"{_W} SELECT id, a, b, id || chr(10) || 'User: ' || a || chr(10) || 'Assistant: ' || b AS text FROM p",
    "sft_examples": f"{_W} {_example('forward', FORWARD, 'a', 'b')} UNION ALL {_example('backward', BACKWARD, 'b', 'a')}",
    "sft_sampled": f"""{_W} {_example('forward', FORWARD, 'a', 'b')} UNION ALL {_example('backward', BACKWARD, 'b', 'a')} UNION ALL {_example('extra', BACKWARD, 'extra', 'a', f"split = 'train' AND extra <> '' AND {_FRACTION.format(salt='extra')} < 300")}
UNION ALL {_example('second_forward', FORWARD, 'second', 'b', _SECOND)} UNION ALL {_example('second_backward', BACKWARD, 'b', 'second', _SECOND)}""",
    "hash_shuffle_rank": f"{_W} SELECT id, sha256(id || '48') AS shuffle_key FROM p",
    "sft_record_check": f"{_W} SELECT id, CASE left(id, 1)::INT % 5 WHEN 1 THEN 'bad_count' WHEN 2 THEN 'bad_json' WHEN 3 THEN 'bad_message' END AS error FROM p",
    "doc_frequency": f"{_W} SELECT x AS token, cx AS n, 'a' AS side FROM ca UNION ALL SELECT y, cy, 'b' FROM cb",
    "cooccurrence": f"{_W} SELECT x, y, n, cx, cy FROM co2",
    "lexicon_dice": f"{_W} SELECT x, y, n, cx, cy FROM lex",
    "lexicon_rows": f"{_W} SELECT x, y, format('{{:.3f}}', dice) AS dice, cx AS x_frequency FROM lex",
    "lexicon_top": f"{_W} SELECT x, y, n, cx, cy FROM lex ORDER BY dice DESC, x LIMIT 50",
    "range_merge": f"{_W} SELECT conv_id, turn, array_to_string(refs, ',') AS refs, t, w FROM l3",
    "group_label_merge": f"{_W} SELECT conv_id, turn, {_LABEL} AS label, string_split(refs[1], ' ')[1] AS book FROM l3",
    "forward_fill": """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS heard, (sum(c) OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS change
FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS DISTINCT FROM role THEN 1 ELSE 0 END AS c FROM conversations)""",
    "forward_fill_headers": """SELECT conv_id, turn, outer_ AS "outer", last_value(CASE WHEN turn % 4 = 2 THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id, segment ORDER BY turn) AS "inner"
FROM (SELECT conv_id, turn, last_value(CASE WHEN turn % 4 = 0 THEN turn END IGNORE NULLS) OVER w AS outer_, count(CASE WHEN turn % 4 = 0 THEN 1 END) OVER w AS segment FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""",
    "fragment_concat": "SELECT conv_id, role, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (text <> ''), '') AS text FROM conversations GROUP BY ALL",
    "note_boundary": "SELECT conv_id, turn, note_before FROM (SELECT *, coalesce(lag(turn % 3 = 1) OVER (PARTITION BY conv_id ORDER BY turn), false) AS note_before FROM conversations) WHERE turn % 3 <> 1",
    "merge_fold": f"SELECT conv_id, list_reduce(list_prepend({{'t': '', 'note': false}}, list({{'t': text, 'note': turn % 3 = 2}} ORDER BY turn)), lambda acc, x: {_PART}).t AS text FROM conversations GROUP BY conv_id",
    "vref_fill": "SELECT conv_id, turn, conv_id || '.' || turn AS ref, CASE WHEN role = 'user' THEN text ELSE '' END AS text FROM conversations",
    "positional_zip": """SELECT a.conv_id AS line_no, a.text AS base, coalesce(b.text, '') AS second, coalesce(c.text, '') AS third FROM (SELECT * FROM conversations WHERE turn = 0) AS a
LEFT JOIN (SELECT * FROM conversations WHERE turn = 1) AS b ON a.conv_id = b.conv_id LEFT JOIN (SELECT * FROM conversations WHERE turn = 2) AS c ON a.conv_id = c.conv_id""",
    "line_count": f"SELECT count(*) FILTER (regexp_matches(x, '[^{_WS[1:]}')) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS x FROM conversations)",
    "chapter_coverage": f"SELECT conv_id, count(*) FILTER (length(text) % 5 <> 0 AND regexp_matches(text, '[^{_WS[1:]}')) AS with_text, count(*) AS segments FROM conversations GROUP BY conv_id",
    "group_content_hash": """SELECT conv_id, sha256('[' || string_agg('{"reference":"' || conv_id || '.' || turn || '","text":"' || regexp_replace(text, '[^a-zA-Z ]', '', 'g') || '"}', ',' ORDER BY turn) || ']') AS content_hash FROM conversations GROUP BY conv_id""",
}
