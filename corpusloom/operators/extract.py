"""Chapter pages: DOM extraction from held HTML, span grouping and validation.

Only the DOM walk is Python (Spark has no HTML parser): batches go through Arrow.
Nothing is fetched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.refs import REFERENCE
from corpusloom.operators import sequence
from corpusloom.operators.dom import Node, parse
from corpusloom.schemas import UNCERTAIN, VERIFIED

#: Thresholds of the language checks, and how many version links a page's record holds.
MOST_STOP_WORDS_A, LEAST_STOP_WORDS_B, LEAST_COVERAGE = 0.55, 0.25, 0.90
MOST_VERSION_LINKS = 10


def page_meta(root: Node) -> dict:
    """A page's head and heading, and its first ``MOST_VERSION_LINKS`` version links, of which its record has no more."""
    out = {"title": None, "canonical": None, "og_url": None, "lang": None, "h1": None, "version_links": []}
    for e in root.elements():
        a = e.attributes
        if e.tag == "title" and out["title"] is None:
            out["title"] = e.text().strip()
        elif e.tag == "html":
            out["lang"] = a.get("lang") or None
        elif e.tag == "h1" and out["h1"] is None:
            out["h1"] = e.text().strip()
        elif e.tag == "link" and a.get("rel") == "canonical" and out["canonical"] is None:
            out["canonical"] = a.get("href")
        elif e.tag == "meta" and a.get("property") == "og:url" and out["og_url"] is None:
            out["og_url"] = a.get("content")
        elif e.tag == "a" and re.match(r"/versions/[0-9]+", a.get("href", "")) and a["href"] not in out["version_links"]:
            out["version_links"].append(a["href"])
    out["version_links"] = out["version_links"][:MOST_VERSION_LINKS]
    return out


def _in_note(node: Node, top: Node) -> bool:
    up = node.parent
    while up is not None and up is not top:
        if "__note" in up.attributes.get("class", ""):
            return True
        up = up.parent
    return False


def _span(element: Node) -> dict:
    label = next((c.text().strip() for c in element.children if isinstance(c, Node) and c.has_class("label")), None)
    parts, note = [], False
    for e in element.elements():
        cls = e.attributes.get("class", "")
        if "__note" in cls:
            note = True
        elif "__content" in cls and not _in_note(e, element):
            parts.append({"text": e.text(), "note_before": note})
            note = False
    return {"usfm": element.attributes["data-usfm"], "label": label, "parts": parts}


def chapter_spans(root: Node, book: str, number: int) -> dict:
    """The container of a chapter, its heading, and its verse spans in document order."""
    usfm = f"{book}.{number}"
    wanted = re.compile(rf"{re.escape(usfm)}\.[0-9]+[a-z]?")
    out = {"container_found": False, "selector_fallback": False, "chapter_label": None, "heading": None, "spans": []}
    held = ([e for e in c.elements() if "data-usfm" in e.attributes] for c in root.elements() if c.attributes.get("data-usfm") == usfm)
    inner = next((x for x in held if x), None)
    if inner is None:
        return out
    top = inner[0].parent
    while top is not None and top.attributes.get("data-usfm") != usfm:
        top = top.parent
    out["container_found"] = True
    for c in top.children:
        if isinstance(c, Node):
            if out["chapter_label"] is None and c.has_class("label"):
                out["chapter_label"] = c.text().strip()
            if out["heading"] is None and c.has_class("heading", "s", "s1"):
                out["heading"] = " ".join(c.text().split())
    fitting = [e for e in inner if wanted.fullmatch(e.attributes["data-usfm"])]
    verses = [e for e in fitting if e.has_class("verse")]
    if not verses:
        out["selector_fallback"] = True
        verses = [e for e in fitting if not _in_note(e, top) and not e.has_class("ref")]
    out["spans"] = [_span(e) for e in verses]
    return out


META = "title string, canonical string, og_url string, lang string, h1 string, version_links array<string>"
SPANS = "container_found boolean, selector_fallback boolean, chapter_label string, heading string, spans array<struct<usfm:string,label:string,parts:array<struct<text:string,note_before:boolean>>>>"


def _mapped(rows: DataFrame, html: str, given: list[str], ddl: str, make) -> DataFrame:  # noqa: ANN001
    from pyspark.sql.types import StructType

    out = StructType([*rows.schema.fields, *StructType.fromDDL(ddl).fields])
    added = [f.name for f in StructType.fromDDL(ddl).fields]
    at = [rows.columns.index(c) for c in (html, *given)]
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(out)
        for batch in batches:
            made = [make(*x) for x in zip(*(batch.column(i).to_pylist() for i in at), strict=True)]
            arrays = [pa.array([m[c] for m in made], types.field(c).type) for c in added]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=out.names)

    return rows.mapInArrow(run, out)


def with_page_meta(rows: DataFrame, html: str = "html", closed: bool = False) -> DataFrame:
    return _mapped(rows, html, [], META, lambda h: page_meta(parse(h or "", closed)))


def with_chapter_spans(rows: DataFrame, html: str = "html", book: str = "book_code", number: str = "chapter") -> DataFrame:
    return _mapped(rows, html, [book, number], f"{META}, {SPANS}", lambda h, b, n: (lambda root: page_meta(root) | chapter_spans(root, b, n))(parse(h or "")))


def with_elements(rows: DataFrame, html: str = "html", tags: tuple[str, ...] = ("h2", "h3", "a")) -> DataFrame:
    """``elements``: the named elements in document order, each with its place, text and href."""
    make = lambda h: {"elements": [{"pos": i, "kind": e.tag, "text": e.text().strip(), "href": e.attributes.get("href")} for i, e in enumerate(x for x in parse(h or "").elements() if x.tag in tags)]}
    return _mapped(rows, html, [], "elements array<struct<pos:int,kind:string,text:string,href:string>>", make)


def with_blocks(rows: DataFrame, html: str = "html", tags: tuple[str, ...] = ("p", "li", "h1"), marked: tuple[str, ...] = ("b", "strong"), closed: bool = False) -> DataFrame:
    """``blocks``: the named elements in document order, each with its place, parent, text, and whether any of its text is in a ``marked`` element.

    With ``closed`` only character references that end in a semicolon are decoded.
    """
    wanted, marks = set(tags), set(marked)

    def one(i: int, e: Node) -> dict:
        inside = any(x.tag in marks and x.text().strip() for x in e.elements())
        return {"pos": i, "kind": e.tag, "parent": e.parent.tag, "text": " ".join(e.text().split()), "marked": inside or (e.within(marks) and bool(e.text().strip()))}

    make = lambda h: {"blocks": [one(i, e) for i, e in enumerate(x for x in parse(h or "", closed).elements() if x.tag in wanted)]}
    return _mapped(rows, html, [], "blocks array<struct<pos:int,kind:string,parent:string,text:string,marked:boolean>>", make)


#: Fixed value: the form of a group's address.
LINK = r"^/bible/([0-9]+)/([0-9A-Z]{3})\.([0-9]+|[A-Z]+[0-9]*)\.([A-Z]+)\z"
OUTER_TITLES = ["Old Testament", "New Testament"]


def version_page(rows: DataFrame, version_id: str, by: str = "page_id") -> DataFrame:
    """Chapter and intro links of a version page with the headers above them: ``code``, ``mid``, ``version_code``, ``testament``, ``name``, ``repeated``."""
    from pyspark.sql import Window

    e = with_elements(rows).select(by, F.explode("elements").alias("e")).select(by, "e.*")
    outer = F.when((F.col("kind") == "h2") & F.col("text").isin(OUTER_TITLES), F.col("text"))
    filled = sequence.fill_within(e, [by], ["pos"], outer, F.when(F.col("kind") == "h3", F.col("text")), ("testament", "name"))
    part = lambda i: F.regexp_extract("href", LINK, i)
    links = filled.where((F.col("kind") == "a") & F.coalesce(F.col("href").rlike(LINK), F.lit(False))).withColumns({"code": part(2), "mid": part(3), "version_code": part(4)}).where(part(1) == version_id)
    seen = F.row_number().over(Window.partitionBy(by, "code", "mid").orderBy("pos"))
    return links.withColumn("repeated", seen > 1).drop("kind", "text")


def books(links: DataFrame, by: str = "page_id") -> DataFrame:
    """One row a collection of a version page: first name and testament, sorted chapters, intro link."""
    chapter = F.col("mid").rlike("^[0-9]+$")
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("pos", c)))[c]
    return links.groupBy(by, "code").agg(first("name").alias("name"), first("testament").alias("testament"), F.array_sort(F.collect_set(F.when(chapter, F.col("mid").try_cast("int")))).alias("chapters"), F.max(F.when(F.col("mid").startswith("INTRO"), F.col("href"))).alias("intro_url"), first("version_code").alias("version_code"))


#: Fixed value: a header's anchor, or a numbered line, of a one-page edition.
HEADER_OR_LINE = r"<a>([^<]+?)\s+([0-9]+)</a>|(?:^|\n|>)\s*([0-9]+)\s+([^\n<]+)"


def single_page(rows: DataFrame, html: str = "html", by: str = "page_id") -> DataFrame:
    """Verses of a whole edition on one page: header anchors and numbered lines in order, fragments of one verse joined.

    ``book_index`` counts headers' names as they change; verses before the first header go.
    """

    def scan(h: str | None) -> dict:
        h = h or ""
        start = h.find("<a>")
        found = re.finditer(HEADER_OR_LINE, h[start:]) if start >= 0 else ()
        return {"tokens": [{"pos": i, "name": (m[1] or "").strip() or None, "chapter": int(m[2]) if m[2] else None, "verse": int(m[3]) if m[3] else None, "text": m[4]} for i, m in enumerate(found)]}

    tokens = _mapped(rows, html, [], "tokens array<struct<pos:int,name:string,chapter:int,verse:int,text:string>>", scan).select(by, F.explode("tokens").alias("t")).select(by, "t.*")
    placed = sequence.change_index(tokens, [by], ["pos"], F.col("name"), "book_index")
    placed = sequence.forward_fill(placed, [by], ["pos"], {"current_chapter": F.col("chapter")})
    lines = placed.where("verse is not null and book_index is not null and current_chapter > 0").withColumn("text", tx.strip(tx.unescape(F.col("text"))))
    return lines.groupBy(by, "book_index", F.col("current_chapter").alias("chapter"), "verse").agg(sequence.ordered_concat(F.col("text"), "pos").alias("text"))


def foreign_spans(spans: DataFrame, usfm: str = "usfm", group: str = "group_usfm") -> DataFrame:
    """Spans of another group, or with no valid reference, as anomalies."""
    own = F.coalesce(F.col(usfm).startswith(F.concat(F.col(group), F.lit("."))) & F.col(usfm).rlike(REFERENCE), F.lit(False))
    return spans.withColumn("anomaly", F.when(~own, F.concat(F.lit("unexpected_usfm:"), F.coalesce(usfm, F.lit("")))))


def coverage(segments: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Segments with text, all segments, and the rounded share."""
    out = segments.groupBy(*by).agg(F.count_if(~F.coalesce(tx.is_blank(F.col(text)), F.lit(True))).alias("with_text"), F.count("*").alias("segments"))
    return out.withColumn("coverage", tx.round4(F.col("with_text") / F.col("segments")))


def url_checks(url: Column, expected: Column, canonical: Column, links: Column, version_id: str, root: str) -> dict[str, Column]:
    plain = lambda c: F.rtrim(F.coalesce(c, F.lit("")), F.lit("/"))
    return {
        "url_version_id": F.startswith(F.coalesce(url, F.lit("")), F.lit(f"{root}/{version_id}/")),
        "url_matches_expected": plain(url) == plain(expected),
        "canonical_matches": plain(canonical) == plain(expected),
        "version_link_present": F.exists(F.coalesce(links, F.array().cast("array<string>")), lambda x: F.regexp_extract(x, r"^/versions/([0-9]+)", 1) == version_id),
    }


def validate(chapters: DataFrame, version_id: str, version_code: str, side: str, root: str, supplementary: bool = True) -> DataFrame:
    """Chapters (page columns, ``expected_url``, ``mapping_name``, ``container_found``, ``book_code``, ``chapter``, ``verses``: reference, text) with ``checks``, ``failing``, ``method``, ``status``.

    The ratio of stop words is no check of a page's fields: it can only withhold the status, and with
    ``supplementary`` false it is told (``stop_word_ratio``) without doing so.
    """
    verses = F.col("verses")
    n, full = F.size(verses), F.size(F.filter(verses, lambda v: ~tx.is_blank(F.coalesce(v["text"], F.lit("")))))
    share = F.when(n > 0, tx.round4(full / n)).otherwise(0.0)
    prefix = F.concat(F.col("book_code"), F.lit("."), F.col("chapter").cast("string"), F.lit("."))
    code, name = tx.title_code(F.coalesce("title", F.lit(""))), tx.page_book_name(F.coalesce("title", F.lit("")), F.coalesce("h1", F.lit("")))
    ratio = tx.stop_word_ratio(F.array_join(F.transform(verses, lambda v: F.coalesce(v["text"], F.lit(""))), " "))
    url = url_checks(F.col("url"), F.col("expected_url"), F.col("canonical"), F.col("version_links"), version_id, root)
    tests = {
        "url_version_id": url["url_version_id"], "url_matches_expected": url["url_matches_expected"], "canonical_matches": url["canonical_matches"],
        "title_version_consistent": code.isNull() | (code == version_code), "version_link_present": url["version_link_present"],
        "container_found": F.coalesce("container_found", F.lit(False)), "verses_extracted": n > 0,
        "references_match_chapter": (n > 0) & F.forall(verses, lambda v: v["reference"].rlike(REFERENCE) & v["reference"].startswith(prefix)),
        "book_name_matches": F.coalesce(tx.casefold(name) == tx.casefold(F.col("mapping_name")), F.lit(False)), "has_text_content": full > 0, "text_coverage_ok": share >= LEAST_COVERAGE,
    }
    good = F.lit(True) if not supplementary else (ratio <= MOST_STOP_WORDS_A) if side == "a" else (ratio >= LEAST_STOP_WORDS_B)
    rows = chapters.withColumns({"stop_word_ratio": ratio, "coverage": share, "checks": F.map_from_arrays(F.array(*map(F.lit, tests)), F.array(*(F.coalesce(t, F.lit(False)) for t in tests.values())))})
    failing = F.concat(F.map_keys(F.map_filter("checks", lambda _, ok: ~ok)), F.when(~good, F.array(F.lit("stop_word_ratio_out_of_range"))).otherwise(F.array().cast("array<string>")))
    all_of = lambda *names: reduce_and([F.col("checks")[k] for k in names])
    method = F.array_compact(
        F.array(
            F.when(all_of("url_version_id", "url_matches_expected", "title_version_consistent", "version_link_present"), "version_metadata"), F.when(F.col("checks")["canonical_matches"], "page_metadata"),
            F.when(all_of("container_found", "verses_extracted", "references_match_chapter", "book_name_matches"), "DOM_context"),
        )
    )
    return rows.withColumns({"failing": failing, "method": method}).withColumn("status", F.when(F.size("failing") == 0, VERIFIED).otherwise(UNCERTAIN))


def reduce_and(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def content_hash(segments: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """SHA-256 of the compact JSON list of the group's references and texts, in order."""
    pairs = F.transform(F.array_sort(F.collect_list(F.struct(*order, "reference", F.coalesce("text", F.lit("")).alias("text")))), lambda s: F.struct(s["reference"].alias("reference"), s["text"].alias("text")))
    return segments.groupBy(*by).agg(F.sha2(F.to_json(pairs), 256).alias("content_hash"))
