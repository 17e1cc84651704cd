"""Trees of pages with missing, misplaced and crossing tags, as browsers build them; spans of such pages."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import dom, extract

#: Worked out by hand from the standard's rules.
TREES = {
    "<p>a<p>b": "p(a)p(b)",
    "<p>a<div>b</div>c": "p(a)div(b)c",
    "<p>a<h2>b</h3>c": "p(a)h2(b)c",
    "<h1>a<h2>b</h1>c": "h1(a)h2(b)c",
    "<div><p>a</div>b": "div(p(a))b",
    "a</p>b": "ap()b",
    "a<br/>b</br>c<div/>d": "abr()bbr()cdiv(d)",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "ul(li(a)li(bul(li(c)))li(d))",
    "<ul><li><div><p>a<li>b</ul>": "ul(li(div(p(a)))li(b))",
    "<dl><dt>a<dd>b<dt>c</dl>": "dl(dt(a)dd(b)dt(c))",
    "<select><option>a<option>b<optgroup><option>c</select>d": "select(option(a)option(b)optgroup(option(c)))d",
    "<select><p>a<b>b<select>c": "select(ab)c",
    "<button>a<button>b</button>c": "button(a)button(b)c",
    "<ruby>a<rt>b<rp>c<rt>d</ruby>e": "ruby(art(b)rp(c)rt(d))e",
    # Tables.
    "<table><tr><td>a<td>b<tr><th>c</table>": "table(tbody(tr(td(a)td(b))tr(th(c))))",
    "<table><td>a</table>b": "table(tbody(tr(td(a))))b",
    "<table><thead><tr><th>a<tbody><tr><td>b</table>": "table(thead(tr(th(a)))tbody(tr(td(b))))",
    "<table><caption>a<td>b</table>": "table(caption(a)tbody(tr(td(b))))",
    "<table><col><tr><td>1</table>": "table(colgroup(col())tbody(tr(td(1))))",
    "<p>a<table><tr><td><p>b</table>c": "p(a)table(tbody(tr(td(p(b)))))c",
    "<table><tr><td><table><tr><td>a</table>b</table>c": "table(tbody(tr(td(table(tbody(tr(td(a))))b))))c",
    "<table>x<tr><td>y</table>": "xtable(tbody(tr(td(y))))",
    "<table><b>x<tr><td>y</table>z": "b(x)table(tbody(tr(td(y))))b(z)",
    "<td>a</td><tr>b": "ab",
    # Formatting that is open across blocks, or closed in another order.
    "<b>1<i>2</b>3</i>4": "b(1i(2))i(3)4",
    "<p>1<b>2<i>3</b>4</i>5</p>": "p(1b(2i(3))i(4)5)",
    "<b>1<p>2</b>3</p>": "b(1)p(b(2)3)",
    "<p><b>a<p>b</b>c": "p(b(a))p(b(b)c)",
    "<p><b>a<br><p>b</p><p>c": "p(b(abr()))p(b(b))p(b(c))",
    "<a>1<div>2<div>3</a>4</div>5</div>": "a(1)div(a(2)div(a(3)4)5)",
    "<a href=x>1<a href=y>2</a>3": "a(1)a(2)3",
    "<font><p>hello<b>cruel</font>world": "font()p(font(hellob(cruel))b(world))",
    "<b><button>foo</b>bar": "b()button(b(foo)bar)",
    "<p><b><b><b><b><p>x": "p(b(b(b(b()))))p(b(b(b(x))))",
    "<b>a<table><tr><td>b</b>c</table>d": "b(atable(tbody(tr(td(bc))))d)",
    # Texts, entities, what isn't shown.
    "a &amp;lt; &eacute;<!-- <p> --><script>'<p>'</script><style>p{}</style>b": "a &lt; éscript()style()b",
    "<div>a</span>b</div>": "div(ab)",
}


@pytest.mark.parametrize("page", TREES)
def test_trees(page):
    assert dom.outline(page) == TREES[page]


def test_head_and_body():
    root = dom.parse("<!DOCTYPE html>\n<title>T &amp; U</title><html lang=en><meta charset=x><p>a<body class=c></body></html>b")
    assert root.outline() == "html(head(title(T & U)meta())body(p(ab)))"
    assert root.children[0].attributes == {"lang": "en"}
    assert next(e for e in root.elements() if e.tag == "body").attributes == {"class": "c"}
    assert dom.parse("").outline() == "html()"


TAGS = ["p", "b", "i", "a", "div", "table", "tr", "td", "tbody", "caption", "li", "ul", "h1", "select", "option", "button", "br", "object", "html", "body", "head", "title", "dd", "nobr", "col", "form"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS]), st.sampled_from(["x", " y "])), max_size=40))
def test_any_tokens_make_a_tree(tokens):
    """Each element is below its parent once, and no text is lost or doubled."""
    root = dom.parse("".join(tokens))
    for e in root.elements():
        assert sum(c is e for c in e.parent.children) == 1
    text = lambda s: sorted(s.replace(" ", ""))
    assert text(root.text()) == text("".join(t for t in tokens if "<" not in t))


def test_deep_pages():
    root = dom.parse("<div>" * 5000 + "x" + "</div>" * 5000 + "<b>" * 3000 + "y")
    assert root.text() == "xy"


def test_spans_of_a_page_with_open_tags(spark):
    """Verses in paragraphs without end tags, under formatting that is never closed, in a table without rows."""
    verse = lambda n, text: f'<span class="v__verse" data-usfm="GEN.2.{n}"><span class="v__label">{n}</span><span class="v__content">{text}</span></span>'
    page = f'<title>T</title><p><b>before<div class="c__chapter" data-usfm="GEN.2"><p>{verse(1, "one <i>two")}<p>{verse(2, "three")}</i><table><td>{verse(3, "four")}</table></div><p>behind'
    row = extract.with_chapter_spans(spark.createDataFrame([(page, "GEN", 2)], "html string, book_code string, chapter int")).first()
    assert [(s.usfm, s.label, [p.text for p in s.parts]) for s in row.spans] == [("GEN.2.1", "1", ["one two"]), ("GEN.2.2", "2", ["three"]), ("GEN.2.3", "3", ["four"])]
    blocks = extract.with_blocks(spark.createDataFrame([(page,)], "html string")).first().blocks
    assert [(b.kind, b.parent, b.text, b.marked) for b in blocks] == [("p", "body", "before", True), ("p", "div", "1one two", True), ("p", "div", "2three", True), ("p", "body", "behind", True)]
