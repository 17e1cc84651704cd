"""A page's tree as browsers build it: implied tags, scopes, re-opened formatting, content out of place in tables.

The tokens are those of the standard library's parser; what is here is the stack of open elements of the HTML
standard's tree construction, without frames, templates and foreign content.  It is the helper of the page
operators, which run it over Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.entities import html5
from html.parser import HTMLParser

# The element groups of the HTML standard's tree construction.
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
HEAD = set("base basefont bgsound link meta noscript script style template title".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup listing main menu nav ol pre search section summary ul".split())
FORMATTING = set("a b big code em font i nobr s small strike strong tt u".split())
IMPLIED_END = set("dd dt li optgroup option p rb rp rt rtc".split())
MARKED = {"applet", "marquee", "object", "td", "th", "caption"}
SPECIAL = BLOCKS | HEADINGS | VOID | set("applet body button caption colgroup dd dt frameset head html iframe li marquee noembed noframes noscript object p plaintext script select style summary table tbody td template textarea tfoot th thead title tr xmp".split())
SCOPE = set("applet caption html table td th marquee object template".split())
SECTIONS = {"tbody", "thead", "tfoot"}
#: Elements nest no deeper, as in browsers: what would go deeper becomes a sibling.
DEEPEST = 512
TABLE_PARTS = SECTIONS | {"caption", "colgroup", "col", "tr", "td", "th"}


@dataclass(eq=False)
class Node:
    """An element; ``children`` holds elements and texts in order."""

    tag: str
    attributes: dict[str, str]
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    def elements(self) -> Iterator[Node]:
        """All elements below, in document order; without recursion, as pages may nest deeply."""
        waiting = [iter(self.children)]
        while waiting:
            child = next(waiting[-1], None)
            if child is None:
                waiting.pop()
            elif isinstance(child, Node):
                yield child
                waiting.append(iter(child.children))

    def text(self) -> str:
        out, waiting = [], [iter(self.children)]
        while waiting:
            child = next(waiting[-1], None)
            if child is None:
                waiting.pop()
            elif isinstance(child, Node):
                waiting.append(iter(child.children))
            else:
                out.append(child)
        return "".join(out)

    def has_class(self, *names: str) -> bool:
        """A class token that is one of the names or ends in two underscores and it."""
        return any(t == n or t.endswith(f"__{n}") for t in self.attributes.get("class", "").split() for n in names)

    def within(self, tags: set[str]) -> bool:
        up = self.parent
        while up is not None and up.tag not in tags:
            up = up.parent
        return up is not None

    def put(self, child: Node | str, before: Node | None = None) -> None:
        """``child`` at the end, or before one of the children; neighbouring texts are one."""
        if isinstance(child, Node):
            if child.parent is not None:
                child.parent.children.remove(child)
            child.parent = self
        at = len(self.children) if before is None else next(i for i, c in enumerate(self.children) if c is before)
        if isinstance(child, str) and at and isinstance(self.children[at - 1], str):
            self.children[at - 1] += child
        else:
            self.children.insert(at, child)

    def outline(self) -> str:
        """The tree in one line, for comparisons."""
        inner = "".join(c if isinstance(c, str) else c.outline() for c in self.children)
        return f"{self.tag}({inner})" if self.tag else inner


class Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.html, self.head, self.body = Node("html", {}), None, None
        self.root.put(self.html)
        self.open = [self.html]
        #: Formatting elements to re-open; None is a marker, beyond which none is re-opened.
        self.formatting: list[Node | None] = []

    # What is open.

    def in_scope(self, tags: set[str], ends: set[str] = SCOPE) -> bool:
        for node in reversed(self.open):
            if node.tag in tags:
                return True
            if node.tag in ends:
                return False
        return False

    def pop_to(self, tags: set[str]) -> None:
        """Closes elements up to and with the first of the tags."""
        while self.open.pop().tag not in tags:
            pass

    def pop_above(self, tags: set[str]) -> None:
        while self.open[-1].tag not in tags:
            self.open.pop()

    def imply_ends(self, but: str = "") -> None:
        while self.open[-1].tag in IMPLIED_END and self.open[-1].tag != but:
            self.open.pop()

    def close_p(self) -> None:
        if self.in_scope({"p"}, SCOPE | {"button"}):
            self.imply_ends("p")
            self.pop_to({"p"})

    def clear_formatting(self) -> None:
        while self.formatting and self.formatting.pop() is not None:
            pass

    def close_cell(self) -> None:
        if self.in_scope({"td", "th"}, {"html", "table"}):
            self.imply_ends()
            self.pop_to({"td", "th"})
            self.clear_formatting()

    # Where things go.

    def place(self, child: Node | str) -> None:
        """Into the current element; before the table if that is a part of one where nothing else may be."""
        here = self.open[-1]
        misplaced = here.tag in SECTIONS | {"table", "tr"} and (child.strip() if isinstance(child, str) else child.tag not in TABLE_PARTS | {"script", "style", "form"})
        self.put_near(here, child, misplaced)

    def put_near(self, here: Node, child: Node | str, misplaced: bool) -> None:
        table = next((n for n in reversed(self.open) if n.tag == "table"), None) if misplaced else None
        if table is None or table.parent is None:
            here.put(child)
        else:
            table.parent.put(child, before=table)

    def insert(self, tag: str, attributes: dict[str, str]) -> Node:
        node = Node(tag, dict(attributes))
        if len(self.open) >= DEEPEST:
            self.open.pop()
        self.place(node)
        if tag not in VOID:
            self.open.append(node)
        if tag in MARKED:
            self.formatting.append(None)
        return node

    def reopen(self) -> None:
        """Formatting elements that a block's end has closed are opened again."""
        at = len(self.formatting)
        while at and self.formatting[at - 1] is not None and self.formatting[at - 1] not in self.open:
            at -= 1
        for i in range(at, len(self.formatting)):
            self.formatting[i] = self.insert(self.formatting[i].tag, self.formatting[i].attributes)

    def format(self, tag: str, attributes: dict[str, str]) -> None:
        node = self.insert(tag, attributes)
        since = self.formatting[len(self.formatting) - next((i for i, n in enumerate(reversed(self.formatting)) if n is None), len(self.formatting)) :]
        alike = [n for n in since if n.tag == tag and n.attributes == attributes]
        if len(alike) >= 3:
            self.formatting.remove(alike[0])
        self.formatting.append(node)

    # Tokens.

    def ensure_body(self) -> None:
        if self.body is None:
            self.start_head()
            del self.open[1:]
            self.body = self.insert("body", {})

    def start_head(self, attributes: dict[str, str] | None = None) -> None:
        if self.head is None:
            self.head = self.insert("head", attributes or {})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        attributes: dict[str, str] = {}
        for k, v in attrs:
            attributes.setdefault(k, v or "")
        if tag == "html":
            self.html.attributes |= {k: v for k, v in attributes.items() if k not in self.html.attributes}
        elif tag == "head":
            if self.body is None:
                self.start_head(attributes)
        elif tag == "body":
            self.ensure_body()
            self.body.attributes |= {k: v for k, v in attributes.items() if k not in self.body.attributes}
        elif self.body is None and tag in HEAD:
            self.start_head()
            if self.open[-1] is self.html:  # behind the head's end: it is opened once more
                self.open.append(self.head)
            self.insert(tag, attributes)
        else:
            self.ensure_body()
            self.start_in_body(tag, attributes)

    handle_startendtag = handle_starttag

    def start_in_body(self, tag: str, attributes: dict[str, str]) -> None:
        here = self.open[-1].tag
        if self.in_scope({"select"}, SPECIAL - {"select", "optgroup", "option"}) and tag not in ("option", "optgroup", "hr", "script"):
            if tag not in ("input", "select", "textarea", "keygen"):
                return
            self.pop_to({"select"})
            if tag == "select":
                return
        if tag in TABLE_PARTS:
            self.start_table_part(tag, attributes)
        elif tag == "table":
            if self.open[-1].tag in SECTIONS | {"table", "tr"}:
                self.pop_to({"table"})
            self.close_p()
            self.insert(tag, attributes)
        elif tag == "li" or tag in ("dd", "dt"):
            alike = {"li"} if tag == "li" else {"dd", "dt"}
            node = next((n for n in reversed(self.open) if n.tag in alike or n.tag in SPECIAL - {"address", "div", "p"}), None)
            if node is not None and node.tag in alike:
                self.imply_ends(node.tag)
                self.pop_to({node.tag})
            self.close_p()
            self.insert(tag, attributes)
        elif tag in BLOCKS | HEADINGS | {"p", "hr", "xmp", "plaintext"}:
            self.close_p()
            if tag in HEADINGS and self.open[-1].tag in HEADINGS:
                self.open.pop()
            self.insert(tag, attributes)
        elif tag in FORMATTING:
            old = next((n for n in reversed(self.formatting) if n is None or n.tag == tag), None)
            if (tag == "a" and old is not None) or (tag == "nobr" and self.in_scope({"nobr"})):
                self.end_formatting(tag)
                for kept in (self.formatting, self.open):
                    if old in kept:
                        kept.remove(old)
            self.reopen()
            self.format(tag, attributes)
        else:
            if tag == "button" and self.in_scope({"button"}):
                self.imply_ends()
                self.pop_to({"button"})
            elif tag in ("option", "optgroup"):
                if here == "option":
                    self.open.pop()
                if tag == "optgroup" and self.open[-1].tag == "optgroup":
                    self.open.pop()
            elif tag in ("rb", "rp", "rt", "rtc") and self.in_scope({"ruby"}):
                self.imply_ends("" if tag in ("rb", "rtc") else "rtc")
            if tag not in HEAD:
                self.reopen()
            self.insert(tag, attributes)

    def start_table_part(self, tag: str, attributes: dict[str, str]) -> None:
        """A part of the innermost table, with the parts between; outside of tables it is nothing."""
        if not self.in_scope({"table"}, {"html"}) or (self.in_scope({"caption"}, {"html", "table"}) and not self.end_caption()):
            return
        self.close_cell()
        if tag in ("td", "th"):
            self.pop_above(SECTIONS | {"table", "tr"})
            if self.open[-1].tag != "tr":
                self.start_table_part("tr", {})
        elif tag == "tr":
            self.pop_above(SECTIONS | {"table"})
            if self.open[-1].tag == "table":
                self.insert("tbody", {})
        elif tag == "col":
            self.pop_above({"table", "colgroup"})
            if self.open[-1].tag == "table":
                self.insert("colgroup", {})
        else:
            self.pop_above({"table"})
        self.insert(tag, attributes)

    def end_caption(self) -> bool:
        self.imply_ends()
        self.pop_to({"caption"})
        self.clear_formatting()
        return True

    def handle_endtag(self, tag: str) -> None:
        if tag == "head" or (self.body is None and tag in HEAD):
            if self.in_scope({tag}, set()):
                self.pop_to({tag})
        elif tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p":
            self.ensure_body()
            if not self.in_scope({"p"}, SCOPE | {"button"}):
                self.insert("p", {})
            self.close_p()
        elif tag in ("body", "html") or self.body is None:
            pass  # what follows is in the body still
        elif tag in FORMATTING:
            self.end_formatting(tag)
        elif tag in ("td", "th"):
            if self.in_scope({tag}, {"html", "table"}):
                self.close_cell()
        elif tag in SECTIONS | {"table", "tr", "caption", "colgroup"}:
            if self.in_scope({tag}, {"html"} if tag == "table" else {"html", "table"}):
                self.imply_ends()
                while self.open[-1].tag != tag:
                    if self.open.pop().tag in MARKED:
                        self.clear_formatting()
                self.open.pop()
                if tag == "caption":
                    self.clear_formatting()
        elif tag in HEADINGS:
            if self.in_scope(HEADINGS):
                self.imply_ends()
                self.pop_to(HEADINGS)
        elif tag in BLOCKS | MARKED | {"button", "li", "dd", "dt"}:
            if self.in_scope({tag}, SCOPE | {"ol", "ul"} if tag == "li" else SCOPE):
                self.imply_ends(tag)
                self.pop_to({tag})
                if tag in MARKED:
                    self.clear_formatting()
        else:
            self.end_any(tag)

    def end_any(self, tag: str) -> None:
        for node in reversed(self.open):
            if node.tag == tag:
                self.imply_ends(tag)
                self.pop_to({tag})
                return
            if node.tag in SPECIAL:
                return

    def end_formatting(self, tag: str) -> None:
        """The end of a formatting element: blocks opened in it get a copy of it around their contents, and leave it."""
        if self.open[-1].tag == tag and self.open[-1] not in self.formatting:
            self.open.pop()
            return
        for _ in range(8):
            node = next((n for n in reversed(self.formatting) if n is None or n.tag == tag), None)
            if node is None:
                return self.end_any(tag)
            if node not in self.open:
                self.formatting.remove(node)
                return None
            if not self._node_in_scope(node):
                return None
            at = self.open.index(node)
            block = next((n for n in self.open[at + 1 :] if n.tag in SPECIAL), None)
            if block is None:
                del self.open[at:]
                self.formatting.remove(node)
                return None
            self._adopt(node, at, block)
        return None

    def _node_in_scope(self, node: Node) -> bool:
        return not any(n.tag in SCOPE for n in self.open[self.open.index(node) + 1 :])

    def _adopt(self, node: Node, at: int, block: Node) -> None:
        above, mark = self.open[at - 1], self.formatting.index(node)
        last, i = block, self.open.index(block)
        for turn in range(1, i - at + 1):
            inner = self.open[i - turn]
            if inner is node:
                break
            if turn > 3 and inner in self.formatting:
                if self.formatting.index(inner) < mark:
                    mark -= 1
                self.formatting.remove(inner)
            if inner not in self.formatting:
                del self.open[i - turn]
                continue
            copy = Node(inner.tag, dict(inner.attributes))
            self.formatting[self.formatting.index(inner)] = self.open[i - turn] = copy
            if last is block:
                mark = self.formatting.index(copy) + 1
            copy.put(last)
            last = copy
        if last.parent is not None:
            last.parent.children.remove(last)
            last.parent = None
        self.put_near(above, last, above.tag in SECTIONS | {"table", "tr"})
        copy = Node(node.tag, dict(node.attributes))
        for child in list(block.children):
            if isinstance(child, Node):
                child.parent = copy
            copy.children.append(child)
        block.children.clear()
        block.put(copy)
        was = self.formatting.index(node)
        self.formatting.insert(mark, copy)
        del self.formatting[was + (mark <= was)]
        self.open.remove(node)
        self.open.insert(self.open.index(block) + 1, copy)

    def handle_data(self, data: str) -> None:
        here = self.open[-1].tag
        if here in ("script", "style"):
            return
        if self.body is None and here not in HEAD:
            if not (data := data.lstrip(" \t\n\r\f")):
                return
            self.ensure_body()
        if here not in HEAD and data.strip(" \t\n\r\f"):
            self.reopen()
        self.place(data)


def only_closed(html: str) -> str:
    """The page with references that no semicolon ends (``&amp`` at a cut) kept as text, where a browser decodes some of them."""
    known = lambda name: name is not None and (name[0] == "#" or f"{name};" in html5)
    return re.sub(r"&(?:(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);)?", lambda m: m[0] if known(m[1]) else f"&amp;{m[0][1:]}", html)


def parse(html: str, closed: bool = False) -> Node:
    """The page's tree; with ``closed`` only references that end in a semicolon are decoded."""
    builder = Builder()
    builder.feed(only_closed(html) if closed else html)
    builder.close()
    return builder.root


def outline(html: str) -> str:
    """The body's tree in one line."""
    body = next((e for e in parse(html).elements() if e.tag == "body"), None)
    return "" if body is None else "".join(c if isinstance(c, str) else c.outline() for c in body.children)
