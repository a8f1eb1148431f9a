"""HTML extraction by layout-aware rendering (operator 6).

A small tree builder with implied end tags reads the page, visibility rules drop what a
browser would not show, and a renderer walks the tree once: blocks on lines of their own
(a blank line around paragraphs, headings, lists and tables), list items with markers and
indentation, ``pre`` as it is, and tables with cells aligned in columns. All visible text
is emitted, menus and footers too, and the text of svg and math in the order of the page. What is
not displayed goes with all that it holds; hidden visibility is inherited, and a part that is made
visible again is shown. Cells stand in the columns that ``colspan`` and ``rowspan`` leave them (spans
end with their row group; below column 1,000 only). Where lining up would take over 64 times the
text of a table, its cells stand apart unaligned, none left out. An open head ends, also without its end tag, at the first thing that cannot stand in it. Parsing is linear in the page and never recursive, so
very deep or broken pages do no harm.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_struct

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript title datalist iframe noembed noframes object audio video canvas".split()
)
#: Elements of svg and math whose text is not shown, and HTML elements that end an open svg.
HIDDEN_FOREIGN = frozenset(
    "desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter annotation annotation-xml".split()
)
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Blocks with a blank line around them, and blocks on a line of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address form fieldset hr li dt dd tr caption thead tbody tfoot "
    "td th details summary figcaption legend option select center hgroup dialog menu".split()
)
#: A start tag ends these open elements, searched upwards as far as the barrier.
_CELLS, _ROWS = frozenset({"td", "th"}), frozenset({"thead", "tbody", "tfoot"})
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "td": (_CELLS, frozenset({"tr", "table"})),
    "th": (_CELLS, frozenset({"tr", "table"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    **{x: (_ROWS | {"caption"}, frozenset({"table"})) for x in _ROWS},
}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTR = re.compile(r"[\s/]*+([^\s/>=]++|=[^\s/>=]*+)(\s*+=\s*+)?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"(?<![\w-])display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
#: Fixed values of the HTML standard: most columns and rows that a cell spans.
MOST_ACROSS, MOST_DOWN = 1000, 65534


class Node:
    __slots__ = ("tag", "attrs", "children", "hidden", "visible", "within")

    def __init__(self, tag: str, attrs: dict[str, str], within: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []
        #: Its content is HTML (""), "svg" (drawn, no text), "text" (text of svg) or "math".
        self.within = within
        if tag in ("svg", "math"):
            self.within = tag
        elif within == "svg" and tag == "text":
            self.within = "text"
        elif within in ("svg", "text") and tag in ("foreignobject", "desc"):
            self.within = ""
        style = attrs.get("style", "")
        said = _VISIBILITY.findall(style)
        #: What its style says, if it does; otherwise it is as visible as its parent.
        self.visible = said[-1].lower() == "visible" if said else None
        self.hidden = (
            tag in HIDDEN or "hidden" in attrs or bool(_NOT_SHOWN.search(style))
            or (tag == "dialog" and "open" not in attrs) or (within != "" and tag in HIDDEN_FOREIGN)
        )


def tokens(page: str):
    """("text", str), ("start", tag, attrs) and ("end", tag) of a page; comments and doctypes dropped.
    Within svg and math, a tag that ends in "/>" is followed by its end."""
    pos, n, unclosed, foreign = 0, len(page), set(), 0

    def attributes(at: int) -> tuple[dict[str, str], int, bool]:
        attrs: dict[str, str] = {}
        last = at  # end of the last value: a slash before it does not close the tag
        while at < n and page[at] != ">":
            m = _ATTR.match(page, at)
            if not m:
                at += 1
                continue
            at, value = m.end(), ""
            if m[2]:
                quote = page[at : at + 1]
                if quote and quote in "\"'" and quote not in unclosed:
                    end = page.find(quote, at + 1)
                    if end < 0:
                        unclosed.add(quote)
                    else:
                        value, at = page[at + 1 : end], end + 1
                if not value and page[at - 1 : at] != quote:
                    end = at
                    while end < n and page[end] not in " \t\n\r\f>":
                        end += 1
                    value, at = page[at:end], end
                last = at
            attrs.setdefault(m[1].lower(), unescape(value))
        return attrs, at + 1, at > last and page[at - 1] == "/"

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos:
            yield ("text", unescape(page[pos:lt]))
        if lt == n:
            return
        nxt = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            pos = n if end < 0 else end + 3
        elif nxt in ("!", "?") and nxt:
            end = page.find(">", lt)
            pos = n if end < 0 else end + 1
        elif nxt == "/" and (m := _NAME.match(page, lt + 2)):
            end = page.find(">", m.end())
            pos = n if end < 0 else end + 1
            if m[0].lower() in ("svg", "math"):
                foreign = max(foreign - 1, 0)
            yield ("end", m[0].lower())
        elif m := _NAME.match(page, lt + 1):
            tag = m[0].lower()
            attrs, pos, closed = attributes(m.end())
            yield ("start", tag, attrs)
            if closed and (foreign or tag in ("svg", "math")):
                yield ("end", tag)
                continue
            if tag in ("svg", "math"):
                foreign += 1
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, pos)
                end = close.start() if close else n
                if tag in ("textarea", "title"):
                    yield ("text", unescape(page[pos:end]))
                pos = end
                if not close:
                    yield ("end", tag)
        else:
            yield ("text", "<")
            pos = lt + 1


def tree(page: str) -> Node:
    """The page as a tree; end tags that authors leave out are implied."""
    root = Node("html", {})
    stack = [root]
    count: dict[str, int] = {"html": 1}  # open elements by tag: an end tag without one is not searched for

    def pop() -> None:
        count[stack.pop().tag] -= 1

    def close(tags: frozenset[str], barrier: frozenset[str]) -> None:
        if not any(count.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in barrier:
                return

    for kind, *rest in tokens(page):
        if kind == "text":
            if stack[-1].tag == "head" and rest[0].strip():
                close(frozenset({"head"}), frozenset())
            if stack[-1].within != "svg":
                stack[-1].children.append(rest[0])
        elif kind == "end":
            tag = rest[0]
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag not in ("html", "body"):
                barrier = frozenset() if tag in ("table", "td", "th", "tr") else frozenset({"table", "td", "th"}) - {tag}
                close(frozenset({tag}), barrier)
        else:
            tag, attrs = rest
            if stack[-1].within in ("svg", "text") and tag in BREAKOUT:
                close(frozenset({"svg"}), frozenset({"foreignobject"}))
            if tag == "body" and count.get("head"):
                close(frozenset({"head"}), frozenset())
            if tag in ("html", "body"):
                continue
            if count.get("head") and tag not in ("meta", "link", "base", "noscript", "template") and tag not in RAW:
                close(frozenset({"head"}), frozenset())
            if tag in CLOSES:
                close(*CLOSES[tag])
                if tag in _ROWS or tag == "tr":
                    close(_CELLS | {"tr"}, frozenset({"table"}))
                if tag in _ROWS:
                    close(_ROWS, frozenset({"table"}))
            if tag in BLOCK and count.get("p"):
                close(frozenset({"p"}), frozenset({"table", "td", "th", "button", "object"}))
            within = stack[-1].within
            node = Node(tag, attrs, within)
            apart = [" "] if within == "svg" and tag == "text" else []  # texts of a drawing stand apart
            stack[-1].children.extend([*apart, node, *apart])
            if tag not in VOID:
                stack.append(node)
                count[tag] = count.get(tag, 0) + 1
    return root


class _Flow:
    """Lines of a page or of a table cell, with collapsed white space."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.indent, self.gap, self.marker = "", "", 0, ""

    def newline(self, gap: int = 0) -> None:
        if text := self.line.rstrip(" "):
            self._put(text)
        self.line = ""
        if self.lines:
            self.gap = max(self.gap, gap)

    def _put(self, text: str) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        lead = self.indent
        if self.marker:
            lead = lead[: -len(self.marker)] + self.marker if lead.endswith(" " * len(self.marker)) else lead + self.marker
            self.marker = ""
        self.lines.append(lead + text)

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *more = s.replace("\r\n", "\n").split("\n")
            self.line += first
            for x in more:
                self.raw(self.line)
                self.line = x
            return
        s = _SPACE.sub(" ", s)
        if not self.line:
            s = s.lstrip(" ")
        elif self.line.endswith(" "):
            s = s.lstrip(" ")
        self.line += s

    def raw(self, text: str) -> None:
        self._put(text)
        self.line = ""

    def done(self) -> str:
        self.newline()
        return "\n".join(self.lines)


class _Table:
    """Cells of a table by row and column."""

    def __init__(self):
        self.rows: list[list[tuple[int, str]]] = []
        self.open, self.column = 0, 0
        self.taken: dict[int, int] = {}  # column: the row from which on it is free again

    def row(self) -> None:
        self.rows.append([])
        self.column = 0

    def group(self) -> None:
        self.taken.clear()

    def cell(self, text: str, across: int, down: int) -> None:
        here = len(self.rows) - 1
        while self.taken.get(self.column, 0) > here:
            self.column += 1
        if text:
            self.rows[-1].append((self.column, text))
        if down > 1:
            for c in range(self.column, min(self.column + across, MOST_ACROSS)):
                self.taken[c] = here + down
        self.column += across

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if r]
        wide: dict[int, int] = {}
        for c, text in (cell for r in rows for cell in r):
            wide[c] = max(wide.get(c, 0), len(text))
        start, before = {}, 0
        for c in sorted(wide):
            start[c] = 2 * c + before  # two blanks after each column, empty ones too
            before += wide[c]
        if sum(start[r[-1][0]] for r in rows) > 64 * sum(len(text) for r in rows for _, text in r) + 4096:
            return ["  ".join(text for _, text in r) for r in rows]
        out = []
        for r in rows:
            line = ""
            for c, text in r:
                line = line.ljust(start[c]) + text
            out.append(line)
        return out


def _span(node: Node, name: str, most: int) -> int:
    """How far a cell spans; 0 rows are all that follow."""
    told = node.attrs.get(name, "").strip()
    told = int(told) if re.fullmatch(r"[0-9]{1,9}", told) else 1
    return min(told, most) or (most if name == "rowspan" else 1)


def render(page: str) -> str:
    """All visible text of a page."""
    flows, tables, lists = [_Flow()], [], []
    pre = 0
    walk: list[tuple[object, bool, bool]] = [(tree(page), False, True)]
    while walk:
        node, leaving, visible = walk.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not visible or (tables and not tables[-1].open and not node.strip()):
                continue  # white space between rows, too
            flow.text(node, pre > 0)
            continue
        tag = node.tag
        if not leaving:
            if node.hidden:
                continue
            if tag == "br":
                if flow.line or not pre:
                    flow.raw(flow.line.rstrip(" ")) if flow.line.strip() else flow.newline()
                continue
            if node.visible is not None:
                visible = node.visible
            walk.append((node, True, visible))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            walk.extend((c, False, visible) for c in reversed(children))
            if tag in ("td", "th") and tables:
                if not tables[-1].rows:
                    tables[-1].row()
                flows.append(_Flow())
                tables[-1].open += 1
                continue
            if tag in BLOCK:
                flow.newline(1 if tag in SPACED and not lists else 0)
            if tag == "pre":
                pre += 1
            elif tag in ("ul", "ol", "menu"):
                start = node.attrs.get("start", "")
                lists.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.indent, flow.marker = flow.indent + " " * len(marker), marker if visible else ""
                node.attrs["\0"] = marker
            elif tag in ("dd", "blockquote"):
                flow.indent += "  "
            elif tag == "table":
                tables.append(_Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in _ROWS and tables:
                tables[-1].group()
        else:
            if tag in ("td", "th") and tables and tables[-1].open:
                cell = _SPACE.sub(" ", flows.pop().done().replace("\n", " ")).strip(" ")
                tables[-1].cell(cell, _span(node, "colspan", MOST_ACROSS), _span(node, "rowspan", MOST_DOWN))
                tables[-1].open -= 1
                continue
            if tag in _ROWS and tables:
                tables[-1].group()
            if tag in BLOCK:
                flow.newline()
            if tag == "pre":
                pre -= 1
            elif tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag == "li":
                flow.indent = flow.indent[: -len(node.attrs["\0"])]
                flow.marker = ""
            elif tag in ("dd", "blockquote"):
                flow.indent = flow.indent[:-2]
            elif tag == "table":
                for line in tables.pop().lines():
                    flow.raw(line)
            if tag in SPACED and not lists and flow.lines:
                flow.gap = 1
    return flows[0].done()


def rendered(pages: DataFrame, html_col: str = "html", name: str = "__html") -> DataFrame:
    """Every row of ``pages`` plus struct ``name``: text, n_lines, n_words.

    A null page has null text and counts of 0; an empty page has empty text. Rows are
    rendered one by one; other columns pass unchanged.
    """

    def batch(b: pa.Array) -> pa.Array:
        out = [None if p is None else render(p) for p in b.to_pylist()]
        lines = [sum(1 for x in (t or "").split("\n") if x.strip()) for t in out]
        words = [len((t or "").encode("utf-8", "replace").split()) for t in out]
        return pa.StructArray.from_arrays(
            [pa.array([t if t is None else t.encode("utf-8", "replace").decode() for t in out], pa.string()),
             pa.array(lines, pa.int64()), pa.array(words, pa.int64())],
            ["text", "n_lines", "n_words"],
        )

    return with_struct(pages, name, F.col(f"`{html_col}`"), "struct<text: string, n_lines: long, n_words: long>", batch)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, text, n_lines, n_words."""
    return rendered(pages.select("page_id", "html")).select("page_id", "__html.text", "__html.n_lines", "__html.n_words")
