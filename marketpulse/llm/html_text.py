"""Visible text of web pages, laid out as a reader sees it.

The markup becomes a tree: end tags that HTML implies are supplied (a block
ends a paragraph, an item ends an item, cells end cells, a cell without a row
opens one), stray end tags are ignored, and no end tag reaches out of a table
cell. A walk over the tree then writes all visible text: block elements start
lines, and paragraphs, headings, lists and tables keep a blank line around
them; items get a bullet or their number and are indented by depth; table
cells are aligned in columns two spaces apart; ``pre`` keeps its spacing.

Hidden: head, script, style, template, noscript and embedded content, elements
with ``hidden``, ``display:none`` or ``visibility:hidden``, hidden inputs, and
what a closed ``details`` holds beside its summary.

Every row is its own: null and empty pages give the empty text, repeated rows
and ids repeat their result, an empty table gives an empty result, and other
columns are not read. Nesting may be of any depth (nothing recurses), and time
and output grow with the page: open elements are found by their name, items and
cells more than ``DEEP`` deep are plain blocks without a further indent, and the
columns of a table wider than ``LINE`` characters are padded only up to their
share of it (longer cells stay whole and push the rest of their line aside).
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels of items and cells that are laid out, characters of a table's line.
DEEP, LINE = 40, 400

#: Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video "
                   "canvas svg math datalist title".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div "
                   "dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                   "html legend li main menu nav ol optgroup option p pre search section summary "
                   "table ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav "
                   "ol p pre search section table ul".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template "
                    "title head html".split())
GROUPS = frozenset("thead tbody tfoot".split())
FRAMED = frozenset("td th li dd blockquote".split())
#: A start tag ends the nearest open one of these, unless a barrier comes first.
ENDS = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption"}, {"table"}), "thead": (GROUPS | {"caption"}, {"table"}),
    "tbody": (GROUPS | {"caption"}, {"table"}), "tfoot": (GROUPS | {"caption"}, {"table"}),
}
SCOPE = frozenset({"td", "th", "caption", "table", "template"})

_START = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)>")
_END = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*>")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_OF_NOTE = re.compile(r"hidden|display|visib|span|start|value|open", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(source):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


class Tree:
    """Builds the tree; ``open`` holds the open elements from the root."""

    def __init__(self, source: str):
        self.root = Node("html", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}   # of each open tag its places in ``open``
        self._read(source)

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self.text(html.unescape(s[at:]))
                return
            if lt > at:
                self.text(html.unescape(s[at:lt]))
            c = s[lt + 1: lt + 2]
            if c.isalpha() and c.isascii():
                m = _START.match(s, lt) or _LOOSE.match(s, lt)
                if not m:
                    return  # a tag that never ends hides what is left
                at = m.end()
                tag = m[1].lower()
                self.start(tag, attributes(m[2]) if _OF_NOTE.search(m[2]) else {},
                           m[2].endswith("/"))
                if tag in RAW:
                    end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(s, at)
                    inner = s[at: end.start()] if end else s[at:]
                    if tag in ("textarea", "xmp"):
                        self.text(html.unescape(inner) if tag == "textarea" else inner)
                    at = end.start() if end else n
            elif c == "/":
                m = _END.match(s, lt)
                if m:
                    self.end(m[1].lower())
                    at = m.end()
                else:
                    at = self._after(s, ">", lt + 2)
            elif s.startswith("<!--", lt):
                at = lt + 4 if s.startswith(">", lt + 4) else self._after(s, "-->", lt + 4)
            elif c and c in "!?":
                at = self._after(s, ">", lt + 2)
            else:
                self.text("<")
                at = lt + 1

    @staticmethod
    def _after(s: str, mark: str, at: int) -> int:
        end = s.find(mark, at)
        return len(s) if end < 0 else end + len(mark)

    def text(self, t: str) -> None:
        if t.strip() and len(self.open) == 2 and self.open[-1].tag == "head":
            self._cut(1)  # text begins the body
        if self.open[-1].tag in ("pre", "textarea") and not self.open[-1].children:
            t = t.removeprefix("\n")
        self.open[-1].children.append(t)

    def _last(self, tags: set | frozenset) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _cut(self, k: int) -> None:
        for node in self.open[k:]:
            self.at[node.tag].pop()
        del self.open[k:]

    def _close(self, tags: set | frozenset, barriers: set | frozenset) -> bool:
        """Closes the innermost of ``tags`` unless one of ``barriers`` is further in."""
        k = self._last(tags)
        if not k or k < self._last(barriers):
            return False
        self._cut(k)
        return True

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self._close({"head"}, SCOPE)
            self.open[0].attrs |= attrs if tag == "body" else {}
            return
        if len(self.open) > 1 and self.open[1].tag == "head" and tag not in IN_HEAD:
            self._cut(1)
        if tag in ENDS_P:
            self._close({"p"}, SCOPE)
        if tag in ENDS:
            self._close(*ENDS[tag])
        if tag in ("tr", *GROUPS):
            self._close({"tr"}, {"table"})
        if tag in GROUPS:
            self._close(GROUPS, {"table"})
        if tag in ("td", "th") and self.open[-1].tag in ("table", *GROUPS):
            self._push(Node("tr", {}))
        node = Node(tag, attrs)
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.at.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {}, True)
            return
        barriers = SCOPE - {tag}
        if tag in ("table", "tr", *GROUPS):
            barriers = {"table"} - {tag}
        if not self._close({tag}, barriers) and tag == "p":
            self.open[-1].children.append(Node("p", {}))


class Flow:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False

    def text(self, t: str) -> None:
        t = _SPACE.sub(" ", t)
        if t == " " and not self.now:
            return
        self.now.append(t)

    def raw(self, t: str) -> None:
        first, *rest = t.split("\n")
        self.now.append(first)
        for line in rest:
            self.newline(False)
            self.now.append(line)

    def newline(self, squeeze: bool = True) -> None:
        line = "".join(self.now)
        self.now = []
        self.put([re.sub(" {2,}", " ", line).strip() if squeeze else line.rstrip()])

    def put(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines += lines

    def block(self, spaced: bool = False, squeeze: bool = True) -> None:
        """Ends the line, if one has begun; ``spaced`` asks for a blank line."""
        line = "".join(self.now)
        if line.strip() if squeeze else line:
            self.newline(squeeze)
        self.now = []
        self.gap = self.gap or spaced


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def lines(self) -> list[str]:
        """Cells in columns; a cell over several counts in the first of them."""
        grid: list[dict[int, list[str]]] = []
        taken: dict[int, int] = {}  # column: rows that a cell from above still covers
        for row in self.rows:
            at, out = 0, {}
            for cell, wide, high in row:
                while taken.get(at, 0) > 0:
                    at += 1
                out[at] = cell
                for k in range(at, at + wide):
                    taken[k] = high
                at += wide
            taken = {k: v - 1 for k, v in taken.items() if v > 1}
            grid.append(out)
        widths: dict[int, int] = {}
        for out in grid:
            for k, cell in out.items():
                widths[k] = max([widths.get(k, 0), *map(len, cell)])
        columns = sorted(k for k, w in widths.items() if w)
        if sum(widths[k] for k in columns) > LINE:
            widths = {k: min(widths[k], max(1, LINE // len(columns))) for k in columns}
        result = []
        for out in grid:
            for k in range(max((len(c) for c in out.values()), default=0)):
                parts = [(out[c][k] if c in out and k < len(out[c]) else "").ljust(widths[c])
                         for c in columns]
                line = "  ".join(parts).rstrip()
                result.append(line)
        return [x for k, x in enumerate(result) if x or k and result[k - 1]]


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "1").strip()
    return min(1000, max(1, int(value))) if value.isdecimal() and len(value) < 6 else 1


def _unseen(node: Node) -> bool:
    a = node.attrs
    return (node.tag in HIDDEN or bool(a) and ("hidden" in a or bool(_UNSEEN.search(a.get("style", "")))
            or node.tag == "input" and a.get("type", "").lower() == "hidden"))


class Page:
    """The walk: enters and leaves each visible element once."""

    def __init__(self):
        self.flows = [Flow()]
        self.lists: list[int | None] = []   # of each open list the next number
        self.tables: list[Table] = []
        self.pre = 0
        self.deep = 0                        # open items and cells beyond DEEP

    def enter(self, node: Node) -> None:
        tag, flow = node.tag, self.flows[-1]
        if tag in FRAMED and (self.deep or len(self.flows) > DEEP):
            self.deep += 1
            flow.block(False, not self.pre)
            if tag == "li":
                flow.text(self._mark())
            return
        if tag == "br":
            flow.newline(not self.pre)
        elif tag == "input":
            if node.attrs.get("value") and node.attrs.get("type", "text").lower() != "password":
                flow.text(f" {node.attrs['value']} ")
        elif tag in ("td", "th"):
            self.flows.append(Flow())
        elif tag == "tr":
            if self.tables:
                self.tables[-1].rows.append([])
        elif tag in BLOCKS:
            flow.block(tag in SPACED and not (tag in LISTS and self.lists), not self.pre)
            if tag in LISTS:
                first = node.attrs.get("start", "1")
                numbered = tag == "ol"
                self.lists.append((int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1)
                                  if numbered else None)
            elif tag in ("li", "dd", "blockquote"):
                self.flows.append(Flow())
            elif tag == "table":
                self.tables.append(Table())
        if tag in ("pre", "textarea", "xmp"):
            self.pre += 1

    def _mark(self) -> str:
        """What goes before an item."""
        if not self.lists or self.lists[-1] is None:
            return "- "
        self.lists[-1] += 1
        return f"{self.lists[-1] - 1}. "

    def leave(self, node: Node) -> None:
        tag, flow = node.tag, self.flows[-1]
        if tag in FRAMED and self.deep:
            self.deep -= 1
            flow.block(False, not self.pre)
            return
        if tag in ("td", "th"):
            lines = self._inner()
            if self.tables and self.tables[-1].rows:
                self.tables[-1].rows[-1].append((lines, _span(node, "colspan"), _span(node, "rowspan")))
            else:  # a cell outside any table is a block
                self._add(lines)
        elif tag in LISTS:
            flow.block(not self.lists[1:], not self.pre)
            self.lists.pop()
        elif tag in ("li", "dd", "blockquote"):
            mark = "  "
            if tag == "li":
                mark = self._mark()
            lines = self._inner()
            pad = " " * len(mark)
            if tag != "li":
                mark = pad
            self._add([(mark if k == 0 else pad) + x if x else x for k, x in enumerate(lines)])
            if tag == "blockquote":
                self.flows[-1].block(True)
        elif tag == "table":
            self._add(self.tables.pop().lines())
            flow.gap = True
        elif tag in BLOCKS:
            flow.block(tag in SPACED, not self.pre)
        if tag in ("pre", "textarea", "xmp"):
            self.pre -= 1

    def _inner(self) -> list[str]:
        flow = self.flows.pop()
        flow.block(squeeze=not self.pre)
        return flow.lines

    def _add(self, lines: list[str]) -> None:
        if lines:
            self.flows[-1].block()
            self.flows[-1].put(lines)

    def walk(self, root: Node) -> str:
        path = [(root, iter(root.children))] if not _unseen(root) else []
        while path:
            node, rest = path[-1]
            child = next(rest, None)
            if child is None:
                path.pop()
                if path:
                    self.leave(node)
            elif isinstance(child, str):
                (self.flows[-1].raw if self.pre else self.flows[-1].text)(child)
            elif not _unseen(child):
                self.enter(child)
                children = child.children
                if child.tag == "details" and "open" not in child.attrs:
                    children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
                path.append((child, iter(children)))
        lines = self._inner()
        return "\n".join(lines).strip("\n")


def render(source: str | None) -> str:
    """The visible text of a page."""
    return Page().walk(Tree(source.replace("\r\n", "\n")).root) if source else ""


def _render_all(batches):
    for batch in batches:
        texts = [render(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                         ["page_id", "text"])


def extract(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """(page_id, text) of each row of ``pages``."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"),
                        F.col(source).cast("string").alias("html"))
    return rows.mapInArrow(_render_all, "page_id long, text string")
