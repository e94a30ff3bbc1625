"""Visible text of HTML, laid out: the per-page helper of ``html_text``.

``parse`` builds a tree as browsers do where tags are missing (implied ends of
p, li, dt/dd, option and table parts, implied table rows and bodies, content
misplaced in a table moved before it); ``render`` walks it without recursion.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from unicodedata import east_asian_width

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACED = HEADINGS | frozenset("p ul ol dl blockquote pre table figure menu dir fieldset listing xmp hr".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main nav optgroup option search section summary tr caption".split()
)
CLOSES_P = (BLOCKS - frozenset("body html dd dt li legend caption option optgroup tr".split())) | frozenset("dd dt li".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist title meta link base param source track area col colgroup".split())
TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
SECTIONS = frozenset("tbody thead tfoot".split())
CELLS = frozenset(("td", "th"))
#: Levels of lists, quotes and cells that are indented, so that output stays in proportion to the page.
DEEPEST = 40
FRAMES = frozenset("table td th caption html template".split())  # ends that implied closing does not cross

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>",
    re.S,
)
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'=<>`]+)))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def attr(self, name: str) -> str | None:
        if name not in self.attrs.lower():
            return None
        for m in ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None


class _Builder:
    def __init__(self):
        self.root = Node("html", "", None)
        self.open = [self.root]
        self.count: dict[str, int] = {"html": 1}

    def push(self, tag: str, attrs: str) -> Node:
        node = Node(tag, attrs, self.place(tag))
        if node.parent.children and self.fostered:
            node.parent.children.insert(len(node.parent.children) - 1, node)
        else:
            node.parent.children.append(node)
        self.open.append(node)
        self.count[tag] = self.count.get(tag, 0) + 1
        return node

    fostered = False

    def place(self, tag: str) -> Node:
        """The parent of what comes now; before the table for what cannot stand in it."""
        here = self.open[-1]
        self.fostered = False
        if here.tag in SECTIONS or here.tag in ("table", "tr"):
            if tag not in TABLE_PARTS and tag not in HIDDEN and tag != "form":
                table = next((n for n in reversed(self.open) if n.tag == "table"), None)
                if table is not None and table.parent is not None:
                    self.fostered = bool(table.parent.children) and table.parent.children[-1] is table
                    return table.parent
        return here

    def pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def close(self, tags: frozenset | tuple, within: frozenset = FRAMES) -> bool:
        """Closes up to the innermost of ``tags`` unless a frame comes first."""
        if not any(self.count.get(t) for t in tags):
            return False
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                while len(self.open) > k:
                    self.pop()
                return True
            if self.open[k].tag in within:
                return False
        return False

    def start(self, tag: str, attrs: str, closed: bool) -> None:
        if tag in ("html", "body", "head") and self.count.get(tag):
            return
        if tag in CLOSES_P and self.count.get("head"):
            self.close(("head",))
        if tag in CLOSES_P:
            self.close(("p",), FRAMES | {"button"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop()
        if tag == "li":
            self.close(("li",), FRAMES | {"ul", "ol", "menu", "dir"})
        elif tag in ("dd", "dt"):
            self.close(("dd", "dt"), FRAMES | {"dl"})
        elif tag in ("option", "optgroup"):
            self.close(("option",) if tag == "option" else ("option", "optgroup"), FRAMES | {"select"})
        elif tag in TABLE_PARTS:
            if not self.count.get("table"):
                return  # a part of no table is dropped, its text stays
            stop = frozenset(("table",))
            if tag in CELLS:
                self.close(tuple(CELLS), stop | {"tr"})
                self.close(("caption",), stop)
                if self.open[-1].tag != "tr" and not self.close_to(("tr",), stop):
                    if self.open[-1].tag == "table":
                        self.push("tbody", "")
                    self.push("tr", "")
            elif tag == "tr":
                self.close(("tr",), stop)
                self.close(("caption",), stop)
                self.close_to(tuple(SECTIONS), stop)
                if self.open[-1].tag == "table":
                    self.push("tbody", "")
            else:
                self.close_to(("table",), frozenset())
        node = self.push(tag, attrs)
        if tag in VOID or closed and tag in ("svg", "math", "path", "g"):
            if self.open[-1] is node:
                self.pop()

    def close_to(self, tags: tuple, within: frozenset) -> bool:
        """Closes down to, not including, the innermost of ``tags``."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag in tags:
                while len(self.open) > k + 1:
                    self.pop()
                return True
            if self.open[k].tag in within:
                while len(self.open) > k + 1:
                    self.pop()
                return False
        return False

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "", False)
        elif tag == "p" and not self.count.get("p"):
            self.start("p", "", False)
            self.end("p")
        elif tag in HEADINGS:
            self.close(tuple(HEADINGS))
        elif tag not in ("html", "body"):
            self.close((tag,), FRAMES - {tag} if tag not in ("table", "tr") and tag not in SECTIONS else frozenset(("table",)) - {tag})

    def text(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.pop()
        parent = self.place("#text") if data.strip() else self.open[-1]
        if self.fostered and data.strip():
            parent.children.insert(len(parent.children) - 1, data)
        else:
            parent.children.append(data)


def parse(html: str) -> Node:
    b, at, size = _Builder(), 0, len(html)
    while at < size:
        m = TOKEN.search(html, at)
        upto = m.start() if m else size
        if upto > at:
            b.text(unescape(html[at:upto]))
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            b.end(tag)
            continue
        b.start(tag, m["attrs"] or "", m["attrs"].endswith("/"))
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            data = html[at : stop.start() if stop else size]
            if b.open[-1].tag == tag:
                b.open[-1].children.append(unescape(data) if tag in ("textarea", "title") else data)
                b.pop()
            at = stop.end() if stop else size
    return b.root


def width(text: str) -> int:
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Flow:
    """Lines of one block container, with collapsed spaces and margins."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False  # a space is due before the next word
        self.margin = 0

    def words(self, data: str) -> None:
        if not data:
            return
        flat = SPACE.sub(" ", data)
        if flat == " ":
            self.gap = bool(self.now)
            return
        if (self.gap or flat[0] == " ") and self.now:
            self.now.append(" ")
        self.now.append(flat.strip(" "))
        self.gap = flat[-1] == " "

    def kept(self, data: str) -> None:
        """Text whose spaces and line ends stand."""
        first, *more = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        if self.gap and self.now:
            self.now.append(" ")
        self.gap = False
        self.now.append(first)
        for line in more:
            self.brk()
            self.now.append(line)

    def brk(self) -> None:
        self._out("".join(self.now))
        self.now, self.gap = [], False

    def block(self, margin: int = 0) -> None:
        """Ends the line; at least ``margin`` blank lines before what follows."""
        if any(self.now):
            self.brk()
        self.now, self.gap = [], False
        self.margin = max(self.margin, margin)

    def _out(self, line: str) -> None:
        if self.lines:
            self.lines.extend([""] * self.margin)
        self.margin = 0
        self.lines.append(line.rstrip(" "))

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Lines that are done already, the first and the others behind a prefix."""
        if lines:
            self._out(first + lines[0])
            self.lines.extend([(rest + x).rstrip(" ") for x in lines[1:]] if rest else lines[1:])

    def done(self) -> list[str]:
        self.block()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Grid:
    """Cells of one table by row and column, spans kept clear."""

    def __init__(self):
        self.rows: list[dict[int, tuple[list[str], int]]] = []
        self.taken: dict[int, int] = {}  # column -> rows still covered
        self.caption: list[str] = []

    def row(self) -> None:
        self.rows.append({})
        self.covered = {c for c, n in self.taken.items() if n}
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.at = 0

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        while self.at in self.covered:
            self.at += 1
        self.rows[-1][self.at] = (lines, columns)
        if rows > 1:
            for c in range(self.at, self.at + columns):
                self.taken[c] = rows - 1
        self.at += columns

    def lines(self) -> list[str]:
        wide: dict[int, int] = {}
        for row in self.rows:
            for c, (lines, span) in row.items():
                if span == 1:
                    wide[c] = max(wide.get(c, 0), *(width(x) for x in lines), 0)
        out = list(self.caption)
        started = sorted({c for row in self.rows for c in row})  # columns that spans alone cover take no room
        for row in self.rows:
            for k in range(max((len(lines) for lines, _ in row.values()), default=0)):
                line, edge, col = "", 0, 0
                for c, (lines, _) in sorted(row.items()):
                    edge += sum(wide.get(x, 0) + 2 for x in started[bisect_left(started, col) : bisect_left(started, c)])
                    col = c
                    line += " " * max(edge - width(line), 2 if line else 0)
                    line += lines[k] if k < len(lines) else ""
                out.append(line.rstrip(" "))
        return out


def _number(value: str | None, least: int, most: int, otherwise: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m[1]), least), most) if m else otherwise


def shown(node: Node) -> bool:
    if node.tag in HIDDEN:
        return False
    if not node.attrs:
        return node.tag != "dialog"
    if node.attr("hidden") is not None or node.tag == "dialog" and node.attr("open") is None:
        return False
    if node.tag == "input":
        return (node.attr("type") or "").lower() in ("submit", "button", "reset", "text", "") and bool(node.attr("value"))
    style = node.attr("style")
    return style is None or not NOT_SHOWN.search(style)


def render(root: Node) -> str:
    """All visible text: blocks on lines of their own, blank lines where blocks
    have margins, list marks and indents, quotes behind ``> ``, table cells in
    aligned columns two spaces apart. Lists and quotes nested over ``DEEPEST``
    deep keep their text and marks but are indented no further."""
    flows, grids, lists = [_Flow()], [], []
    work: list = [root]
    kept = 0  # open pre-formatted elements
    while work:
        node = work.pop()
        if isinstance(node, str):
            (flows[-1].kept if kept else flows[-1].words)(node)
            continue
        leave = isinstance(node, tuple)
        node, start = node if leave else (node, None)
        tag = node.tag
        if not leave:
            if not shown(node):
                continue
            if tag == "br":
                flows[-1].brk()
                continue
            if tag == "input":
                flows[-1].words(f" {node.attr('value')} ")
                continue
            closed = tag == "details" and node.attr("open") is None
            below = [c for c in node.children if not closed or not isinstance(c, str) and c.tag == "summary"][:1] if closed else node.children
            if tag == "table" or tag in CELLS or tag in ("li", "blockquote", "dd", "caption"):
                if tag in CELLS and not grids:
                    flows[-1].block()
                elif tag == "table":
                    flows[-1].block(1)
                    grids.append(_Grid())
                if tag not in CELLS or grids:
                    flows.append(_Flow())
            elif tag in BLOCKS:
                flows[-1].block(1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists) else 0)
                if tag == "tr" and grids:
                    grids[-1].row()
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append(_number(node.attr("start"), -(10**9), 10**9, 1) if tag == "ol" else None)
            if tag in ("pre", "textarea", "listing", "xmp"):
                kept += 1
                if below and isinstance(below[0], str) and below[0][:1] == "\n":
                    below = [below[0][1:], *below[1:]]
            work.append((node, len(flows)))
            work.extend(reversed(below))
            continue
        if tag in ("pre", "textarea", "listing", "xmp"):
            kept -= 1
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        if tag == "table":
            own, grid = flows.pop().done(), grids.pop()
            flows[-1].add(own)
            flows[-1].add(grid.lines())
            flows[-1].block(1)
        elif tag in CELLS and grids:
            grids[-1].cell(flows.pop().done(), _number(node.attr("colspan"), 1, 1000, 1), _number(node.attr("rowspan"), 1, 65534, 1))
        elif tag == "caption":
            own = flows.pop().done()
            if grids:
                grids[-1].caption += own
            else:
                flows[-1].block()
                flows[-1].add(own)
        elif tag == "li":
            own = flows.pop().done()
            mark = "- "
            if lists and lists[-1] is not None:
                lists[-1] = _number(node.attr("value"), -(10**9), 10**9, lists[-1])
                mark = f"{lists[-1]}. "
                lists[-1] += 1
            flows[-1].block()
            flows[-1].add(own or [""], mark, " " * len(mark) if len(flows) <= DEEPEST else "")
        elif tag in ("blockquote", "dd"):
            own = flows.pop().done()
            sign = ("> " if tag == "blockquote" else "  ") if len(flows) <= DEEPEST else ""
            flows[-1].block(tag == "blockquote")
            flows[-1].add(own, sign, sign)
            flows[-1].block(tag == "blockquote")
        elif tag in BLOCKS or tag in CELLS:
            flows[-1].block(1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists) else 0)
    return "\n".join(flows[0].done()).replace(" ", " ")
