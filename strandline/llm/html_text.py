"""Visible text of HTML pages, laid out as a text browser would.

A tree is built with the tags that authors may leave out implied, elements that a
browser does not show are passed over, and what is left is emitted block by block:
blank lines between blocks, markers and indents for lists, cells of tables in columns.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices

#: A column is padded to its widest cell, but not beyond this.
WIDEST = 80
#: A table is not padded if that made it longer than its content by this factor.
BLOWN_UP = 100
ENDLESS = 1 << 62

# Element names by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
UNESCAPED = frozenset(["textarea", "title"])
HIDDEN = frozenset(
    "head script style template noscript title meta link base datalist iframe noembed noframes "
    "object audio video canvas svg map param source track rp".split()
)
BLOCKS = frozenset(
    "address article aside body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form header hgroup html legend li main menu nav ol optgroup option p pre search "
    "section summary table ul blockquote h1 h2 h3 h4 h5 h6 hr caption tr td th thead tbody tfoot".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre table figure hr fieldset".split())
CLOSES_P = BLOCKS - frozenset("html body li dd dt td th tr caption thead tbody tfoot option optgroup".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
#: A start tag ends these open elements, if no element of the second set is between.
LISTS = frozenset("ul ol menu dir".split())
IMPLIED_END = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset("td th caption".split()), frozenset(["tr", "table"])),
    "th": (frozenset("td th caption".split()), frozenset(["tr", "table"])),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "caption": (frozenset(["caption"]), frozenset(["table"])),
}
#: An end tag does not reach beyond these.
SCOPE = frozenset("table td th caption html template".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    """An element: name, attributes, and children that are nodes or texts."""

    __slots__ = ("name", "attributes", "children", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


class Builder:
    """Builds the tree from tags and texts, whatever their order."""

    def __init__(self) -> None:
        self.root = self.at = Node("html", {}, None)
        self.body: Node | None = None
        self.opened: Counter[str] = Counter()  # open elements by name

    def open(self, name: str, attributes: dict[str, str]) -> Node:
        node = Node(name, attributes, self.at)
        self.at.children.append(node)
        self.at = node
        self.opened[name] += 1
        return node

    def close_up_to(self, node: Node) -> None:
        while True:
            last = self.at
            self.opened[last.name] -= 1
            self.at = last.parent or self.root
            if last is node:
                return

    def nearest(self, names: frozenset, barrier: frozenset) -> Node | None:
        if not any(self.opened[n] for n in names):
            return None
        node = self.at
        while node is not None and node.name not in barrier:
            if node.name in names:
                return node
            node = node.parent
        return None

    def in_body(self) -> None:
        """Body content ends the head and begins a body."""
        if self.body is None:
            if self.at is not self.root:
                outer = self.at
                while outer.parent is not self.root:
                    outer = outer.parent
                self.close_up_to(outer)
            self.body = self.open("body", {})

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "html":
            return
        if name == "head":
            if self.body is None and self.at is self.root:
                self.open("head", attributes)
            return
        if name == "body":
            if self.body is None:
                self.in_body()
                self.body.attributes = attributes
            return
        if self.body is None:
            if name in HEAD_ONLY:
                self.open(name, attributes)
                if name in VOID:
                    self.close_up_to(self.at)
                return
            self.in_body()
        if name in IMPLIED_END:
            ends, barrier = IMPLIED_END[name]
            while (node := self.nearest(ends, barrier)) is not None:
                self.close_up_to(node)
        if name in CLOSES_P:
            p = self.nearest(frozenset(["p"]), SCOPE | {"button", "li", "dd", "dt"})
            if p is not None:
                self.close_up_to(p)
        if name in ("td", "th") and self.nearest(frozenset(["tr"]), frozenset(["table"])) is None:
            if self.nearest(frozenset(["table"]), frozenset()) is not None:
                self.open("tr", {})
        self.open(name, attributes)
        if name in VOID:
            self.close_up_to(self.at)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
        elif name == "p" and self.nearest(frozenset(["p"]), SCOPE) is None:
            self.in_body()
            self.close_up_to(self.open("p", {}))
        elif name in ("html", "body"):
            return
        else:
            barrier = frozenset() if name in SCOPE else SCOPE
            if name in ("tr", "thead", "tbody", "tfoot"):
                barrier = frozenset(["table"])
            node = self.nearest(frozenset([name]), barrier)
            if node is not None and node is not self.root and node is not self.body:
                self.close_up_to(node)

    def text(self, text: str) -> None:
        if self.body is None and self.at.name in ("html", "head"):
            if not text.strip(" \t\n\r\f"):
                return
            self.in_body()
        self.at.children.append(text)


def parse(page: str) -> Node:
    """The tree of a page; any text is a page."""
    builder = Builder()
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            builder.text(html.unescape(page[at:stop]))
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            builder.end(name)
            continue
        given = found[3]
        builder.start(name, attributes_of(given) if given and not given.isspace() else {})
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*>?", re.IGNORECASE).search(page, at)
            raw = page[at : close.start() if close else end]
            if raw and builder.at.name == name:
                builder.at.children.append(html.unescape(raw) if name in UNESCAPED else raw)
            at = close.end() if close else end
            builder.end(name)
        elif name == "plaintext":
            builder.text(page[at:])
            break
    return builder.root


def shown(node: Node) -> bool:
    """Whether a browser shows the element."""
    a = node.attributes
    if node.name in HIDDEN or "hidden" in a:
        return False
    if node.name == "dialog" and "open" not in a:
        return False
    if node.name == "input" and a.get("type", "").lower() == "hidden":
        return False
    return not ("style" in a and _UNSEEN.search(a["style"]))


class Block:
    """Lines of one column of text, with indents and pending space."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.words: list[str] = []
        self.gap = 0
        self.indents: list[str] = []
        self.marker: str | None = None
        self.space = False

    def add(self, text: str) -> None:
        """Text whose runs of blanks count as one, and none at the begin of a line."""
        for at, part in enumerate(_BLANKS.split(text)):
            if at and self.words:
                self.space = True
            if part:
                if self.space:
                    self.words.append(" ")
                self.space = False
                self.words.append(part)

    def put(self, line: str) -> None:
        """One whole line as it is."""
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0
        indent = "".join(self.indents)
        if self.marker is not None:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = None
        self.lines.append((indent + line).rstrip())

    def break_line(self) -> None:
        if self.words:
            line, self.words = "".join(self.words), []
            self.put(line)
        self.space = False

    def block(self, gap: int) -> None:
        self.break_line()
        self.gap = max(self.gap, gap)


class Grid:
    """Columns that no cell from above covers, as gaps in order; what a cell covers
    comes free again after its last row."""

    def __init__(self) -> None:
        self.begins, self.ends = [0], [ENDLESS]
        self.freed: dict[int, list[tuple[int, int]]] = {}

    def free(self, row: int) -> None:
        """Columns of cells that ended above this row are gaps again."""
        for begin, end in self.freed.pop(row, ()):
            at = bisect_left(self.begins, begin)
            after = at < len(self.begins) and self.begins[at] == end
            before = at > 0 and self.ends[at - 1] == begin
            first, past = at - before, at + after
            begin = self.begins[first] if before else begin
            end = self.ends[at] if after else end
            self.begins[first:past], self.ends[first:past] = [begin], [end]

    def place(self, row: int, cells: list[tuple[int, int]]) -> list[int]:
        """First columns of cells (columns wide, rows high) of one row.  A cell ends at
        the latest where one from above begins."""
        starts, left = [], []
        gap, at = 0, self.begins[0]
        for wide, high in cells:
            if at == self.ends[gap]:
                gap += 1
                at = self.begins[gap]
            end = min(at + wide, self.ends[gap])
            starts.append(at)
            if high > 1:
                self.freed.setdefault(row + high, []).append((at, end))
            elif left and left[-1][1] == at:
                left[-1] = (left[-1][0], end)
            else:
                left.append((at, end))
            at = end
        if at < self.ends[gap]:
            if left and left[-1][1] == at:
                left[-1] = (left[-1][0], self.ends[gap])
            else:
                left.append((at, self.ends[gap]))
        self.begins[: gap + 1] = [x for x, _ in left]
        self.ends[: gap + 1] = [x for _, x in left]
        return starts


def columns(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table: cells (lines, columns wide, rows high) side by side, each
    column padded to its widest cell.

    Columns in which no cell begins take no room.  A table that padding would blow up
    (many lines far to the right) has its cells two blanks apart instead, so time and
    length stay in proportion to the page.
    """
    grid, placed, width = Grid(), [], {}
    content = 0
    for number, row in enumerate(rows):
        grid.free(number)
        below = len(rows) - number
        starts = grid.place(number, [(wide, min(high, below)) for _, wide, high in row])
        placed.append(starts)
        for at, (lines, wide, _) in zip(starts, row):
            width.setdefault(at, 0)
            content += 2 + sum(map(len, lines))
            longest = max(map(len, lines), default=0)
            if wide == 1 and longest <= WIDEST:
                width[at] = max(width[at], longest)
    used = sorted(width)
    offset = dict(zip(used, accumulate((width[c] + 2 for c in used), initial=0)))
    tall = [max((len(lines) for lines, _, _ in row), default=0) for row in rows]
    padded = sum(n * (offset[starts[-1]] + len(starts)) for n, starts in zip(tall, placed) if starts)
    out = []
    for row, starts, high in zip(rows, placed, tall):
        if padded > BLOWN_UP * content:
            out += _unpadded([lines for lines, _, _ in row])
            continue
        for i in range(high):
            parts, begin = [], 0
            for at, (lines, _, _) in zip(starts, row):
                text = lines[i] if i < len(lines) else ""
                parts.append(" " * (offset[at] - begin) + text.ljust(width[at]) + "  ")
                begin = offset[at] + width[at] + 2
            out.append("".join(parts).rstrip())
    return out


def _unpadded(cells: list[list[str]]) -> list[str]:
    """Cells of one row behind each other; a cell goes on where the one before ends."""
    out, line = [], []
    for lines in cells:
        line += lines[:1]
        for more in lines[1:]:
            out.append("  ".join(line).rstrip())
            line = [more]
    return [*out, "  ".join(line).rstrip()] if line else out


def _whole(text: str | None, least: int, most: int) -> int:
    try:
        return min(most, max(least, int(text or "")))
    except ValueError:
        return least


class Renderer:
    """Walks a tree, without recursion, and lays out what is shown."""

    def __init__(self) -> None:
        self.stack = [Block()]
        self.tables: list[list[list[tuple[list[str], int, int]]]] = []
        self.counters: list[int | None] = []
        self.pre = 0

    def text(self, text: str) -> None:
        block = self.stack[-1]
        if not self.pre:
            block.add(text)
            return
        parts = text.replace("\r\n", "\n").split("\n")
        for part in parts[:-1]:
            block.words.append(part)
            block.put("".join(block.words))
            block.words = []
        if parts[-1]:
            block.words.append(parts[-1])

    def enter(self, node: Node) -> None:
        name, block = node.name, self.stack[-1]
        if name == "br":
            if block.words:
                block.break_line()
            else:
                block.put("")
            return
        if name == "input":
            if node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                block.add(f" {node.attributes.get('value', '')} ")
            return
        if name not in BLOCKS:
            return
        if name in ("td", "th") and self.tables:
            self.stack.append(Block())
            return
        nested = name in LISTS and bool(self.counters)
        block.block(2 if name in SPACED and not nested else 1)
        if name == "table":
            self.tables.append([])
        elif name == "tr" and self.tables:
            self.tables[-1].append([])
        elif name in LISTS:
            start = _whole(node.attributes.get("start", "1"), -(10**9), 10**9)
            self.counters.append(start if name == "ol" else None)
            block.indents.append("")
        elif name == "li":
            number = self.counters[-1] if self.counters else None
            marker = "- " if number is None else f"{number}. "
            if number is not None:
                self.counters[-1] = number + 1
            block.indents.append(" " * len(marker))
            block.marker = marker
        elif name in ("blockquote", "dd"):
            block.indents.append("  ")
        elif name == "pre":
            self.pre += 1

    def leave(self, node: Node) -> None:
        name = node.name
        if name not in BLOCKS:
            return
        if name in ("td", "th") and self.tables:
            cell = self.stack.pop()
            cell.break_line()
            wide = _whole(node.attributes.get("colspan"), 1, 1000)
            high = _whole(node.attributes.get("rowspan"), 1, 65534)
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((cell.lines, wide, high))
            return
        block = self.stack[-1]
        nested = name in LISTS and len(self.counters) > 1
        block.block(2 if name in SPACED and not nested else 1)
        if name == "table" and self.tables:
            for line in columns(self.tables.pop()):
                block.put(line)
            block.block(2)
        elif name in LISTS:
            self.counters.pop()
            block.indents.pop()
        elif name == "li":
            block.indents.pop()
            block.marker = None
        elif name in ("blockquote", "dd"):
            block.indents.pop()
        elif name == "pre":
            self.pre -= 1

    def render(self, root: Node) -> str:
        todo: list[tuple[Node | str, bool]] = [(root, True)]
        while todo:
            item, entering = todo.pop()
            if isinstance(item, str):
                self.text(item)
            elif not entering:
                self.leave(item)
            elif shown(item):
                self.enter(item)
                todo.append((item, False))
                inner = item.children
                if item.name == "details" and "open" not in item.attributes:
                    inner = [c for c in inner if isinstance(c, Node) and c.name == "summary"][:1]
                todo += [(c, True) for c in reversed(inner)]
        block = self.stack[0]
        block.break_line()
        lines = block.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return "\n".join(lines)


def visible_text(page: str) -> str:
    """The text that a page shows, laid out; empty for an empty page."""
    return Renderer().render(parse(page))


def extracted(pages: DataFrame, page_id: str = "page_id", page: str = "html") -> DataFrame:
    """For every row of ``pages``: ``page_id``, the visible ``text``, ``n_chars`` and
    ``n_lines``.

    A null or empty page has the text '' and no lines.  Broken markup, unknown tags
    and plain text are read as a browser would.  Repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, 4 << 20):
                texts = [visible_text(x or "") for x in batch.column(1).to_pylist()]
                lines = [t.count("\n") + 1 if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(texts, pa.string()),
                        pa.array(list(map(len, texts)), pa.int64()), pa.array(lines, pa.int64()),
                    ],
                    ["page_id", "text", "n_chars", "n_lines"],
                )

    picked = pages.select(F.col(page_id).alias("page_id"), F.col(page).alias("html"))
    kind = picked.schema["page_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"page_id {kind}, text string, n_chars bigint, n_lines bigint")
