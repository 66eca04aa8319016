"""The visible text of an HTML page, laid out as lines.

A tree builder supplies the tags a page leaves out; a renderer walks the tree, leaves out what is not
shown, and emits all other text with the spacing of its blocks, markers of lists and aligned cells of
tables. Scripts are not run; ``display`` and ``visibility`` are taken from ``hidden`` and ``style``
attributes and from the style sheets in the page, see ``styles``. Elements may be nested to any depth:
nothing here calls itself, ``run`` keeps the calls of the renderer in a list.

Blocks know their width and height and are put together once, when the whole page is painted, so a line is
not copied for each of the lists, quotes and tables it is in.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html import unescape
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.llm import styles

# What is put before and between texts may take so many times the characters of a page's lines and this
# much more. Where it would take more, nothing begins further right than a column for which it does not.
PADDING, FREE_PADDING = 20, 1 << 24
# The limits of spans in tables.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes plaintext".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks with a blank line around them, and those on lines of their own only.
SPACED = HEADINGS | frozenset("p blockquote pre dl figure table ul ol menu dir xmp listing".split())
BLOCKS = SPACED | frozenset(
    """address article aside body center dd details dialog div dt fieldset figcaption footer form header
    hgroup html legend li main nav optgroup option search section summary tr caption thead tbody tfoot
    td th""".split()
)
NOT_SHOWN = frozenset(
    """script style head title template datalist iframe object canvas audio video noembed noframes map
    area param source track col colgroup rp""".split()
)
CLOSES_P = (BLOCKS | {"hr"}) - frozenset("body html option optgroup tr td th thead tbody tfoot caption".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script template noscript".split())
LISTS = frozenset("ul ol menu dir".split())
SECTIONS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
# A start tag ends open elements of the first set, looking no further up than the second.
IMPLIED_END = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "td": (CELLS, frozenset(["tr", "table"])),
    "th": (CELLS, frozenset(["tr", "table"])),
    "thead": (SECTIONS | {"caption", "colgroup"}, frozenset(["table"])),
    "tbody": (SECTIONS | {"caption", "colgroup"}, frozenset(["table"])),
    "tfoot": (SECTIONS | {"caption", "colgroup"}, frozenset(["table"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
}
# An end tag looks no further up than these.
SCOPE = frozenset("table td th caption html template object".split())
TABLE_TAGS = SECTIONS | CELLS | frozenset("table tr caption".split())

SPACE = re.compile(r"[ \t\n\r\f]+")
TAG = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))
    |<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(
    r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+""", re.S
)


class Node:
    __slots__ = ("name", "attributes", "children", "display", "visibility")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name = name
        self.attributes = attributes or {}
        self.children: list[Node | str] = []
        # What the style attribute and style sheets say, if they do.
        self.display: str | None = None
        self.visibility: str | None = None


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class Builder:
    """Builds the tree from start tags, end tags and text, in the order of the page."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.body = Node("body")
        self.head: Node | None = Node("head")
        self.root.children += [self.head, self.body]
        self.stack = [self.root, self.head]
        # By name, the places in the stack of the open elements within head or body.
        self.places: dict[str, list[int]] = {}
        self.sheets: list[str] = []

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def leave_head(self) -> None:
        if self.head is not None:
            self.head = None
            self.stack = [self.root, self.body]
            self.places = {}

    def text(self, text: str) -> None:
        if self.head is not None and len(self.stack) == 2:
            if not text.strip(" \t\n\r\f"):
                return
            self.leave_head()
        if text:
            self.top.children.append(text)

    def open_place(self, names: frozenset[str], stop: frozenset[str]) -> int | None:
        """Where in the stack the innermost of ``names`` is, unless one of ``stop`` is further in."""
        at = self.innermost(names)
        return None if at < 0 or self.innermost(stop) > at else at

    def innermost(self, names: frozenset[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, node: Node) -> None:
        self.top.children.append(node)
        self.places.setdefault(node.name, []).append(len(self.stack))
        self.stack.append(node)

    def close(self, at: int) -> None:
        """Ends the open elements from a place of the stack on."""
        for node in self.stack[at:]:
            self.places[node.name].pop()
        del self.stack[at:]

    def start(self, name: str, attributes: dict[str, str]) -> Node | None:
        if name in ("html", "body", "head"):
            if name == "body":
                self.leave_head()
            own = {"html": self.root, "body": self.body}.get(name)
            for key, value in attributes.items() if own else ():
                own.attributes.setdefault(key, value)
            return None
        if self.head is not None and len(self.stack) == 2 and name not in HEAD_ONLY:
            self.leave_head()
        if name in CLOSES_P:
            at = self.open_place(frozenset(["p"]), SCOPE | {"button"})
            if at is not None:
                self.close(at)
        if name in HEADINGS and self.top.name in HEADINGS:
            self.close(len(self.stack) - 1)
        if name in IMPLIED_END:
            closes, stop = IMPLIED_END[name]
            while (at := self.open_place(closes, stop)) is not None:
                self.close(at)
        if name in TABLE_TAGS and name != "table":
            self.table_parts(name)
        node = Node(name, attributes)
        if name in VOID:
            self.top.children.append(node)
        else:
            self.push(node)
        return node

    def table_parts(self, name: str) -> None:
        """Opens the rows and bodies that a cell or row leaves out, inside a table only."""
        table = self.open_place(frozenset(["table"]), frozenset())
        if table is None:
            return
        # What is still open between the part and its table ends here.
        fits = {"tr": SECTIONS, "td": frozenset(["tr"]), "th": frozenset(["tr"])}.get(name, frozenset())
        at = self.open_place(fits | {"table"}, frozenset())
        self.close(at + 1)
        if name in ("tr", "td", "th") and self.top.name == "table":
            self.push(Node("tbody"))
        if name in CELLS and self.top.name != "tr":
            self.push(Node("tr"))

    def end(self, name: str) -> None:
        if name == "head":
            self.leave_head()
        elif name == "br":
            self.start("br", {})
        elif name not in ("html", "body"):
            stop = frozenset(["table"]) if name in TABLE_TAGS else SCOPE
            at = self.open_place(frozenset([name]), stop - {name})
            if at is not None:
                self.close(at)
            elif name == "p":
                self.start("p", {})
                self.end("p")


def parse(html: str) -> Node:
    """The tree of a page: ``html`` with ``head`` and ``body``, whatever the page says."""
    builder = Builder()
    at = 0
    while True:
        found = TAG.search(html, at)
        builder.text(unescape(html[at : found.start() if found else len(html)]))
        if not found:
            styles.apply(builder.root, builder.sheets)
            return builder.root
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["end"] or found["end2"]:
            builder.end(name)
            continue
        rest = found["rest"] or found["rest2"] or ""
        node = builder.start(name, attributes_of(rest) if rest.strip("/ \n\t") else {})
        if name in RAW or name in ESCAPABLE_RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            inner = html[at : closing.start() if closing else len(html)]
            if node is not None:
                node.children.append(unescape(inner) if name in ESCAPABLE_RAW else inner)
                if name == "style" and styles.is_for_screens(node.attributes):
                    builder.sheets.append(inner)
            builder.end(name)
            if closing:
                end = html.find(">", closing.end())
                at = end + 1 if end >= 0 else len(html)
            else:
                at = len(html)


def shown(node: Node) -> bool:
    """Whether an element has a box at all."""
    name, attributes = node.name, node.attributes
    if name in NOT_SHOWN:
        return False
    if name == "input" and attributes.get("type", "").lower() == "hidden":
        return False
    if node.display is not None:
        return node.display != "none"
    return "hidden" not in attributes and (name != "dialog" or "open" in attributes)


def visible(node: Node, inherited: bool) -> bool:
    """Whether the text of an element is painted; its children may differ."""
    if node.visibility in (None, "inherit", "unset"):
        return inherited
    return node.visibility in ("visible", "initial")


@dataclass(frozen=True)
class Inset:
    """Lines with ``first`` before the first of them, the others as far in."""

    first: str
    lines: list[Entry]
    height: int = field(init=False)
    width: int = field(init=False)

    def __post_init__(self) -> None:
        height, width = extent(self.lines)
        object.__setattr__(self, "height", height)
        object.__setattr__(self, "width", len(self.first) + width)


@dataclass(frozen=True)
class Grid:
    """Cells, each with its top line, its first column, and its lines; by rows, from left to right."""

    cells: list[tuple[int, int, list[Entry]]]
    height: int
    width: int


Entry = str | Inset | Grid


def extent(lines: list[Entry]) -> tuple[int, int]:
    """Height and width of what lines hold."""
    height = width = 0
    for entry in lines:
        if isinstance(entry, str):
            height += 1
            width = max(width, len(entry))
        else:
            height += entry.height
            width = max(width, entry.width)
    return height, width


def flat(lines: list[Entry]) -> list[str]:
    """All lines as they stand. Pieces of a line keep their order and cells two spaces between them.

    Depth and wide cells push texts to the right without a bound, and a page of many such lines would be
    blanks for the most part; see PADDING for what is done there. No text is lost.
    """
    canvas: list[list[tuple[int, bool, str]]] = [[] for _ in range(extent(lines)[0])]
    # Lines with the place of their first character, and whether they begin a cell. What is put on top
    # is painted first, so the pieces of a line come from left to right.
    blocks: list[tuple[list[Entry], int, int, bool]] = [(lines, 0, 0, False)]
    while blocks:
        entries, row, column, in_cell = blocks.pop()
        for entry in entries:
            if isinstance(entry, str):
                if entry:
                    canvas[row].append((column, in_cell, entry))
                row += 1
            elif isinstance(entry, Inset):
                canvas[row].append((column, in_cell, entry.first))
                blocks.append((entry.lines, row, column + len(entry.first), False))
                row += entry.height
            else:
                for top, start, cell in reversed(entry.cells):
                    blocks.append((cell, row + top, column + start, True))
                row += entry.height
    furthest = [pieces[-1][0] if pieces else 0 for pieces in canvas]
    room = FREE_PADDING + PADDING * sum(len(text) for pieces in canvas for *_, text in pieces)
    limit = max(furthest, default=0)
    while sum(min(column, limit) for column in furthest) > room:
        limit //= 2
    out = []
    for pieces in canvas:
        line: list[str] = []
        end = 0
        for column, in_cell, text in pieces:
            gap = max(min(column, limit) - end, 2 if in_cell and end else 0)
            line.append(" " * gap + text)
            end += gap + len(text)
        out.append("".join(line))
    return out


class Lines:
    """Lines of text as they come, with collapsed spaces and margins."""

    def __init__(self) -> None:
        self.lines: list[Entry] = []
        self.parts: list[str] = []
        self.after_space = True
        self.margin = 0

    def text(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if self.after_space and text[:1] == " ":
            text = text[1:]
        if text:
            self.parts.append(text)
            self.after_space = text[-1] == " "

    def put(self, line: Entry) -> None:
        if self.lines and self.margin:
            self.lines += [""] * self.margin
        self.margin = 0
        self.lines.append(line)

    def end_line(self) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.after_space = [], True
        if line:
            self.put(line)

    def line_break(self) -> None:
        if self.parts:
            self.end_line()
        elif self.lines and not self.margin:
            self.put("")

    def block(self, margin: int) -> None:
        self.end_line()
        self.margin = max(self.margin, margin)

    def add(self, lines: list[Entry]) -> None:
        self.end_line()
        for line in lines:
            self.put(line)

    def finish(self) -> list[Entry]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start]:
            start += 1
        return self.lines[start:]


# A call that yields the calls it needs and is sent their results.
Call = Generator["Call", Any, Any]


def run(call: Call) -> Any:
    """The result of a call and all those within it, however deep."""
    calls, result = [call], None
    while calls:
        try:
            calls.append(calls[-1].send(result))
            result = None
        except StopIteration as done:
            calls.pop()
            result = done.value
    return result


def lines_of(node: Node, painted: bool, as_is: bool = False, in_list: bool = False) -> Call:
    out = Lines()
    yield flow(node, out, painted, as_is, in_list)
    return out.finish()


def flow(node: Node, out: Lines, painted: bool, as_is: bool, in_list: bool) -> Call:
    """Puts the children of a node into ``out``."""
    for child in node.children:
        if isinstance(child, str):
            if painted:
                verbatim(child, out) if as_is else out.text(child)
        elif shown(child):
            yield element(child, out, painted, as_is, in_list)


def verbatim(text: str, out: Lines) -> None:
    first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    out.parts.append(first)
    out.after_space = False
    for line in rest:
        out.put("".join(out.parts))
        out.parts = [line]


def element(node: Node, out: Lines, painted: bool, as_is: bool, in_list: bool) -> Call:
    name = node.name
    painted = visible(node, painted)
    if name == "br":
        out.line_break()
    elif name == "hr":
        out.block(1)
    elif name in LISTS:
        margin = 0 if in_list else 1
        out.block(margin)
        yield items(node, out, painted)
        out.block(margin)
    elif name == "table":
        out.block(1)
        out.add((yield table_lines(node, painted)))
        out.block(1)
    elif name in ("pre", "xmp", "listing", "textarea"):
        out.block(1)
        inner = Node(name)
        inner.children = list(node.children)
        if inner.children and isinstance(inner.children[0], str):
            inner.children[0] = inner.children[0].removeprefix("\n")
        lines = yield lines_of(inner, painted, as_is=True)
        out.add([line.rstrip() if isinstance(line, str) else line for line in lines])
        out.block(1)
    elif name == "details" and "open" not in node.attributes:
        out.block(0)
        for child in node.children:
            if isinstance(child, Node) and child.name == "summary" and shown(child):
                yield element(child, out, painted, as_is, in_list)
                break
        out.block(0)
    elif name == "dd":
        out.block(0)
        lines = yield lines_of(node, painted, as_is)
        if lines:
            out.add([Inset("    ", lines)])
        out.block(0)
    elif name == "blockquote":
        out.block(1)
        lines = yield lines_of(node, painted, as_is)
        if lines:
            out.add([Inset("  ", lines)])
        out.block(1)
    elif name == "q":
        if painted:
            out.text("“")
        yield flow(node, out, painted, as_is, in_list)
        if painted:
            out.text("”")
    elif name in BLOCKS:
        margin = 1 if name in SPACED else 0
        out.block(margin)
        yield flow(node, out, painted, as_is, in_list)
        out.block(margin)
    else:
        yield flow(node, out, painted, as_is, in_list)


def number_of(node: Node, key: str, otherwise: int) -> int:
    found = re.match(r"\s*([+-]?[0-9]{1,9})", node.attributes.get(key, ""))
    return int(found[1]) if found else otherwise


def items(node: Node, out: Lines, painted: bool) -> Call:
    """The items of a list with their markers, further lines indented below the first."""
    ordered = node.name == "ol"
    step = -1 if ordered and "reversed" in node.attributes else 1
    count = sum(isinstance(c, Node) and c.name == "li" for c in node.children)
    number = number_of(node, "start", count if step < 0 else 1)
    for child in node.children:
        if isinstance(child, str):
            if painted:
                out.text(child)
        elif not shown(child):
            continue
        elif child.name != "li":
            yield element(child, out, painted, False, True)
        else:
            number = number_of(child, "value", number) if ordered else number
            marker = f"{number}. " if ordered else "- "
            lines = yield lines_of(child, visible(child, painted), in_list=True)
            if lines:
                out.add([Inset(marker, lines)])
            number += step


def rows_of(table: Node) -> Iterator[Node]:
    """Rows, heads first and feet last, wherever they stand."""
    parts: dict[str, list[Node]] = {"thead": [], "tbody": [], "tfoot": []}
    for child in table.children:
        if isinstance(child, Node) and shown(child):
            if child.name == "tr":
                parts["tbody"].append(child)
            elif child.name in parts:
                parts[child.name] += [
                    row
                    for row in child.children
                    if isinstance(row, Node) and row.name == "tr" and shown(row)
                ]
    for part in parts.values():
        yield from part


class Columns:
    """The columns that cells from rows above cover, and those that are free, as intervals."""

    def __init__(self) -> None:
        # Free intervals from left to right.
        self.starts = [0]
        self.ends = [1 << 62]
        # Covered ones from left to right: first column, the one after the last, first row that is free.
        self.covered: list[tuple[int, int, int]] = []
        self.expiring: dict[int, list[tuple[int, int, int]]] = {}

    def next_row(self, row: int) -> None:
        """Columns whose cell from above ended with the row before are free again."""
        for piece in self.expiring.pop(row, ()):
            i = bisect_left(self.covered, piece)
            # It may have been cut, or covered for longer, since.
            if i < len(self.covered) and self.covered[i] == piece:
                del self.covered[i]
                self._free(piece[0], piece[1])

    def _free(self, start: int, end: int) -> None:
        i = bisect_left(self.starts, start)
        if i and self.ends[i - 1] == start:
            i -= 1
            start = self.starts[i]
            del self.starts[i], self.ends[i]
        if i < len(self.starts) and self.starts[i] == end:
            end = self.ends[i]
            del self.starts[i], self.ends[i]
        self.starts.insert(i, start)
        self.ends.insert(i, end)

    def free_from(self, column: int) -> int:
        i = bisect_right(self.starts, column) - 1
        if i >= 0 and column < self.ends[i]:
            return column
        return self.starts[i + 1]

    def _replace(self, low: int, high: int, pieces: list[tuple[int, int, int]]) -> int:
        """Put pieces that are not empty in the place of others; the place after them."""
        pieces = [piece for piece in pieces if piece[0] < piece[1]]
        self.covered[low:high] = pieces
        for piece in pieces:
            self.expiring.setdefault(piece[2], []).append(piece)
        return low + len(pieces)

    def cover(self, start: int, end: int, row: int) -> None:
        """From ``start`` to before ``end``, columns are covered up to before ``row`` at least."""
        i = max(0, bisect_left(self.covered, (start,)) - 1)
        while i < len(self.covered) and self.covered[i][0] < end:
            low, high, until = self.covered[i]
            if high <= start or until >= row:
                i += 1
                continue
            a, b = max(low, start), min(high, end)
            i = self._replace(i, i + 1, [(low, a, until), (a, b, row), (b, high, until)])
        i = max(0, bisect_right(self.starts, start) - 1)
        while i < len(self.starts) and self.starts[i] < end:
            low, high = max(start, self.starts[i]), min(end, self.ends[i])
            if low >= high:
                i += 1
                continue
            left = [(self.starts[i], low), (high, self.ends[i])]
            left = [(a, b) for a, b in left if a < b]
            self.starts[i : i + 1] = [a for a, _ in left]
            self.ends[i : i + 1] = [b for _, b in left]
            i += len(left)
            at = bisect_left(self.covered, (low,))
            self._replace(at, at, [(low, high, row)])


Cells = list[tuple[int, int, list[Entry]]]


def widths_of(grid: list[Cells]) -> dict[int, int]:
    """The widest cell of each column that has a cell of its own."""
    widths: dict[int, int] = {}
    for cells in grid:
        for column, across, lines in cells:
            if across == 1:
                widths[column] = max(widths.get(column, 0), extent(lines)[1])
    return widths


def grid_of(grid: list[Cells]) -> list[Entry]:
    """The rows as one block, columns aligned and two spaces apart; none if all cells are empty."""
    widths = widths_of(grid)
    # Columns without a cell of their own take no room.
    columns, starts, at = sorted(widths), [], 0
    for column in columns:
        starts.append(at)
        at += widths[column] + 2 if widths[column] else 0
    starts.append(at)
    placed: list[tuple[int, int, list[Entry]]] = []
    top = width = 0
    for cells in grid:
        height = 0
        for column, _, lines in cells:
            if lines:
                start = starts[bisect_left(columns, column)]
                own_height, own_width = extent(lines)
                placed.append((top, start, lines))
                height, width = max(height, own_height), max(width, start + own_width)
        top += height
    return [Grid(placed, top, width)] if placed else []


def table_lines(table: Node, painted: bool) -> Call:
    """Caption and stray content, then the rows, columns aligned and two spaces apart."""
    before = Lines()
    for child in table.children:
        if isinstance(child, str):
            if painted:
                before.text(child)
        elif shown(child):
            if child.name in SECTIONS:
                stray = Node(child.name)
                stray.children = [
                    c for c in child.children if isinstance(c, str) or c.name != "tr"
                ]
                yield flow(stray, before, painted, False, False)
            elif child.name != "tr":
                yield element(child, before, painted, False, False)
    grid: list[Cells] = []
    columns = Columns()
    for number, row in enumerate(rows_of(table)):
        columns.next_row(number)
        cells, column = [], 0
        # What cells of this row cover is covered from the next row on.
        covered = []
        stray = Node("tr")
        stray.children = [
            c for c in row.children if isinstance(c, str) or c.name not in CELLS
        ]
        yield flow(stray, before, painted, False, False)
        for cell in row.children:
            if not isinstance(cell, Node) or cell.name not in CELLS or not shown(cell):
                continue
            column = columns.free_from(column)
            across = min(max(1, number_of(cell, "colspan", 1)), MAX_COLSPAN)
            down = min(max(1, number_of(cell, "rowspan", 1)), MAX_ROWSPAN)
            own = visible(cell, visible(row, painted))
            cells.append((column, across, (yield lines_of(cell, own))))
            if down > 1:
                covered.append((column, column + across, number + down))
            column += across
        for start, end, until in covered:
            columns.cover(start, end, until)
        grid.append(cells)
    out = before.finish()
    aligned = grid_of(grid)
    return [*out, "", *aligned] if out and aligned else out + aligned


def render(html: str) -> str:
    """All visible text of a page as lines; no-break spaces become spaces."""
    root = parse(html)
    body = root.children[1]
    if not isinstance(body, Node) or not shown(root) or not shown(body):
        return ""
    painted = visible(body, visible(root, True))
    return "\n".join(flat(run(lines_of(body, painted)))).replace("\xa0", " ")


def rendered(html: Column) -> Column:
    """The visible text of a column of pages; a null or empty page has none."""

    @F.arrow_udf("string")
    def texts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([render(value or "") for value in column.to_pylist()], pa.string())

    return texts(html.cast("string"))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id`` and ``text``, one row for each of ``pages``.

    A null or empty page has an empty text. Null ids and repeated rows stay, columns beyond the two are
    not looked at, whatever their names, and an empty table gives an empty result. A page of any length
    and depth is rendered whole, in a time in proportion to it and to the text with its padding; it has to
    fit in a task.
    """
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), rendered(F.col(html_col)).alias("text")
    )
