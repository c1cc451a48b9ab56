"""Visible text of HTML pages, laid out as a reader sees it.

A tree builder closes implied tags; what the visibility rules hide is left out; blocks are set apart by line breaks
and blank lines, list items have markers and indentation, and the cells of a table stand in aligned columns. Builder
and renderer are loops over stacks, so nesting may be as deep as the page is long. Work and output stay in proportion to
the page: indentation ends at ``DEEPEST`` columns, and cells of tables inside more than ``NESTED`` others follow each
other without columns; no text is left out for that.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable
from html import unescape
from itertools import accumulate
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.arrow import slices, texts_of

# Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes title object audio video canvas svg datalist".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header "
    "hgroup html legend li main menu nav option section summary search optgroup".split())
CLOSES_PARAGRAPH = (BLOCKS - frozenset("body html option optgroup caption legend dt dd".split())) | {"dt", "dd"}
TABLE_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())
# a start tag ends these open elements, if they are open above the nearest of the elements in the second set
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir", "table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (TABLE_PARTS, frozenset(["table"])),
    "tbody": (TABLE_PARTS, frozenset(["table"])),
    "tfoot": (TABLE_PARTS, frozenset(["table"])),
}
# a quote opens a value only behind a name's "=" and if it is closed; any other is a character like the rest
ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))?+)?+")
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[\s/]++|"
    + re.sub(r"\((?!\?)", "(?:", ATTRIBUTE.pattern) + r")*+)(?:>|\Z)|([^<]+|<)", re.DOTALL)
SPACE = re.compile(r"[ \t\n\r\f]+")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
FIRST_BREAK = re.compile(r"(?:\r\n|\n|\r)?")
PARAGRAPH = frozenset(["p"])
WIDEST = 80
INDENT = 2
DEEPEST = 60
NESTED = 8
MOST_COLUMNS, MOST_ROWS = 1000, 65534


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        for match in ATTRIBUTE.finditer(self.attributes):
            if match[1].lower() == name:
                return unescape(match[2] or match[3] or match[4] or "")
        return None


def tree(html: str) -> Node:
    """The page's elements and texts; a text is a string among the children."""
    root = Node("")
    open_nodes = [root]
    depths: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    place, end = 0, len(html)

    def close(depth: int) -> None:
        for node in open_nodes[depth:]:
            depths[node.tag].pop()
        del open_nodes[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    def close_first(tags: frozenset, within: frozenset) -> None:
        """Closes the outermost open element of the tags that stands inside the nearest of ``within``."""
        edge = max((depths[tag][-1] for tag in within - tags if depths[tag]), default=0)
        inside = [depths[tag][at] for tag in tags if (at := bisect_right(depths[tag], edge)) < len(depths[tag])]
        if inside:
            close(min(inside))

    while place < end:
        match = TOKEN.match(html, place)
        place = match.end()
        text = match[3]
        if text is not None:
            open_nodes[-1].children.append(text)
            continue
        if match[1] is None:
            continue
        tag, start = match[1].lower(), match.start()
        if html[start + 1] == "/":
            if depths[tag]:
                depth = depths[tag][-1]
                # an end tag inside a table does not reach outside, nor does one of a stretch of text outside its block
                table = depths["table"][-1] if depths["table"] and tag not in ("body", "html") else 0
                block = blocks[-1] if blocks and tag not in BLOCKS else 0
                if depth >= max(table, block):
                    close(depth)
            continue
        if tag in CLOSES_PARAGRAPH and depths["p"]:
            close_first(PARAGRAPH, frozenset(["table", "td", "th", "caption", "button"]))
        if tag in IMPLIED:
            close_first(*IMPLIED[tag])
        node = Node(tag, match[2])
        open_nodes[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(html, place)
            content = html[place: stop.start() if stop else end]
            node.children.append(content[FIRST_BREAK.match(content).end():] if tag == "textarea" else content)
            place = end if stop is None else (html.find(">", stop.end()) + 1 or end)
        elif tag not in VOID:
            depths[tag].append(len(open_nodes))
            if tag in BLOCKS:
                blocks.append(len(open_nodes))
            open_nodes.append(node)
            if tag == "pre":
                place = FIRST_BREAK.match(html, place).end()
    return root


def declared(node: Node) -> dict[str, str]:
    """The first words of the declarations in an element's style, lower-cased."""
    style = node.attribute("style") if node.attributes else None
    found: dict[str, str] = {}
    for declaration in COMMENT.sub(" ", style).split(";") if style else ():
        name, _, value = declaration.partition(":")
        words = value.lower().replace("!", " !").split()
        if words and (not found.get(name := name.strip().lower(), "").endswith("!") or words[-1] == "!important"):
            found[name] = words[0] + ("!" if words[-1] == "!important" else "")
    return {name: word.rstrip("!") for name, word in found.items()}


def removed(node: Node, style: dict[str, str]) -> bool:
    """Whether the element and all inside it are not laid out."""
    if node.tag in HIDDEN or style.get("display") == "none":
        return True
    if not node.attributes:
        return node.tag == "dialog"
    return node.attribute("hidden") is not None or (node.tag == "dialog" and node.attribute("open") is None)


def columns_of(text: str) -> int:
    """The columns that a line takes: two for a wide character, none for a combining one."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


def number_of(value: str | None, least: int, most: int, default: int) -> int:
    value = (value or "").strip()
    return min(most, max(least, int(value))) if re.fullmatch("-?[0-9]{1,9}", value) else default


def deeper(indent: str, columns: int) -> str:
    return indent + " " * columns if len(indent) < DEEPEST else indent


class Page:
    """Lines of text under way; ``gap`` blank lines are due before the next one."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.spaced, self.gap = True, 0
        self.indent, self.marker = "", ""

    def text(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if self.spaced:
            text = text.lstrip(" ")
        if text:
            self.parts.append(text)
            self.spaced = text[-1] == " "

    def kept(self, text: str) -> None:
        """Text whose white space counts."""
        first, *others = text.replace("\r\n", "\n").split("\n")
        self.parts.append(first)
        for line in others:
            self.end_line(True)
            self.parts.append(line)
        self.spaced = False

    def end_line(self, empty_too: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        self.parts, self.spaced = [], True
        if line or empty_too:
            self._put(line)

    def _put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines.append((self.indent + self.marker + line).rstrip())
        if self.marker:
            self.indent, self.marker = deeper(self.indent, len(self.marker)), ""

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def whole(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._put(line)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """The rows' cells (lines, columns and rows that they span) in aligned columns."""
    placed, taken = [], {}
    for number, row in enumerate(rows):
        column, cells = 0, []
        for lines, span, down in row:
            # columns that cells from above still reach into
            while taken.get(column, (0, 0))[1] > number:
                column = taken[column][0]
            cells.append((column, span, lines))
            if down > 1:
                taken[column] = (column + span, number + down)
            column += span
        placed.append(cells)
    widths: dict[int, int] = {}
    for cells in placed:
        for column, span, lines in cells:
            if span == 1:
                widths[column] = max([widths.get(column, 0), *(min(WIDEST, columns_of(line)) for line in lines)])
    known = sorted(widths)
    sums = [0, *accumulate(widths[column] for column in known)]
    found = []
    for cells in placed:
        starts = [2 * column + sums[bisect_left(known, column)] for column, _, _ in cells]
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            parts, reached = [], 0
            for start, (_, _, lines) in zip(starts, cells):
                if i < len(lines) and lines[i]:
                    # past the column, two blanks set the cell apart
                    gap = start - reached if start > reached else 2 if parts and parts[-1][-1] != " " else 0
                    parts += [" " * gap, lines[i]]
                    reached += gap + columns_of(lines[i])
            found.append("".join(parts).rstrip())
    return found


def render(html: str) -> str:
    """The visible text of a page."""
    pages = [Page()]
    # rows of cells; None for a table inside too many others, whose cells follow each other
    tables: list[list[list[tuple[list[str], int, int]]] | None] = []
    lists: list[tuple[str, int, int]] = []
    saved: list = []
    shown = [True]
    kept = 0
    todo: list[tuple[Node | str, bool]] = [(tree(html), True)]
    while todo:
        node, enters = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if shown[-1]:
                text = unescape(node) if "&" in node else node
                page.kept(text) if kept else page.text(text)
            continue
        tag = node.tag
        if enters:
            style = declared(node)
            if tag and removed(node, style):
                continue
            if tag == "br":
                page.end_line(bool(page.parts or page.lines or kept))
                continue
            if tag == "hr":
                page.block(1)
                continue
            if tag in VOID:
                continue
            todo.append((node, False))
            children = node.children
            if tag == "details" and node.attribute("open") is None:
                children = [child for child in children if isinstance(child, Node) and child.tag == "summary"][:1]
            todo += [(child, True) for child in reversed(children)]
            # hidden texts keep no place here, but what is inside them may be made visible again
            shown.append({"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility"), shown[-1]))
            if tag == "textarea":
                page.text(" ")
            elif tag == "table":
                page.block(1)
                tables.append([] if len(tables) < NESTED else None)
            elif tag == "tr" and tables:
                if tables[-1] is None:
                    page.block(0)
                else:
                    tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if tables[-1] is None:
                    page.text(" ")
                    continue
                if not tables[-1]:
                    tables[-1].append([])
                spans = [number_of(node.attribute(name) if node.attributes else None, 1, most, 1)
                         for name, most in (("colspan", MOST_COLUMNS), ("rowspan", MOST_ROWS))]
                pages.append(Page())
                saved.append((*spans, kept, lists))
                kept, lists = 0, []
            elif tag in PARAGRAPHS:
                page.block(0 if tag in ("ul", "ol") and lists else 1)
                if tag == "pre":
                    kept += 1
                elif tag in ("ul", "ol"):
                    down = tag == "ol" and node.attributes and node.attribute("reversed") is not None
                    items = sum(isinstance(child, Node) and child.tag == "li" for child in children) if down else 1
                    first = node.attribute("start") if tag == "ol" and node.attributes else None
                    lists.append((tag, number_of(first, -10 ** 9, 10 ** 9, items), -1 if down else 1))
                elif tag == "blockquote":
                    saved.append(page.indent)
                    page.indent = deeper(page.indent, INDENT)
            elif tag == "li":
                page.block(0)
                saved.append((page.indent, page.marker))
                kind, number, step = lists[-1] if lists else ("ul", 1, 1)
                number = number_of(node.attribute("value") if node.attributes else None, -10 ** 9, 10 ** 9, number)
                page.indent = deeper(page.indent, len(page.marker)) if page.marker else page.indent
                page.marker = (f"{number}. " if kind == "ol" else "- ") if shown[-1] else ""
                if lists:
                    lists[-1] = (kind, number + step, step)
            elif tag == "dd":
                page.block(0)
                saved.append(page.indent)
                page.indent = deeper(page.indent, INDENT)
            elif tag in BLOCKS:
                page.block(0)
            continue
        shown.pop()
        if tag == "textarea":
            page.text(" ")
        elif tag == "table":
            rows = tables.pop()
            page.block(1)
            page.whole(table_lines(rows or []))
            page.block(1)
        elif tag in ("td", "th") and tables:
            if tables[-1] is not None:
                lines = pages.pop().done()
                span, down, kept, lists = saved.pop()
                tables[-1][-1].append((lines, span, down))
        elif tag in PARAGRAPHS:
            page.block(0 if tag in ("ul", "ol") and len(lists) > 1 else 1)
            if tag == "pre":
                kept -= 1
            elif tag in ("ul", "ol"):
                lists.pop()
            elif tag == "blockquote":
                page.indent = saved.pop()
        elif tag == "li":
            page.block(0)
            page.indent, page.marker = saved.pop()
        elif tag == "dd":
            page.block(0)
            page.indent = saved.pop()
        elif tag in BLOCKS:
            page.block(0)
    return "\n".join(pages[0].done())


def visible_text(pages: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """Per row of ``pages``: id, text, n_lines and n_chars of the laid-out visible text.

    A null or empty page has the empty text: 0 lines, 0 characters. Broken markup is read as far as it goes: unclosed
    and misplaced tags are repaired, an unfinished tag or comment ends the page. Rows are independent, repeated rows
    repeat, a null id stays null; other columns are not read. Nothing is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_html"):
                found = [render(value) for value in texts_of(part.column("_html")).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(found, pa.string()),
                     pa.array([text.count("\n") + 1 if text else 0 for text in found], pa.int64()),
                     pa.array([len(text) for text in found], pa.int64())],
                    names=[id, "text", "n_lines", "n_chars"])

    rows = pages.select(F.col(id).alias("_id"), F.col(html).cast("string").alias("_html"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, text string, n_lines bigint, n_chars bigint")
