"""Visible text of HTML pages, laid out as a reader would see it.

A tolerant tokenizer feeds a tree builder that closes what HTML leaves open (a block ends a paragraph, an item the item
before it, a cell the cell before it, rows appear around lone cells). A walk over the tree then emits all text that no
visibility rule hides: white space collapses outside ``pre``, blocks start on their own lines and paragraphs stand apart, list
items get markers and indents, table cells are padded to columns.

Only the page itself is in memory; nesting of any depth is walked with an explicit stack.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe noembed noframes object audio video canvas svg datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section summary table ul".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())  # a blank line around them
LISTS = frozenset(["ul", "ol", "menu", "dir"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
ROWS = frozenset(["thead", "tbody", "tfoot"])
# start tag -> the open elements it ends, and the elements beyond which it does not look
ENDS = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    **{r: ({"tr", "td", "th", "caption", *ROWS}, {"table"}) for r in ROWS},
}
FENCES = frozenset("html body table td th caption button object template".split())

MARKS = ("!", "?")
REMARK = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?", re.S)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?|=")
MAYBE_HIDDEN = re.compile(r"hidden|style(?=.*(?:none|collapse|&))", re.I | re.S)  # all that can hide holds one of these
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
IMPORTANT = re.compile(r"\s*!\s*important\Z")
SPAN = re.compile(r"\b(colspan|rowspan|start)\s*=\s*[\"']?(\d{1,4})", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")
WIDEST = 60  # columns with wider cells are not padded
SPAN_MOST = 1000  # columns a cell can span at most, by the standard
INDENT_MOST = 80


def is_hidden(tag: str, attrs: str) -> bool:
    """Whether the attributes ``hidden``, ``type`` (of an input) or ``style`` hide the element; of repeated ones the first counts."""
    if not MAYBE_HIDDEN.search(attrs):
        return False
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attrs):
        if m[1]:
            found.setdefault(m[1].lower(), unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    if "hidden" in found or (tag == "input" and found.get("type", "").strip().lower() == "hidden"):
        return True
    styles: dict[str, str] = {}
    strong: set[str] = set()
    for declaration in COMMENT.sub(" ", found.get("style", "")).split(";"):
        name, _, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        plain = IMPORTANT.sub("", value)
        # the last declaration counts, unless an earlier one is important
        if plain != value or name not in strong:
            styles[name] = plain
            strong |= {name} if plain != value else set()
    return styles.get("display") == "none" or styles.get("visibility") in ("hidden", "collapse")


@dataclass
class Node:
    tag: str
    attrs: str = ""
    children: list = field(default_factory=list)  # nodes and texts

    def number(self, name: str, default: int = 1) -> int:
        return next((int(v) for k, v in SPAN.findall(self.attrs) if k.lower() == name), default)


class Stack:
    """The open elements, with the places of each tag, so that nothing is looked for element by element."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        for _ in range(len(self.nodes) - at):
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """The innermost open one of the tags; 0, the place of the root, if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def first(self, tags, beyond: int) -> int | None:
        """The outermost open one of the tags behind a place."""
        found = [p[i] for t in tags if (p := self.places.get(t)) and p[-1] > beyond and (i := bisect_right(p, beyond)) < len(p)]
        return min(found, default=None)


def build_tree(html: str) -> Node:
    """The tree of a page, in time in proportion to its length whatever is left open.

    Behind the last ``>`` all is text. A tag whose quotes do not end before the page does ends at its first ``>``, and so do all
    tags behind it.
    """
    root = Node("html")
    stack = Stack(root)
    at, end, last_end, tag_at = 0, len(html), html.rfind(">"), TAG.match
    no_quotes = lambda *_: None
    places = stack.places

    def add_text(text: str) -> None:
        top = stack.nodes[-1]
        if top.tag in ("pre", "listing") and not top.children:
            text = text.removeprefix("\r").removeprefix("\n")  # one line break behind the tag does not count
        if text:
            top.children.append(unescape(text))

    def close(tags, fences) -> None:
        place = 0
        for t in tags:
            if (found := places.get(t)) and found[-1] > place:
                place = found[-1]
        # the usual case, the element on top, needs no look at the fences
        if place and (place == len(stack.nodes) - 1 or place >= stack.last(fences)):
            stack.cut(place)

    def open_tag(tag: str, attrs: str) -> None:
        if tag in ENDS:
            tags, fences = ENDS[tag]
            first = stack.first(tags, stack.last(fences))
            if first is not None:
                # the outermost of its kind within the fence: what a new row or item ends, it ends with all inside
                stack.cut(first)
        if places.get("p") and tag in BLOCKS:
            close(("p",), FENCES)
        if tag in HEADINGS and stack.nodes[-1].tag in HEADINGS:
            stack.cut(len(stack.nodes) - 1)
        if tag in ("td", "th") and stack.nodes[-1].tag != "tr" and stack.places.get("table"):
            open_tag("tr", "")
        node = Node(tag, attrs)
        stack.nodes[-1].children.append(node)
        if tag not in VOID:
            stack.push(node)

    text_from = 0
    while 0 <= (at := html.find("<", at)):
        if html[at + 1 : at + 2] in MARKS:
            add_text(html[text_from:at])
            text_from = at = REMARK.match(html, at).end()
            continue
        m = tag_at(html, at) if at < last_end else None
        if m:
            closing, tag, attrs = m.groups()
            stop = m.end()
        elif at < last_end and (m := NAME.match(html, at)) and (stop := html.find(">", m.end()) + 1):
            tag_at = no_quotes
            closing, tag, attrs = m[1], m[2], html[m.end() : stop - 1]
        else:
            at += 1
            continue
        if text_from < at:
            add_text(html[text_from:at])
        tag = tag.lower()
        text_from = at = stop
        if closing:
            if tag == "br":
                open_tag("br", "")
            elif tag not in ("html", "body"):
                close((tag,), {"table", "td", "th"} - {tag} if tag not in ("table", *ROWS, "tr") else {"table"} - {tag})
        elif tag in ("html", "body"):
            # implied and repeated ones are the root
            root.attrs += " " + attrs
        else:
            open_tag(tag, attrs)
            if tag in RAW:
                found = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                inner = html[at : found.start() if found else end]
                # only title and textarea hold character references
                stack.nodes[-1].children.append(unescape(inner) if tag in ("title", "textarea") else inner)
                text_from = at = found.end() if found else end
                stack.cut(len(stack.nodes) - 1)
    add_text(html[text_from:])
    return root


class Sink:
    """Text under construction: pending line breaks, the indent of lists, and where the line stands."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks = 0
        self.indent = ""
        self.marker: str | None = None
        self.fresh = True  # at the start of a line, or behind a space

    def block(self, lines: int) -> None:
        self.breaks = max(self.breaks, lines)
        self.fresh = True

    def _start(self) -> None:
        if self.parts:
            if self.breaks and self.parts[-1] == " ":
                self.parts.pop()
            self.parts.append("\n" * self.breaks)
        if self.breaks or not self.parts:
            self.parts.append(self.marker if self.marker is not None else self.indent)
        elif self.marker is not None:
            self.parts.append(self.marker)
        self.marker, self.breaks = None, 0

    def text(self, text: str, pre: bool) -> None:
        if pre:
            lines = text.replace("\r\n", "\n").split("\n")
            for i, line in enumerate(lines):
                if i:
                    self.line()
                if line:
                    self._start()
                    self.parts.append(line)
            return
        text = SPACE.sub(" ", text)
        if self.fresh:
            text = text.lstrip(" ")
        if not text:
            return
        self._start()
        if text[-1] == " ":
            if text != " ":
                self.parts.append(text[:-1])
            self.parts.append(" ")
        else:
            self.parts.append(text)
        self.fresh = text[-1] == " "

    def line(self) -> None:
        """A line break as written (br): unlike block starts, these add up."""
        self.breaks = self.breaks + 1 if self.parts else 0
        self.fresh = True

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            self.block(1)
            self._start()
            self.parts.append(line)

    def value(self) -> str:
        return "".join(self.parts).rstrip()


class Table:
    def __init__(self):
        self.at = 0  # where the next cell of the row may begin
        self.rows: list[dict[int, tuple[str, int]]] = []
        self.held: list[tuple[int, int, int]] = []  # first column, column after the last, rows still taken by a cell from above
        self.next: list[tuple[int, int, int]] = []  # the same for the rows below
        self.passed = 0  # of the held ones, those the row has gone by

    def row(self) -> None:
        self.rows.append({})
        self.at = self.passed = 0
        self.held = sorted([(a, z, n - 1) for a, z, n in self.held if n > 1] + self.next)
        self.next = []

    def cell(self, text: str, across: int, down: int) -> None:
        if not self.rows:
            self.row()
        across = min(across, SPAN_MOST)
        while self.passed < len(self.held) and self.held[self.passed][0] <= self.at:
            self.at = max(self.at, self.held[self.passed][1])
            self.passed += 1
        self.rows[-1][self.at] = (text, across)
        if down > 1:
            self.next.append((self.at, self.at + across, down - 1))
        self.at += across

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for at, (text, across) in row.items():
                if across == 1:
                    widths[at] = max(widths.get(at, 0), *map(len, text.split("\n")))
        out, starts = [], [0]
        used = {at for row in self.rows for at in row}
        wide = max(used, default=0) > SPAN_MOST  # in very wide tables, columns in which no cell begins take no room
        for c in range(max(used, default=0)):
            starts.append(starts[-1] + (0 if wide and c not in used else min(widths.get(c, 0), WIDEST) + 2))
        for row in self.rows:
            cells = {at: text.split("\n") for at, (text, _) in row.items()}
            for i in range(max(map(len, cells.values()), default=0)):
                line = ""
                for at in sorted(cells):
                    start = starts[at]
                    line = line.rstrip() + "  " if len(line) >= start and line.strip() else line.ljust(start)
                    line += cells[at][i] if i < len(cells[at]) else ""
                if line.strip():
                    out.append(line.rstrip())
        return out


def render(root: Node) -> str:
    sinks, tables, lists = [Sink()], [], []
    # (node, iterator over its children, what to do at its end)
    work: list[tuple[Node, Iterator, list]] = []
    pre = 0

    def enter(node: Node) -> None:
        nonlocal pre
        tag, sink, undo = node.tag, sinks[-1], []
        if tag in UNSEEN or (node.attrs and is_hidden(tag, node.attrs)):
            return
        if tag == "br":
            sink.line()
            return
        if tag == "tr" and tables:
            tables[-1].row()
        elif tag in ("td", "th") and tables:
            sinks.append(Sink())
            undo.append("cell")
        elif tag == "table":
            sink.block(2)
            tables.append(Table())
            undo.append("table")
        elif tag in BLOCKS or tag == "caption":
            sink.block(2 if tag in APART and not (tag in LISTS and lists) else 1)
            undo.append("block")
        if tag in LISTS:
            lists.append([tag == "ol", node.number("start") - 1])
            undo.append("list")
        elif tag == "li":
            mark = "- "
            if lists and lists[-1][0]:
                lists[-1][1] += 1
                mark = f"{lists[-1][1]}. "
            sink.marker = sink.indent + mark
            undo += ["indent", sink.indent]
            sink.indent = (sink.indent + " " * len(mark))[:INDENT_MOST]
        elif tag == "dd":
            undo += ["indent", sink.indent]
            sink.indent = (sink.indent + "  ")[:INDENT_MOST]
        elif tag == "pre":
            pre += 1
            undo.append("pre")
        elif tag == "hr":
            sink.rows(["---"])
        if tag not in VOID:
            work.append((node, iter(node.children), undo))

    def leave(node: Node, undo: list) -> None:
        nonlocal pre
        for i, what in enumerate(undo):
            if what == "cell":
                text = sinks.pop().value()
                tables[-1].cell(text, max(1, node.number("colspan")), max(1, node.number("rowspan")))
            elif what == "table":
                lines = tables.pop().lines()
                sinks[-1].rows(lines)
                sinks[-1].block(2)
            elif what == "block":
                sinks[-1].block(2 if node.tag in APART and not (node.tag in LISTS and len(lists) > 1) else 1)
            elif what == "list":
                lists.pop()
            elif what == "indent":
                sinks[-1].indent, sinks[-1].marker = undo[i + 1], None
            elif what == "pre":
                pre -= 1

    enter(root)
    while work:
        node, children, undo = work[-1]
        child = next(children, None)
        if child is None:
            work.pop()
            leave(node, undo)
        elif isinstance(child, str):
            if not (node.tag in ("table", "tr", *ROWS) and tables and not child.strip()):
                sinks[-1].text(child, pre > 0)
        else:
            enter(child)
    return sinks[0].value()


def visible_text(html: str | None) -> str:
    return render(build_tree(html)) if html else ""


def extract_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """The pages without their HTML, with the visible text in ``into`` (replacing a column of that name).

    Null and empty pages give an empty text; texts without markup are laid out as one block. Other columns ride along untouched,
    repeated rows stay repeated, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    kept = [c for c in pages.columns if c not in (html, into)]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(html).alias("html"))
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(run, f"row {kind}, text string").select("row.*", F.col("text").alias(into))
