"""HTML extraction: a tree with implied tags and visibility, rendered with block spacing, lists and aligned table cells.

``tree`` reads tags, text, comments and raw elements; it closes what HTML closes by itself (``p`` before a block, ``li``, ``dt``, ``dd``,
``option``, table parts), ignores end tags without a start, ends open elements with their parent, and puts text that stands in a
table outside of its cells before the table. Open elements are found by tag, so a page takes a time that follows its length, and
tree and rendering keep their own stacks, so elements nest to any depth. ``rendered`` emits all visible
text: hidden elements (by element, ``hidden`` attribute or inline style) are skipped; white space collapses but in ``pre``;
paragraphs and headings stand apart by an empty line, other blocks by a line end; list items get a bullet or their number,
indented by depth; table cells are aligned in columns, two spaces apart, with ``colspan`` kept.

Defined cases: null and empty pages give empty text; broken markup gives the text that can be read; null ids are rows like any other; repeated rows give equal texts;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas svg datalist title area param rp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr form fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside caption center dd details dialog div dir dt figcaption footer header hgroup legend li main menu nav "
    "optgroup option search section summary tbody td tfoot th thead tr".split()
)
#: An opening tag ends these open elements, up to the nearest scope element.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
    "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "thead": {"tbody", "thead", "tfoot", "tr", "td", "th"},
    "tfoot": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "body": {"head"},
}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"}}
#: Text directly in these goes before their table.
FOSTERING = frozenset("table tbody thead tfoot tr".split())
TABLE_PARTS = frozenset("td th tr tbody thead tfoot caption".split())
P_SCOPE = frozenset("td th caption button object table html body".split())
FLOW_IN_HEAD = frozenset("title meta link script style base noscript template".split())

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


class Open:
    """The open elements, outermost first, and the places of each tag among them; the root has none."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost element with one of the tags, or 0."""
        return max((self.places[x][-1] for x in tags if self.places.get(x)), default=0)

    def first(self, tags: Iterable[str], after: int) -> int:
        """Place of the outermost element with one of the tags inside the element at ``after``, or 0."""
        found = [self.places.get(x, ()) for x in tags]
        return min((x[bisect_right(x, after)] for x in found if x and x[-1] > after), default=0)


def tree(page: str) -> Node:
    """The element tree of a page; text nodes are strings."""
    root = Node("html", {})
    stack, at, end = Open(root), 0, len(page)
    while at < end:
        m = _MARKUP.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if not text.startswith(("<!", "<?")):
                text = html.unescape(text) if "&" in text else text
                if stack.nodes[-1].tag == "head" and not text.isspace():
                    stack.cut(len(stack.nodes) - 1)
                _add_text(stack, text)
            continue
        tag = tag.lower()
        if m[1]:
            _end(stack, tag)
            continue
        _imply(stack, tag)
        node = Node(tag, attributes(m[3]))
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            text = page[at : close.start() if close else end]
            node.children.append(html.unescape(text) if tag in ("textarea", "title") else text)
            at = close.end() if close else end
        elif tag not in VOID:
            stack.push(node)
    return root


def _add_text(stack: Open, text: str) -> None:
    nodes = stack.nodes
    if nodes[-1].tag in FOSTERING and text.strip(" \t\n\r\f"):
        tables = stack.places.get("table", ())
        for place in reversed(tables):
            # An open table is the last child of its parent; one that stands in another table outside of a cell passes the text on.
            if nodes[place - 1].tag not in FOSTERING or place == tables[0]:
                above = nodes[place - 1].children
                above.insert(len(above) - 1, text)
                return
    nodes[-1].children.append(text)


def _end(stack: Open, tag: str) -> None:
    place = stack.last((tag,))
    # An end tag inside a table cell closes nothing outside of its table.
    if place and (tag in ("body", "html") or place >= stack.last(("table",))):
        stack.cut(place)


def _imply(stack: Open, tag: str) -> None:
    if stack.nodes[-1].tag == "head" and tag not in FLOW_IN_HEAD:
        stack.cut(len(stack.nodes) - 1)
    if tag in BLOCKS and tag not in ("td", "th"):
        place = stack.last(("p",))
        if place > stack.last(P_SCOPE):
            stack.cut(place)
    closing = CLOSES.get(tag)
    if closing:
        place = stack.first(closing, stack.last(SCOPE.get(tag, ("table",))))
        if place:
            stack.cut(place)


def visible(node: Node) -> bool:
    a = node.attributes
    if node.tag in HIDDEN or not a:
        return node.tag not in HIDDEN and not (node.tag == "dialog")
    if "hidden" in a or node.tag == "input" or node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and _HIDING.search(a["style"]))


class Page:
    """Lines written so far; ``gap`` is the number of line ends due before the next text."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.gap, self.space, self.indent, self.mark = 0, False, 0, ""

    def block(self, gap: int) -> None:
        self.gap, self.space = max(self.gap, gap), False

    def open_line(self) -> None:
        if self.gap:
            if self.out:
                self.out.append("\n" * self.gap)
            self.gap = 0
            pad = "  " * self.indent
            if self.mark:
                pad = pad[: -2] + self.mark if len(pad) >= 2 else self.mark
                self.mark = ""
            self.out.append(pad)
        elif self.space:
            self.out.append(" ")
        self.space = False

    def text(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        if words == " " or not words:
            self.space = self.space or (bool(words) and not self.gap)
            return
        if words[0] == " ":
            self.space = not self.gap
            words = words[1:]
        tail = words[-1] == " "
        self.open_line()
        self.out.append(words[:-1] if tail else words)
        self.space = tail

    def verbatim(self, text: str) -> None:
        for k, part in enumerate(text.split("\n")):
            if k:
                self.gap = max(self.gap + 1, 1)
            if part:
                self.open_line()
                self.out.append(part)


def rendered(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    out = Page()
    out.gap = 1
    _run(_render(tree(page), out, False))
    text = "".join(out.out)
    return "\n".join(x.rstrip() for x in text.split("\n")).strip("\n")


def _run(task: Generator) -> None:
    """Run a generator that yields the generators it waits for; they wait on a list, so nothing bounds their depth."""
    waiting, result = [task], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(result))
            result = None
        except StopIteration as done:
            waiting.pop()
            result = done.value


def _render(node: Node, out: Page, verbatim: bool) -> Generator:
    counter = _first_number(node) if node.tag == "ol" else 0
    for child in node.children:
        if isinstance(child, str):
            out.verbatim(child) if verbatim else out.text(child)
            continue
        tag = child.tag
        if not visible(child) or node.tag == "details" and "open" not in node.attributes and tag != "summary":
            continue
        if tag == "br":
            out.gap, out.space = out.gap + 1, False
        elif tag == "hr":
            out.block(2)
        elif tag == "table":
            out.block(2)
            for line in (yield _table(child)):
                out.block(1)
                out.verbatim(line)
            out.block(2)
        elif tag == "li":
            out.block(1)
            ordered = node.tag == "ol"
            if ordered and child.attributes.get("value", "").isdigit():
                counter = int(child.attributes["value"])
            out.indent += 1
            out.mark = f"{counter}. " if ordered else "- "
            counter += 1
            yield _render(child, out, verbatim)
            out.mark = ""
            out.indent -= 1
            out.block(1)
        elif tag in BLOCKS:
            gap = 2 if tag in SPACED and not (tag in ("ul", "ol") and node.tag == "li") else 1
            deeper = tag in ("blockquote", "dd")
            out.block(gap)
            out.indent += deeper
            yield _render(child, out, verbatim or tag == "pre")
            out.indent -= deeper
            out.block(gap)
        else:
            yield _render(child, out, verbatim)


def _first_number(node: Node) -> int:
    start = node.attributes.get("start", "1").strip()
    return int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1


def _rows(node: Node) -> Iterator[list[Node]]:
    waiting = [iter(node.children)]
    while waiting:
        child = next(waiting[-1], None)
        if child is None:
            waiting.pop()
            continue
        if isinstance(child, str) or not visible(child):
            continue
        if child.tag == "tr":
            yield [c for c in child.children if not isinstance(c, str) and visible(c)]
        elif child.tag in ("tbody", "thead", "tfoot"):
            waiting.append(iter(child.children))
        elif child.tag in ("td", "th", "caption") or child.children:
            yield [child]


def _table(node: Node) -> Generator:
    """Returns the lines of a table."""
    grid, widths = [], []
    for cells in _rows(node):
        row, column = [], 0
        for cell in cells:
            inner = Page()
            inner.gap = 1
            yield _render(cell, inner, False)
            text = _SPACE.sub(" ", "".join(inner.out)).strip()
            span = cell.attributes.get("colspan", "1")
            span = min(int(span), 100) if re.fullmatch(r"\d{1,4}", span) and int(span) else 1
            row.append((column, span, text))
            if span == 1 and len(cells) > 1:
                widths += [0] * (column + 1 - len(widths))
                widths[column] = max(widths[column], len(text))
            column += span
        grid.append(row)
    lines = []
    for row in grid:
        line = ""
        for column, _, text in row:
            start = sum(w + 2 for w in widths[:column])
            line = line.ljust(start) if len(line) + 2 <= start or not line else line + "  "
            line += text
        if line.strip():
            lines.append(line.rstrip())
    return lines


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, html) to page_id, text, n_chars and n_lines of the visible text; every whole page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rendered(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    texts = pages.select("page_id", "html").mapInArrow(run, f"page_id {kind}, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("bigint")
    return texts.select("page_id", "text", F.length("text").cast("bigint").alias("n_chars"), lines.alias("n_lines"))
