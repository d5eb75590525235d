"""Text of HTML pages as a reader sees it.

A tree is built with the implied tags of HTML (an open paragraph ends before a block, a
list item before the next, cells and rows likewise, raw text inside script and style), then
rendered: hidden elements are skipped, blocks stand on lines of their own, paragraphs and
headings are set off by an empty line, list items get a bullet or their number, and the
cells of a table are padded to the width of their columns, spanned ones included. Text that
stands in a table outside its cells comes before it. White space collapses outside ``pre``.

``display: none`` and the hidden elements take all inside them along; inside ``visibility: hidden``
an element with ``visibility: visible`` is seen again. No page raises: declarations, broken tags and
comments that HTML does not know are comments, a tag that never ends is dropped with what follows, and
an ``&`` that begins nothing stands for itself. Time grows with the length of a page and not with
its depth: scans for open elements look up where each name is open, and nothing is nested on
the Python stack.

A null page gives a null text, an empty one an empty text. Pages are independent: repeated
rows get equal texts, null ids stay null, an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices

#: Fixed word lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure".split())
HIDDEN = frozenset("head script style template noscript title meta link iframe object svg canvas audio video datalist".split())
#: An opening tag ends open elements of these names, up to the nearest of the barriers.
ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p"}, {"table"}),
}
#: What a closing tag must not reach beyond, unless it closes one of these itself.
SCOPES = frozenset("table td th html body".split())
P_ENDERS = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "li", "dt", "dd", "option", "html", "body", "legend"}
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")
BULLET, COLUMN_GAP = "- ", "  "
#: Columns and rows a cell may span at most, and levels by which a list is indented.
WIDEST, TALLEST, DEEPEST = 100, 65534, 20

#: Elements whose content holds no tags; in the first ones it holds no references either.
RAW, PLAIN_TEXT = frozenset("script style xmp iframe noembed noframes".split()), frozenset("textarea title".split())
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_TAG_END = re.compile(r"[\s/]*>")
_COMMENT_END = re.compile(r"--!?>")


def tokens(html: str) -> Iterator[tuple[str, str, dict]]:
    """("text", characters, {}), ("start", name, attributes) and ("end", name, {}) of a page, in one pass."""
    at, n, ends = 0, len(html), {}
    while at < n:
        mark = html.find("<", at)
        if mark < 0 or mark == n - 1:
            yield "text", unescape(html[at:]), {}
            return
        if mark > at:
            yield "text", unescape(html[at:mark]), {}
        follows = html[mark + 1]
        if follows.isascii() and follows.isalpha():
            name = _NAME.match(html, mark + 1)
            attributes, at = _attributes(html, name.end())
            if at < 0:
                return  # a tag that never ends
            tag = name[0].lower()
            yield "start", tag, attributes
            if tag in RAW or tag in PLAIN_TEXT:
                end = ends.setdefault(tag, re.compile(rf"</{tag}(?=[\s/>])", re.I)).search(html, at)
                stop = end.start() if end else n
                inside = html[at:stop]
                if inside:
                    yield "text", unescape(inside) if tag in PLAIN_TEXT else inside, {}
                at = stop
        elif follows == "/" and html[mark + 2 : mark + 3].isascii() and html[mark + 2 : mark + 3].isalpha():
            name = _NAME.match(html, mark + 2)
            _, at = _attributes(html, name.end())
            if at < 0:
                return
            yield "end", name[0].lower(), {}
        elif html.startswith("<!--", mark):
            end = _COMMENT_END.search(html, mark + 2)
            at = end.end() if end else n
        elif follows in "!?/":  # doctypes, declarations, instructions, and end tags without a name
            end = html.find(">", mark)
            at = end + 1 if end >= 0 else n
        else:
            yield "text", "<", {}
            at = mark + 1


def _attributes(html: str, at: int) -> tuple[dict, int]:
    """The attributes of a tag and where it ends, or -1."""
    found: dict[str, str] = {}
    while True:
        end = _TAG_END.match(html, at)
        if end:
            return found, end.end()
        name = _ATTRIBUTE.match(html, at)
        if not name:
            return found, -1
        at, value = name.end(), ""
        if name[2]:
            quote = html[at : at + 1]
            if quote and quote in "\"'":
                stop = html.find(quote, at + 1)
                if stop < 0:
                    return found, -1
                value, at = html[at + 1 : stop], stop + 1
            else:
                bare = _BARE.match(html, at)
                value, at = bare[0], bare.end()
        found.setdefault(name[1].lower(), unescape(value))


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def displayed(self) -> bool:
        a = self.attrs
        return not (
            self.tag in HIDDEN
            or "hidden" in a
            or self.tag == "dialog" and "open" not in a
            or a.get("aria-hidden", "").lower() == "true"
            or self.tag == "input"
            or _NO_DISPLAY.search(a.get("style", ""))
        )

    def visible(self, before: bool) -> bool:
        """Whether its text is seen, given whether that of the element around it is."""
        said = _VISIBILITY.search(self.attrs.get("style", ""))
        return said[1].lower() == "visible" if said else before

    def number(self, name: str, default: int) -> int:
        value = self.attrs.get(name, "").strip()
        return int(value) if re.fullmatch(r"[+-]?[0-9]{1,9}", value) else default


class Tree:
    """Builds the tree; tags that HTML leaves out are put in by ``ENDS``."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        #: Where in ``open`` each name stands, the root apart.
        self.places: dict[str, list[int]] = defaultdict(list)

    def _pop_to(self, size: int) -> None:
        while len(self.open) > size:
            self.places[self.open.pop().tag].pop()

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        if node.tag not in VOID:
            self.places[node.tag].append(len(self.open))
            self.open.append(node)

    def _innermost(self, names) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _close(self, names, barriers) -> None:
        """Close the outermost open element of these names above the nearest barrier."""
        barrier, found = self._innermost(barriers), len(self.open)
        for name in names:
            for place in reversed(self.places.get(name, ())):
                if place <= barrier:
                    break
                found = min(found, place)  # all that is passed here is closed now
        if found < len(self.open):
            self._pop_to(found)

    def start(self, tag: str, attrs: dict) -> None:
        if tag == "html":
            self.root.attrs.update(attrs)
            return
        if (tag == "body" or tag in BLOCKS) and self.open[-1].tag == "head":
            self._pop_to(len(self.open) - 1)
        if tag in ENDS:
            self._close(*ENDS[tag])
        elif tag in P_ENDERS:
            self._close(("p",), ("table", "td", "th", "button"))
        parent = self.open[-1].tag
        if tag == "tr" and parent == "table":
            self._push(Node("tbody", {}))
        elif tag in ("td", "th") and parent in ("table", "tbody", "thead", "tfoot"):
            if parent == "table":
                self._push(Node("tbody", {}))
            self._push(Node("tr", {}))
        self._push(Node(tag, attrs))

    def end(self, tag: str) -> None:
        if tag == "p" and not self.places.get("p"):
            self.start("p", {})
        if tag == "br":
            return self.start("br", {})
        place = self._innermost((tag,))
        if not place:
            return
        free = tag in ("table", "tr", "tbody", "thead", "tfoot", "body")
        if free or self._innermost(SCOPES - {tag}) < place:
            self._pop_to(place)

    def text(self, data: str) -> None:
        self.open[-1].children.append(data)


class _Lines:
    """Output lines; text flows, blocks break lines, gaps ask for an empty line."""

    def __init__(self):
        self.lines, self.now, self.gap = [], [], False

    def text(self, s: str, keep: bool) -> None:
        if keep:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.break_line()
                self._put(line)
            return
        s = _BLANKS.sub(" ", s)
        if not self.now or self.now[-1].endswith(" "):
            s = s.removeprefix(" ")
        self._put(s)

    def _put(self, s: str) -> None:
        if s:
            if self.gap and not self.now and self.lines:
                self.lines.append("")
            self.gap = False
            self.now.append(s)

    def break_line(self) -> None:
        """The line ends here, even if nothing stands on it."""
        if self.now or (self.lines and not self.gap):
            self.lines.append("".join(self.now).rstrip())
        self.now = []

    def end(self, gap: bool = False) -> None:
        line = "".join(self.now).rstrip()
        if line:
            self.lines.append(line)
        self.now = []
        self.gap = self.gap or gap

    def result(self) -> str:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def _parts(table: Node, seen: bool) -> tuple[list[tuple[list[Node], bool]], list]:
    """(rows of cells, each with whether its text is seen; what stands outside the cells)."""
    rows, strays, todo = [], [], [(table, seen)]
    while todo:
        node, seen = todo.pop()
        if isinstance(node, str):
            if node.strip():
                strays.append((node, seen))
        elif not node.displayed():
            continue
        elif node is table or node.tag in ("thead", "tbody", "tfoot"):
            todo.extend((c, node.visible(seen)) for c in reversed(node.children))
        elif node.tag == "tr":
            own = node.visible(seen)
            cells = [c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th")]
            rows.append(([c for c in cells if c.displayed()], own))
            todo.extend((c, own) for c in reversed(node.children) if c not in cells)
        else:
            strays.append((node, seen))
    return [r for r in rows if r[0]], strays


def _width(s: str) -> int:
    """Columns a text takes where characters have a fixed width."""
    return len(s) if s.isascii() else sum(0 if combining(c) else 1 + (east_asian_width(c) in "WF") for c in s)


def _grid(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of a table from rows of (text, columns spanned, rows spanned)."""
    placed, taken = [], {}  # column -> rows it is still taken by a cell from above
    for row in rows:
        at, line = 0, []
        for text, across, down in row:
            while taken.get(at, 0):
                at += 1
            line.append((at, across, text))
            if down > 1:
                taken.update(dict.fromkeys(range(at, at + across), down))
            at += across
        placed.append(line)
        taken = {k: v - 1 for k, v in taken.items() if v > 1}
    widths: dict[int, int] = defaultdict(int)
    for across_only in (False, True):
        for line in placed:
            for at, across, text in line:
                if (across > 1) == across_only:
                    room = sum(widths[k] for k in range(at, at + across)) + len(COLUMN_GAP) * (across - 1)
                    widths[at + across - 1] += max(0, _width(text) - room)
    starts, total = {}, 0
    for k in range(max(widths, default=-1) + 1):
        starts[k] = total
        total += widths[k] + len(COLUMN_GAP) * (widths[k] > 0)
    out = []
    for line in placed:
        now, size = [], 0
        for at, across, text in line:
            if text:
                now += [" " * (starts[at] - size), text]
                size = max(size, starts[at]) + _width(text)
        out.append("".join(now))
    return out


def _cell(table: list, frame: _Lines) -> None:
    sizes, texts = table
    across, down = sizes[len(texts)]
    texts.append((" ".join(frame.result().split("\n")).strip(), across, down))


def render(root: Node) -> str:
    """All visible text of a tree, laid out."""
    frames = [_Lines()]
    tables: list[tuple[list[int], list[list]]] = []
    todo: list = [("node", root, 0, False, True)]
    while todo:
        kind, item, depth, keep, seen = todo.pop()
        out = frames[-1]
        if kind == "end":
            out.end(gap=item)
        elif kind == "cell":  # an inner frame is finished: its text becomes one cell
            _cell(tables[-1][1], frames.pop())
        elif kind == "table":
            counts, (_, cells) = tables.pop()
            rows, at = [], 0
            for n in counts:
                rows.append(cells[at : at + n])
                at += n
            for line in _grid(rows):
                if line.strip():
                    out._put(line)
                    out.end()
        elif kind == "frame":
            frames.append(_Lines())
        elif isinstance(item, str):
            if seen:
                out.text(item, keep)
        elif item.displayed():
            tag, seen = item.tag, item.visible(seen)
            if tag == "br":
                out.break_line() if out.now else None
                continue
            if tag == "img":
                out.text(item.attrs.get("alt", "") if seen else "", False)
                continue
            block, spaced = tag in BLOCKS, tag in SPACED and not (tag in ("ul", "ol") and depth)
            keep = keep or tag in ("pre", "textarea")
            if block:
                out.end(gap=spaced)
                todo.append(("end", spaced, depth, keep, seen))
            if tag == "table":
                rows, strays = _parts(item, seen)
                cells = [(c, own) for row, own in rows for c in row]
                spans = [
                    (min(WIDEST, max(1, c.number("colspan", 1))), min(TALLEST, max(1, c.number("rowspan", 1)))) for c, _ in cells
                ]
                tables.append(([len(row) for row, _ in rows], [spans, []]))
                todo.append(("table", item, depth, keep, seen))
                for cell, own in reversed(cells):
                    own = cell.visible(own)
                    todo.append(("cell", cell, depth, keep, own))
                    todo.extend(("node", c, 0, keep, own) for c in reversed(cell.children))
                    todo.append(("frame", cell, depth, keep, own))
                if strays:
                    for stray, own in reversed(strays):
                        todo.append(("end", False, depth, keep, seen))
                        todo.append(("node", stray, depth, keep, own))
                continue
            inner = depth + (tag in ("ul", "ol", "menu", "dir"))
            if tag in ("ul", "ol", "menu", "dir"):
                count = item.number("start", 1) if tag == "ol" else 1
                for child in item.children:
                    if isinstance(child, Node) and child.tag == "li":
                        count = child.number("value", count) if tag == "ol" else count
                        child.attrs["\0mark"] = f"{count}. " if tag == "ol" else BULLET
                        count += 1
            if tag == "li" and seen:
                out._put("  " * min(DEEPEST, max(0, depth - 1)) + item.attrs.get("\0mark", BULLET))
            if tag == "pre" and item.children and isinstance(item.children[0], str):
                item.children[0] = item.children[0].removeprefix("\n")  # HTML drops a line end behind the tag
            todo.extend(("node", c, inner, keep, seen) for c in reversed(item.children))
    return frames[0].result()


def page_text(html: str) -> str:
    tree = Tree()
    for kind, value, attributes in tokens(html):
        if kind == "text":
            tree.text(value)
        elif kind == "start":
            tree.start(value, attributes)
        else:
            tree.end(value)
    return render(tree.root)


def _extract(batches: Iterator[pa.RecordBatch]):
    for batch in slices(batches, "html"):
        found = [None if h is None else page_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(found, pa.string())],
            names=["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the visible text of every page."""
    return arrow_map(pages.select("page_id", "url", "html"), "page_id long, url string, text string", _extract)
