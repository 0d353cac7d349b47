"""Text of web pages as a reader sees it: a forgiving tree, visibility rules, and a renderer that keeps the layout."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablewright.llm.shared import replaced

WIDEST = 40  # cells are aligned up to this width; longer ones stick out, so a page cannot blow up

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title object iframe audio video canvas datalist".split())
# Drawings and formulas show their text, except for these elements; each tag means this only inside svg or math.
UNDRAWN = {
    "svg": frozenset("desc defs metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
APART = {"svg": frozenset(["text"]), "math": frozenset("mi mn mo ms mtext".split())}  # drawn at places of their own
HEAD_CONTENT = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
# Blank lines around a block.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure fieldset hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article header footer nav main aside address form li dt dd tr td th thead tbody tfoot "
    "caption figcaption details summary center option legend".split()
)
# What a start tag closes if it is open, and the elements that shield what is outside them.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th caption", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "thead": ("thead tbody tfoot tr td th caption", ("table",)), "tbody": ("thead tbody tfoot tr td th caption", ("table",)),
    "tfoot": ("thead tbody tfoot tr td th caption", ("table",)), "option": ("option", ("select",)), "body": ("head", ("html",)),
}
SHIELDS = frozenset("td th table body html template".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
TAG = re.compile(r"<[a-zA-Z/!?]")


class Node:
    __slots__ = ("tag", "attrs", "children", "inside")

    def __init__(self, tag: str, attrs: dict, inside: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.inside = inside  # svg, math or nothing

    def hidden(self) -> bool:
        a = self.attrs
        return (
            self.tag in HIDDEN or self.inside and self.tag in UNDRAWN[self.inside] or "hidden" in a or a.get("aria-hidden") == "true"
            or bool(a.get("style") and UNSEEN.search(a["style"])) or self.tag == "dialog" and "open" not in a
        )


class Tree(HTMLParser):
    """Start and end tags to a tree: missing ends are implied, stray ends ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.count = Counter()  # open elements by tag, so that deep pages are not searched in vain

    def _drop(self, at: int) -> None:
        self.count.subtract(n.tag for n in self.open[at:])
        del self.open[at:]

    def _close(self, tags, shields) -> None:
        """Close all open elements of these tags up to the nearest shield."""
        while any(self.count[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                tag = self.open[i].tag
                if tag in tags:
                    self._drop(i)
                    break
                if tag in shields:
                    return

    def _imply(self, tag: str) -> None:
        """Rows and cells get the table parts they need."""
        top = self.open[-1].tag
        if tag in ("td", "th") and top in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})

    def _inside(self) -> str:
        return "svg" if self.count["svg"] else "math" if self.count["math"] else ""

    def _push(self, tag: str, attrs: dict) -> None:
        node = Node(tag, attrs, self._inside())
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if self.open[-1].tag == "head" and tag not in HEAD_CONTENT:
            self._drop(len(self.open) - 1)
        if tag in CLOSES:
            tags, shields = CLOSES[tag]
            self._close(tags.split(), shields)
        if tag in BLOCKS and tag not in ("option", "html", "body"):
            self._close(("p",), SHIELDS | {"button", "object"})
        self._imply(tag)
        self._push(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open[-1].tag == tag and (tag in ("svg", "math") or self.open[-1].inside):  # elsewhere the slash means nothing
            self._drop(len(self.open) - 1)

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            own = self.open[i].tag
            if own == tag:
                self._drop(i)
                return
            if own in SHIELDS and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "td", "th"):
                return

    def parse_html_declaration(self, i):
        """``<![if ...]>`` and the like show nothing up to the next ``>``; in comments and scripts they are plain characters.

        Inside svg and math ``<![CDATA[...]]>`` is text.
        """
        if self._inside() and self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            if end > 0:
                self.handle_data(self.rawdata[i + 9 : end])
                return end + 3
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._drop(len(self.open) - 1)
        self.open[-1].children.append(data)


class Writer:
    """Lines of one flow: collapsed blanks, gaps between blocks, hanging list markers."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False
        self.gap = 0
        self.indent: list[str] = []
        self.marker = ""

    def text(self, data: str) -> None:
        words = data.split()
        if not words:
            self.blank = self.blank or bool(data)
            return
        if self.parts and (self.blank or data[0].isspace()):
            self.parts.append(" ")
        self.parts.append(" ".join(words))
        self.blank = data[-1].isspace()

    def verbatim(self, data: str) -> None:
        for i, line in enumerate(data.split("\n")):
            if i:
                self.end(True)
            if line:
                self.parts.append(line)

    def end(self, always: bool = False) -> None:
        """Finish the line; an empty one only counts if asked for."""
        if self.parts or always:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            lead = "".join(self.indent[:-1] if self.marker else self.indent) + self.marker
            self.marker = ""
            self.lines.append((lead + "".join(self.parts)).rstrip())
        self.parts, self.blank = [], False

    def block(self, gap: int) -> None:
        self.end()
        self.gap = max(self.gap, gap)

    def result(self) -> list[str]:
        self.end()
        return self.lines


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Cells side by side, each column as wide as its widest line (up to WIDEST)."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            wide = min(max(map(len, cell), default=0), WIDEST)
            if i == len(widths):
                widths.append(wide)
            else:
                widths[i] = max(widths[i], wide)
    out = []
    for row in rows:
        for k in range(max(map(len, row), default=0)):
            line = "  ".join((cell[k] if k < len(cell) else "").ljust(widths[i]) for i, cell in enumerate(row))
            out.append(line.rstrip())
    return out


def render(root: Node) -> str:
    """Walk the tree without recursion: pages may be nested as deeply as they like."""
    writers, tables, lists, pre = [Writer()], [], [], 0
    todo: list = [(root, False)]
    while todo:
        node, leave = todo.pop()
        out = writers[-1]
        if isinstance(node, str):
            (out.verbatim if pre else out.text)(node)
            continue
        tag = node.tag
        if leave:
            if tag in ("td", "th", "caption") and tables:
                writers.pop()
                cell = out.result()
                row = tables[-1]
                if tag == "caption" or not row:
                    row.append([])
                row[-1].append(cell)
                span = node.attrs.get("colspan", "")
                row[-1].extend([[]] * (min(int(span), 100) - 1 if span.isascii() and span.isdigit() and span != "0" else 0))
                if tag == "caption":
                    row.append([])
            elif tag == "table":
                rows = [r for r in tables.pop() if any(r)]
                out.block(1)
                for line in table_lines(rows):
                    out.parts.append(line)
                    out.end(True)
                out.block(1)
            elif tag == "li":
                out.end()
                out.indent.pop()
                out.marker = ""
            elif tag in ("ul", "ol"):
                lists.pop()
                out.block(0 if lists else 1)
            elif tag == "dd" or tag == "blockquote":
                out.end()
                out.indent.pop()
                out.block(int(tag in SPACED))
            elif tag == "pre":
                pre -= 1
                out.block(1)
            elif tag in BLOCKS:
                out.block(int(tag in SPACED))
            elif node.inside and tag in APART[node.inside]:
                (out.verbatim if pre else out.text)(" ")
            continue
        if node.hidden():
            continue
        if tag == "br":
            out.end(True)
            continue
        if tag == "hr":
            out.block(1)
            out.text("---")
            out.block(1)
            continue
        if tag in ("td", "th", "caption") and tables:
            writers.append(Writer())
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag == "table":
            out.block(1)
            tables.append([])
        elif tag == "li":
            out.block(0)
            if lists and lists[-1] is not None:
                lists[-1] += 1
            mark = f"{lists[-1]}. " if lists and lists[-1] is not None else "- "
            out.indent.append(" " * len(mark))
            out.marker = mark
        elif tag in ("ul", "ol"):
            out.block(0 if lists else 1)
            start = node.attrs.get("start", "")
            lists.append((int(start) - 1 if start.isascii() and start.isdigit() and len(start) < 10 else 0) if tag == "ol" else None)
        elif tag == "dd" or tag == "blockquote":
            out.block(int(tag in SPACED))
            out.indent.append("  ")
        elif tag == "pre":
            out.block(1)
            pre += 1
        elif tag in BLOCKS:
            out.block(int(tag in SPACED))
        elif node.inside and tag in APART[node.inside]:
            (out.verbatim if pre else out.text)(" ")
        if tag not in VOID:
            todo.append((node, True))
            todo.extend((child, False) for child in reversed(node.children))
    while len(writers) > 1:  # cannot happen for a closed tree
        writers.pop()
    return "\n".join(writers[0].result()).strip("\n")


def page_text(html: str | None) -> str:
    """Visible text of one page; null, empty and tagless input are fine."""
    if not html:
        return ""
    unfinished = TAG.search(html, html.rfind(">") + 1)  # a tag that the page's end cuts off shows nothing
    tree = Tree()
    tree.feed(html[: unfinished.start()] if unfinished else html)
    tree.close()
    return render(tree.root)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Put ``text`` and ``n_chars`` in the place of ``html``, for every row of ``pages``, one page at a time.

    A null page has empty text. Nothing is cut: every visible character of a page of any length comes out, with one
    exception: ``aria-hidden=true`` is left out although browsers show it. What a page draws by style sheets or
    scripts, and the stand-in text of embedded objects, is not looked at.
    """
    kept = [c for c in replaced(pages, ["text", "n_chars"]).columns if c != html]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html).alias("__html"))
    schema = StructType([*rows.schema.fields[:-1], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                text = [page_text(x) for x in part.column(len(kept)).to_pylist()]
                columns = [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *columns], names=[*kept, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
