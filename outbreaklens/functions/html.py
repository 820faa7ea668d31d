"""Article text of an HTML page.

A page is read by the parser of the standard library: real pages leave elements open, close them by the end of an
outer one, quote badly and write character references in old ways, which no expression of patterns follows. The
parser sees each page once, in Arrow batches, and takes time in proportion to its length.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

REGIONS = ("main", "article", "body")
LEFT_OUT = frozenset(("nav", "header", "footer", "script", "style"))
# Elements without an end tag.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Article(HTMLParser):
    """Text nodes with the regions they lie in. An end tag closes what is open inside its element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # tag, and whether it is the first of its region
        self.count: dict[str, int] = {}
        self.seen: set[str] = set()
        self.inside: set[str] = set()
        self.left_out = 0
        self.nodes: list[tuple[frozenset[str], str]] = []
        self.text: list[str] = []

    def _end_node(self) -> None:
        if self.text and not self.left_out:
            self.nodes.append((frozenset(self.inside), "".join(self.text)))
        self.text = []

    def handle_starttag(self, tag, attrs):
        self._end_node()
        if tag in EMPTY:
            return
        first = tag in REGIONS and tag not in self.seen
        if first:
            self.seen.add(tag)
            self.inside.add(tag)
        self.open.append((tag, first))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.left_out += tag in LEFT_OUT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_node()
        if not self.count.get(tag):
            return
        while True:
            name, first = self.open.pop()
            self.count[name] -= 1
            self.left_out -= name in LEFT_OUT
            if first:
                self.inside.discard(name)
            if name == tag:
                return

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._end_node()

    handle_decl = handle_pi = unknown_decl = handle_comment


def page_text(page: str | None) -> str | None:
    """Text nodes of the first main, article or body element or of the whole page, stripped, one per line."""
    if page is None:
        return None
    parser = _Article()
    parser.feed(page)
    parser.close()
    parser._end_node()
    region = next((name for name in REGIONS if name in parser.seen), None)
    nodes = (text.strip() for inside, text in parser.nodes if region is None or region in inside)
    return "\n".join(text for text in nodes if text)


def article_text(html: Column) -> Column:
    """Text nodes of the first main, article or body element, without navigation and scripts, one per line."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([page_text(page) for page in pages.to_pylist()], pa.string())

    return run(html)
