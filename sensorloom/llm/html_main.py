"""Main text of web pages from the events of the standard library's HTML parser.

A page becomes a row of lines (blocks of text). Each line has a text-to-tag ratio: its characters over
the tags met in it. The ratios are smoothed with a Gaussian kernel; lines above a share of their
standard deviation form the content clusters. The region is the deepest element that holds nearly all
text of the clusters. An article or main element around it takes its place and bounds the text; without
one, lines of the clusters outside the region (title, introduction, ending) count too, but for links.
Within the region all lines stay, in page order, but for blocks of links: three or more lines in a row that
are mostly link text and whose own ratio is below the clusters'.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are known by element, role
or class and left out. A block left out by role or class alone is taken back if it holds nearly all text
of the clusters and no article or main element beside it has text.

Defined results: a null or empty html, or one without text, gives an empty text; unclosed elements end
with the element around them; equal rows give equal texts; an empty table gives no rows. Other columns
are ignored, whatever their names. Time grows in proportion to a page's length, however deep its elements
are nested.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body blockquote center dialog div dl fieldset figure footer form head header html main "
    "menu nav ol section table ul".split()
)
LEFT_OUT = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object script select style svg "
    "template textarea title".split()
)
LEFT_OUT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent disclaimer footer masthead menu modal nav navbar navigation newsletter notice notices "
    "popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
PARTS = re.compile(r"[\s_-]+")
SPACE = re.compile(r"\s+")

SIGMA = 1.5
THRESHOLD = 0.3
REGION_SHARE = 0.8
LINK_LINES = 3
#: Elements that leave a head open; any other ends it.
IN_HEAD = frozenset("base head link meta noscript script style template title".split())


class _Element:
    """What its place in the tree tells is kept as it opens, so that no line walks up to the root.

    ``marked``: it or one around it is named; ``article``: the nearest article or main element, itself included.
    """

    __slots__ = ("tag", "parent", "hidden", "named", "mass", "depth", "marked", "article")

    def __init__(self, tag: str, parent: "_Element | None", hidden: bool, named: bool = False):
        self.tag, self.parent, self.hidden, self.named, self.mass = tag, parent, hidden, named, 0.0
        self.depth = parent.depth + 1 if parent else 0
        self.marked = named or parent is not None and parent.marked
        self.article = self if tag in ("article", "main") else parent and parent.article


def _weigh(elements: list[_Element], lines: list, content: np.ndarray) -> None:
    """Give every element the characters of the content lines in it; elements stand in order of opening."""
    for element in elements:
        element.mass = 0.0
    for size, (_, _, element, _) in zip(content, lines, strict=True):
        element.mass += size
    for element in reversed(elements):
        if element.parent is not None:
            element.parent.mass += element.mass


class _Lines(HTMLParser):
    """Collects lines as (text, tags, element, characters in links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Element("", None, False)
        self.elements: list[_Element] = [self.root]
        self.open: list[_Element] = [self.root]
        self.n_open: Counter[str] = Counter()
        self.lines: list[tuple[str, int, _Element, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.in_link = False

    def _end_line(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((text, self.tags, self.open[-1], self.linked))
            self.parts = []
        self.tags = self.linked = 0

    def _left_out(self, tag: str) -> bool:
        return tag in LEFT_OUT or tag == "header" and self.open[-1].article is None

    def _named(self, tag: str, attributes: list) -> bool:
        """Whether a role, class or id tells that it is no content."""
        if tag in ("header", "html", "body", "article", "main"):
            return False
        for name, value in attributes:
            if not value:
                continue
            if name == "role" and value.strip().lower() in LEFT_OUT_ROLES:
                return True
            if name in ("class", "id") and not LEFT_OUT_NAMES.isdisjoint(PARTS.split(value.lower())):
                return True
        return False

    def _leave(self, tag: str) -> None:
        """Close the innermost open element ``tag``, if there is one, and all within it."""
        if self.n_open[tag]:
            left = None
            while left != tag:
                left = self.open.pop().tag
                self.n_open[left] -= 1

    def handle_starttag(self, tag, attrs):
        if self.open[-1].tag == "head" and tag not in IN_HEAD or tag == "body":
            self._leave("head")
        if tag in BLOCKS:
            self._end_line()
            if self.open[-1].tag == "p":
                self._leave("p")
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.in_link = True
        hidden, named = self._left_out(tag), self._named(tag, attrs)
        if named and tag not in BLOCKS:  # within a line, whose text goes on after it
            hidden = True
        if hidden or named or tag in CONTAINERS:
            above = self.open[-1]
            self.open.append(_Element(tag, above, hidden or above.hidden, named))
            self.elements.append(self.open[-1])
            self.n_open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_line()
        if tag == "a" or tag in BLOCKS:
            self.in_link = False
        self.tags += 1
        self._leave(tag)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._leave("head")
        if not self.open[-1].hidden:
            self.parts.append(data)
            self.linked += len(data) if self.in_link else 0

    def close(self):
        super().close()
        self._end_line()


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = int(3 * SIGMA + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _clusters(lines: list) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the lines that are content by their smoothed ratio, else 0; and whether each line's own
    ratio is below the clusters'."""
    sizes = np.array([len(text) for text, *_ in lines], float)
    ratios = sizes / np.maximum([tags for _, tags, *_ in lines], 1)
    smooth = _smoothed(ratios)
    least = THRESHOLD * smooth.std()
    content = np.where(smooth >= least, sizes, 0.0)
    return content if content.any() else sizes, ratios < least


def _without_named(lines: list, elements: list[_Element]) -> list:
    """The lines but for those in blocks that a role or class leaves out."""
    if not any(element.marked for _, _, element, _ in lines):
        return lines
    semantic = any(element.article is not None and not element.marked for _, _, element, _ in lines)
    least = np.inf
    if not semantic:
        content, _ = _clusters(lines)
        _weigh(elements, lines, content)
        least = REGION_SHARE * content.sum()
    out: set[_Element] = set()
    for element in elements:
        if element.parent in out or element.named and element.mass < least:
            out.add(element)
    return [line for line in lines if line[2] not in out]


def _link_blocks(lines: list, low: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Lines in runs of LINK_LINES or more low lines of links."""
    found = np.zeros(len(lines) + 2, bool)
    found[1:-1] = low & links
    edges = np.flatnonzero(found[1:] != found[:-1])
    for start, end in edges.reshape(-1, 2):
        if end - start < LINK_LINES:
            found[start + 1 : end + 1] = False
    return found[1:-1]


def main_text(html: str | None) -> str:
    """The main text of one page."""
    page = _Lines()
    page.feed(html if isinstance(html, str) else "")
    page.close()
    lines = _without_named(page.lines, page.elements)
    if not lines:
        return ""
    content, low = _clusters(lines)
    _weigh(page.elements, lines, content)
    least = REGION_SHARE * content.sum()
    best = max((e for e in page.elements if e.mass >= least), key=lambda e: e.depth)
    around = best.article
    region = around or best

    inside: dict[int, bool] = {id(region): True}

    def within(element: _Element | None) -> bool:
        path = []
        while element is not None and id(element) not in inside:
            path.append(id(element))
            element = element.parent
        answer = element is not None and inside[id(element)]
        inside.update(dict.fromkeys(path, answer))
        return answer

    links = np.array([2 * linked > len(text) for text, _, _, linked in lines])
    blocks = _link_blocks(lines, low, links)
    return "\n".join(
        text
        for (text, _, element, _), size, link, block in zip(lines, content, links, blocks, strict=True)
        if (not block if within(element) else around is None and size > 0 and not link)
    )


@F.pandas_udf(StringType())
def main_text_of(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    texts = pages.select("page_id", "url", main_text_of(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
