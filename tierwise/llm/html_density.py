"""Main-text extraction from HTML by text density.

The standard library's streaming parser turns a page into lines (a line ends
at every block-level tag).  Each line has a text-to-tag ratio; the ratios are
smoothed with a Gaussian and split into two clusters by a threshold.  The
content regions (all ``article``/``main`` elements where a page has them,
otherwise the smallest container that holds all lines of the dense cluster)
are taken whole, less what is menu, header, footer, sidebar, notice, advert,
form, script, style or reader comment by its tag, role or class.

Defined cases: a null or empty page, and one without text outside the
excluded parts, gives the empty string; unclosed and stray tags are
tolerated, as is a page that breaks off; repeated rows are extracted alike.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: elements whose text is never part of the article
DROPPED = frozenset(
    "script style noscript template nav header footer aside form button select option textarea input iframe object svg canvas dialog menu head title".split()
)
REGION = frozenset(("article", "main"))
#: an open paragraph outside of these isn't ended by the next one
P_BOUNDS = ("article", "main", "section", "div", "td", "li", "blockquote", "body")
#: blocks that are parts of a text, not containers of one
PARTS = frozenset("p li ul ol dl dt dd table caption thead tbody tfoot tr td th blockquote figure figcaption pre details summary address".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: words of class and id attributes, and roles, that mark excluded parts
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar widget comment comments commentlist "
    "disqus replies respond cookie cookies consent notice notices newsletter subscribe subscription popup modal overlay breadcrumb breadcrumbs "
    "menu nav navbar navigation topnav footer masthead header share sharing social related recommended pagination pager login signup".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _marked(tag: str, attrs) -> bool:
    for name, value in attrs:
        if name == "hidden":
            return True
        if not value:
            continue
        if name in ("class", "id"):
            words = _WORD.findall(value.lower())
            if tag in ("html", "body", "main"):
                continue
            if any(w in MARKED for w in words) and not (tag == "article" and not any(w.startswith("comment") for w in words)):
                return True
        elif name == "role" and value.lower() in ROLES and tag not in ("html", "body", "main"):
            return True
        elif name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and _HIDDEN.search(value.lower()):
            return True
    return False


class PageLines(HTMLParser):
    """Collects the lines of a page: text, tags seen, region, container."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, region, container
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, dropped, region, container
        self.text: list[str] = []
        self.tags = 0
        self.made = 0
        self.parent = [0]  # of each container; 0 is the page
        # what is open, kept beside the stack: a page may nest without end
        self.opened: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack
        self.headings = 0
        self.excluders: list[str] = []  # tags that began the exclusions still open

    def _push(self, tag, dropped, region, container) -> None:
        if dropped and not self._top()[1]:
            self.excluders.append(tag)
        self.stack.append((tag, dropped, region, container))
        self.opened[tag].append(len(self.stack) - 1)
        self.headings += tag in HEADINGS

    def _pop(self) -> None:
        tag, dropped, *_ = self.stack.pop()
        if dropped and not self._top()[1]:
            self.excluders.pop()
        self.opened[tag].pop()
        self.headings -= tag in HEADINGS

    def _top(self):
        return self.stack[-1] if self.stack else ("", False, 0, 0)

    def flush(self) -> None:
        words = "".join(self.text).split()
        if words:
            _, _, region, container = self._top()
            self.lines.append((" ".join(words), self.tags, region, container))
            self.tags = 0
        self.text.clear()

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        _, dropped, region, container = self._top()
        if tag == "p":  # an open paragraph ends where the next begins
            self._close("p", P_BOUNDS)
            _, dropped, region, container = self._top()
        if tag in REGION and not _marked(tag, attrs):
            if dropped and all(t == "form" for t in self.excluders):
                dropped = False  # a form around the whole page
            if not dropped:
                self.made += 1
                region = region or self.made
        elif not dropped:
            if tag in DROPPED:
                dropped = not (tag == "header" and region)
            elif _marked(tag, attrs):
                dropped = True
            elif region and self.opened["header"] and tag not in HEADINGS and not self.headings:
                dropped = False
        if tag not in INLINE and tag not in HEADINGS and tag not in PARTS:
            self.parent.append(container)
            container = len(self.parent) - 1
        self._push(tag, dropped, region, container)

    def _close(self, tag, until=()) -> None:
        """Closes the innermost ``tag`` and all within it, unless a tag of
        ``until`` is open inside it."""
        if not self.opened[tag]:
            return
        place = self.opened[tag][-1]
        if any(self.opened[t] and self.opened[t][-1] > place for t in until):
            return
        while len(self.stack) > place:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        self._close(tag)

    def handle_data(self, data):
        _, dropped, region, _ = self._top()
        if dropped:
            return
        if region and not self.headings and self.opened["header"]:
            return
        self.text.append(data)

    def finish(self):
        if self.rawdata.startswith("<!--"):  # a comment that never ends
            self.rawdata = ""
        self.close()
        self.flush()
        return self.lines


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; near the ends the kernel is renormalised."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """Boundary of two one-dimensional clusters (means of two groups)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        below, above = values[values < cut], values[values >= cut]
        if not len(below) or not len(above):
            return cut if len(above) else low
        if (below.mean(), above.mean()) == (low, high):
            break
        low, high = float(below.mean()), float(above.mean())
    return (low + high) / 2


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The text of the content regions, blocks joined by one space."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    if any(region for _, _, region, _ in lines):
        return " ".join(text for text, _, region, _ in lines if region)
    ratios = np.array([len(t) / (tags + 1) for t, tags, _, _ in lines])
    dense = (s := smooth(ratios, sigma)) >= (cut := min(threshold(s), s.max()))
    own = dense & (ratios >= cut)  # not only by their neighbours
    inside = _common([x[3] for x in lines], own if own.any() else dense, parser.parent)
    return " ".join(x[0] for x in lines if inside[x[3]])


def _common(containers: list[int], wanted: np.ndarray, parent: list[int]) -> list[bool]:
    """Which containers lie in the smallest one that holds all wanted lines;
    a container's number is above its parent's."""
    held = [0] * len(parent)
    for c, w in zip(containers, wanted.tolist(), strict=True):
        held[c] += w
    for c in range(len(parent) - 1, 0, -1):
        held[parent[c]] += held[c]
    top = max(c for c in range(len(parent)) if held[c] == held[0])
    inside = [top == 0] * len(parent)
    for c in range(1, len(parent)):
        inside[c] = c == top or inside[parent[c]]
    return inside


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; columns besides
    ``page_id``, ``url`` and ``html`` are ignored."""

    def run(batches):
        for b in batches:
            texts = [main_text(h, sigma) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_batches(page, run, "page_id long, url string, text string, n_chars long")
