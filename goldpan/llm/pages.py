"""Main text of web pages from parser events and text-to-tag ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title iframe object svg math canvas audio video map datalist".split())
CHROME = frozenset("nav header footer aside form button select textarea dialog menu".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
MAIN = frozenset(("article", "main"))
#: What an open head may hold; anything else ends it, as its end tag may be left out.
HEAD_PARTS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: An open element of the first kind ends where one of the second kind begins.
ENDS_BEFORE = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p"
                   " pre section table ul".split()),
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",)),
}
#: Words in class, id and role values that name parts around an article.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar"
    " footer header masthead cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social"
    " related recommended recommendations comment comments respond disqus replies widget toolbar pagination pager copyright legal disclaimer skip"
    " complementary contentinfo".split()
)
#: Elements of the page's own frame are no chrome, whatever their class says.
FRAME = frozenset(("html", "body", "article", "main"))
_NAME_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SPACES = re.compile(r"\s+")


@dataclass
class Line:
    """The text between two block borders with the tags met on the way."""

    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    chrome: bool = False
    path: tuple[int, ...] = ()
    main: bool = False
    heading: bool = False
    text: str = ""


class LineReader(HTMLParser):
    """Turns parser events into lines; every block element begins and ends one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, int]] = []  # element, whether it or one around it is chrome, number
        self.count = 0
        self.silent = 0
        self.links = 0
        self.current = Line()

    def _flush(self) -> None:
        line = self.current
        line.text = _SPACES.sub(" ", "".join(line.parts)).strip()
        line.parts = []
        if line.text or line.tags:
            self.lines.append(line)
        self.current = Line(chrome=bool(self.open) and self.open[-1][1], path=tuple(n for _, _, n in self.open),
                            main=any(t in MAIN for t, _, _ in self.open), heading=any(re.fullmatch("h[1-6]", t) for t, _, _ in self.open))

    def _chrome(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in CHROME:
            # a header or a footer of an article is chrome as well: it holds by-lines and sharing links, not text
            return True
        if tag in FRAME:
            return False
        for name, value in attrs:
            if name in ("hidden",) or (name == "aria-hidden" and value == "true"):
                return True
            if name in ("class", "id", "role") and value and not CHROME_WORDS.isdisjoint(_NAME_WORD.findall(_CAMEL.sub(" ", value).lower())):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open and self.open[-1][0] == "head" and tag not in HEAD_PARTS:
            self._close()
        if tag == "br":
            self.current.parts.append(" ")
            self.current.tags += 1
            return
        while self.open and tag in ENDS_BEFORE.get(self.open[-1][0], ()):
            self._close()
        if tag in VOID:
            self.current.tags += 1
            return
        chrome = bool(self.open) and self.open[-1][1] or self._chrome(tag, attrs)
        self.count += 1
        self.open.append((tag, chrome, self.count))
        self.silent += tag in SILENT
        self.links += tag == "a"
        if tag not in INLINE:
            self._flush()
        elif chrome != self.current.chrome and self._inline_chrome(tag):
            self._flush()
        self.current.tags += 1

    def _inline_chrome(self, tag: str) -> bool:
        return tag == "span" or tag in CHROME

    def _close(self) -> None:
        tag, chrome, _ = self.open.pop()
        self.silent -= tag in SILENT
        self.links -= tag == "a"
        if tag not in INLINE or chrome != (bool(self.open) and self.open[-1][1]):
            self._flush()

    def handle_endtag(self, tag: str) -> None:
        self.current.tags += 1
        if tag == "p" and not any(t == "p" for t, _, _ in self.open):
            return
        depth = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag), None)
        if depth is None:
            return
        if tag in INLINE and any(t not in INLINE for t, _, _ in self.open[depth + 1:]):
            # an inline element that was never closed before a block: only the element itself goes
            gone = self.open.pop(depth)
            self.links -= gone[0] == "a"
            return
        while len(self.open) > depth:
            self._close()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._close()
        if self.silent:
            return
        self.current.parts.append(data)
        if self.links:
            self.current.linked += len(data.strip())

    def read(self, html: str) -> list[Line]:
        self.feed(html)
        self.close()
        self._flush()
        return self.lines


def ratios(lines: list[Line]) -> np.ndarray:
    """Characters of unlinked text per tag of each line; parts around the article count nothing."""
    return np.array([0.0 if x.chrome else max(0, len(x.text) - x.linked) / max(1, x.tags) for x in lines])


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over the lines; at the ends the weights that remain are scaled up."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]
    return np.convolve(values, kernel)[reach:reach + len(values)] / weights


def main_lines(lines: list[Line], sigma: float) -> list[Line]:
    """Lines of the content region.

    Lines whose smoothed ratio reaches the standard deviation of all of them form the content cluster.  Its region is what the
    marked main elements hold, if they hold most of the cluster's text, or else the smallest element that holds the whole cluster; short
    lines between long ones belong to the region as well.
    """
    value = ratios(lines)
    if not len(value) or not value.any():
        return []
    smooth = smoothed(value, sigma)
    threshold = min(float(smooth.std()), float(smooth.max()))
    content = [x for x, v in zip(lines, smooth, strict=True) if v >= threshold and x.text and not x.chrome]
    if not content:
        return []
    total = sum(len(x.text) for x in content)
    if 2 * sum(len(x.text) for x in content if x.main) > total:
        return [x for x in lines if x.main and x.text and not x.chrome]
    around = set(content[0].path).intersection(*(x.path for x in content[1:]))
    root = max(around, default=None)  # elements are numbered from the outside in
    return [x for x in lines if x.text and not x.chrome and (root is None or root in x.path)]


def main_text(html: str | None, sigma: float = 1.5) -> str:
    """Blocks of the content region joined by line feeds; empty for pages without text."""
    if not html:
        return ""
    return "\n".join(x.text for x in main_lines(LineReader().read(html), sigma))


def extract_pages(pages: DataFrame, sigma: float = 1.5, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Main text of every page and its number of code points.

    A null, empty or text-free page gives an empty text; pages are parsed whole, however long or badly nested; repeated rows give repeated
    results; of all other columns only those named in ``keep`` are carried.
    """

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, sigma) for h in htmls], dtype="object")

    return (
        pages.select(*keep, extracted(F.col(html_column)).alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
