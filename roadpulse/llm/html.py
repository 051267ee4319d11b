"""Main text of web pages by text-to-tag ratios.

A streaming parser of the standard library turns a page into lines, one per block of text, each with the characters it
holds and the tags met since the line before. The ratios are smoothed by a Gaussian, so that a short paragraph between
long ones is lifted, and clustered by a threshold (half of the mean smoothed ratio). Runs of lines over the threshold are
the content regions, wherever they stand; a region inside an ``article`` or ``main`` element grows to all of that element,
and regions outside it stay. Teasers and related boxes written as ``article`` do not grow: their lines count by their own
ratios. If nothing passes the threshold, the articles are taken.

Elements that as a rule stand beside an article (menus, headers, footers, sidebars, forms, adverts, notices, reader
comments) give lines of ratio zero. The ratios overrule that: before, all lines are smoothed and clustered as they are, and
an element around the heaviest ``article`` or ``main``, or a form or a named ``div`` with most of the text, is a wrapper of
the page if less of the high-ratio text stands free of all such elements; its other parts are judged as on any page.

Null, empty and broken html never fails: open elements end with the page, and end tags without a start are passed over.
A ``<![`` section is a comment up to the next ``>``, as in HTML5, whatever its name. Pages without content give an empty text. Nothing is cut or capped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadpulse.llm.common import slices

# fixed values: element names of HTML by their part in a page
HIDDEN = frozenset(("script", "style", "noscript", "template", "head", "svg", "iframe", "object", "canvas", "math"))
OUTSIDE = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu", "dialog"))
VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
INLINE = frozenset(
    (
        "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
        "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    )
)
WHOLE = frozenset(("article", "main"))
#: leading words in class or id of articles that only point at others
POINTER = re.compile(r"(?:^|\s)(?:teaser|related|promo\w*|sponsor\w*|advert\w*|recommend\w*)(?:$|[\s_-])", re.I)
#: words in class, id or role of elements beside the article
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar\w*|side-bar|footer\w*|masthead|"
    r"breadcrumbs?|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|sharing|social|related|comments?|disqus|"
    r"replies|widget\w*|toolbar|pagination|pager|complementary|contentinfo|navigation)(?:$|[\s_-])",
    re.I,
)
#: words that make a class the state of a wrapper: has-sidebar, comments-open
STATE = frozenset(("no", "has", "with", "without", "is", "open", "closed", "enabled", "disabled", "layout", "on", "off"))
#: reader comments may be most of a page and are still no article
REPLIES = re.compile(r"comments?|disqus|replies", re.I)
#: A wrapper without article or main in it has so many lines over the threshold at least.
WRAPPED_LINES = 3
#: decimal references that int() refuses for their length
LONG_REFERENCE = re.compile(r"&#([0-9]{1000,})")
SIGMA = 1.5
SHARE = 0.5


def named_beside(value: str) -> str | None:
    """The first word of a class or id that names an element beside the article."""
    for word in value.split():
        if (found := BESIDE.search(word)) and STATE.isdisjoint(re.split("[-_]", word.lower())):
            return found[0]
    return None


class Lines(HTMLParser):
    """Lines of a page: (text, tags before it, number of the innermost element around it that stands beside an article or
    -1, number of its article element or 0). The number of an article that does not grow is negative."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.stack: list[tuple[str, int, int, int]] = []  # name, hidden, beside, article
        self.text: list[str] = []
        self.tags = 1
        self.hidden = self.whole = self.wholes = 0
        self.beside = -1
        #: of each element beside: may it be a wrapper by its text alone, and the next one around it
        self.wrapper: list[bool] = []
        self.outer: list[int] = []
        #: the innermost element beside around each article
        self.around: dict[int, int] = {}

    def line(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.lines.append((text, self.tags, self.beside, self.whole))
            self.tags = 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.line()
        if tag in VOID:
            return
        if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            self._implied(tag)
        state = (tag, self.hidden, self.beside, self.whole)
        self.stack.append(state)
        if tag in HIDDEN:
            self.hidden += 1
        elif tag in OUTSIDE and not (tag == "header" and self.whole):
            self._aside(tag == "form")
        elif attrs and tag not in ("html", "body", *WHOLE):
            for name, value in attrs:
                if value and name in ("class", "id", "role") and (word := named_beside(value)):
                    self._aside(not REPLIES.search(word))
                    break
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    self._aside(True)
                    break
        if tag in WHOLE:
            self.wholes += 1
            if tag == "article" and any(value and name in ("class", "id") and POINTER.search(value) for name, value in attrs):
                self.whole = -self.wholes
            elif self.whole <= 0:
                self.whole = self.wholes
                self.around[self.whole] = self.beside

    def _aside(self, wrapper: bool) -> None:
        self.outer.append(self.beside)
        self.beside = len(self.wrapper)
        self.wrapper.append(wrapper)

    def _implied(self, tag: str) -> None:
        """A paragraph or list item ends where the next one begins."""
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                self._close(k)
                return
            if name not in INLINE:
                return

    def _close(self, k: int) -> None:
        _, self.hidden, self.beside, self.whole = self.stack[k]
        del self.stack[k:]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.line()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._close(k)
                return
            if tag in INLINE and self.stack[k][0] not in INLINE:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag:
            self._close(len(self.stack) - 1)

    def parse_html_declaration(self, i: int) -> int:
        """The library raises at unknown sections and looks for the end of known ones anywhere behind."""
        if self.rawdata.startswith("<![", i):
            foreign = any(name in ("svg", "math") for name, *_ in self.stack)
            end = self.rawdata.find("]]>", i) if foreign and self.rawdata.startswith("<![CDATA[", i) else -1
            return end + 3 if end >= 0 else self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, reach), kernel / kernel.sum(), "valid")


def beside(page: Lines, sigma: float = SIGMA, share: float = SHARE) -> np.ndarray:
    """Which lines are in an element beside the article that is no wrapper of the article."""
    at = np.array([x[2] for x in page.lines])
    n = len(page.wrapper)
    if not n:
        return np.zeros(len(at), bool)
    size = np.array([len(x[0]) for x in page.lines])
    smooth = smoothed(size / np.array([x[1] for x in page.lines]), sigma)
    high = smooth > share * smooth.mean()
    size = size * high
    # text and lines over the threshold by element; the last place is that of no element
    held, lines = np.bincount(at % (n + 1), size, n + 1), np.bincount(at % (n + 1), high, n + 1)
    own = held.copy()
    for k in range(n - 1, -1, -1):
        if page.outer[k] >= 0:
            held[page.outer[k]] += held[k]
            lines[page.outer[k]] += lines[k]
    lifted = np.zeros(n + 1, bool)
    lifted[:n] = np.array(page.wrapper) & (held[:n] > max(own[n], size.sum() / 2)) & (lines[:n] >= WRAPPED_LINES)

    def open_() -> np.ndarray:
        """Elements that are wrappers, as are all around them."""
        out = lifted.copy()
        out[n] = True
        for k in range(n):
            out[k] &= out[page.outer[k]]
        return out

    if page.around:
        article = np.array([x[3] for x in page.lines])
        weight = np.bincount(article[article > 0], size[article > 0], max(page.around) + 1)
        heaviest = max(page.around, key=weight.__getitem__)
        if weight[heaviest] > own[open_()].sum():
            k = page.around[heaviest]
            while k >= 0:
                lifted[k] = True
                k = page.outer[k]
    return ~open_()[at]


def content(lines: list[tuple[str, int, bool, int]], sigma: float = SIGMA, share: float = SHARE) -> np.ndarray:
    """Which lines (text, tags, beside the article, article) belong to the content."""
    ratio = np.array([0.0 if beside else len(text) / tags for text, tags, beside, _ in lines])
    beside = np.array([x[2] for x in lines], bool)
    article = np.array([x[3] for x in lines])
    smooth = smoothed(ratio, sigma)
    chosen = (smooth > share * smooth.mean()) & ~beside
    if not chosen.any():
        return (article != 0) & ~beside
    grown = np.unique(article[chosen & (article > 0)])
    return chosen | np.isin(article, grown) & ~beside


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one space."""
    if not html:
        return ""
    parser = Lines()
    # beyond the last code point both are the replacement character
    parser.feed(LONG_REFERENCE.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), html))
    parser.close()
    parser.line()
    if not parser.lines:
        return ""
    chosen = content([(text, tags, b, article) for (text, tags, _, article), b in zip(parser.lines, beside(parser).tolist(), strict=True)])
    return " ".join([line[0] for line, c in zip(parser.lines, chosen, strict=True) if c])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` (code points) of every page."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    given = pages.select("page_id", "url", pages[html_column].alias("html"))
    return given.mapInArrow(run, f"{schema}, text string, n_chars long")
