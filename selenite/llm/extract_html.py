"""HTML extraction: parser events give lines, their text-to-tag ratios are smoothed and clustered by a threshold.

The standard library's parser reports a page tag by tag; every block is one line with its characters outside links per tag. Lines
of boilerplate elements have ratio 0. After Gaussian smoothing, lines of at least one standard deviation are content, and content
lines select regions: the articles that hold some, else the span from the first to the last of them. A region is kept whole, since
a short paragraph between long ones has a low ratio of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import trim

#: Elements that start and end a line. The lists of this module are fixed values of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never content.
DROPPED = frozenset("aside audio button canvas dialog footer form head iframe math menu nav noscript object script select style svg template textarea title video".split())
#: A start tag of the first closes an open element of the second; the third ends the search.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
}
#: An end tag of a line doesn't close what lies outside of these.
REGIONS = frozenset("article aside body div dialog footer form header main nav section td th".split())
#: Words of class, id and role that mark boilerplate.
LABELS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promos promotion banner contentinfo cookie cookies consent "
    "gdpr notice notices notification sidebar rail complementary nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead topbar "
    "share sharing social related recommended newsletter subscribe signup paywall popup modal toolbar pagination pager search skip "
    "comment comments commentlist disqus respond replies teaser teasers".split()
)
#: Of those, the ones that also mark an article as no main text.
OTHERS = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments reply replies teaser".split())
#: Words that turn a label around, as in no-sidebar.
TURNED = frozenset("has no not with without hide".split())
_BEGUN = re.compile(r"<[a-zA-Z/!?]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SIGMA = 1.0
#: Gaussian weights of a line's neighbours.
KERNEL = np.exp(-0.5 * (np.arange(-3, 4) / SIGMA) ** 2)


def labelled(attrs: list[tuple[str, str | None]], words: frozenset[str] = LABELS) -> bool:
    """Whether class, id or role name boilerplate, by one of their words."""
    for key, value in attrs:
        if value and key in ("class", "id", "role"):
            for name in value.split():
                found = [w.lower() for w in _WORD.findall(name)]
                if not words.isdisjoint(found) and TURNED.isdisjoint(found):
                    return True
    return False


class Lines(HTMLParser):
    """Collects a page's lines: texts, characters outside links, tags, whether they may be content, and the article around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.chars: list[int] = []
        self.tags: list[int] = []
        self.kept: list[bool] = []
        self.articles: list[int] = []
        self._open: list[tuple[str, bool, int, bool]] = []  # tag and the state outside of it
        self._dropped = False
        self._firm = False  # dropped in a way that no article inside undoes
        self._article = 0
        self._n_articles = 0
        self._parts: list[str] = []
        self._linked = 0
        self._n_tags = 0
        self._in_link = False

    def _end_line(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.texts.append(text)
                self.chars.append(max(0, len(text) - self._linked))
                self.tags.append(self._n_tags)
                self.kept.append(not self._dropped)
                self.articles.append(self._article)
            self._parts = []
        self._linked = self._n_tags = 0

    def _close(self, at: int) -> None:
        """Closes the open elements from place ``at`` on."""
        self._end_line()
        _, self._dropped, self._article, self._firm = self._open[at]
        del self._open[at:]

    def _find(self, tags: frozenset[str], ends: frozenset[str]) -> int:
        for at in range(len(self._open) - 1, -1, -1):
            tag = self._open[at][0]
            if tag in tags:
                return at
            if tag in ends:
                break
        return -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._n_tags += 1
        if tag in VOID:
            if tag == "br":
                self._parts.append(" ")
            elif tag == "hr":
                self._end_line()
            return
        if tag == "a":
            self._in_link = True
        block = tag in BLOCKS
        if block:
            at = self._find(*CLOSES[tag]) if tag in CLOSES else self._find(frozenset(("p",)), REGIONS)
            if at >= 0:
                self._close(at)
            self._end_line()
            self._n_tags = 1
        main = tag == "article" or tag == "main"
        if main:
            drop = tag == "article" and bool(attrs) and labelled(attrs, OTHERS)
        elif tag == "body" or tag == "html":
            drop = False
        else:
            drop = tag in DROPPED or tag == "header" and not self._article or (bool(attrs) and not (len(tag) == 2 and tag[0] == "h") and labelled(attrs, LABELS - {"header"} if self._article else LABELS))
        if not (block or drop or self._dropped):
            return
        if not block and drop and not self._dropped:  # text before it is of this line, its own isn't
            self._end_line()
        self._open.append((tag, self._dropped, self._article, self._firm))
        if drop:
            self._dropped = True
            self._firm = self._firm or main or tag in ("aside", "footer") or labelled(attrs, OTHERS)
        elif main and not self._firm:
            self._dropped = False
            if tag == "article" or not self._article:
                self._n_articles += 1
                self._article = self._n_articles
        elif tag == "body":
            self._dropped = self._firm = False

    def handle_endtag(self, tag: str) -> None:
        self._n_tags += 1
        if tag == "a":
            self._in_link = False
        at = self._find(frozenset((tag,)), frozenset() if tag in REGIONS or tag in BLOCKS and tag != "p" and tag != "li" else REGIONS)
        if at >= 0:
            self._close(at)
        elif tag in BLOCKS:
            self._end_line()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        self._parts.append(data)
        if self._in_link:
            self._linked += len(data)

    def end(self) -> None:
        """Ends the last line."""
        self._end_line()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian means over the line and three lines to either side; beyond the ends nothing counts."""
    side = len(KERNEL) // 2
    around = np.pad(ratios, side)
    inside = np.pad(np.ones(len(ratios)), side)
    return np.convolve(around, KERNEL, "valid") / np.convolve(inside, KERNEL, "valid")


def main_text(html: str | None) -> str:
    """The content lines of a page in their order, joined by a newline; empty for null, empty and pages without content."""
    if not html:
        return ""
    page = Lines()
    # behind the last ">" nothing is a whole tag: text up to the first that is begun, which the page's end drops, as browsers do.
    # The parser would try each of them anew
    whole = html.rfind(">") + 1
    page.feed(html[:whole])
    page.close()
    page.handle_data(unescape(_BEGUN.split(html[whole:], maxsplit=1)[0]))
    page.end()
    if not any(page.kept):
        return ""
    kept = np.array(page.kept)
    chars = np.where(kept, np.array(page.chars, dtype=float), 0.0)
    values = smoothed(chars / np.maximum(np.array(page.tags), 1))
    content = kept & (values >= values.std()) & (chars > 0)
    articles = np.array(page.articles)
    inside = kept & (articles > 0)
    if inside.any():
        chosen = np.unique(articles[content & inside])
        keep = inside & np.isin(articles, chosen) if len(chosen) else inside
    elif content.any():
        at = np.flatnonzero(content)
        keep = kept.copy()
        keep[: at[0]] = keep[at[-1] + 1 :] = False
        keep &= (2 * chars >= np.array([len(t) for t in page.texts])) | content  # lists of links between
    else:
        keep = kept
    return "\n".join(t for t, k in zip(page.texts, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page and its code points.

    A tag that the page's end breaks off is dropped. Null or empty html gives an empty text, null ids and urls stay null, repeated rows stay repeated, an empty table gives no rows,
    further columns are left out. A page is parsed whole in one task: a very long one needs some ten times its size there.
    Rows of equal ratio are treated alike, so ties need no order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
            trim()

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.selectExpr("page_id", "url", "CAST(html AS STRING) AS html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
