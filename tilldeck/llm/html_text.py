"""Main text of web pages from streaming parser events.

The parser's events give lines (block elements) with their text and number of
tags. Text-to-tag ratios are smoothed by a Gaussian; lines above the standard
deviation of the smoothed ratios cluster into content regions. The smallest element,
or run of siblings in it, that covers all regions is the article, with neighbours
that are not mostly links: its blocks are the text, short ones included, without the
parts that page markup names as something else. Article tags are a hint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.words import chunks, column, whole_texts

SIGMA = 1.0
# Share of the content regions' text from which on articles hold all that counts.
LEAST_SHARE = 0.8
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
# Elements that are kept on the stack; others need no matching end.
_HOLDER = _BLOCK - frozenset("p hr h1 h2 h3 h4 h5 h6 li dd dt tr td th tbody thead tfoot".split())
_LEFT_OUT = frozenset("nav header footer aside form dialog menu search".split())
_MUTE = frozenset(
    "script style noscript template head title svg math iframe object select textarea button audio video canvas".split()
)
_ARTICLE = frozenset(("article", "main"))
# Names in class, id or role that mark an element as no part of the article.
_OTHER = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar footer header masthead contentinfo complementary comment "
    "comments commentlist respond reply replies disqus cookie cookies consent gdpr notice notices notification alert "
    "newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended "
    "recommendations widget widgets toolbar pagination pager search skip".split()
)
_REMARKS = frozenset("comment comments commentlist respond reply replies disqus".split())
# An element is not extended to all of these.
_PAGE = frozenset(("", "html", "body"))
# Share of a neighbour's text from which on links make it no part of the article.
_MOST_LINKS = 0.5
_BODY = frozenset("article content main post entry story body text".split())
# First parts of names that tell of a page's layout, not of an element's role.
_ABOUT = frozenset("has no with without is not show hide toggle js".split())
# Last parts of names that say nothing if an unknown word stands before them, as in a
# section on job search.
_LOOSE = frozenset("search notice notices promotion related social skip respond reply replies".split())
_NAMES = re.compile(r"[^a-z0-9]+")


def named_part(value: str) -> int:
    """What the names in class, id or role say of an element: 0 nothing, 1 no part of the
    article, 2 a reader's remark.

    The last part of a name decides (``post-comments`` are comments), else the first one
    (``comment-body``), which a name made of words for the article overrules
    (``content sidebar-left``).
    """
    strong = weak = 0
    body = False
    for name in value.lower().split():
        parts = [p for p in _NAMES.split(name) if p]
        if not parts or parts[0] in _ABOUT:
            continue
        first, last = parts[0], parts[-1]
        unknown = len(parts) > 1 and not any(p in _OTHER or p in _BODY for p in parts[:-1])
        if last in _OTHER and not (last in _LOOSE and unknown):
            strong = max(strong, 2 if last in _REMARKS else 1)
        elif first in _OTHER and len(parts) > 1:
            weak = max(weak, 2 if first in _REMARKS else 1)
        elif _BODY.issuperset(parts):
            body = True
    return max(strong, 0 if body else weak)


class _Lines(HTMLParser):
    """Lines of one page: text, tags, element, and whether it counts at all."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.homes: list[int] = []
        self.links: list[int] = []
        self.headings: list[bool] = []
        # Element numbers: parent, name, and whether it is an article.
        self.parents = [-1]
        self.tag_names = [""]
        self.articles = [False]
        self.stack: list[tuple[str, int, int]] = []
        self.home = 0
        # 0 counts, 1 is left out, 2 is a reader's remark.
        self.out = 0
        # Open elements without text of the article: name, depth, and the block they began in.
        self.mute: list[tuple[str, int, str]] = []
        self.block = ""
        self.heading = False
        self.words: list[str] = []
        self.count = 0
        self.linked = False
        self.link = 0

    def _line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.texts.append(text)
            self.tags.append(self.count)
            self.homes.append(self.home)
            self.links.append(self.link)
            self.headings.append(self.heading)
        if text or self.count:
            self.words.clear()
            self.count = self.link = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _MUTE:
            self.mute.append((tag, len(self.stack), self.block))
            return
        if tag in _BLOCK:
            if [name for name, _, _ in self.mute] == ["head"]:
                self.mute.clear()  # its end tag may be left out
            self._line()
            if not self.mute:
                self.block = "" if tag in _HOLDER else tag
            self.heading = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
            if tag in _HOLDER:
                self._open(tag, attrs)
        elif tag == "br":
            self.words.append(" ")
        elif tag == "a":
            self.linked = True
        self.count += 1

    def _open(self, tag: str, attrs: list) -> None:
        out = self.out
        named = named_part(" ".join(v for k, v in attrs if v and k in ("class", "id", "role")))
        if named and tag not in ("body", "html"):
            out = max(out, named)
        elif tag in _LEFT_OUT:
            out = max(out, 1)
        elif tag in _ARTICLE and out == 1 and not any(t in _LEFT_OUT for t, _, _ in self.stack):
            # An advert whose end tag is missing does not swallow the article.
            out = 0
        self.stack.append((tag, self.home, self.out))
        self.parents.append(self.home)
        self.tag_names.append(tag)
        self.articles.append(tag in _ARTICLE and not out)
        self.home = len(self.parents) - 1
        self.out = out

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in _MUTE:
            self.handle_starttag(tag, attrs)
            if tag in _HOLDER:
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _MUTE:
            while any(name == tag for name, _, _ in self.mute):
                if self.mute.pop()[0] == tag:
                    break
            return
        self.count += 1
        if tag == "a":
            self.linked = False
        if tag not in _BLOCK:
            return
        self._line()
        self.heading = False
        if tag not in _HOLDER:
            # What was left open inside a block ends with it.
            while self.mute and self.mute[-1][2] == tag:
                self.mute.pop()
            self.block = ""
        if tag in _HOLDER and any(t == tag for t, _, _ in self.stack):
            while True:
                closed, self.home, self.out = self.stack.pop()
                if closed == tag:
                    break
            while self.mute and self.mute[-1][1] > len(self.stack):
                self.mute.pop()

    def handle_data(self, data: str) -> None:
        if not self.mute and (not self.out or self._title()):
            self.words.append(data)
            self.link += len(data.strip()) if self.linked else 0

    def _title(self) -> bool:
        """A heading in the header of an article belongs to the article."""
        return (
            self.heading and self.out == 1 and self.stack[-1][0] == "header" and self.articles[self.stack[-1][1]]
        )

    def close(self) -> None:
        super().close()
        self._line()


def content_lines(texts: list[str], tags: list[int], sigma: float = SIGMA) -> np.ndarray:
    """Lines whose smoothed text-to-tag ratio exceeds its standard deviation."""
    ratio = np.array([len(t) for t in texts]) / np.maximum(1, np.array(tags))
    reach = max(1, int(np.ceil(2 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.convolve(ratio, weights / weights.sum())[reach : reach + len(ratio)]
    return smooth >= min(smooth.std(), smooth.max())


def main_text(html: str | None, sigma: float = SIGMA, least_share: float = LEAST_SHARE) -> str:
    """Blocks of the article, one a line; empty where there is none."""
    page = _Lines()
    page.feed(html or "")
    page.close()
    if not page.texts:
        return ""
    dense = content_lines(page.texts, page.tags, sigma)
    ratio = np.array([len(t) for t in page.texts]) / np.maximum(1, np.array(page.tags))
    # A menu's last line is in a cluster only because its neighbour is dense.
    core = np.flatnonzero(dense & (ratio >= min(ratio[dense].max(), ratio.std())))
    held = [_holder(page, page.homes[i]) for i in core]
    mass = [len(page.texts[i]) for i in core]
    if sum(m for m, e in zip(mass, held, strict=True) if e >= 0) >= least_share * sum(mass):
        core = core[[e >= 0 for e in held]]
    low, high = _region(page, core)
    return "\n".join(page.texts[low:high])


def _holder(page: _Lines, element: int) -> int:
    """The innermost article around an element, -1 where there is none."""
    while element >= 0 and not page.articles[element]:
        element = page.parents[element]
    return element


def _above(page: _Lines, element: int) -> list[int]:
    path = [element]
    while path[-1] > 0:
        path.append(page.parents[path[-1]])
    return path[::-1]


def _region(page: _Lines, core: np.ndarray) -> tuple[int, int]:
    """Lines, from and to, of the smallest run of siblings with all ``core`` lines."""
    memo: dict[int, list[int]] = {}
    paths = [memo.setdefault(h, _above(page, h)) if h not in memo else memo[h] for h in page.homes]
    common = paths[core[0]]
    for i in core[1:]:
        n = next((k for k, (x, y) in enumerate(zip(common, paths[i], strict=False)) if x != y), None)
        common = common[: min(len(common), len(paths[i])) if n is None else n]
    low, high = int(core[0]), int(core[-1]) + 1
    around = [e for e in common if page.articles[e]]
    if around:  # all in one article: it is taken whole
        depth = common.index(around[-1])
        return _spread(page, paths, depth, around[-1], low, high, _ALL)
    depth = len(common) - 1
    while True:
        first, last = _spread(page, paths, depth, common[depth], low, high, _ALL)
        # Whole siblings, then neighbours.
        low, high = _siblings(paths, depth, low, high, first, last)
        if page.tag_names[common[depth]] in _PAGE:
            while low > first and page.headings[low - 1]:
                low -= 1
            return low, high
        low, high = _spread(page, paths, depth, common[depth], low, high, _MOST_LINKS)
        if (low, high) != (first, last) or not depth or page.tag_names[common[depth - 1]] in _PAGE:
            return low, high
        depth -= 1


_ALL = 2.0


def _item(path: list[int], depth: int, line: int) -> tuple[int, int]:
    """The child of the element at ``depth`` that holds a line, or the line itself."""
    return (path[depth + 1], -1) if len(path) > depth + 1 else (-1, line)


def _siblings(paths: list[list[int]], depth: int, low: int, high: int, first: int, last: int) -> tuple[int, int]:
    while low > first and _item(paths[low - 1], depth, low - 1) == _item(paths[low], depth, low):
        low -= 1
    while high < last and _item(paths[high], depth, high) == _item(paths[high - 1], depth, high - 1):
        high += 1
    return low, high


def _spread(
    page: _Lines, paths: list[list[int]], depth: int, element: int, low: int, high: int, most: float
) -> tuple[int, int]:
    """``low`` and ``high`` moved over neighbours in ``element`` whose share of text
    in links stays below ``most``."""

    def fits(start: int, end: int) -> bool:
        return sum(page.links[start:end]) < most * sum(len(t) for t in page.texts[start:end])

    def inside(line: int) -> bool:
        return 0 <= line < len(paths) and len(paths[line]) > depth and paths[line][depth] == element

    while inside(low - 1):
        start, item = low - 1, _item(paths[low - 1], depth, low - 1)
        while inside(start - 1) and _item(paths[start - 1], depth, start - 1) == item:
            start -= 1
        if not fits(start, low):
            break
        low = start
    while inside(high):
        end, item = high + 1, _item(paths[high], depth, high)
        while inside(end) and _item(paths[end], depth, end) == item:
            end += 1
        if not fits(high, end):
            break
        high = end
    return low, high


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "html"):
        texts = [main_text(html) for html in column(part, "html")]
        carried = part.column(part.schema.get_field_index("carried"))
        yield pa.RecordBatch.from_arrays([carried, pa.array(texts, type=pa.string())], names=["carried", "text"])


def extract_main_text(
    pages: DataFrame, html_column: str = "html", carry: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """One row per page: the ``carry`` columns and ``text``.

    Character references are decoded, white space inside a block becomes one
    space, blocks stand in page order, one a line; nothing is dropped or cut but
    what is no part of the article. Null, empty and text-free html gives an empty
    text. Unclosed elements end with the element around them, a page's cut end
    counts as its end. Repeated rows give repeated results; other columns are not
    looked at. Each page is worked on alone, so nothing is shuffled.
    """
    df = whole_texts(pages).select(F.struct(*carry).alias("carried"), F.col(html_column).cast("string").alias("html"))
    kinds = df.schema["carried"].dataType.simpleString()
    return df.mapInArrow(_extract, f"carried {kinds}, text string").select("carried.*", "text")
