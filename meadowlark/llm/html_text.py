"""HTML extraction: the main text of pages.

1. The standard library's parser reads a page as a stream of events. Block tags and line breaks end a line; a line
   has the text and the number of tags since the last one, and the element that it lies in.
2. What markup names as something else is no text: ``NOT_TEXT`` elements, hidden ones, landmarks (``role``) and
   elements whose class or id has a word of ``NAMED`` (menus, adverts, notices, comments, ...). Such lines stay in
   the row of lines, with a ratio of 0, so they part what lies before and after them.
3. Each line's text-to-tag ratio is smoothed by a Gaussian over its neighbours. Lines at or above the standard
   deviation of the smoothed ratios are content, as they cluster around the article's paragraphs.
4. The region is the element that holds most of the content: from the root, the child with at least ``MOST`` of
   the content's characters is entered as long as there is one that has blocks of its own; an ``article`` or
   ``main`` is entered if it has content and isn't left again. All text lines of the region are taken, short
   ones too; without an ``article`` or ``main``, lines that are mostly links only if they are content, and content
   outside the region as well.

If nothing is left, the words in ``NAMED`` are taken not to count on that page. Character references are decoded;
white space (Unicode's, too) inside a line becomes one space; lines are joined by one. Tags that end without a
beginning are passed over, elements that don't end do so with the one around them, a paragraph with the next
block, a comment, a declaration or a tag cut off by the end of the page with the page.

Nulls: a null or empty page, and one without text, gives an empty text of 0 characters. Pages of any length go
whole, one at a time, in memory in proportion to one page and time to its length; nested elements take no
recursion. Repeated rows are extracted each; an empty table gives an empty one. Columns of the input with the
name of a result column give way.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meadowlark.llm.common import add_by_rows

#: Elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
NOT_TEXT = frozenset("applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe input label legend map math menu meter nav noframes noscript object optgroup option output progress script search select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
NAMED = frozenset(
    "ad ads adslot adsense adsbygoogle advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies disclaimer discussion disqus dropdown footer form gdpr header hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo promoted promotion promotions recommended related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tagcloud toolbar widget widgets".split()
)
#: Whole-page elements and texts' own, which no class makes anything else.
KEPT = frozenset("html body main article".split())
#: What an open one of ends when the same begins, or another of its row.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
OWNERS = frozenset("ul ol menu dl table select html body".split())
#: The Gaussian's standard deviation in lines, and the share of the content that a region has to have.
SIGMA, MOST, LINKS = 1.0, 0.8, 0.5

_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Lines(HTMLParser):
    """The lines of a page: text, its length without white space at the ends, tags, characters within links, element, whether
    it counts as text; and the elements in the order of their beginnings: parent, tag, whether they have blocks."""

    def __init__(self, by_name: bool = True):
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.parent, self.tags, self.has_blocks = [-1], ["#root"], [False]
        self.stack: list[tuple[str, int, bool]] = [("#root", 0, True)]  # tag, element, whether it is text
        self.open: Counter[str] = Counter()
        self.lines: list[tuple[str, int, int, int, bool]] = []  # text, tags, characters in links, element, whether it is text
        self.held: list[str] = []
        self.n_tags = self.n_links = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.held).split())
        if text or self.n_tags:
            _, element, is_text = self.stack[-1]
            self.lines.append((text, self.n_tags, min(self.n_links, len(text)), element, is_text))
        self.held, self.n_tags, self.n_links = [], 0, 0

    def pop_to(self, at: int) -> None:
        for tag, _, _ in self.stack[at:]:
            self.open[tag] -= 1
        del self.stack[at:]

    def close(self) -> None:
        super().close()
        self.end_line()

    # ---- events

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
            if tag != "br":
                self.end_open(tag)
        self.n_tags += 1
        _, around, is_text = self.stack[-1]
        if tag in VOID:
            return
        if tag in BLOCK:
            self.has_blocks[around] = True
        self.parent.append(around), self.tags.append(tag), self.has_blocks.append(False)
        self.stack.append((tag, len(self.parent) - 1, is_text and self.is_text(tag, attrs)))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML but in elements that are void anyway

    def end_open(self, tag: str) -> None:
        """Ends what the beginning of a block ends: an open paragraph, the last item of the same row."""
        ends = (*ENDS.get(tag, ()), "p")
        if not any(self.open[t] for t in ends):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at][0]
            if name in ends:
                return self.pop_to(at)
            if name in BLOCK and (tag not in ENDS or name in OWNERS):
                return None

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        self.n_tags += 1
        if self.open[tag]:
            for at in range(len(self.stack) - 1, 0, -1):
                name = self.stack[at][0]
                if name == tag:
                    return self.pop_to(at)
                if name in BLOCK and tag not in BLOCK:
                    return None

    def handle_data(self, data: str) -> None:
        if self.stack[-1][2]:
            self.held.append(data)
            if self.open["a"]:
                self.n_links += len(data)

    def is_text(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        inside = self.open["article"] or self.open["main"]
        if tag in NOT_TEXT or (tag == "header" and not inside):
            return False
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _UNSEEN.search(value.lower())):
                return False
            if name == "role" and value.lower() in ROLES:
                return False
            if self.by_name and name in ("class", "id") and tag not in KEPT:
                words = {w.lower() for w in _WORDS.findall(value)}
                if words & NAMED and not (inside and words & NAMED == {"header"}):
                    return False
            if self.by_name and name == "class" and tag == "article" and value.lower().startswith(("comment", "reply")):
                return False
        return True

    # ---- what the end of the page, or a mistake, cuts off

    def parse_comment(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find("-->", i + 2)
        return end + 3 if end >= 0 else len(self.rawdata)

    def to_bracket(self, i: int) -> int:
        end = self.rawdata.find(">", i + 1)
        return end + 1 if end >= 0 else len(self.rawdata)

    parse_html_declaration = parse_pi = parse_bogus_comment = parse_marked_section = lambda self, i, report=1: self.parse_comment(i) if self.rawdata.startswith("<!--", i) else self.to_bracket(i)

    def parse_starttag(self, i: int) -> int:
        end = super().parse_starttag(i)
        return end if end >= 0 else self.to_bracket(i)

    def parse_endtag(self, i: int) -> int:
        end = super().parse_endtag(i)
        return end if end >= 0 else self.to_bracket(i)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means of each ratio and its neighbours; at the borders, of those there are."""
    reach = max(1, round(3 * sigma))
    weights = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    return np.convolve(ratios, weights, "full")[reach:-reach] / np.convolve(np.ones(len(ratios)), weights, "full")[reach:-reach]


def content(page: Lines) -> np.ndarray:
    """Which lines are content by their smoothed ratios; of a page with text, one at least."""
    size = np.array([len(text) if is_text else 0 for text, _, _, _, is_text in page.lines], float)
    if not size.any():
        return np.zeros(len(size), bool)
    even = smoothed(size / np.maximum([n for _, n, _, _, _ in page.lines], 1))
    chosen = (even >= even.std()) & (size > 0)
    return chosen if chosen.any() else (size > 0) & (even == even[size > 0].max())


def region(page: Lines, chosen: np.ndarray) -> tuple[int, int, bool]:
    """The element that holds most of the content, as the range of elements in it, and whether it is a text by its tag."""
    n = len(page.parent)
    weight, last = [0] * n, list(range(n))
    for (text, _, _, element, _), is_content in zip(page.lines, chosen, strict=True):
        weight[element] += len(text) if is_content else 0
    best, texts = [-1] * n, []
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        weight[up] += weight[i]
        last[up] = max(last[up], last[i])
        if best[up] < 0 or weight[i] >= weight[best[up]]:
            best[up] = i
        if page.tags[i] in ("article", "main") and weight[i]:
            texts.append(i)
    if texts:  # the one with most content; of several with the same, the innermost
        most = max(weight[i] for i in texts)
        own = max(i for i in texts if weight[i] == most)
        if most >= MOST * weight[0] or sum(page.tags[i] == page.tags[own] for i in texts) == 1:
            return own, last[own], True
    at = 0
    while best[at] >= 0 and weight[best[at]] >= MOST * weight[at] and page.has_blocks[best[at]]:
        at = best[at]
    return at, last[at], False


def main_text(html: str | None) -> str:
    for by_name in (True, False):
        page = Lines(by_name)
        page.feed(html or "")
        page.close()
        chosen = content(page)
        if chosen.any():
            break
    else:
        return ""
    first, last, is_article = region(page, chosen)
    out = []
    for (text, _, links, element, is_text), is_content in zip(page.lines, chosen, strict=True):
        within = first <= element <= last
        taken = within if is_article else is_content or (within and links <= LINKS * len(text))
        if text and is_text and taken:
            out.append(text)
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (its code points)."""

    def rows(found: list[str | None]) -> tuple[list[str], list[int]]:
        texts = [main_text(h) for h in found]
        return texts, list(map(len, texts))

    return add_by_rows(pages, [html], [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], rows, 1 << 20)


def pages_digest(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


#: For the markup of the given pages alone: an article of h1, p, b and br.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, regexp_replace(replace(x, '<b>', ''), '</?(h1|p|br)>', ' ', 'g') AS x FROM a),
c AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#(x27|39);', chr(39), 'g'), '&amp;?', '&', 'g') AS x FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(x, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
