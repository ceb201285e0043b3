"""Main text of HTML pages.

Method: the standard library's parser turns a page into events. Block by block (the lines
of the page as it is shown) text and tags are counted; the ratio of text to tags is
smoothed with a Gaussian over neighbouring blocks, and blocks above a threshold are
clustered into content regions. The elements that hold these regions are the article, however
many there are. All their blocks are returned, short ones too, but for menus, notices, adverts,
comments and the like, which are told by their elements and by whole values of class, id and role, and
lists of nothing but links. Headings and paragraphs right beside a region that is no article belong to it,
and so do those in the header of an article.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, text_of

SIGMA = 1.5
DATA_ROWS = 3  # from which on a table holds data; a smaller one may lay the page out, each cell for itself
MENU_ENTRIES = 3  # from which on a list of nothing but links is a menu

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
_HIDDEN = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe map menu nav noscript object option script "
    "search select style svg template textarea title video".split()
)
_HOLDERS = frozenset("article body div main section table tbody td tr".split())
_LISTS = frozenset("ul ol dl table menu select".split())
_CLOSES_P = _BLOCK - {"html", "body", "head"}
_BOILERPLATE = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline-links comment comments consent "
    "cookie cookies copyright disclaimer disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter "
    "notice notices overlay pagination pager popup promo promoted promotion recommended related replies reply responses search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toc toolbar widget widgets".split()
)
# Words that may stand beside those in a name ("page-footer"); any other word makes a name of its own ("social-impact").
_NEUTRAL = frozenset(
    "area bar block bottom box container inner left links list outer page panel reader right section site top user wrap wrapper".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_NAMED_BY_AUTHORS = _HEADINGS | frozenset("a dt p section span".split())  # their ids are anchors into the text
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
_COMMENT_END = re.compile("--!?>")
_LEGAL = re.compile("\u00a9|\\(c\\) *[0-9]{4}|copyright|all rights reserved|cookies", re.IGNORECASE)
_SENTENCE_ENDS = frozenset(".!?:\u2026\"'\u201d\u2019)\u00bb\u3002\uff01\uff1f")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Is an element with these attributes outside the article, with all it holds?"""
    if tag in _HIDDEN:
        return True
    if not attrs or tag in ("html", "body", "main", "article"):
        return False
    classes = next((value or "" for name, value in attrs if name == "class"), "").split()
    anchor = tag in _NAMED_BY_AUTHORS or "section" in classes
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in _ROLES:
            return True
        if tag not in _HEADINGS and value and (name == "class" or name == "id" and not anchor):
            for word in value.split():
                parts = {p.lower() for p in _TOKEN.findall(word)}
                if word.lower() in _BOILERPLATE or parts & _BOILERPLATE and parts <= _BOILERPLATE | _NEUTRAL:
                    return True
    return False


class _Open(NamedTuple):
    """An open element."""

    tag: str
    holder: int
    hidden: bool
    hidden_block: bool  # a hidden block is open
    heading: bool  # a heading is open
    paragraph: bool
    lists: int  # number of the innermost list, -1 outside lists
    header: bool  # inside the header of an article


class _Block(NamedTuple):
    text: str
    tags: int
    holder: int
    hidden: bool
    heading: bool
    paragraph: bool
    lists: int
    linked: bool  # all text is in links


class _Blocks(HTMLParser):
    """Blocks of a page: text, tags, enclosing elements, and whether it is outside the article.

    Time is linear in the page: open elements are found by tag, and markup that never ends
    takes the rest of the page with it, as in browsers.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[_Block] = []
        self.parents = [-1]  # of each holder; 0 is the page
        self.names = [""]
        self.tables = [0]  # the table around each holder
        self.articles = [0]  # the article or main around each holder, or itself
        self.rows = [0]  # of each table
        self.lists = 0
        self.open: list[_Open] = [_Open("", 0, False, False, False, False, -1, False)]
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
        self.blocks_open: list[int] = []  # places of open blocks
        self.text: list[str] = []
        self.letters = self.linked = 0
        self.tags = 0

    # Markup without an end, and declarations the parser would refuse

    def _ends(self, i: int) -> bool:
        return self.rawdata.find(">", i) >= 0

    def parse_starttag(self, i):
        return super().parse_starttag(i) if self._ends(i) else len(self.rawdata)

    def parse_endtag(self, i):
        return super().parse_endtag(i) if self._ends(i) else len(self.rawdata)

    def parse_pi(self, i):
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def parse_html_declaration(self, i):
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def parse_comment(self, i, report=True):
        if self.rawdata.startswith((">", "->"), i + 4):
            return self.rawdata.find(">", i) + 1
        end = _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def _break(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            at = self.open[-1]
            hidden = at.hidden or at.header and not (at.heading or at.paragraph)
            linked = self.linked >= self.letters
            self.blocks.append(_Block(text, self.tags, at.holder, hidden, at.heading, at.paragraph, at.lists, linked))
            self.tags = 0
        self.text.clear()
        self.letters = self.linked = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in _BLOCK:
            self._break()
            if tag in _CLOSES_P:
                self._close("p", stop=_HOLDERS)
            if tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                self._close(tag, stop=_LISTS)
        elif tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        up = self.open[-1]
        holder, lists = up.holder, up.lists
        header = up.header or tag == "header" and self.names[self.articles[holder]] == "article"
        outside = up.hidden or _boilerplate("div" if header and tag == "header" else tag, attrs)
        if tag in _HOLDERS:
            self.parents.append(holder)
            self.names.append(tag)
            self.rows.append(0)
            new = len(self.parents) - 1
            self.tables.append(new if tag == "table" else self.tables[holder])
            self.articles.append(new if tag in ("article", "main") else self.articles[holder])
            holder = new
            if tag == "tr":
                self.rows[self.tables[holder]] += 1
        if tag in ("ul", "ol", "menu", "dl"):
            lists, self.lists = self.lists, self.lists + 1
        self.places[tag].append(len(self.open))
        if tag in _BLOCK:
            self.blocks_open.append(len(self.open))
        self.open.append(
            _Open(
                tag, holder, outside, up.hidden_block or outside and tag in _BLOCK,
                up.heading or tag in _HEADINGS, up.paragraph or tag == "p", lists, header,
            )
        )

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _innermost(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _leave(self, place: int) -> None:
        """Close the open elements from this one on."""
        for element in self.open[place:]:
            self.places[element.tag].pop()
        while self.blocks_open and self.blocks_open[-1] >= place:
            self.blocks_open.pop()
        del self.open[place:]

    def _close(self, tag: str, stop: frozenset) -> None:
        place = self._innermost(tag)
        if place and place >= max(self._innermost(t) for t in stop):
            self._break()
            self._leave(place)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in _BLOCK:
            self._break()
        place = self._innermost(tag)
        if place:
            if self.blocks_open and self.blocks_open[-1] >= place:
                self._break()
            self._leave(place)

    def handle_data(self, data):
        at = self.open[-1]
        if at.hidden and at.tag not in _BLOCK and not at.hidden_block:
            return  # hidden inline elements leave no text
        self.text.append(data)
        letters = len(data) - sum(map(data.count, " \n\t\r\f"))
        self.letters += letters
        if self._innermost("a"):
            self.linked += letters

    def finish(self) -> None:
        self.close()
        self._break()

    def menus(self) -> set[int]:
        """Lists of at least MENU_ENTRIES entries whose whole text is links."""
        counts: dict[int, int] = defaultdict(int)
        text = set()
        for block in self.blocks:
            if block.linked:
                counts[block.lists] += 1
            else:
                text.add(block.lists)
        return {k for k, n in counts.items() if n >= MENU_ENTRIES and k >= 0 and k not in text}


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / weight


def main_text(html: str) -> str:
    """The article's blocks, joined by line breaks; empty if the page has none."""
    page = _Blocks()
    page.feed(html)
    page.finish()
    blocks = page.blocks
    menus = page.menus()
    shown = [i for i, b in enumerate(blocks) if not b.hidden and b.lists not in menus]
    if not shown:
        return ""
    ratios = np.zeros(len(blocks))
    ratios[shown] = [len(blocks[i].text) / max(1, blocks[i].tags) for i in shown]
    smooth = smoothed(ratios)
    threshold = min(smooth[shown].mean(), smooth[shown].std()) if len(shown) > 1 else 0.0
    content = {i for i in shown if smooth[i] >= threshold}
    regions = _regions(page, ratios, content, threshold)
    inside = [False] * len(page.parents)
    for h in range(1, len(inside)):  # holders come after their parents
        inside[h] = inside[page.parents[h]] or h in regions and page.names[h] != "body"
    around = _around(page, regions)
    return "\n".join(
        blocks[i].text
        for i in shown
        if inside[blocks[i].holder] or blocks[i].holder in regions or blocks[i].holder in around and _prose(blocks[i])
    )


def _regions(page: _Blocks, ratios: np.ndarray, content: set[int], threshold: float) -> set[int]:
    """Elements that hold content regions.

    Smoothing lifts the ends of a menu beside the text, too; so one block of an element has to be a
    heading or above the threshold by itself. The block stands for the article or main around it, a
    table of data for a cell, or the element that holds it.
    """
    cells = list(range(len(page.parents)))
    for h in range(1, len(cells)):
        up = page.parents[h]
        layout = page.names[up] == "table" and page.rows[up] < DATA_ROWS  # a table that lays the page out
        if page.names[h] in ("td", "tr", "tbody") and not layout:
            cells[h] = cells[up]
    holders = {page.blocks[i].holder for i in content if page.blocks[i].heading or ratios[i] >= threshold}
    return {page.articles[h] or cells[h] for h in holders}


def _around(page: _Blocks, regions: set[int]) -> set[int]:
    """Elements that hold or stand beside a region that is no article: a title and a lead above it, a short last section below."""
    parents = {page.parents[h] for h in regions if h > 0 and page.names[h] not in ("article", "main")}
    beside = {h for h in range(1, len(page.parents)) if page.names[h] in ("div", "section") and page.parents[h] in parents}
    return parents | beside


def _prose(block: _Block) -> bool:
    """Is a short block outside the regions a heading or a paragraph, not a link or a legal line?"""
    if block.linked or _LEGAL.search(block.text):
        return False
    return block.heading or block.paragraph and block.text[-1] in _SENTENCE_ENDS


def extract(pages: DataFrame, out: str = "main_text", html_col: str = "html") -> DataFrame:
    """Add string column `out` with the main text of each page.

    NULL and empty pages have empty text; markup that never ends takes the rest of the page with it. Rows are independent: repeated rows, empty tables
    and other columns need no care; a column called `out` is replaced.
    """

    @F.arrow_udf("string")
    def run(html: pa.Array) -> pa.Array:
        return pa.array([main_text(h.decode()) for _, some in byte_slices(html) for h in some], pa.string())

    return pages.withColumn(out, run.asNondeterministic()(text_of(html_col)))


def report(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"))
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars")
    )
