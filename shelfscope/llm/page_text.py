"""Main text of web pages: text-to-tag ratios over the events of the standard library's parser.

A line is the text between two block boundaries. Its ratio of characters (without those of links) to start tags is smoothed along
the page with a Gaussian, and the logarithms of the smoothed ratios are clustered in two by a threshold. If the innermost container of nearly
all text of the upper cluster is in an article or main element, the lines of that are the result. On other pages it is all lines
from the first to the last that is not mostly links, but for parts of the page (below the innermost container of these lines) that
have nothing but links.

Elements that say that they are something else (menus, forms, adverts, ..) are left out whatever their ratio. Where only a class or
id says so, the element stays if it holds most of the page's article text.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.blocks import free_name

SIGMA = 1.5
#: Share of the upper cluster's text that the article or main element must hold.
HOLDS = 0.8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li menu "
    "nav ol p pre search summary tfoot th thead title ul br head option select legend".split()
)
#: Elements that are never article text.
OUTSIDE = frozenset(
    "head title nav header footer aside form script style noscript template menu button select option textarea label fieldset legend dialog "
    "search iframe object canvas svg audio video math datalist".split()
)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form toolbar status".split())
#: Words of class or id values that mark such elements, alone or with other ones or words of LAYOUT.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion menu submenu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar sidebars footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription share sharing social comment comments commentlist reply replies respond disqus related recommended "
    "recommendations pagination pager login signup signin toolbar widget widgets skip disclaimer".split()
)
#: These mark also as the first or last part of any name.
OUTSIDE_ENDS = frozenset("advert adverts advertisement advertising adsense breadcrumb breadcrumbs disqus gdpr navbar sponsored".split())
LAYOUT = frozenset(
    "left right top bottom upper lower main primary secondary site page post entry article articles posts stories story list box area block bar panel "
    "container wrapper wrap section inner outer row column col item items link links button buttons icon icons count form slot unit text title header "
    "body group thread message messages policy accept media follow us global mobile desktop sticky fixed small large the and to of".split()
)
#: Share of the page's unlinked text that a marked element must hold to stay, where no article or main tells.
MOST = 0.8
OUTSIDE_NAMES = frozenset("header site-header page-header top-header global-header".split())
#: A new one of these ends an open one of those, as every block ends an open p.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _marks(name: str) -> bool:
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    if name in OUTSIDE_NAMES or parts and (parts[0] in OUTSIDE_ENDS or parts[-1] in OUTSIDE_ENDS):
        return True
    return not OUTSIDE_WORDS.isdisjoint(parts) and all(x in OUTSIDE_WORDS or x in LAYOUT for x in parts)


def _is_marked(attributes: list) -> bool:
    """Does a class or id say that the element is something else?"""
    return any(_marks(n) for name, value in attributes if name in ("class", "id") and value for n in value.lower().split())


def _is_outside(tag: str, attributes: list) -> bool:
    if tag in OUTSIDE:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(name == "hidden" or name == "role" and value and value.lower() in OUTSIDE_ROLES for name, value in attributes)


class PageLines(HTMLParser):
    """Collects the lines of a page: text, tags, the containers and the marked elements it is in, unlinked characters.

    Numbers of marked elements follow the page, as those of containers do. `articles` are the articles and mains without a mark,
    `holds_article` the marked elements around them.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, bool]] = []
        self.count: Counter[str] = Counter()
        self.outside = 0
        self.path: tuple[int, ...] = ()
        self.kinds: list[str] = []
        self.marks: tuple[int, ...] = ()
        self.n_marks = 0
        self.articles: set[int] = set()
        self.holds_article: set[int] = set()
        self.lines: list[tuple[str, int, tuple[int, ...], int, tuple[int, ...]]] = []
        self.text: list[str] = []
        self.linked = 0
        self.tags = 0

    def end_line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append((line, max(self.tags, 1), self.path, max(len(line) - self.linked, 0), self.marks))
                self.tags = 0
            self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.close_open({"p"} | CLOSES.get(tag, set()))
        outside = self.outside > 0 or _is_outside(tag, attrs)
        mark = not outside and _is_marked(attrs)
        article = tag in ("article", "main")
        if outside or mark and tag not in ("html", "body"):
            self.end_line()
        self.outside += outside
        held = tag in CONTAINERS
        if held:
            self.kinds.append(tag)
            self.path = (*self.path, len(self.kinds) - 1)
            if article and not mark:
                self.articles.add(self.path[-1])
                self.holds_article.update(self.marks)
        mark = mark and not article and tag not in ("html", "body")
        if mark:
            self.marks = (*self.marks, self.n_marks)
            self.n_marks += 1
        self.open.append((tag, outside, held, mark))
        self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_open(self, names: set[str]) -> None:
        """Ends the innermost open element of these names, with all inline ones in it."""
        if not any(self.count[n] for n in names):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name in names:
                self.pop_to(depth)
                return
            if name in BLOCKS:
                return

    def pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            name, outside, held, mark = self.open.pop()
            self.count[name] -= 1
            if outside and self.outside == 1 or mark:
                self.end_line()
            self.outside -= outside
            if mark:
                self.marks = self.marks[:-1]
            if held:
                self.path = self.path[:-1]

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        if not self.count[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name == tag:
                self.pop_to(depth)
                return
            if name in CONTAINERS and tag not in BLOCKS:
                return  # a stray inline end tag does not leave its container

    def handle_data(self, data):
        if not self.outside:
            self.text.append(data)
            if self.count["a"]:
                self.linked += len(data)


def page_lines(html: str) -> PageLines:
    try:
        parser = PageLines()
        parser.feed(html)
        parser.close()
    except AssertionError:  # a marked section that the parser does not know
        parser = PageLines()
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    parser.end_line()
    return parser


def article_lines(page: PageLines) -> list[tuple]:
    """The lines that are in no marked element, or only in such that hold most of the text in articles or, without any, of the page."""
    if not page.n_marks:
        return page.lines
    of_articles = Counter()
    of_page = Counter()
    for _, _, path, own, marks in page.lines:
        in_article = not page.articles.isdisjoint(path)
        for mark in (-1, *marks):
            of_page[mark] += own
            of_articles[mark] += own * in_article
    whole, least = (of_articles, 0.5) if of_articles[-1] else (of_page, MOST)
    stay = {m for m in range(page.n_marks) if (m in page.holds_article or not of_articles[-1]) and whole[m] > least * whole[-1]}
    return [line for line in page.lines if stay.issuperset(line[4])]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Weighted means with Gaussian weights; at the ends over the lines that there are."""
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    sums = np.convolve(ratios, weights)[reach : reach + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]


def cluster_threshold(values: np.ndarray) -> float:
    """The middle between the means of two clusters, found from the extremes; equal values are one upper cluster."""
    low, high = float(values.min()), float(values.max())
    middle = (low + high) / 2
    for _ in range(50):
        upper = values >= middle
        if upper.all():
            return low
        new = (float(values[upper].mean()) + float(values[~upper].mean())) / 2
        if new == middle:
            break
        middle = new
    return middle


def main_text(html: str) -> str:
    page = page_lines(html)
    lines = article_lines(page)
    if not lines:
        return ""
    texts, tags, paths, own, _ = zip(*lines, strict=True)
    size = np.array(own, float)
    ratio = size / np.array(tags, float)
    value = np.log1p(smoothed(ratio))  # one very long line does not raise the threshold above all others
    upper = value >= cluster_threshold(value)
    held: dict[int, float] = {}
    for path, n in zip((p for p, u in zip(paths, upper, strict=True) if u), size[upper], strict=True):
        for container in path:
            held[container] = held.get(container, 0.0) + n
    enough = HOLDS * size[upper].sum()
    region = max((c for c, n in held.items() if n >= enough), default=None)  # numbers follow the page, inner ones are larger
    if region is not None:
        path = next(p for p in paths if region in p)
        around = path[: path.index(region) + 1]
        for kind in ("article", "main"):
            found = [c for c in around if page.kinds[c] == kind]
            if found:
                return " ".join(t for t, p in zip(texts, paths, strict=True) if found[0] in p)
    own_text = np.flatnonzero(2 * size >= np.array([len(t) for t in texts]))
    if not len(own_text):
        return " ".join(texts)
    depth = len(os.path.commonprefix([paths[i] for i in own_text]))
    parts = {paths[i][depth : depth + 1] for i in own_text} | {()}
    return " ".join(texts[i] for i in range(own_text[0], own_text[-1] + 1) if paths[i][depth : depth + 1] in parts)


def extract_pages(pages: DataFrame, html_column: str = "html", *keep: str) -> DataFrame:
    """The `keep` columns of every row and text: the page's main text, '' for a NULL or empty page or one without text.

    Blocks are joined by one space, as is all white space inside them; character references are decoded. A page of any
    length is read whole, one at a time. A column text among `keep` is replaced.
    """
    keep = tuple(c for c in keep if c != "text")

    def extract(batches):
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])

    kept = pages.select(*[F.col(f"`{c}`") for c in keep])
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_column).cast("string").alias(free_name(list(keep), "_html")))
    return rows.mapInArrow(extract, kept.schema.add("text", "string"))
