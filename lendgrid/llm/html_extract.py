"""Main text of web pages from parser events, text density and its clusters.

The standard library's parser streams events into lines, one per block of the
page. A line has its text and the number of tags seen in it; their ratio, with
a logarithm, is its density. Densities are smoothed by a Gaussian over the
neighbouring lines, and split into content and the rest by two-means threshold
clustering. Menus, notices and other boilerplate that their element names
itself (tag, role, class or id) can't be content. A name that only holds such a
word among others (``share-price``) is a doubt, which the density decides.

Every line that the density calls content is main text, and the regions these lines
select add the short lines among them: all article or main elements if these hold most of it, else the deepest plain container that holds nearly all of it. With
articles on the page, lines outside of them are not part of one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship_package

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript iframe object canvas svg math head title audio video map".split())
BOILERPLATE = frozenset("nav header footer aside form button select textarea menu dialog label fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article main section div body td".split())
#: An open element of the value is closed by the start of the key's.
CLOSES = {**{t: ("p",) for t in BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "option", "optgroup"}},
          "li": ("p", "li"), "dd": ("p", "dd", "dt"), "dt": ("p", "dd", "dt"), "tr": ("p", "td", "th", "tr"), "td": ("p", "td", "th"), "th": ("p", "td", "th"),
          "tbody": ("p", "td", "th", "tr", "thead", "tbody"), "option": ("option",)}
# Words in a class, id or role that name boilerplate, whatever stands beside them; those that do so
# alone or beside words of place and form; and these.
NAMED = frozenset(
    "advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist contentinfo cookie cookies disqus footer masthead"
    " modal navbar newsletter pagination popover popup sidebar sidebars sponsored toolbar tooltip topbar".split())
AMBIGUOUS = frozenset(
    "ad ads adv alert alertdialog banner banners complementary consent form header menu menus nav navigation notice notices promo promoted promotion"
    " recommended related replies reply respond search share sharing signup skip social sponsor subscribe subscription toc widget widgets".split())
PLACE = frozenset(
    "area bar bottom box btn button buttons block container content global group holder icon icons inner item items left links link list main mobile"
    " outer page panel posts post primary right row secondary section site slot sticky sub text title top unit wrap wrapper".split())
#: A class that begins with these tells what an element has, not what it is.
ABOUT = frozenset("has is no non not with without".split())
SPLIT_NAME = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
SPACE = re.compile(r"\s+")
#: What an element's names say of it.
CONTENT, DOUBT, BOILER = 0, 1, 2

SIGMA = 1.5
#: Share of the content lines' text that a region has to hold.
MOST = 0.5
NEARLY_ALL = 0.9


def named(name: str) -> int:
    """What one class, id or role says of its element."""
    words = [w for w in SPLIT_NAME.split(CAMEL.sub("-", name).lower()) if w]
    if not words or words[0] in ABOUT:
        return CONTENT
    if any(w in NAMED for w in words):
        return BOILER
    if not any(w in AMBIGUOUS for w in words):
        return CONTENT
    return BOILER if all(w in AMBIGUOUS or w in PLACE or w.isdigit() for w in words) else DOUBT


def says(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """What an element's tag and attributes say of it. A header within an article has its headline."""
    if tag in BOILERPLATE and not (tag == "header" and in_article):
        return BOILER
    found = CONTENT
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and re.search(r"display\s*:\s*none", value):
            return BOILER
        if name in ("class", "id", "role") and value and tag not in ("body", "html", "main"):
            for one in value.split():
                if tag == "article":  # listings name their articles by topic and form
                    found = max(found, BOILER if one.lower() in NAMED | AMBIGUOUS else CONTENT)
                elif not (tag == "header" and one.lower() == "header"):
                    found = max(found, named(one))
    return found


class Lines(HTMLParser):
    """Lines of a page: text, tags, the chain of open containers, and what the open elements say."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, bool]] = []  # tag, container number, what it says, silent
        self.containers: list[tuple[str, int, int]] = [("page", -1, CONTENT)]  # tag, parent, what it says
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, container, what its elements say
        self.text: list[str] = []
        self.tags = 0

    def here(self) -> tuple[int, int, bool]:
        return self.open[-1][1:] if self.open else (0, CONTENT, False)

    def in_article(self, container: int) -> bool:
        while container > 0:
            if self.containers[container][0] == "article":
                return True
            container = self.containers[container][1]
        return False

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            container, said, _ = self.here()
            self.lines.append((text, self.tags, container, said))
            self.tags = 0
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
        for closed in CLOSES.get(tag, ()):
            self._close(closed, tag)
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        container, said, silent = self.here()
        said = CONTENT if tag == "main" else max(said, says(tag, attrs, tag == "header" and self.in_article(container)))
        if tag in CONTAINERS:
            role = dict(attrs).get("role")
            itemprop = dict(attrs).get("itemprop")
            self.containers.append(("main" if role == "main" else "article" if role == "article" or itemprop == "articleBody" else tag, container, said))
            container = len(self.containers) - 1
        self.open.append((tag, container, said, silent or tag in SILENT))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def _close(self, closed: str, by: str) -> None:
        """Close an open ``closed`` that the start of ``by`` ends, if no container stands between."""
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag == closed:
                del self.open[i:]
                return
            if tag in CONTAINERS or tag in ("ul", "ol", "dl", "table", "select") or tag in BOILERPLATE:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if not self.here()[2]:
            self.text.append(data)


def page_lines(html: str) -> Lines:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser


def content_lines(lines: list[tuple[str, int, int, int]], sigma: float = SIGMA) -> np.ndarray:
    """Which lines are content: smoothed densities above a two-means threshold, and not boilerplate."""
    density = np.array([0.0 if said == BOILER else math.log1p(len(text) / max(1, tags)) for text, tags, _, said in lines])
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.convolve(density, kernel, "full")[reach : reach + len(density)] / np.convolve(np.ones(len(density)), kernel, "full")[reach : reach + len(density)]
    low, high = smooth.min(), smooth.max()
    for _ in range(32):
        threshold = (low + high) / 2
        upper = smooth >= threshold
        if upper.all():
            break
        new = smooth[~upper].mean(), smooth[upper].mean()
        if np.allclose(new, (low, high)):
            break
        low, high = new
    threshold = (low + high) / 2
    content = (smooth >= threshold) & np.array([said != BOILER for *_, said in lines])
    # A dense line beside content is content too, though the menu on its other side drags its smoothed density down.
    for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):
        step = 1 if order.step < 0 else -1
        for i in order:
            content[i] |= content[i + step] and lines[i][3] == CONTENT and density[i] >= threshold
    return content if content.any() else np.array([said == CONTENT for *_, said in lines])


def regions(page: Lines, content: np.ndarray) -> tuple[set[int], bool]:
    """(numbers of the containers that are content regions, whether they are articles)."""
    held = [0] * len(page.containers)
    for (text, _, container, _), is_content in zip(page.lines, content):
        if is_content:
            held[container] += len(text)
    for i in range(len(held) - 1, 0, -1):  # a container comes after its parent
        held[page.containers[i][1]] += held[i]
    for kind in ("article", "main"):
        found = {i for i, (tag, _, said) in enumerate(page.containers) if tag == kind and said != BOILER}
        outer = {i for i in found if not found & set(ancestors(page, i))}
        if sum(held[i] for i in outer) >= MOST * held[0] and outer:
            return outer, True
    return {max((i for i in range(len(held)) if held[i] >= NEARLY_ALL * held[0] and page.containers[i][2] == CONTENT), default=0)}, False


def ancestors(page: Lines, container: int) -> Iterator[int]:
    while (container := page.containers[container][1]) >= 0:
        yield container


def main_text(html: str) -> str:
    page = page_lines(html)
    if not page.lines:
        return ""
    content = content_lines(page.lines)
    found, articles = regions(page, content)
    inside = [i in found for i in range(len(page.containers))]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[page.containers[i][1]]
    kept = []
    for (text, _, container, said), is_content in zip(page.lines, content):
        if said != BOILER and (is_content if said == DOUBT else inside[container] or is_content) and (inside[container] or not articles):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    ``text`` has one line per block, white space in it made one space; it is empty
    if the html is null, empty or holds no text outside boilerplate. A null
    page_id or url stays null, a repeated row is returned again, html of any length is
    parsed whole, by itself, an empty table gives an empty table, and columns other than these
    three are not read.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
