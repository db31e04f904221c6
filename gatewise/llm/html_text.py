"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

The standard library's parser streams a page as events. Text gathers into
blocks (lines of the page as a reader sees it), each with the number of tags
met since the block before it and with the container that holds it; scripts and
hidden elements are passed over. Blocks of menus, headers, footers, sidebars,
forms, notices, adverts and comments are marked as aside. The text-to-tag
ratios of all blocks, these too, are smoothed over their neighbours with a
Gaussian and clustered around two centres, one of them fixed at the origin,
with a threshold between them. The content is an article or main element that
holds most of the upper cluster's text, else what stands in the nearest common
container of the upper cluster between its first and last block and next to
them, short blocks too. What is aside is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewise.llm.common import ship, slices

# Fixed values of HTML: elements by what they do to a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul hr title head".split())
HIDDEN = frozenset("script style noscript template head title iframe object svg math canvas audio video".split())
CHROME = frozenset("nav header footer aside form menu button select textarea input dialog search fieldset".split())
REGIONS = frozenset("article main section div td body aside nav header footer form".split())
#: Elements that an open <p> does not outlive.
ENDS_P = BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend", "summary", "title", "head"}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Words in class or id that name what is not part of the article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|side|widget\w*|"
    r"footer|foot|header|masthead|cookies?\w*|consent|gdpr|notices?|notification\w*|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|share|sharing|social\w*|related|recommend\w*|comments?|"
    r"commentlist|respond|replies|reply|disqus\w*|pagination|pager|tags|toolbar|skip\w*|copyright|legal)(?:$|[\s_-])", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

#: Width of the smoothing, in blocks, and rounds of the clustering.
SIGMA, ROUNDS = 1.0, 20
#: Share of the upper cluster's text that an article or main element must hold.
MOST = 2 / 3
#: What an element's text is: the page's own, aside from the article, or not shown.
OWN, ASIDE, UNSEEN = range(3)


class Block(NamedTuple):
    text: str
    tags: int  # tags since the block before
    region: int
    story: int  # the outermost article or main element around it, 0 if there is none
    aside: bool
    links: bool  # most of it is link text


class Open(NamedTuple):
    tag: str
    kind: int
    region: int
    story: int
    link: bool


def kind_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """What the text of an element is, by its name, role, class, id or style."""
    if tag in HIDDEN:
        return UNSEEN
    kind = ASIDE if tag in CHROME else OWN
    if tag in ("html", "body", "main"):
        return kind
    for name, value in attrs:
        value = (value or "").lower()
        if (name == "hidden" or name == "aria-hidden" and value == "true"
                or name == "style" and "display:none" in value.replace(" ", "")):
            return UNSEEN
        if name == "role" and value in ROLES or name in ("class", "id") and tag not in HEADINGS and NAMES.search(value):
            kind = ASIDE
    return kind


class Reader(HTMLParser):
    """Gathers the blocks of a page from the parser's events, in page order.

    Text that is aside gathers apart, so an aside inside a line does not split it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Open("", OWN, 0, 0, False)]
        self.blocks: list[Block] = []
        self.parts: tuple[list[str], list[str]] = [], []
        self.tags, self.linked = [0, 0], [0, 0]
        self.stories = 0
        self.around = [0]  # the region around each region
        self.at: dict[str, list[int]] = {}  # places of the open elements of each tag ...
        self.borders: list[int] = [0]  # ... and of the open regions

    def flush(self, kind: int) -> None:
        text = " ".join("".join(self.parts[kind]).split())
        self.parts[kind].clear()
        if text:
            at = self.open[-1]
            self.blocks.append(Block(text, self.tags[kind], at.region, at.story, kind == ASIDE,
                                     2 * self.linked[kind] > len(text)))
            self.tags[kind] = 0
        self.linked[kind] = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        kind = self.open[-1].kind
        if kind != UNSEEN:
            self.tags[kind] += 1
            if tag in BLOCKS:
                self.flush(kind)
            elif tag == "br":
                self.parts[kind].append(" ")
        if tag in VOID:
            return
        if tag in ENDS_P:
            self.leave("p")
        _, kind, region, story, link = self.open[-1]
        if kind != UNSEEN:
            kind = max(kind, kind_of(tag, attrs))
            if tag in REGIONS:
                self.around.append(region)
                region = len(self.around) - 1
            if tag in ("article", "main") and not story:
                self.stories += 1
                story = self.stories
        link = link and tag not in BLOCKS or tag == "a" and any(name == "href" for name, _ in attrs)
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in REGIONS:
            self.borders.append(len(self.open))
        self.open.append(Open(tag, kind, region, story, link))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a browser does not heed the slash

    def leave(self, tag: str) -> None:
        """Close the innermost open ``tag`` and what is open inside it; a <p> only within its container."""
        if not self.at.get(tag) or (tag == "p" and self.at[tag][-1] < self.borders[-1]):
            return
        i = self.at[tag][-1]
        kind, gone = self.open[-1].kind, self.open[i:]
        if kind == OWN and any(x.tag in BLOCKS for x in gone):
            self.flush(OWN)
        elif kind == ASIDE and (self.open[i - 1].kind == OWN or any(x.tag in BLOCKS for x in gone)):
            self.flush(ASIDE)
        for x in gone:
            self.at[x.tag].pop()
            if x.tag in REGIONS:
                self.borders.pop()
        del self.open[i:]

    def handle_endtag(self, tag: str) -> None:
        if self.open[-1].kind != UNSEEN:
            self.tags[self.open[-1].kind] += 1
        if tag not in VOID:
            self.leave(tag)

    def handle_data(self, data: str) -> None:
        at = self.open[-1]
        if at.kind != UNSEEN:
            self.parts[at.kind].append(data)
            if at.link:
                self.linked[at.kind] += sum(map(len, data.split()))

    def read(self, html: str) -> list[Block]:
        self.feed(html)
        self.close()
        self.flush(OWN)
        self.flush(ASIDE)
        return self.blocks


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbouring blocks; borders repeat the last value."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma ** 2))
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Border of the two clusters of ``values`` (two-means on a line, the lower
    centre fixed at 0: text that is all tags). It is not above the largest value."""
    high = float(values.max())
    for _ in range(ROUNDS):
        new = float(values[values >= high / 2].mean())
        if new == high:
            break
        high = new
    return high / 2


def within(regions: list[int], around: list[int]) -> list[int]:
    """How many of ``regions`` lie in each region; a region's number is above that of the region around it."""
    count = [0] * len(around)
    for region in regions:
        count[region] += 1
    for region in range(len(around) - 1, 0, -1):
        count[around[region]] += count[region]
    return count


def content(blocks: list[Block], around: list[int]) -> list[Block]:
    """The blocks of the content, without what is aside; ``around`` has the region around each region.

    The ratios of all blocks decide which are in the upper cluster; those that
    are aside or mostly links do not count, and if none is left, the ratios of
    the blocks that are not aside decide. An article or main element is the
    content if it holds MOST of the upper cluster's text.
    Else it is what stands in the nearest common container of the upper
    cluster from the cluster's first to its last block, and the blocks before
    and after them there up to the next one that is mostly links. A container
    of a single block is a part of the container around it.
    """
    own = [i for i, b in enumerate(blocks) if not b.aside]
    if not own:
        return []
    ratio = smoothed(np.log1p([len(b.text) / max(1, b.tags) for b in blocks]))
    border = threshold(ratio)
    upper = [i for i in own if ratio[i] >= border and not blocks[i].links]
    if not upper:
        border = threshold(ratio[own])
        upper = [i for i in own if ratio[i] >= border]
    held: Counter[int] = Counter()
    for i in upper:
        held[blocks[i].story] += len(blocks[i].text)
    story, most = held.most_common(1)[0]
    if story and most >= MOST * held.total():
        return [blocks[i] for i in own if blocks[i].story == story]
    met, every = (within([blocks[i].region for i in which], around) for which in (upper, own))
    home = max(r for r, n in enumerate(met) if n == len(upper))
    while home and every[home] == 1:
        home = around[home]
    inside = [home == 0]
    for region in range(1, len(around)):
        inside.append(region == home or inside[around[region]])
    first, last = upper[0], upper[-1]
    while first > 0 and inside[blocks[first - 1].region] and not blocks[first - 1].links:
        first -= 1
    while last + 1 < len(blocks) and inside[blocks[last + 1].region] and not blocks[last + 1].links:
        last += 1
    return [b for b in blocks[first:last + 1] if not b.aside]


def main_text(html: str) -> str:
    page = Reader()
    return "\n\n".join(b.text for b in content(page.read(html), page.around))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Null and empty pages, and pages without article text, give an empty text.
    Pages of any length are parsed whole; broken markup is read as far as it
    goes. Repeated rows each get their own row.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    schema = f"page_id {rows.schema[0].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
