"""Main text of HTML pages from parser events, text-to-tag ratios and their smoothed clusters.

The standard library's streaming parser gives the events. They make up lines: one block of text
each, with the number of tags met since the line before and the chain of containers around it.
Lines in page furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments)
are marked by their elements and by names that are a furniture word or a known compound of it.
An ambiguous word alone marks a block only if its text-to-tag ratio is low. The text-to-tag ratio of the other lines is smoothed by a
Gaussian kernel; lines above the threshold are the content cluster. The content region is
the smallest container that holds the whole cluster. It is never below an article or main that
holds the cluster, and it is widened to a container around it with a heading before it. All its
unmarked lines are the text, but for menus: runs of short lines below the threshold that are links.
Short paragraphs between long ones stay.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from noticeflow.llm.common import map_text

RADIUS, SIGMA = 2, 1.0
DENSE = 50  # characters a tag; with that ratio a block is text, though an ambiguous word names it
THRESHOLD_SHARE = 0.5  # of the mean smoothed ratio
FULL_RATIO = 200  # a longer line counts as this, so that one very long line does not put the others below the threshold

LINK_SHARE = 0.8  # of a line's characters; such lines are a menu if they are short and below the threshold
MENU_LINES, MENU_CHARS = 2, 60  # links that make a menu, and the longest one on average
COPYRIGHT, COPYRIGHT_WORDS = re.compile(r"(?i)^(?:\u00a9|(?:copyright|\(c\))\s*(?:\u00a9|\(c\))?\s*\d{4})"), 15

# HTML element names by role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
                   "pre search section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article aside blockquote body center details dialog div dl fieldset figure footer form header main "
                       "menu nav ol search section table tbody td tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset("aside dialog fieldset footer form header menu nav search".split())
SILENT = frozenset("applet audio button canvas datalist embed head iframe map math noscript object script select style svg "
                   "template textarea title video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role attributes that name page furniture.
NAMED = frozenset("ad ads adv advert advertisement adverts breadcrumb breadcrumbs comment comments complementary "
                  "contentinfo cookie cookies copyright disqus footer masthead menu nav navbar navigation newsletter "
                  "pagination pager replies sidebar sponsor sponsored toolbar topbar".split())
# Words around them in compounds such as "main-menu" and "cookie-notice-bar".
QUALIFIERS = frozenset("area bar block bottom box btn button buttons cell consent container content entry fixed form global "
                       "group header icon icons inner item items left link links list local main mobile notice notices "
                       "outer page panel popup post primary right row secondary section settings signup site slot sticky "
                       "sub tabs text title toggle top tree unit widget widgets wrap wrapper".split())
# Ambiguous words, with those that make them a known compound in either order.
AMBIGUOUS = {word: frozenset(others.split()) for words, others in {
    "search": "bar box button field form icon input toggle widget wrapper",
    "share sharing social": "area bar block box btn button buttons container icon icons link links list media post tools widget wrapper",
    "related": "articles box items links list news posts stories widget",
    "header": "bar global inner site top wrap wrapper",
    "form": "contact feedback mail signup",
    "login subscribe promo promotion": "banner bar block box btn button form link modal popup widget wrapper",
    "notice notices": "consent gdpr privacy",
    "banner": "bar bottom consent gdpr promo top",
    "modal popup": "backdrop box container dialog overlay window wrapper",
    "reply": "btn button form link links",
    "skip": "content link links main to",
    "widget": "area box container list title wrapper",
}.items() for word in words.split()}
# A layout "with-sidebar" is no sidebar.
RELATIONS = frozenset(("with", "has", "no", "without"))
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Za-z][a-z]*")
SURE, WEAK = 2, 1


def named_furniture(name: str) -> int:
    """SURE for a furniture word or a known compound, WEAK for an ambiguous word alone, else 0."""
    parts = {part.lower() for part in NAME_PARTS.findall(name)}
    if parts & NAMED and parts <= NAMED | QUALIFIERS | AMBIGUOUS.keys() and not parts & RELATIONS:
        return SURE
    if any(len(parts) > 1 and parts - {word} <= others for word, others in AMBIGUOUS.items() if word in parts):
        return SURE
    return WEAK if len(parts) == 1 and parts & AMBIGUOUS.keys() else 0


def is_furniture(tag: str, attributes, article: bool = False) -> int:
    """SURE, WEAK or 0; ``article``: the block is inside an article or main.

    Ids of headings, and of sections of an article, are made from their titles and say nothing.
    """
    if tag in FURNITURE:
        return SURE
    if tag in ("html", "body", "main", "article"):
        return 0
    found = 0
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if not value or name == "id" and (tag in HEADINGS or article and tag == "section"):
            continue
        if name == "role" and {part.lower() for part in value.split()} & (NAMED | AMBIGUOUS.keys()):
            return SURE
        if name == "id" or name == "class" and not RELATIONS & set(value.lower().split()):
            found = max(found, *map(named_furniture, value.split()), 0)
    return found


@dataclass
class Line:
    text: str
    tags: int
    node: int  # innermost container
    heading: bool
    furniture: bool
    weak: int  # innermost block around it that an ambiguous word names, 0 if none
    seen: int  # tags of the page up to here
    links: int  # links in it
    linked: float  # share of its characters inside them
    header: int  # the header of an article around it, 0 if none


class LineReader(HTMLParser):
    """Turns the events of one page into lines. Each event costs the same, however deep the blocks are nested.

    Containers are numbered as they open; ``parent`` leads outwards and the numbers from a container to its ``last``
    are those inside it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parent, self.last, self.kind = [0], [0], ["body"]
        self.article_of = [0]  # outermost article or main around each container, itself included
        self.open: list[tuple[str, int, int]] = []  # containers: tag, number, furniture
        self.counts: dict[str, int] = {}  # open containers by tag
        self.node = self.tags = self.seen = self.marks = 0
        self.heading = False
        self.weak = self.weak_block = 0
        self.weak_parent, self.begin = [0], [0]  # of blocks that an ambiguous word names: the one around it, tags before it
        self.block_marked = 0  # of a block that is no container
        self.headers: list[int] = []  # open headers of articles
        self.silent: list[str] = []
        self.parts: list[str] = []
        self.link, self.links, self.linked = False, 0, 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            chars = len(text) - text.count(" ")
            self.lines.append(Line(text, self.tags, self.node, self.heading, self.marks > 0 or self.block_marked == SURE,
                                   self.weak_block or self.weak, self.seen, self.links, self.linked / chars,
                                   self.headers[-1] if self.headers else 0))
            self.tags = 0
        self.block_marked, self.weak_block, self.heading = 0, 0, False
        self.link, self.links, self.linked = False, 0, 0

    def named_weakly(self) -> int:
        self.weak_parent.append(self.weak)
        self.begin.append(self.seen - 1)
        return len(self.begin) - 1

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self.seen += 1
        if self.silent:
            if tag == "body":  # a head that was never closed
                self.silent.clear()
            else:
                if tag == self.silent[-1]:
                    self.silent.append(tag)
                return
        if tag in SILENT and tag not in VOID:
            self.flush() if tag in BLOCKS else None
            self.silent.append(tag)
            return
        if tag not in BLOCKS:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.link, self.links = True, self.links + 1
            return
        self.flush()
        article = self.article_of[self.node]
        furniture = is_furniture(tag, attrs, article > 0)
        if tag == "header" and article and not self.marks and not any(is_furniture("div", [a]) for a in attrs):
            furniture = 0  # it may hold the title of the article
        if tag in CONTAINERS:
            number = len(self.parent)
            self.parent.append(self.node)
            self.last.append(number)
            self.kind.append(tag)
            self.article_of.append(article or (number if tag in ("article", "main") else 0))
            self.open.append((tag, number, furniture))
            self.counts[tag] = self.counts.get(tag, 0) + 1
            self.node = number
            self.marks += furniture == SURE
            if furniture == WEAK:
                self.weak = self.named_weakly()
            if tag == "header" and furniture == 0:
                self.headers.append(number)
        else:
            self.block_marked, self.heading = furniture, tag in HEADINGS
            self.weak_block = self.named_weakly() if furniture == WEAK else 0

    def handle_startendtag(self, tag, attrs):
        # The slash means nothing on elements that are not void.
        self.handle_starttag(tag, attrs)
        if tag in VOID and self.silent and self.silent[-1] == tag:
            self.silent.pop()

    def close_container(self) -> str:
        tag, number, furniture = self.open.pop()
        self.counts[tag] -= 1
        self.last[number] = len(self.parent) - 1
        self.node = self.parent[number]
        self.marks -= furniture == SURE
        if furniture == WEAK:
            self.weak = self.weak_parent[self.weak]
        if self.headers and self.headers[-1] == number:
            self.headers.pop()
        return tag

    def handle_endtag(self, tag):
        self.tags += 1
        self.seen += 1
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
            return
        if tag not in BLOCKS:
            if tag == "a":
                self.link = False
            return
        self.flush()
        if self.counts.get(tag):
            while self.close_container() != tag:
                pass

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.link:
                self.linked += sum(map(len, data.split()))

    def end(self) -> None:
        self.close()
        self.flush()
        while self.open:
            self.close_container()
        self.last[0] = len(self.parent) - 1

    def inside(self, node: int, region: int) -> bool:
        return region <= node <= self.last[region]


def read_page(html: str) -> LineReader:
    reader = LineReader()
    reader.feed(html)
    reader.end()
    mark_weak(reader)
    # A header of an article is its furniture unless it holds the article's first heading.
    first: dict[int, int] = {}
    for line in reader.lines:
        if line.heading and not line.furniture:
            first.setdefault(reader.article_of[line.node], line.header)
    for line in reader.lines:
        if line.header and first.get(reader.article_of[line.node]) != line.header:
            line.furniture = True
        if COPYRIGHT.match(line.text) and line.text.count(" ") < COPYRIGHT_WORDS:
            line.furniture = True
    return reader


def mark_weak(reader: LineReader) -> None:
    """Marks the lines of those blocks named by an ambiguous word whose own ratio is below DENSE."""
    count = len(reader.begin)
    chars, last = [0] * count, list(reader.begin)
    for line in reader.lines:
        if not line.furniture:
            chars[line.weak] += len(line.text)
            last[line.weak] = line.seen
    for block in range(count - 1, 0, -1):  # blocks inside have higher numbers
        outer = reader.weak_parent[block]
        chars[outer] += chars[block]
        last[outer] = max(last[outer], last[block])
    sparse = [False] * count
    for block in range(1, count):
        sparse[block] = sparse[reader.weak_parent[block]] or chars[block] < DENSE * (last[block] - reader.begin[block])
    for line in reader.lines:
        line.furniture = line.furniture or sparse[line.weak]


def smoothed(values: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut off and rescaled."""
    kernel = [math.exp(-((k / SIGMA) ** 2) / 2) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - RADIUS), min(len(values), i + RADIUS + 1)
        weights = kernel[low - i + RADIUS:high - i + RADIUS]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def content_region(reader: LineReader, lines: list[Line], dense: list[bool]) -> int:
    """The container that is the content region."""
    cluster = [line for line, good in zip(lines, dense, strict=True) if good]
    low, high = min(line.node for line in cluster), max(line.node for line in cluster)
    region = low
    while not reader.inside(high, region):  # the smallest container that holds the whole cluster
        region = reader.parent[region]
    if reader.article_of[region]:
        return reader.article_of[region]
    for line in lines:
        if reader.inside(line.node, region):
            break
        if line.heading and reader.inside(region, line.node):
            return line.node
    return region


def menu_lines(lines: list[Line], low: list[bool]) -> set[int]:
    """Places of lines that are menus: short links one after another, in one line or several, all with a ratio below the threshold."""
    found, run = set(), []
    for place in range(len(lines) + 1):
        if place < len(lines) and low[place] and lines[place].linked >= LINK_SHARE:
            run.append(place)
            continue
        links = sum(lines[n].links for n in run)
        if links >= MENU_LINES and sum(len(lines[n].text) for n in run) <= MENU_CHARS * links:
            found.update(run)
        run = []
    return found


def main_text(html: str) -> str:
    """The lines of the content region, one after another, without menus; empty if there are none."""
    reader = read_page(html)
    lines = [line for line in reader.lines if not line.furniture]
    if not lines:
        return ""
    ratios = [min(FULL_RATIO, len(line.text) / max(1, line.tags)) for line in lines]
    smooth = smoothed(ratios)
    threshold = THRESHOLD_SHARE * sum(smooth) / len(smooth)
    menus = menu_lines(lines, [ratio < threshold for ratio in ratios])
    if len(menus) == len(lines):
        return ""
    dense = [ratio >= threshold and n not in menus for n, ratio in enumerate(smooth)]
    region = content_region(reader, lines, dense if any(dense) else [n not in menus for n in range(len(lines))])
    return "\n".join(line.text for n, line in enumerate(lines) if n not in menus and reader.inside(line.node, region))


def extract(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keys, text and n_chars (code points) of every row.

    NULL and empty pages have an empty text, and so have pages of furniture alone.
    Each row is parsed on its own: repeated rows and NULL keys are kept, other columns are not read,
    an empty table gives no rows. No shuffle; memory is bounded by the batch and the longest page.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    kinds = ", ".join(f"{n} {pages.schema[k].dataType.simpleString()}" for n, k in zip(names, keys, strict=True))
    rows = pages.selectExpr(*(f"`{k}` AS {n}" for n, k in zip(names, keys, strict=True)), f"`{html}` AS _html")

    def make(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) if h else "" for h in batch.column("_html").to_pylist()]
        return {**{n: batch.column(n) for n in names}, "text": texts, "n_chars": [len(t) for t in texts]}

    found = map_text(rows, "_html", f"{kinds}, text string, n_chars bigint", make)
    return found.withColumnsRenamed(dict(zip(names, keys, strict=True)))
