"""The main text of web pages: parser events, text-to-tag ratios, smoothing, clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = 1.0  # standard deviation of the smoothing, in lines
REACH = 3  # lines on each side that smoothing takes in
MAJORITY = 0.75  # share of the page's content that leads into a container

# The elements of HTML by what they mean for the text around them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav ol"
    " optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = set("article aside blockquote body div footer form header main nav section table td ul ol".split())
UNSEEN = set("script style noscript template svg math iframe object canvas audio video".split())
NOISE = set("nav footer aside form dialog menu select button textarea title".split())
# What classes, identifiers and roles call the parts that are no article.
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment"
    " comments complementary consent contentinfo cookie cookies disqus footer gdpr login masthead menu modal"
    " nav navbar navigation newsletter notice notices pagination paywall popup promo promoted related"
    " replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription teaser toolbar widget".split()
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
COMMENTS = {"comment", "comments", "reply", "replies"}  # of articles, what their classes tell
WORD = re.compile(r"[a-z]+")
NAMES = ("class", "id", "role")


@dataclass
class Line:
    """The text between two breaks."""

    text: str
    tags: int  # start and end tags since the line before
    links: int  # characters inside links
    noise: bool
    container: int  # the innermost one around it
    kind: str  # the innermost element with a break


class Events(HTMLParser):
    """Takes a page's parser events one after another and keeps its lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Containers by number: what they are, and the number of the one around them.
        self.containers, self.parents = ["page"], [0]
        # Open elements: tag, innermost container, whether noise, whether never shown.
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self.counts: Counter[str] = Counter()  # of open elements by tag
        self.parts: list[str] = []
        self.tags = self.links = self.anchors = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![…``: skipped to its end like a comment, whatever it says."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BREAKS:
            self.end_line()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.anchors += 1
        if tag in VOID:
            return
        around, container, noise, unseen = self.open[-1]
        named = set(WORD.findall(" ".join(v.lower() for n, v in attrs if n in NAMES and v))) if attrs else set()
        article = tag in ("article", "main")
        if article and around == "form":
            noise = False  # a form around the whole page
        if tag in NOISE or (tag == "header" and not (self.counts["article"] or self.counts["main"])):
            noise = True
        elif named and tag not in ("html", "body"):
            noise = noise or not named.isdisjoint(COMMENTS if article else NOISE_WORDS)
        if tag in CONTAINERS:
            self.parents.append(container)
            container = len(self.containers)
            self.containers.append("main" if "main" in named and tag != "body" else tag)
        if tag in BREAKS or tag in UNSEEN or noise != self.open[-1][2]:
            self.open.append((tag, container, noise, unseen or tag in UNSEEN))
            self.counts[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in UNSEEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BREAKS:
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.anchors = max(0, self.anchors - 1)
        at = len(self.open) - 1
        while self.counts[tag] and at > 0:
            if self.open[at][0] == tag:
                self.counts.subtract(name for name, *_ in self.open[at:])
                del self.open[at:]
                break
            if self.open[at][0] in CONTAINERS and tag not in CONTAINERS:
                break  # nothing inside a container ends what is around it
            at -= 1

    def handle_data(self, data: str) -> None:
        if not self.open[-1][3]:
            self.parts.append(data)
            if self.anchors:
                self.links += len("".join(data.split()))

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            kind, container, noise, _ = self.open[-1]
            self.lines.append(Line(text, self.tags, self.links, noise, container, kind))
            self.tags = self.links = 0


def parsed(html: str) -> Events:
    """The lines of a page. A tag that the page's end cuts off is left out."""
    events = Events()
    cut = CUT_TAG.search(html, html.rfind(">") + 1)
    events.feed(html[: cut.start()] if cut else html)
    events.close()
    events.end_line()
    return events


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Each line's ratio averaged with its neighbours', by a Gaussian cut at REACH lines."""
    weights = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SPREAD) ** 2)
    total = np.convolve(ratios, weights)[REACH : REACH + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), weights)[REACH : REACH + len(ratios)]


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines are in the cluster of text: smoothed ratios over one standard deviation."""
    ratios = np.array([len(line.text) / max(line.tags, 1) for line in lines])
    smooth = smoothed(ratios)
    return smooth > smooth.std()


def within(own: list[int], parents: list[int]) -> list[int]:
    """For each container the sum over itself and all inside it."""
    total = list(own)
    for number in range(len(total) - 1, 0, -1):  # parents come before their children
        total[parents[number]] += total[number]
    return total


def region(events: Events, content: np.ndarray) -> int:
    """The container of the main text.

    From the page down, into the child with at least MAJORITY of the page's content,
    until there is none; an article is not divided, and neither is a container whose
    main heading stands outside that child.
    """
    lines, parents = events.lines, events.parents
    own = [i for i, line in enumerate(lines) if not line.noise]
    chosen = [i for i in own if content[i]] or own
    sizes, titles = [0] * len(parents), [0] * len(parents)
    for i in chosen:
        sizes[lines[i].container] += len(lines[i].text)
    for i in own:
        titles[lines[i].container] += lines[i].kind == "h1"
    sizes, titles = within(sizes, parents), within(titles, parents)
    largest = list(range(len(parents)))  # each container's largest child; itself if it has none
    for child in range(1, len(parents)):
        best = largest[parents[child]]
        if best == parents[child] or sizes[child] > sizes[best]:
            largest[parents[child]] = child
    at = 0
    while events.containers[at] != "article" and largest[at] != at:
        child = largest[at]
        if sizes[child] < MAJORITY * sizes[0] or titles[child] < titles[at]:
            break
        at = child
    return at


def main_text(html: str) -> str:
    """The main text of a page, its blocks joined by empty lines."""
    events = parsed(html)
    lines = events.lines
    if all(line.noise for line in lines):
        return ""
    content = content_lines(lines)
    chosen = region(events, content)
    inside = [number == chosen for number in range(len(events.parents))]
    for number in range(1, len(inside)):
        inside[number] = inside[number] or inside[events.parents[number]]

    def menu(i: int) -> bool:
        """An item of a list that is a link and not among text."""
        line = lines[i]
        return line.kind == "li" and not content[i] and line.links >= len("".join(line.text.split()))

    found = (line.text for i, line in enumerate(lines) if inside[line.container] and not line.noise and not menu(i))
    return "\n\n".join(found)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``: the page's main text.

    A page is read as parser events. Text between two breaks is a line, and its ratio
    is its characters to the tags met since the line before. Ratios are smoothed by a
    Gaussian over neighbouring lines, and lines above one standard deviation of them are
    content. The text's region is the container (an article, if one holds the content)
    that the content leads to, and all of its lines are returned, in page order: the
    clusters find the place, and lose no short line in it. Menus, headers and footers of
    the page, sidebars, notices, adverts, forms, reader comments (by their elements, or
    by what classes, identifiers and roles are called), scripts and styles are left out
    wherever they stand; a heading inside the article is part of it.

    Character references are decoded, white space of any kind (``str.split``) is one
    space, a line break too. Null, empty and text-free pages give the empty text; text
    without any tag is one line, and returned; broken markup (unclosed or crossed tags, a
    page that ends in the middle) is read as far as it goes. Rows that repeat give rows
    that repeat; an empty table gives an empty result; other columns are not read. One
    page at a time is in memory, besides the batch it came in; nothing is shuffled.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            columns.append(pa.array([len(text) for text in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("string"), F.lit(""))
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(compute, schema)
