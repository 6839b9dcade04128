"""Main text of web pages by tag-path ratios.

Each text node has the path of tags from the root to it. Over the nodes of one
path, the text length and the number of punctuation marks are averaged. Both are smoothed
along the page, so that a short node between long ones is not lost, and multiplied.
Paths whose mean of that reaches a share of the page's length-weighted mean are
content; inside ``article`` or ``main`` a smaller share will do.

The content of articles of one path, and that outside of any, are weighed by length (of articles
the mean, twice): what has less than ``GROUP_SHARE`` of the greatest weight goes, such as teaser cards
beside the body or a line beside the article. What is left names the content region: the articles it is in, or
outside of any the deepest element that holds ``REGION_SHARE`` of it. In the region **every** block stays,
lists, tables, quotes, captions and code as well, whatever its score; outside of it the blocks on content paths. Headings
of articles around what is kept stay too.

Left out everywhere are parts that say they are no article (menus, page headers, footers, sidebars, notices,
adverts, scripts, styles, comments; by tag, role, or a whole class or id), and lists of links. Names that
articles also use (``DOUBTFUL``) and ``form`` count only where the text is not prose: ``PROSE`` characters
or more, with marks, mostly outside of links.

Parsing mends what is left open. Comments and declarations without an end run to the end of the page, unknown
ones to the next ``>``; a DOCTYPE goes with its subset. Elements are linked to their parents
and paths have numbers, so memory and time grow with the page alone, however deep it is.

Character references are decoded, white space inside a block is one space, blocks are
joined by a newline. Null and empty html give an empty text. Pages are worked on one by one,
in tasks, without a shuffle; repeated rows get equal results and extra columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SIGMA = 1.5
SHARE = 0.1
ARTICLE_SHARE = 0.03
ARTICLE_WEIGHT = 2
GROUP_SHARE = 0.25
REGION_SHARE = 0.75
# Prose has this many characters, a mark for each so many, and at most this share in links.
PROSE, PER_MARK, PROSE_LINKS = 200, 120, 0.3
# A list of links: so many blocks of one path, with this share of their text in links.
LINK_BLOCKS, LINK_SHARE = 3, 0.8
COLUMN = "__main_text"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe li "
    "main menu nav noscript ol option p pre script search section select style summary table "
    "tbody td template textarea tfoot th thead title tr ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINERS = frozenset(("", "html", "body", "div", "section", "center", "form"))
NO_ARTICLE = frozenset(
    "aside button datalist dialog footer head iframe input menu nav noscript object script "
    "search select style svg template textarea title".split()
)
LABELS = frozenset(("label", "legend"))
# A class, id or role that says the same: as a whole, as the first part of a compound, or
# as its last part after a word of place.
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer gdpr modal nav navbar "
    "navigation newsletter popup promo replies sidebar sponsor sponsored subscribe".split()
)
DOUBTFUL = frozenset(
    "alert menu notice promotion related search share sharing social widget".split()
)
PLACES = frozenset(
    "bottom footer global header left main page primary reader right secondary site top user".split()
)
PAGE_HEADER_WORDS = frozenset(("header", "masthead", "topbar"))
ARTICLES = frozenset(("article", "main"))
# A new one ends an open one of the same kind.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table select".split())
_PART = re.compile(r"[a-z]+")
_MARK = re.compile(r"[^\w\s]")
_COMMENT_END = re.compile(r"--!?>")
_SUBSET_END = re.compile(r"\]\s*>")


def _says(names: set[str], words: frozenset[str]) -> bool:
    """Whether one of the class, id or role names is, or is a compound with, one of the words."""
    for name in names:
        if name in words:
            return True
        parts = _PART.findall(name)
        if len(parts) > 1 and (parts[0] in words or parts[0] in PLACES and parts[-1] in words):
            return True
    return False


@dataclass(slots=True, eq=False)
class Element:
    """An open or closed element; what is inside has numbers from ``number`` to ``last``."""

    tag: str
    path: int
    parent: Element | None
    number: int
    barred: bool = False
    doubt: Element | None = None  # the innermost element around that counts unless it is prose
    article: Element | None = None  # the innermost article or main around
    heading: bool = False
    link: bool = False
    form: bool = False
    block_path: int = 0
    last: int = 0

    def holds(self, other: Element) -> bool:
        return self.number <= other.number <= self.last


@dataclass(slots=True)
class Node:
    """The text of one block under one path."""

    block: int
    element: Element
    text: str


class PageParser(HTMLParser):
    """Text nodes of a page, with blocks and paths; mends what is left open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        root = Element("", 0, None, 0)
        self.open = [root]
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
        self.paths: dict[tuple[int, str], int] = {}
        self.doubts: list[Element] = []
        self.nodes: list[Node] = []
        self.block = 0
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self.block += 1
            elif tag == "br" and self.nodes:
                self.handle_data(" ")
            return
        if tag in BLOCKS:
            self.block += 1
            self._end_open(("p",), ("button",))
        if tag in CLOSES:
            self._end_open(CLOSES[tag], SCOPES)
        above = self.open[-1]
        self.count += 1
        path = self.paths.setdefault((above.path, tag), len(self.paths) + 1)
        new = Element(tag, path, above, self.count, above.barred, above.doubt)
        new.article = new if tag in ARTICLES else above.article
        new.heading = above.heading or tag in HEADINGS
        new.link = above.link or tag == "a"
        new.form = above.form or tag == "form"
        new.block_path = path if tag in BLOCKS else above.block_path
        hard, doubtful = self._says_no_article(tag, attrs, new)
        new.barred = new.barred or hard
        if doubtful and not new.barred:
            new.doubt = new
            self.doubts.append(new)
        self.places[tag].append(len(self.open))
        self.open.append(new)

    @staticmethod
    def _says_no_article(tag, attrs, new) -> tuple[bool, bool]:
        """Whether the element is no article, and whether that is in doubt."""
        names = {
            w for k, v in attrs if v and k in ("class", "id", "role") for w in v.lower().split()
        }
        if tag in NO_ARTICLE or tag in LABELS and new.form:
            return True, False
        if new.article is None and (tag == "header" or _says(names, PAGE_HEADER_WORDS)):
            return True, False
        if tag in ("html", "body") or tag in ARTICLES:
            return False, False
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        return hidden or _says(names, NO_ARTICLE_WORDS), tag == "form" or _says(names, DOUBTFUL)

    def _end(self, place: int) -> None:
        for element in reversed(self.open[place:]):
            self.places[element.tag].pop()
            element.last = self.count
        del self.open[place:]

    def _innermost(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end_open(self, tags, scopes) -> None:
        """End the innermost open element of ``tags``, unless a scope or article lies between."""
        place = self._innermost(tags)
        if place > max(self._innermost(scopes), self._innermost(ARTICLES)):
            self._end(place)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.block += 1
        if place := self._innermost((tag,)):
            self._end(place)

    def close(self):
        super().close()
        self._end(1)
        self.open[0].last = self.count

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    # The page is fed as a whole, so what has no end goes on to the end of the page.

    def parse_starttag(self, i):
        end = super().parse_starttag(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_endtag(self, i):
        end = super().parse_endtag(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_comment(self, i, report=1):
        text = self.rawdata
        for early in (">", "->"):
            if text.startswith(early, i + 4):
                return i + 4 + len(early)
        end = _COMMENT_END.search(text, i + 4)
        return end.end() if end else len(text)

    def parse_html_declaration(self, i):
        text = self.rawdata
        if text.startswith("--", i + 2):
            return self.parse_comment(i)
        end = text.find(">", i + 2)
        if end < 0:
            return len(text)
        if text[i + 2 : i + 9].lower() == "doctype" and "[" in text[i:end]:
            subset = _SUBSET_END.search(text, i)
            return subset.end() if subset else end + 1
        return end + 1

    def parse_pi(self, i):
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data):
        element = self.open[-1]
        if not element.barred:
            self.nodes.append(Node(self.block, element, data))

    def counted(self) -> list[Node]:
        """The nodes that no doubtful element bars."""
        totals = {e.number: [0, 0, 0] for e in self.doubts}
        for n in self.nodes:
            if n.element.doubt:
                t = totals[n.element.doubt.number]
                length = len(n.text.strip())
                t[0] += length
                t[1] += len(_MARK.findall(n.text))
                t[2] += length if n.element.link else 0
        for e in reversed(self.doubts):
            if e.parent.doubt:
                above = totals[e.parent.doubt.number]
                for i, x in enumerate(totals[e.number]):
                    above[i] += x
        barred: dict[int, bool] = {}
        for e in self.doubts:
            length, marks, linked = totals[e.number]
            prose = length >= PROSE and marks * PER_MARK >= length and linked <= PROSE_LINKS * length
            barred[e.number] = not prose or bool(e.parent.doubt and barred[e.parent.doubt.number])
        return [n for n in self.nodes if not (n.element.doubt and barred[n.element.doubt.number])]


def _smoothed(values: list[float]) -> list[float]:
    """Gaussian mean over neighbours in page order."""
    reach = math.ceil(2 * SIGMA)
    weights = [math.exp(-0.5 * (d / SIGMA) ** 2) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d, w in zip(range(i - reach, i + reach + 1), weights, strict=True):
            if 0 <= d < len(values):
                total += w * values[d]
                weight += w
        out.append(total / weight)
    return out


def content_paths(nodes: list[Node]) -> set[int]:
    """Tag paths whose fused ratio reaches the page's threshold."""
    lengths = [len(n.text.strip()) for n in nodes]
    marks = [len(_MARK.findall(n.text)) for n in nodes]
    paths = [n.element.path for n in nodes]
    inside = {n.element.path for n in nodes if n.element.article}
    sums: dict = defaultdict(lambda: [0, 0, 0])
    for path, length, mark in zip(paths, lengths, marks, strict=True):
        s = sums[path]
        s[0], s[1], s[2] = s[0] + 1, s[1] + length, s[2] + mark
    text = _smoothed([sums[p][1] / sums[p][0] for p in paths])
    mark = _smoothed([sums[p][2] / sums[p][0] for p in paths])
    fused = [t * (1 + m) for t, m in zip(text, mark, strict=True)]
    total = sum(lengths) or 1
    mean = sum(f * n for f, n in zip(fused, lengths, strict=True)) / total
    of_path: dict = defaultdict(list)
    for path, value in zip(paths, fused, strict=True):
        of_path[path].append(value)
    return {
        p
        for p, values in of_path.items()
        if sum(values) / len(values) >= mean * (ARTICLE_SHARE if p in inside else SHARE)
    }


def _group(element: Element) -> int:
    """Path of the article around; 0 outside of any."""
    return element.article.path if element.article else 0


def _main_groups(nodes: list[Node]) -> set[int]:
    """Groups of articles, or that outside of any, that hold enough text."""
    length, members = defaultdict(int), defaultdict(set)
    for n in nodes:
        group = _group(n.element)
        length[group] += len(n.text.strip())
        members[group].add(n.element.article.number if n.element.article else 0)
    weight = {g: x / len(members[g]) * (ARTICLE_WEIGHT if g else 1) for g, x in length.items()}
    least = GROUP_SHARE * max(weight.values())
    return {g for g, w in weight.items() if w >= least}


def _region(nodes: list[Node]) -> Element:
    """The deepest container that holds ``REGION_SHARE`` of the nodes' text."""
    whole = sum(len(n.text.strip()) for n in nodes)
    inside: dict[int, int] = defaultdict(int)
    elements: dict[int, Element] = {}
    for n in nodes:
        e = n.element
        inside[e.number] += len(n.text.strip())
        while e and e.number not in elements:
            elements[e.number] = e
            e = e.parent
    # Numbers grow from parents to children.
    for number in sorted(elements, reverse=True):
        e = elements[number]
        if inside[number] >= REGION_SHARE * whole and e.tag in CONTAINERS:
            return e
        if e.parent:
            inside[e.parent.number] += inside[number]
    return elements[min(elements)]


def _link_lists(nodes: list[Node]) -> set[int]:
    """Paths of blocks that are lists of links."""
    sums: dict = defaultdict(lambda: [0, 0, set()])
    for n in nodes:
        s = sums[n.element.block_path]
        length = len(n.text.strip())
        s[0] += length
        if n.element.link:
            s[1] += length
            s[2].add(n.block)
    return {
        p for p, (all_, linked, blocks) in sums.items()
        if len(blocks) >= LINK_BLOCKS and linked >= LINK_SHARE * all_
    }


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order, without empty ones."""
    parts: dict[int, list[str]] = {}
    for n in nodes:
        parts.setdefault(n.block, []).append(n.text)
    texts = (" ".join("".join(p).split()) for p in parts.values())
    return [t for t in texts if t]


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    parser = PageParser()
    parser.feed(html)
    parser.close()
    nodes = parser.counted()
    full = [n for n in nodes if n.text.strip()]
    if not full:
        return ""
    lists = _link_lists(full)
    prose = [n for n in full if n.element.block_path not in lists] or full
    paths = content_paths(prose)
    chosen = [n for n in prose if n.element.path in paths]
    groups = _main_groups(chosen)
    chosen = [n for n in chosen if _group(n.element) in groups]
    kept = {n.block for n in chosen}

    outside = [n for n in chosen if n.element.article is None]
    region = _region(outside) if outside else None
    articles = {n.element.article.number for n in chosen if n.element.article}
    around = set()  # articles with kept blocks, their own or those of articles inside
    for n in chosen:
        e = n.element.article
        while e and e.number not in around:
            around.add(e.number)
            e = e.parent.article
    for n in prose:
        article = n.element.article
        if article:
            whole, near = article.number in articles, article.number in around
        else:
            whole = near = bool(region and region.holds(n.element))
        if whole or near and n.element.heading:
            kept.add(n.block)
    return "\n".join(_blocks([n for n in nodes if n.block in kept]))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the column ``__main_text``."""
    schema = T.StructType([*pages.schema.fields, T.StructField(COLUMN, T.StringType())])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(html))
            texts = pa.array([main_text(h.as_py()) for h in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return pages.mapInArrow(run, schema)
