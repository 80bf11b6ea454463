"""Main text of web pages from shallow text features.

A page becomes a flat list of text blocks.  Each block has its word count and link density and those of its
two neighbours; a decision tree trained on the small table below turns them into the share of article blocks
among blocks of that kind.  Nothing else enters the tree.  A block is kept if that share reaches a half.  Markup
only shifts this bar: inside what the page itself calls its article a block goes only if hardly any block of
its kind is text (lists of links), and what the page itself calls menu, advert, comment and so on gives no block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN_ATTRIBUTE = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)

# Fixed values of HTML: elements that hold anything up to their end tag, elements whose content is no text,
# void elements, those inside a line of text.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed"}
UNREAD = {
    "select", "button", "svg", "math", "object", "audio", "video", "canvas", "datalist", "noscript", "template",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FURNITURE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
# What ends an unread element that is never closed.
BLOCK = HEADINGS | FURNITURE | MAIN | {
    "html", "body", "p", "div", "section", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody",
    "tfoot", "tr", "td", "th", "pre", "blockquote", "figure", "figcaption", "address", "hr", "center", "details",
    "summary", "hgroup",
}
# Words for page furniture in class, id and role.  A name counts if it consists of such words and FILLER only:
# "sidebar-right" does, "has-sidebar" and "content-sidebar-wrap" do not.
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored sponsors promo promotion"
    " promotions nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer foot sidebar"
    " sidenav aside widget widgets related recommended share sharing social comment comments commentlist replies reply"
    " respond disqus cookie cookies consent gdpr notice notices alert newsletter subscribe signup popup modal overlay"
    " login search searchform toolbar copyright legal disclaimer contentinfo complementary".split()
)
FILLER = set(
    "site main global top bottom left right primary secondary first last inner outer wrapper wrap container"
    " box block area section group panel bar row col column list item items link links button buttons icon icons form"
    " field message text body title slot unit leaderboard google media this the id next prev previous post posts entry"
    " article articles stories page".split()
)
TOPS = {"header", "masthead", "title"}  # of a page: furniture; of a text: its heading
OF_TEXT = {"post", "posts", "entry", "article", "articles", "page", "section"}


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading")
# Labelled blocks: the features above (link density in hundredths) and whether the block belongs to the article.
LABELLED = (
    # inside an article
    (9, 0, 10, 0, 60, 0, 1, 1), (3, 0, 1, 100, 90, 0, 1, 1), (1, 0, 12, 0, 0, 0, 1, 1),
    (120, 0, 9, 0, 80, 0, 0, 1), (60, 2, 120, 0, 30, 0, 0, 1), (4, 0, 60, 0, 70, 0, 0, 1),
    (1, 0, 30, 0, 20, 0, 0, 1), (2, 0, 1, 100, 0, 0, 0, 1), (35, 40, 60, 0, 50, 0, 0, 1),
    (15, 0, 25, 0, 12, 100, 0, 1), (200, 8, 0, 0, 0, 0, 0, 1), (6, 0, 5, 0, 9, 0, 0, 1),
    (20, 60, 80, 0, 60, 0, 0, 1), (3, 100, 60, 0, 50, 0, 0, 1), (1, 100, 90, 0, 90, 0, 0, 1),
    (4, 100, 35, 0, 80, 0, 0, 1), (6, 100, 45, 5, 40, 0, 0, 1), (8, 90, 20, 0, 70, 0, 0, 1),
    (2, 100, 12, 0, 9, 0, 0, 1), (5, 100, 8, 0, 30, 0, 1, 1), (30, 0, 3, 100, 0, 0, 0, 1),
    (40, 0, 2, 100, 2, 100, 0, 1), (3, 0, 4, 100, 5, 100, 0, 1), (5, 0, 5, 100, 6, 100, 1, 1),
    (4, 100, 0, 0, 60, 0, 0, 1), (6, 100, 0, 0, 0, 0, 0, 1), (5, 20, 4, 100, 30, 0, 0, 1),
    (8, 0, 3, 100, 0, 0, 0, 1), (15, 0, 5, 100, 2, 0, 0, 1), (5, 0, 2, 100, 3, 0, 0, 1),
    (12, 0, 4, 100, 0, 0, 0, 1), (3, 0, 6, 100, 0, 0, 0, 1), (4, 100, 60, 0, 0, 0, 0, 1),
    (3, 100, 9, 0, 0, 0, 0, 1), (7, 100, 30, 0, 2, 0, 0, 1), (80, 8, 60, 0, 3, 100, 0, 1),
    (90, 4, 70, 0, 2, 100, 0, 1), (40, 12, 50, 0, 4, 100, 0, 1), (25, 30, 60, 0, 5, 100, 0, 1),
    (3, 0, 40, 0, 4, 100, 0, 1), (1, 0, 20, 0, 3, 100, 0, 1), (2, 0, 60, 0, 5, 100, 0, 1),
    (6, 0, 30, 0, 2, 100, 0, 1), (4, 0, 0, 0, 3, 100, 0, 1), (2, 0, 5, 100, 6, 100, 0, 1),
    (5, 0, 1, 0, 4, 100, 0, 1), (1, 0, 0, 0, 1, 0, 0, 1), (2, 0, 1, 0, 3, 0, 0, 1),
    (3, 0, 2, 0, 0, 0, 0, 1), (1, 0, 1, 100, 1, 0, 0, 1), (4, 0, 3, 0, 2, 0, 0, 1),
    (7, 0, 4, 100, 1, 0, 0, 1), (2, 0, 2, 100, 3, 100, 0, 1), (5, 0, 0, 0, 0, 0, 0, 1),
    (1, 0, 0, 0, 0, 0, 0, 1), (6, 0, 3, 0, 2, 100, 0, 1), (3, 0, 1, 0, 1, 0, 0, 1),
    # lists of links inside an article
    (5, 100, 6, 100, 7, 100, 0, 0), (2, 100, 2, 100, 1, 100, 0, 0), (8, 100, 9, 100, 8, 100, 0, 0),
    (1, 100, 1, 100, 1, 100, 0, 0), (12, 95, 10, 100, 11, 100, 0, 0), (6, 100, 5, 100, 4, 100, 0, 0),
    (4, 100, 5, 100, 0, 0, 0, 0), (7, 100, 8, 100, 0, 0, 0, 0), (2, 100, 1, 100, 0, 0, 0, 0),
    (5, 100, 4, 100, 40, 0, 0, 0), (3, 100, 3, 100, 60, 0, 0, 0), (9, 90, 7, 100, 25, 0, 0, 0),
    (6, 100, 50, 0, 5, 100, 0, 0), (3, 100, 70, 0, 4, 100, 0, 0), (8, 100, 2, 0, 9, 100, 0, 0),
    (4, 100, 0, 0, 5, 100, 0, 0), (10, 85, 30, 0, 12, 90, 0, 0), (2, 100, 4, 0, 3, 100, 0, 0),
    # without an article
    (90, 0, 8, 0, 60, 0, 0, 1), (45, 3, 90, 0, 70, 0, 0, 1), (22, 0, 60, 0, 40, 0, 0, 1),
    (18, 0, 40, 5, 30, 0, 0, 1), (150, 6, 2, 100, 3, 100, 0, 1), (9, 0, 70, 0, 60, 0, 0, 1),
    (60, 0, 70, 0, 1, 100, 0, 1), (80, 0, 60, 0, 2, 100, 0, 1), (30, 0, 2, 100, 90, 0, 0, 1),
    (7, 0, 1, 100, 80, 0, 1, 1), (5, 0, 40, 0, 60, 0, 1, 1), (12, 0, 35, 0, 25, 0, 0, 1),
    (1, 100, 1, 100, 1, 100, 0, 0), (3, 100, 2, 100, 4, 100, 0, 0), (6, 90, 40, 0, 5, 100, 0, 0),
    (2, 0, 1, 100, 1, 100, 0, 0), (4, 0, 2, 100, 3, 100, 0, 0), (25, 80, 10, 90, 20, 85, 0, 0),
    (6, 0, 3, 100, 2, 0, 0, 0), (3, 0, 90, 0, 1, 100, 0, 0), (8, 0, 2, 100, 0, 0, 0, 0),
    (2, 0, 3, 100, 90, 0, 0, 0), (4, 0, 0, 0, 120, 0, 0, 0), (3, 0, 60, 0, 45, 0, 0, 1),
    (40, 70, 60, 60, 30, 75, 0, 0), (3, 0, 2, 0, 1, 100, 1, 0),
    # without an article, at the end or alone
    (300, 0, 0, 0, 0, 0, 0, 1), (60, 3, 0, 0, 0, 0, 0, 1), (20, 0, 0, 0, 0, 0, 0, 1),
    (8, 0, 0, 0, 0, 0, 0, 1), (120, 0, 80, 0, 0, 0, 0, 1), (45, 5, 60, 0, 0, 0, 0, 1),
    (25, 0, 40, 0, 0, 0, 0, 1), (14, 0, 70, 0, 0, 0, 0, 1), (9, 0, 30, 0, 0, 0, 0, 1),
    (80, 0, 5, 0, 0, 0, 0, 1), (150, 2, 2, 100, 0, 0, 0, 1), (35, 0, 3, 100, 0, 0, 0, 1),
    (6, 0, 50, 0, 0, 0, 0, 1), (3, 0, 60, 0, 0, 0, 0, 1), (4, 0, 25, 0, 0, 0, 0, 1),
    (4, 0, 0, 0, 0, 0, 0, 1), (5, 0, 8, 0, 0, 0, 0, 1),
    # without an article, short ones among text
    (4, 0, 60, 0, 70, 0, 0, 1), (2, 0, 45, 0, 30, 0, 0, 1), (1, 0, 30, 0, 50, 0, 0, 1),
    (5, 0, 20, 0, 20, 0, 0, 1), (3, 0, 25, 5, 90, 0, 0, 1), (6, 0, 35, 0, 12, 0, 0, 1),
    (5, 0, 30, 0, 4, 0, 0, 1), (4, 0, 5, 0, 4, 0, 0, 1), (3, 0, 4, 0, 5, 0, 0, 1),
    (6, 0, 7, 0, 6, 0, 0, 1), (4, 0, 6, 0, 50, 0, 0, 1), (2, 0, 3, 0, 4, 0, 0, 1),
    (5, 0, 6, 0, 40, 0, 0, 1), (3, 0, 60, 0, 5, 0, 0, 1), (4, 0, 40, 0, 60, 0, 1, 1),
    (2, 0, 80, 0, 70, 0, 1, 1), (3, 0, 20, 0, 35, 0, 1, 1), (6, 0, 0, 0, 80, 0, 1, 1),
    (3, 0, 2, 100, 60, 0, 1, 1), (4, 0, 1, 100, 90, 0, 1, 1), (2, 0, 3, 100, 40, 0, 1, 1),
    (5, 0, 4, 100, 20, 0, 1, 1), (3, 0, 0, 0, 60, 0, 1, 1), (8, 0, 3, 100, 6, 0, 0, 1),
    (9, 0, 2, 100, 40, 0, 0, 1), (12, 0, 3, 100, 25, 0, 0, 1),
    (9, 0, 70, 0, 1, 100, 0, 1), (12, 0, 50, 0, 2, 100, 0, 1), (10, 0, 30, 0, 3, 100, 0, 1),
    (11, 0, 5, 0, 2, 100, 0, 1), (60, 10, 40, 0, 5, 100, 0, 1), (35, 25, 60, 0, 3, 100, 0, 1),
    (25, 15, 3, 100, 2, 100, 0, 1),
    (1, 0, 0, 0, 0, 0, 0, 1), (2, 0, 0, 0, 0, 0, 0, 1), (6, 0, 0, 0, 0, 0, 0, 1),
    (2, 0, 3, 0, 2, 0, 0, 1), (1, 0, 2, 0, 1, 0, 0, 1), (3, 0, 1, 0, 2, 0, 0, 1), (4, 0, 2, 0, 0, 0, 0, 1),
    (7, 0, 3, 0, 0, 0, 0, 1), (3, 0, 0, 0, 30, 0, 0, 1), (2, 0, 0, 0, 5, 0, 0, 1),
    (300, 0, 2, 100, 0, 0, 0, 1), (60, 0, 3, 100, 0, 0, 0, 1), (90, 3, 1, 100, 3, 0, 0, 1),
    (20, 0, 4, 100, 0, 0, 0, 1), (40, 0, 5, 100, 2, 0, 0, 1), (15, 0, 2, 100, 0, 0, 0, 1),
    (200, 1, 3, 100, 1, 0, 0, 1), (25, 0, 6, 100, 4, 0, 0, 1),
    # without an article, linked among text, and lists of links
    (5, 60, 60, 0, 70, 0, 0, 1), (15, 50, 40, 0, 60, 0, 0, 1), (25, 45, 70, 0, 50, 0, 0, 1),
    (2, 100, 3, 100, 0, 0, 0, 0), (4, 100, 5, 100, 2, 100, 0, 0), (5, 100, 50, 0, 4, 100, 0, 0),
    (7, 100, 6, 100, 60, 0, 0, 0), (3, 100, 0, 0, 2, 100, 0, 0), (1, 100, 60, 0, 0, 0, 0, 0),
    (4, 100, 80, 0, 0, 0, 0, 0), (8, 100, 7, 100, 9, 100, 0, 0), (2, 100, 2, 0, 3, 100, 0, 0),
    (6, 100, 8, 0, 5, 100, 0, 0), (10, 80, 9, 90, 0, 0, 0, 0),
    (1, 100, 0, 0, 21, 0, 0, 0), (2, 100, 0, 0, 60, 0, 0, 0), (3, 100, 0, 0, 120, 0, 0, 0),
    (2, 100, 80, 0, 5, 0, 0, 0), (4, 100, 60, 0, 70, 0, 0, 0), (6, 100, 0, 0, 0, 0, 0, 0),
    (5, 100, 30, 0, 40, 0, 0, 0), (3, 100, 12, 0, 90, 0, 0, 0), (8, 85, 3, 0, 4, 0, 0, 0),
    # without an article, labels of lists of links and notes below them
    (3, 0, 4, 100, 0, 0, 0, 0), (4, 0, 3, 100, 0, 0, 0, 0), (9, 0, 5, 100, 0, 0, 0, 0), (6, 0, 6, 100, 0, 0, 0, 0),
    (2, 0, 4, 100, 3, 100, 0, 0), (1, 0, 60, 0, 2, 100, 0, 0), (3, 0, 5, 100, 6, 100, 1, 0),
    (2, 0, 50, 0, 4, 100, 1, 0), (4, 0, 30, 0, 5, 100, 1, 0), (3, 0, 2, 100, 0, 0, 0, 0),
    (5, 0, 1, 100, 0, 0, 0, 0), (6, 0, 3, 100, 0, 0, 0, 0), (7, 0, 2, 100, 0, 0, 0, 0),
    (4, 0, 90, 0, 2, 100, 0, 0), (5, 0, 4, 100, 2, 100, 0, 0), (2, 0, 0, 0, 1, 100, 0, 0),
)


@dataclass
class Tag:
    start: int
    end: int  # of a raw element: of its end tag
    name: str  # empty for comments and the like
    closing: bool
    attributes: str
    partner: int = -1  # of a start tag: the place of its end tag


def tags(source: str) -> list[Tag]:
    """The tags of a page in order.  Only raw elements are skipped up to the end of the page if not closed."""
    found: list[Tag] = []
    opened: dict[str, list[int]] = {}
    at = 0
    while (match := TOKEN.search(source, at)) is not None:
        at = match.end()
        name = (match[2] or match[5] or "").lower()
        tag = Tag(match.start(), at, name, bool(match[1] or match[4]), match[3] or match[6] or "")
        if tag.closing:
            if opened.get(name):
                found[opened[name].pop()].partner = len(found)
        elif name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            tag.end = at = end.end() if end else len(source)
        elif name not in ("svg", "math") or not tag.attributes.endswith("/"):
            opened.setdefault(name, []).append(len(found))
        found.append(tag)
    return found


@dataclass
class Block:
    text: str
    words: int
    links: float
    heading: bool
    article: bool  # stands in what the page calls its article


def furniture_name(named: str, within: bool) -> bool:
    """Whether a class, id or role names page furniture; ``within``: inside an article."""
    for name in named.lower().split():
        parts = {x for x in re.split(r"[-_]+", name) if x and not x.isdigit()}
        heading = parts & TOPS and (within or parts & OF_TEXT) and not parts & FURNITURE_WORDS - TOPS
        if parts & FURNITURE_WORDS and parts <= FURNITURE_WORDS | FILLER and not heading:
            return True
    return False


def unlinked(source: str, found: list[Tag]) -> list[int]:
    """Running count of the words outside links, within articles if the page has any such; entry i counts
    those before tag i."""
    every, inside = [0], [0]
    at = depth = skip = 0
    linked = False
    for i, tag in enumerate(found):
        n = 0 if linked or i < skip else len(source[at : tag.start].split())
        every.append(every[-1] + n)
        inside.append(inside[-1] + (n if depth else 0))
        at = tag.end
        if tag.name == "a":
            linked = not tag.closing
        elif tag.name in UNREAD and tag.partner > i:
            skip = max(skip, tag.partner + 1)
        elif tag.name in MAIN:
            depth = max(0, depth + (-1 if tag.closing else 1))
    n = 0 if linked else len(source[at:].split())
    every.append(every[-1] + n)
    inside.append(inside[-1] + (n if depth else 0))
    return (inside if inside[-1] else every)[1:]


def squeeze(text: str) -> str:
    return " ".join(text.split())


class Page:
    """Collects the text blocks of one page in one pass over its tags."""

    def __init__(self, source: str) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int]] = []  # containers that place their blocks
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.in_link = self.heading = False
        self.read(source)
        self.flush()

    def place(self) -> int:
        sides = {side for _, side in self.open}
        return -1 if -1 in sides else 1 if 1 in sides else 0

    def flush(self) -> None:
        place = self.place()
        text = squeeze(html.unescape("".join(self.parts))) if place >= 0 else ""
        if text:
            words = len(text.split(" "))
            linked = len(html.unescape("".join(self.linked)).split())
            self.blocks.append(Block(text, words, min(1.0, linked / words), self.heading, place == 1))
        self.parts, self.linked = [], []

    def text(self, piece: str) -> None:
        self.parts.append(piece)
        if self.in_link:
            self.linked.append(piece)

    def read(self, source: str) -> None:
        found = tags(source)
        counts: list[int] = []
        at = i = 0
        unread = False  # within an unread element that is never closed
        while i < len(found):
            tag = found[i]
            if tag.start > at and not unread:
                self.text(source[at : tag.start])
            at = tag.end
            unread = unread and tag.name not in BLOCK
            if tag.closing:
                self.close(tag.name)
            elif tag.name in RAW or tag.name in UNREAD:
                self.text(" ")
                if tag.partner > i:
                    i = tag.partner
                    at = found[i].end
                elif tag.name in UNREAD and not (tag.name in ("svg", "math") and tag.attributes.endswith("/")):
                    unread = True
            elif tag.name:
                named = ""
                if tag.name not in INLINE and tag.name not in ("body", "html"):
                    named = " ".join("".join(x) for x in NAMED.findall(tag.attributes))
                if named and furniture_name(named, any(side == 1 for _, side in self.open)):
                    # What holds most of the text is no furniture, whatever its name.
                    counts = counts or unlinked(source, found)
                    own = counts[tag.partner] - counts[i] if tag.partner > i else counts[-1] - counts[i]
                    self.start(tag.name, tag.attributes, 2 * own < max(1, counts[-1]))
                else:
                    self.start(tag.name, tag.attributes)
            i += 1
        if at < len(source) and not unread:
            self.text(source[at:])

    def start(self, name: str, attributes: str, named: bool = False) -> None:
        if name == "a":
            self.in_link = True
        if name == "br":
            self.text(" ")
        if name in INLINE:
            return
        self.flush()
        self.in_link = False
        if name in HEADINGS:
            self.heading = True
        if name in VOID or attributes.endswith("/") and name not in MAIN | FURNITURE:
            return
        within = any(side == 1 for _, side in self.open)
        if named or HIDDEN_ATTRIBUTE.search(attributes):
            side = -1
        elif name in MAIN:
            side = 1
        elif name in FURNITURE and not (name == "header" and within):
            side = -1
        else:
            side = 0
        if side == 1 and not within:
            # An article does not stand inside furniture that was left open.
            self.open = [(n, s) for n, s in self.open if s != -1 or n in ("div", "section", "ul", "ol")]
        if side or name in {n for n, _ in self.open}:
            self.open.append((name, side))

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = False
            self.linked.append(" ")  # links side by side are words of their own
        if name in INLINE:
            return
        self.flush()
        self.in_link = False
        if name in HEADINGS:
            self.heading = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                del self.open[i:]
                break


def matrix(blocks: list[Block]) -> np.ndarray:
    own = np.array([(b.words, 100 * b.links) for b in blocks], dtype=float).reshape(-1, 2)
    nothing = np.zeros((1, 2))
    return np.hstack([
        own, np.vstack([nothing, own[:-1]]), np.vstack([own[1:], nothing]),
        np.array([[b.heading] for b in blocks], dtype=float).reshape(-1, 1),
    ])


LEAF = 3  # rows that a split leaves on each side at least
# Least share of article blocks in the leaf of a block that is kept: in a declared article, and elsewhere.
IN_ARTICLE, ELSEWHERE = 0.1, 0.5


@dataclass(frozen=True)
class Node:
    share: float  # of article blocks among its rows, one of each kind added: few rows are never sure
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def gini(labels: np.ndarray) -> float:
    share = labels.mean() if len(labels) else 0.0
    return len(labels) * 2 * share * (1 - share)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int) -> Node:
    """The binary split with the least impurity that leaves ``LEAF`` rows on each side, again on both sides."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if depth == 0 or gini(labels) == 0:
        return Node(share)
    found = (gini(labels) - 1e-9, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= cut
            if min(low.sum(), (~low).sum()) < LEAF:
                continue
            found = min(found, (gini(labels[low]) + gini(labels[~low]), feature, cut),
                        key=lambda x: x[0])
    if found[1] < 0:
        return Node(share)
    low = rows[:, found[1]] <= found[2]
    return Node(share, found[1], found[2], grow(rows[low], labels[low], depth - 1),
                grow(rows[~low], labels[~low], depth - 1))


@cache
def tree(depth: int = 8) -> Node:
    table = np.array(LABELLED, dtype=float)
    return grow(table[:, :-1], table[:, -1], depth)


def article_share(node: Node, row: np.ndarray) -> float:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.cut else node.high
    return node.share


def extract(source: str | None) -> str:
    """Article blocks of one page, one per line; empty for a NULL or empty page."""
    if not source:
        return ""
    blocks = Page(source).blocks
    if not blocks:
        return ""
    kept = [
        b.text for b, row in zip(blocks, matrix(blocks), strict=True)
        if article_share(tree(), row) >= (IN_ARTICLE if b.article else ELSEWHERE)
    ]
    return "\n".join(kept)


def main_text(source: str = "html") -> Column:
    """The main text of a page column; never NULL.

    NULL, empty and text-free pages give an empty string, an empty table no row.  Repeated rows give the same
    text each.  Pages are read whole however long, one at a time.  Reads no other column, so names cannot clash;
    the caller keeps what columns it likes.
    """
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([extract(p) for p in pages], dtype=object)

    return run(F.col(source))
