"""Main text of web pages by two passes of rules over their blocks.

A page is read once, tag by tag, into blocks: stretches of text between block-level tags. What stands in menus, headers,
footers, sidebars, notices, adverts, forms or reader comments, by element, role or words of its class or id, is decided as
boilerplate at once. The first pass judges every other block by its length, the share of its characters in links and the
share of stop words among its words: long blocks full of stop words are text, blocks of links are not. Blocks too
short or too odd for that stay open. In the second pass they inherit the label of the nearest decided neighbours, of those in the
same element first. Where a page marks its article, blocks in it have their neighbours there, and nothing outside it counts.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread

#: Shorter blocks (in characters) are open, and so are longer ones whose share of stop words lies between the two bounds.
SHORT = 70
FEW_STOPS, MANY_STOPS = 0.08, 0.2
#: A block with a larger share of its characters in links is no text by itself.
MOST_LINKED = 0.5
#: Fixed lists: frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    (
        "the of and to a in is that it for was on with be this by as are at from or an not have he his which but they had her she you we were their has "
        "der die und in von den zu mit für das des sich nicht ist auf dem im eine ein als auch es an werden aus er hat dass sie nach wird bei "
        "de la le et des les en du un que pour une est qui dans par pas sur avec au ne se ce il sont plus mais ou nous "
        "el y los se las del con no una su por es para lo al como más o pero sus le ha me si sin este ya entre"
    ).split()
)

#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "title"}
#: Elements that are boilerplate wherever they stand, and those in which an article may still begin.
NEVER = {"aside", "dialog", "template", "object", "svg", "canvas", "audio", "video", "select", "button", "head"}
UNLESS_ARTICLE = {"nav", "menu", "footer", "form", "header"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold one block of many: blocks in them are neighbours in what holds these.
PARTS = HEADINGS | {"p", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "pre", "blockquote"}
#: What an opening tag closes if it is the innermost open element; any block-level tag closes a paragraph.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}, "body": {"head"}}
#: Words of classes and ids: boilerplate wherever they stand, and unless an article begins in it.
NEVER_NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist reply replies respond disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall share sharing social related recommended trending".split()
)
UNLESS_NAMED = frozenset("nav navbar navigation menu submenu breadcrumb breadcrumbs pagination sidebar sidebars rail widget widgets footer masthead topbar toolbar banner header login search".split())
#: Named so, an element inside an article is part of it.
OF_ARTICLE = frozenset("header banner".split())
NEVER_ROLE, UNLESS_ROLE = {"alert", "alertdialog", "dialog", "complementary", "search", "button", "tooltip"}, {"navigation", "banner", "contentinfo", "form", "menu", "menubar"}

# what follows = may be quoted, and only there a > does not end the tag
TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
TELLING = re.compile(r"class|\bid\b|role|hidden|style|itemprop", re.I)
WORD = re.compile(r"[^\W\d_]+")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    linked: int
    stops: float
    heading: bool
    in_article: bool
    boilerplate: bool
    container: int


class Nature(NamedTuple):
    """What an element makes of its content: boilerplate always, boilerplate unless an article begins in it, an article."""

    never: bool
    unless: bool
    article: bool


PLAIN = Nature(False, False, False)


@lru_cache(maxsize=8192)
def nature(tag: str, attributes: str) -> Nature:
    """The nature of an element by its name and attributes. `header` and `banner` are told apart by where they stand."""
    got = {}
    if TELLING.search(attributes):
        for m in ATTRIBUTE.finditer(attributes):
            got.setdefault(m[1].lower(), references.unescape(m[2] or m[3] or m[4] or ""))
    role = got.get("role", "").strip().lower()
    article = tag in ARTICLE or role == "main" or got.get("itemprop", "").lower() == "articlebody"
    if tag in ("html", "body"):  # their classes tell of the page, not of themselves
        return PLAIN
    parts = {x.lower() for x in NAME_PART.findall(f"{got.get('class', '')} {got.get('id', '')}")}
    hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I) is not None
    never = tag in NEVER or bool(parts & NEVER_NAMED) or role in NEVER_ROLE or hidden
    unless = not article and (tag in UNLESS_ARTICLE or bool(parts & UNLESS_NAMED) or role in UNLESS_ROLE)
    return Nature(never, unless, article and not never)


@lru_cache(maxsize=8192)
def only_header(tag: str, attributes: str) -> bool:
    """Whether an element is boilerplate only as a header, which inside an article is the article's own."""
    if tag in UNLESS_ARTICLE - {"header"}:
        return False
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    parts = {x.lower() for x in NAME_PART.findall(f"{got.get('class', '')} {got.get('id', '')}")}
    return not parts & (UNLESS_NAMED - OF_ARTICLE) and got.get("role", "").strip().lower() not in UNLESS_ROLE - {"banner"}


class Reader:
    """Reads one page. Open elements are kept as (tag, nature, container and state before), inline ones only if they matter."""

    def __init__(self, stop_words: frozenset[str]):
        self.stop_words, self.blocks, self.pieces = stop_words, [], []
        self.stack, self.open = [], Counter()
        # how many enclosing elements make boilerplate, may make it, are articles, are links
        self.never = self.unless = self.article = self.link = self.heading = 0
        self.containers = self.container = 0

    def flush(self) -> None:
        """Ends the block: its pieces outside boilerplate make its text; of boilerplate alone only that there was some."""
        if not self.pieces:
            return
        pieces, self.pieces = self.pieces, []
        bad = not any(not b and t.strip() for t, _, b in pieces)
        text = " ".join("".join(t for t, _, b in pieces if b == bad).split())
        if text:
            linked = sum(len("".join(t.split())) for t, a, b in pieces if a and b == bad)
            words = [] if bad else WORD.findall(text.lower())
            stops = sum(w in self.stop_words for w in words) / max(len(words), 1)
            self.blocks.append(Block(text, linked, stops, self.heading > 0, self.article > 0, bad, self.container))

    def say(self, text: str) -> None:
        if text:
            self.pieces.append((references.unescape(text) if "&" in text else text, self.link > 0, self.never > 0 or self.unless > 0))

    def pop(self) -> None:
        tag, kind, unless, self.container = self.stack.pop()
        self.open[tag] -= 1
        self.never -= kind.never
        self.article -= kind.article
        self.unless = unless
        self.link -= tag == "a"
        self.heading -= tag in HEADINGS

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            closed = CLOSES.get(tag, ())
            while self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] in closed):
                self.pop()
        elif tag == "br":
            self.say(" ")
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "object"):
            return
        if tag == "a" and self.open["a"]:
            self.end("a")
        kind = nature(tag, attributes if len(attributes) < 4096 else "")
        if kind.unless and self.article and only_header(tag, attributes if len(attributes) < 4096 else ""):
            kind = PLAIN
        if tag in BLOCK or tag == "a" or kind is not PLAIN and kind != PLAIN or self.open[tag]:
            self.stack.append((tag, kind, self.unless, self.container))
            if tag in BLOCK and tag not in PARTS:
                self.containers += 1
                self.container = self.containers
            self.open[tag] += 1
            self.never += kind.never
            self.article += kind.article
            self.unless = 0 if kind.article else self.unless + kind.unless
            self.link += tag == "a"
            self.heading += tag in HEADINGS

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.say(" ")
        if self.open[tag]:
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def read(self, page: str) -> list[Block]:
        at, unclosed = 0, False
        while m := TAG.search(page, at):
            self.say(page[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self.end(tag)
            elif tag in RAW and not (unclosed and tag == "title"):
                if close := re.compile(f"</{tag}", re.I | re.A).search(page, at):
                    at = close.start()
                elif tag == "title":
                    unclosed = True
                else:  # nothing of the rest is markup
                    at = len(page)
            else:
                self.start(tag, m[3])
        self.say(page[at:])
        self.flush()
        return self.blocks


def blocks_of(page: str | None, stop_words: Iterable[str] = STOP_WORDS) -> list[Block]:
    return Reader(frozenset(stop_words)).read(page or "")


def judged(b: Block) -> bool | None:
    """First pass: whether a block is text; None if it is open."""
    if b.boilerplate:
        return False
    size = len(b.text) - b.text.count(" ")
    if b.linked > MOST_LINKED * size:
        return None if b.heading or b.in_article and b.stops >= MANY_STOPS else False
    if b.heading or len(b.text) < SHORT:
        return None
    if b.stops >= MANY_STOPS:
        return True
    return None if b.in_article or b.stops >= FEW_STOPS else False


def _nearest(blocks: list[Block], first: list[bool | None], rows: Iterable[int]) -> dict[int, tuple[bool, int, bool]]:
    """For each open block of rows, in their order: (in another container, how far, label) of the decided one that came last, one in its own container before any other."""
    out, own, last = {}, {}, None
    for at, k in enumerate(rows):
        if first[k] is not None:
            own[blocks[k].container] = last = (at, first[k])
        elif near := own.get(blocks[k].container):
            out[k] = (False, at - near[0], near[1])
        elif last:
            out[k] = (True, at - last[0], last[1])
    return out


def labels(blocks: list[Block]) -> list[bool]:
    """Both passes. An open block takes the label of its nearest decided neighbour, on whichever side it is nearer, counted
    in blocks; of equally near ones a heading takes that of the following, any other block that of the one before it.
    Without any decided one, it is text in an article only."""
    first = [judged(b) for b in blocks]
    marked = any(b.in_article and f is not False for b, f in zip(blocks, first))
    rows = [k for k, b in enumerate(blocks) if not marked or b.in_article and not b.boilerplate]
    back, ahead = _nearest(blocks, first, rows), _nearest(blocks, first, reversed(rows))
    out = [False] * len(blocks)
    for k in rows:
        sides = [x for x in ((ahead.get(k), back.get(k)) if blocks[k].heading else (back.get(k), ahead.get(k))) if x]
        out[k] = first[k] if first[k] is not None else min(sides, key=lambda x: x[:2])[2] if sides else blocks[k].in_article
    return out


def main_text(page: str | None, stop_words: Iterable[str] = STOP_WORDS) -> str:
    """The main text of a page: its text blocks in order, joined by one space; white space within a block is one space."""
    blocks = blocks_of(page, stop_words)
    return " ".join(b.text for b, text in zip(blocks, labels(blocks)) if text)


def extracted(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """The columns named in keep, text and n_chars (code points): one row per row of pages.

    A null page counts as empty; an empty page, or one without main text, gives an empty text. Markup that is broken or
    never closed is read as far as it goes; long pages take time in proportion to their length. Repeated rows give repeated
    rows, an empty table an empty one; other columns are not looked at, whatever their names.
    """
    words, kinds = frozenset(stop_words), dict(pages.dtypes)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(h, words) for h in b["__html"]]
            yield b.drop(columns="__html").assign(text=texts, n_chars=[len(t) for t in texts])

    rows = spread(pages.select(*keep, F.col(html_col).alias("__html")))
    return rows.mapInPandas(of, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text string, n_chars long")
