"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from the
root down to it. Text outside links and punctuation are summed per path and
divided by the path's blocks. Both ratios are smoothed along the page, where a
neighbour counts for as much as it shares enclosing elements, and fused; paths
below a share of the best are set aside, so a short block beside long paragraphs
gains from them and an advert in an element of its own hardly does. The chosen
blocks' ``article`` or ``main``, or else their lowest common element, is the
article, with all its blocks; where that is the whole page, the chosen paths and
the headings right before their blocks are.

Elements that the markup itself sets apart (navigation, forms, scripts ...) are
not cut at all. Whole class or id names of adverts, notices and comments make
their paths weigh nothing.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element kinds of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
NOISE_TAGS = frozenset("head nav header footer aside form button select option fieldset dialog menu svg canvas object audio video".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Class and id names, compared as a whole, of elements that are no part of an article.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead "
    "cookie cookies cookie-banner cookie-notice consent gdpr newsletter subscribe login share sharing social comment comments disqus replies respond related recommended pagination".split()
)
#: A start of one of these closes an open one of the others, up to the nearest list or table.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = frozenset("ul ol dl table".split())

#: Elements that hold one block, and so are never the article.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | frozenset("p li td blockquote pre".split())
#: Of the best path's ratio, what a path must reach; blocks on either side that smooth one, by a Gaussian of this width.
SHARE, REACH, WIDTH = 0.3, 3, 1.0

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/a-zA-Z][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=>]|$)|aria-hidden\s*=\s*.?true|display\s*:\s*none", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


@dataclass
class Block:
    path: int  # number of its path
    element: int  # number of the innermost open element, 0 for none
    depth: int  # open elements
    shared: int  # of these, open since the block before
    text: str
    linked: int  # characters in links


@dataclass
class Page:
    """A page's blocks and elements. Elements are numbered as they open, so those inside one follow it up to its ``last``."""

    blocks: list[Block] = field(default_factory=list)
    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    paths: list[int] = field(default_factory=lambda: [0])
    last: list[int] = field(default_factory=lambda: [-1])
    noise: list[bool] = field(default_factory=lambda: [False])
    marked: set[int] = field(default_factory=set)  # paths with a name of NOISE_NAMES
    frames: dict[str, list[int]] = field(default_factory=lambda: {"article": [0], "main": [0]})  # of each element, itself or the innermost around it of that tag
    steps: dict[tuple[int, str], int] = field(default_factory=dict)  # number of a path from that of its start and its last step
    open: list[int] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)  # of each tag, where it stands among the open elements
    parts: list[str] = field(default_factory=list)
    links: int = 0
    linked: int = 0
    low: int = 0  # least number of open elements since the last block

    def inner(self) -> int:
        return self.open[-1] if self.open else 0

    def text(self, raw: str) -> None:
        if raw and not self.noise[self.inner()]:
            found = html.unescape(raw)
            self.parts.append(found)
            if self.links:
                self.linked += len(found.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.paths[self.inner()], self.inner(), len(self.open), min(self.low, len(self.open)), text, min(self.linked, len(text))))
                self.low = len(self.open)
            self.parts, self.linked = [], 0

    def cut(self, to: int) -> None:
        """Close all open elements from place ``to`` on."""
        while len(self.open) > to:
            n = self.open.pop()
            self.last[n] = len(self.tags) - 1
            self.places[self.tags[n]].pop()
        self.low = min(self.low, to)

    def place(self, *tags: str) -> int:
        """Where the last opened of these stands, -1 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def start(self, tag: str, rest: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self.text(" ")
            self.links += tag == "a"
            return
        self.flush()
        if tag in VOID:
            return
        self.links = 0
        if self.tags[self.inner()] == "p" and tag not in RAW:
            self.cut(len(self.open) - 1)
        if tag in CLOSES and (at := self.place(*CLOSES[tag])) > self.place(*LIMITS):
            self.cut(at)
        names, role = [], ""
        for key, *values in _NAME.findall(rest):
            value = next((v for v in values if v), "").lower()
            if key.lower() == "role":
                role = value
            else:
                names += value.split()
        outer = self.inner()
        path = self.steps.setdefault((self.paths[outer], ".".join([tag, *names])), len(self.steps) + 1)
        if self.paths[outer] in self.marked or tag not in ("html", "body", "article", "main") and not NOISE_NAMES.isdisjoint(names):
            self.marked.add(path)
        noise = self.noise[outer] or (tag in NOISE_TAGS and not (tag == "header" and self.places.get("article"))) or role in NOISE_ROLES or bool(_HIDDEN.search(rest))
        for kind, near in self.frames.items():
            near.append(len(self.tags) if tag == kind else near[outer])
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(len(self.tags))
        for column, value in ((self.tags, tag), (self.parents, outer), (self.paths, path), (self.last, -1), (self.noise, noise)):
            column.append(value)

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = max(0, self.links - 1)
            return
        if (at := self.place(tag)) >= 0:
            self.flush()
            self.links = 0
            self.cut(at)
        elif tag in ("p", "hr"):
            self.flush()


def cut_page(source: str) -> Page:
    """The blocks of a page outside what its markup sets apart, in page order; broken and unclosed markup is read as far as it goes."""
    page, at = Page(), 0
    while m := _PIECE.search(source, at):
        page.text(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            page.end(tag)
        elif tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*>?", re.I).search(source, at)
            at = close.end() if close else len(source)
        else:
            page.start(tag, m[3])
            if m[3].endswith("/") and tag == "svg":
                page.end(tag)
    page.text(source[at:])
    page.flush()
    page.cut(0)
    return page


def smooth(values: np.ndarray, depth: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Each value with its neighbours', weighted by distance and by the enclosing elements that the two blocks share.

    depth: elements around each block; shared: those also around the block before.
    """
    kernel = np.exp(-0.5 * (np.arange(REACH + 1) / WIDTH) ** 2)
    kernel /= kernel[0] + 2 * kernel[1:].sum()
    out = kernel[0] * values
    common = shared.copy()  # of blocks i - k and i
    for k in range(1, min(REACH, len(values) - 1) + 1):
        if k > 1:
            common[k:] = np.minimum(common[k:], shared[1 : len(shared) - k + 1])
        like = (2 * common[k:] + 1) / (depth[k:] + depth[:-k] + 1)
        out[k:] += kernel[k] * like * values[:-k]
        out[:-k] += kernel[k] * like * values[k:]
    return out


def path_ratios(page: Page) -> np.ndarray:
    """The fused ratio of each path, by its number: the best among its blocks; 0 for paths with a name of NOISE_NAMES."""
    of = lambda f: np.array([f(b) for b in page.blocks], float)
    path, depth, shared = (np.array([getattr(b, k) for b in page.blocks]) for k in ("path", "depth", "shared"))
    count = np.maximum(1, np.bincount(path))
    text = np.bincount(path, of(lambda b: len(b.text) - b.linked)) / count
    marks = np.bincount(path, of(lambda b: len(_PUNCTUATION.findall(b.text)))) / count
    fused = smooth(text[path], depth, shared) * (1 + smooth(marks[path], depth, shared))
    best = np.zeros(len(count))
    np.maximum.at(best, path, fused)
    best[[p for p in page.marked if p < len(best)]] = 0
    return best


def chosen_paths(page: Page, share: float = SHARE) -> set[int]:
    """Numbers of the paths whose ratio reaches a share of the best."""
    best = path_ratios(page)
    return set(np.flatnonzero((best >= share * best.max()) & (best > 0)).tolist())


def article_element(page: Page, chosen: list[int]) -> int:
    """The element that holds the article, given the places of the chosen blocks; 0 for the whole page."""
    weight: dict[int, int] = {}
    for i in chosen:
        for near in page.frames.values():
            if n := near[page.blocks[i].element]:
                weight[n] = weight.get(n, 0) + len(page.blocks[i].text)
    total = sum(len(page.blocks[i].text) for i in chosen)
    for tag in page.frames:
        own = [n for n, w in weight.items() if page.tags[n] == tag and 2 * w >= total]
        if own:
            return max(own, key=lambda n: (weight[n], n))
    first = page.blocks[chosen[0]]
    depth = min([first.depth, *(b.shared for b in page.blocks[chosen[0] + 1 : chosen[-1] + 1])])
    element = first.element
    for _ in range(first.depth - depth):
        element = page.parents[element]
    while element and page.tags[element] in LEAVES:  # one long paragraph: what stands around it
        element = page.parents[element]
    return 0 if page.tags[element] in ("html", "body") else element


def main_text(source: str | None) -> str:
    """The article of a page, blocks joined by empty lines; empty for null and where no path weighs anything."""
    page = cut_page(source or "")
    paths = chosen_paths(page) if page.blocks else set()
    if not paths:
        return ""
    holder = article_element(page, [i for i, b in enumerate(page.blocks) if b.path in paths])
    if holder:
        kept = [b.text for b in page.blocks if holder <= b.element <= page.last[holder] and b.path not in page.marked]
    else:
        kept, below = [], -1  # below: the element around the block kept last, seen from the end
        for b in reversed(page.blocks):
            if b.path in paths or page.tags[b.element] in HEADINGS and b.path not in page.marked and page.parents[b.element] == below:
                kept.append(b.text)
                below = page.parents[b.element]
        kept.reverse()
    return "\n\n".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of pages(page_id, url, html).

    A null, empty or textless html gives an empty text. Repeated rows and null
    ids or urls stay, equal pages get equal texts, other columns are ignored, and
    an empty table gives an empty table. Time and memory grow with a page's length.
    """

    def run(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s) for s in sources], dtype=object)

    return pages.select("page_id", "url", F.pandas_udf(run, "string").asNondeterministic()(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
