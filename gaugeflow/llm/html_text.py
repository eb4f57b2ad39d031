"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events; they become lines, one for each
block of the page, with the tags that led up to it. Lines that show no text of
the page by their element, or that lie in a container of navigation, adverts
and the like by its element or its class and id words, are set aside. Reader
comments and consent dialogs are so whatever they hold, but for a container
of the page's ``main`` element; a menu, footer, form or dialog unless it holds
an ``article`` or ``main`` element that is no comment; another container named
like something beside the text also where, on a page without such elements, it
holds most of the text. Each remaining line has a ratio of text
outside links to tags, weighted by its containers; the ratios are smoothed
with a Gaussian over the lines of a region in page order, and the page's
threshold splits the regions into content and the rest. A region is what one
``article`` or ``main`` element holds outside those within it, or else a run
of lines between such elements and set aside lines; the same threshold decides
on every region, which is kept or left whole, so short blocks stay with their
text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import free_name

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn del em font i ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br img".split())
NO_TEXT = frozenset("head title script style noscript template select textarea button iframe object svg canvas audio "
                    "video map".split())
SET_ASIDE = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset(("article", "main"))
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                        "menubar".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus replies cookie cookies consent gdpr".split())
MENU_WORDS = frozenset("menu nav navbar navigation breadcrumb breadcrumbs footer modal popup login pagination pager "
                       "toolbar skip".split())
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                        "sidebar header masthead notice notices notification overlay newsletter subscribe "
                        "subscription signup share sharing social related recommended widget".split())
#: What sets a container aside, the strictest last: nothing, its name, its kind, being comments or consent.
OPEN, NAMED, KIND, COMMENTS = range(4)
#: Standard deviation of the smoothing, in lines, and the part of the ratios' deviation that is the threshold.
SIGMA, THRESHOLD = 1.0, 1.0
#: Weight of ratios in ``article`` and ``main`` elements, and in containers that only their content saves from being set aside.
MAIN_WEIGHT, ASIDE_WEIGHT = 2.0, 0.25
NAME_WORDS = re.compile(r"[a-z]+|\d+")


@dataclass
class Line:
    """A block's text, the tags before and in it, its characters in links, its
    innermost element, and by its containers: the region's element (0: none),
    the weight, and whether it is set aside."""

    text: str
    tags: int
    linked: int
    element: int
    region: int = 0
    weight: float = 1.0
    aside: bool = False


@dataclass
class Element:
    """A block element: its container, its name if it is ``article`` or
    ``main``, what sets it aside, and whether it has no text by its kind."""

    parent: int
    main: str
    beside: int
    no_text: bool


class LineParser(HTMLParser):
    """Parser events to lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.elements = [Element(0, "", OPEN, False)]  # the page, then block elements in page order
        self.open: list[tuple[str, int]] = []  # block elements: name, number
        self.words: list[str] = []
        self.tags = self.linked = self.links = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append(Line(text, max(self.tags, 1), self.linked, self.open[-1][1] if self.open else 0))
            self.tags = 0
        self.words, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
        if tag == "a":
            self.links += 1
        if tag in INLINE:
            return
        self.end_line()
        if tag in VOID:
            return
        if self.open and self.open[-1][0] == "p" or self.open and tag == self.open[-1][0] == "li":
            self.open.pop()
        parent = self.open[-1][1] if self.open else 0
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        names = NAME_WORDS.findall(f"{given.get('class', '')} {given.get('id', '')}".lower())
        named = frozenset() if tag in ("html", "body") else frozenset(names)
        beside = (COMMENTS if named & COMMENT_WORDS else
                  KIND if tag in SET_ASIDE or given.get("role", "").lower() in ASIDE_ROLES or named & MENU_WORDS else
                  NAMED if named & ASIDE_WORDS else OPEN)
        no_text = (tag in NO_TEXT or "hidden" in given or given.get("aria-hidden") == "true"
                   or self.elements[parent].no_text)
        self.open.append((tag, len(self.elements)))
        self.elements.append(Element(parent, tag if tag in MAIN else "", beside, no_text))

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE or tag in VOID:
            return
        self.end_line()
        if tag in ("p", "li") and not (self.open and self.open[-1][0] == tag):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                self.links = 0
                return

    def handle_data(self, data):
        self.words.append(data)
        if self.links:
            self.linked += len(data)

    def place_lines(self) -> None:
        """Region, weight and setting aside of every line, once the whole page
        is known."""
        elements = self.elements
        # from the page inwards: without text or within comments
        shut = [False] * len(elements)
        for i, e in enumerate(elements[1:], 1):
            shut[i] = shut[e.parent] or e.no_text or e.beside == COMMENTS
        # from the leaves outwards: characters, and ``article`` (1) or ``main`` (2) elements that are no comments
        held, main = [0] * len(elements), [0] * len(elements)
        for line in self.lines:
            if not shut[line.element]:
                held[line.element] += len(line.text)
        for i in range(len(elements) - 1, -1, -1):
            e = elements[i]
            if not e.no_text:
                main[i] = max(main[i], 2 if e.main == "main" else 1 if e.main and not shut[i] else 0)
            if i:
                held[e.parent] += held[i]
                main[e.parent] = max(main[e.parent], main[i])
        states = [(0, False, False)]  # region, saved by its content, set aside
        for i, e in enumerate(elements[1:], 1):
            region, saved, aside = states[e.parent]
            holds = (main[i] == 2 or e.beside < COMMENTS and main[i] > 0
                     or e.beside == NAMED and not main[0] and 2 * held[i] > held[0])
            states.append((i if e.main else region, saved or e.beside > OPEN and holds,
                           aside or e.no_text or e.beside > OPEN and not holds))
        for line in self.lines:
            line.region, saved, line.aside = states[line.element]
            line.weight = (MAIN_WEIGHT if line.region else 1.0) * (ASIDE_WEIGHT if saved else 1.0)


def page_lines(html: str) -> list[Line]:
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser.end_line()
    parser.place_lines()
    return parser.lines


def smoothed_ratios(lines: list[Line]) -> np.ndarray:
    """Weighted text-to-tag ratio of each line of a region, smoothed over them."""
    ratio = np.array([x.weight * max(0, len(x.text) - x.linked) / x.tags for x in lines])
    reach = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * SIGMA ** 2))
    return np.convolve(ratio, kernel / kernel.sum())[reach:reach + len(ratio)]


def main_text(html: str | None) -> str:
    """The blocks of the content regions in page order, two line feeds between
    them; the empty string for null, empty and text-free pages. Text outside
    every block is a block of its own, so a page without markup is its text."""
    lines = page_lines(html or "")
    regions: dict[tuple, list[int]] = {}
    run = 0
    for i, line in enumerate(lines):
        if line.aside or line.region:
            run += 1
        if not line.aside:
            regions.setdefault((line.region, 0 if line.region else run), []).append(i)
    if not regions:
        return ""
    smooth = np.zeros(len(lines))  # lines set aside stay at zero
    for at in regions.values():
        smooth[at] = smoothed_ratios([lines[i] for i in at])
    peaks = {k: smooth[at].max() for k, at in regions.items()}
    least = min(THRESHOLD * float(smooth.std()), max(peaks.values()))
    chosen = sorted(i for k, at in regions.items() if peaks[k] >= least for i in at)
    return "\n\n".join(lines[i].text for i in chosen)


def extract_pages(pages: DataFrame, html_col: str = "html", text_col: str = "text",
                  count_col: str = "n_chars") -> DataFrame:
    """Pages with their main text and its number of code points instead of the
    html; other columns stay, but for those of the new names in any case. Each row is
    worked on by itself: repeats, nulls and empty tables need no rule."""
    @F.pandas_udf("text string, n_chars long")
    def extract(html: pd.Series) -> pd.DataFrame:
        texts = [main_text(h) for h in html]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    made = free_name(pages, "made")
    gone = {c.lower() for c in (html_col, text_col, count_col)}
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in gone]
    return (pages.select(*rest, extract(F.col(f"`{html_col}`")).alias(made))
            .select(*rest, F.col(f"{made}.text").alias(text_col), F.col(f"{made}.n_chars").alias(count_col)))
