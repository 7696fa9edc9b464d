"""Main text of web pages by text-to-tag ratios.

The standard library's parser is fed a page in blocks and its events make
lines, one for each piece of text between block tags. A line's ratio is its
characters by its tags; ratios are smoothed over neighbouring lines with a
Gaussian, and lines above a threshold mark the content regions. Regions are
taken whole, so short paragraphs and headings of an article stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import small_batches, without

#: Characters fed to the parser at once; lines the Gaussian reaches to each side, its
#: width in lines; the part of a region's text that must be in marked lines; the parts of
#: the page's marked text from which an element set apart by its name is a wrapper,
#: outside and inside articles.
BLOCK, REACH, SIGMA, MARKED, WRAPS = 1 << 16, 2, 1.0, 0.5, (0.5, 0.75)

# Elements of HTML by the part they play here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr br img".split()
)
UNSEEN = frozenset("script style noscript template head title iframe object svg canvas math audio video".split())
ASIDE = frozenset("nav footer aside menu dialog button select textarea fieldset".split())
REGION = frozenset("article main".split())
#: Blocks that are parts of the container they stand in.
INNER = frozenset(
    "ul ol dl table caption colgroup thead tbody tfoot tr blockquote figure details hgroup address center".split()
)
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption summary caption".split())
#: What a start tag ends if it is open and no element of the second set is opened inside it.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
# Words of classes, ids and roles that mark what is not the article. Readers' comments, notices and
# adverts never are around it; parts of the layout may give their name to the element around all.
REMARKS = frozenset("comment comments disqus replies reply respond".split())
NOTES = REMARKS | frozenset(
    "ad ads advert adverts advertisement advertising consent cookie cookies gdpr modal newsletter notice notices"
    " popup promo related sponsor sponsored subscribe".split()
)
LAYOUT = frozenset(
    "banner breadcrumb breadcrumbs complementary contentinfo footer masthead menu menubar nav navbar navigation pager"
    " pagination search share sharing sidebar social toolbar".split()
)
#: Words that make a name of several say how the rest is, not what the element is.
STATES = frozenset("closed disabled enabled free has is no off on open with without".split())
#: The part of the text around it from which an element named by a part of a word, or a form, wraps the page.
WHOLE = 0.97


def kind_of(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """How an element is set apart by its names: "remark" or "note" by a whole one, "remark part"
    or "part" by a part of one (a form is a part), "layout", or not at all. Of an article only
    the names of readers' comments count."""
    if tag in ("html", "body", "main"):
        return ""
    names = {t for n, v in attrs if n in ("class", "id", "role") and v for t in v.lower().split()}
    parts = [set(re.split("[-_]+", name)) for name in names]
    parts = {part for of in parts if len(of) > 1 and not of & STATES for part in of}
    parts = set() if tag in INLINE else parts
    if names & REMARKS or (tag == "article" and parts & REMARKS):
        return "remark"
    if tag == "article":
        return ""
    if parts & REMARKS:
        return "remark part"
    if names & NOTES:
        return "note"
    if tag == "form" or parts & NOTES:
        return "part"
    return "layout" if names & LAYOUT or parts & (LAYOUT | {"header"}) else ""


@dataclass
class Line:
    """Text between block tags: its parts, tags, region, block, whether it may be content,
    and the innermost element around it that is set apart by name (-1 if none)."""

    region: int
    block: int
    content: bool
    apart: int
    parts: list[str] = field(default_factory=list)
    tags: int = 1

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Open:
    tag: str
    region: int
    block: int
    content: bool
    apart: int
    seen: bool


@dataclass
class Apart:
    """An element set apart by a name or as a form: how, the one around it, whether it stands
    in an article, and what article and main elements it holds."""

    kind: str
    around: int
    inside: bool
    holds: set[str] = field(default_factory=set)


class _Lines(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.articles: set[int] = set()
        # The region around each region; regions of the whole page, and those with text of their own.
        self.around: dict[int, int] = {}
        self.wide, self.spoken = {0}, set()
        self.blocks = 0
        self.aparts: list[Apart] = []
        self.open = [Open("", 0, 0, True, -1, True)]
        self.line = Line(0, 0, True, -1)

    def _break(self) -> None:
        top = self.open[-1]
        if self.line.parts:
            self.lines.append(self.line)
            if any(part.strip() for part in self.line.parts):
                self.spoken.add(self.line.region)
        self.line = Line(top.region, top.block, top.content, top.apart)

    def _pop(self, tags: frozenset[str], stop: frozenset[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                del self.open[at:]
                return
            if self.open[at].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            self.line.tags += 1
            if tag in ("br", "img", "wbr"):
                self.line.parts += [" "] if tag == "br" else []
                return
        else:
            # A block ends an open paragraph, and some elements end their like.
            self._pop(frozenset(["p"]), REGION | ASIDE | frozenset(["div", "section", "table", "button", "form"]))
            if tag in ENDS:
                self._pop(*ENDS[tag])
            self._break()
            if tag in VOID:
                return
        top = self.open[-1]
        aside, named = self._is_aside(tag, attrs), kind_of(tag, attrs)
        region, block, apart = top.region, top.block, top.apart
        if tag in INLINE:
            # What is set apart inside a block is left out of its text.
            self.open.append(Open(tag, region, block, top.content, apart, top.seen and not aside and not named))
            return
        content = top.content and not aside
        if named:
            self.aparts.append(Apart(named, apart, region in self.articles))
            apart = len(self.aparts) - 1
        if tag in REGION and apart >= 0 and not named:
            self.aparts[apart].holds.add(tag)
        if tag in REGION or (region not in self.articles and tag not in LEAF):
            self.blocks += 1
            block = self.blocks
            # A section is a part of a container that holds text beside it.
            part = tag in INNER or (tag == "section" and region in self.spoken - self.wide)
            if not part:
                self.around[block], region = region, block
            if tag in REGION:
                self.articles.add(region)
            if tag in ("html", "body"):
                self.wide.add(region)
        if tag == "header" and region not in self.articles:
            content = False
        self.open.append(Open(tag, region, block, content, apart, top.seen and tag not in UNSEEN))
        self._break()

    def _is_aside(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in ASIDE:
            return True
        if tag in ("html", "body") or tag in REGION:
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        # An inline end tag reaches no further than its block.
        stop = LEAF | REGION | ASIDE | frozenset(["div", "section", "table", "form"]) if tag in INLINE else frozenset()
        self._pop(frozenset([tag]), stop)
        if tag in INLINE:
            self.line.tags += 1
        else:
            self._break()

    def handle_data(self, data: str) -> None:
        if self.open[-1].seen:
            self.line.parts.append(data)


def lines_of(html: str) -> tuple[list[Line], _Lines]:
    """The lines of a page that have text, and the parser that knows its regions."""
    parser = _Lines()
    # Marked sections are comments in HTML.
    html = html.replace("<![", "<! [")
    for at in range(0, len(html), BLOCK):
        parser.feed(html[at : at + BLOCK])
    parser.close()
    parser._break()
    return [line for line in parser.lines if line.text()], parser


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over neighbouring lines; at the ends, over those there are."""
    offsets = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(offsets**2) / (2 * SIGMA**2))
    total = np.convolve(ratios, kernel)[REACH : REACH + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]


def main_text(html: str | None) -> str:
    """Blocks of the main text, one a line, in page order; empty if there is none.

    Lines whose smoothed ratio reaches the standard deviation of all are marked. A
    region is an article or main element, or on pages without one, a container with
    the lists, tables and quotes in it. It is content if half its text, or half of
    what is outside those, is in marked lines; if no region is, the one with most
    text. A list, table or quote of another region is content by its own text, and
    a container between two marked lines of a region that is content is part of it.
    Forms and elements named as comments, notices, adverts or parts of the layout are left
    out unless they are around the article, see ``_shut`` and ``_free``; a header inside an
    article, with its title and byline, belongs to it.
    """
    every, page = lines_of(html or "")
    articles = page.articles
    lines = _shut(every, page)
    if not lines:
        return ""
    sizes = np.array([len(line.text()) for line in lines], dtype=float)
    ratios = smoothed(sizes / np.array([line.tags for line in lines]))
    marked = ratios >= ratios.std()
    own = _free(lines, sizes * marked, page)
    inside = [i for i in own if lines[i].region in articles] or own
    # Text and marked text of regions, of their lines outside inner blocks, and of blocks.
    whole, outside, blocks = {}, {}, {}
    for i in inside:
        line = lines[i]
        own_lines = [(outside, line.region)] if line.region == line.block else []
        for totals, of in [(whole, line.region), (blocks, line.block), *own_lines]:
            total = totals.setdefault(of, [0.0, 0.0])
            total[0] += sizes[i]
            total[1] += sizes[i] * marked[i]
    alone = {b for b, (text, above) in blocks.items() if above >= MARKED * text}
    kept = {r for totals in (whole, outside) for r, (text, above) in totals.items() if above >= MARKED * text}
    if not kept | alone and whole:
        kept = {max(whole, key=lambda r: (whole[r][0], -r))}
    kept |= _enclosed(lines, inside, marked, kept, page.around)
    return "\n".join(lines[i].text() for i in inside if lines[i].region in kept or lines[i].block in alone)


def _shut(every: list[Line], page: _Lines) -> list[Line]:
    """Lines in no note, in page order; what is in a note bears on no ratio either.

    A note is around the article if it holds a main element; if it is no readers' comment,
    also if it holds an article and half the text while no article is elsewhere. By a part
    of a name, or as a form, it may also hold nearly all text around it. If nothing is
    left, notes count like the layout.
    """
    lines, aparts = [line for line in every if line.content], page.aparts
    held, holds = [0] * len(aparts), [set(apart.holds) for apart in aparts]
    for line in lines:
        if line.apart >= 0:
            held[line.apart] += len(line.text())
    for at in range(len(aparts) - 1, -1, -1):
        if (around := aparts[at].around) >= 0:
            held[around] += held[at]
            holds[around] |= holds[at]
    total = sum(len(line.text()) for line in lines)
    noted = [False] * len(aparts)
    for at, apart in enumerate(aparts):
        noted[at] = apart.kind != "layout" or (apart.around >= 0 and noted[apart.around])
    article_free = any(line.region in page.articles and (line.apart < 0 or not noted[line.apart]) for line in lines)
    wraps, scope = {-1: True}, {-1: total}
    for at, apart in enumerate(aparts):
        whole = apart.kind.endswith("part") and held[at] >= WHOLE * scope[apart.around]
        only = "article" in holds[at] and not article_free and 2 * held[at] >= total
        holds_it = "main" in holds[at] or (only and not apart.kind.startswith("remark"))
        wraps[at] = wraps[apart.around] and (apart.kind == "layout" or whole or holds_it)
        scope[at] = held[at] if wraps[at] else scope[apart.around]
    return [line for line in lines if wraps[line.apart]] or lines


def _free(lines: list[Line], weights: np.ndarray, page: _Lines) -> list[int]:
    """Places of lines that may be content: in no part of the layout, but for wrappers.

    A wrapper holds a main element or most of the marked text. Where all articles are set
    apart, so does an element that holds one and more marked text than is free.
    """
    aparts = page.aparts
    held, holds = [0.0] * len(aparts), [set(apart.holds) for apart in aparts]
    for i, line in enumerate(lines):
        if line.apart >= 0:
            held[line.apart] += weights[i]
    for at in range(len(aparts) - 1, -1, -1):
        if (around := aparts[at].around) >= 0:
            held[around] += held[at]
            holds[around] |= holds[at]
    total = weights.sum()
    wraps = [
        apart.kind != "layout" or "main" in holds[at] or (total > 0 and held[at] >= WRAPS[apart.inside] * total)
        for at, apart in enumerate(aparts)
    ]

    def free() -> list[int]:
        opened = {-1: True}
        for at, apart in enumerate(aparts):
            opened[at] = wraps[at] and opened[apart.around]
        return [i for i, line in enumerate(lines) if opened[line.apart]]

    found = free()
    if any(lines[i].region in page.articles for i in found):
        return found
    rest = weights[found].sum()
    for at in range(len(aparts)):
        if "article" in holds[at] and held[at] >= rest:
            wraps[at] = True
    return free()


def _enclosed(
    lines: list[Line], inside: list[int], marked: np.ndarray, kept: set[int], around: dict[int, int]
) -> set[int]:
    """Regions whose neighbouring lines in a kept region around them are both marked."""
    places: dict[int, list[int]] = {}
    for i in inside:
        places.setdefault(lines[i].region, []).append(i)
    found = set()
    for region in places.keys() - kept:
        first, last = places[region][0], places[region][-1]
        outer = region
        while region not in found and (outer := around.get(outer)) is not None:
            if outer in kept:
                rows = places.get(outer, [])
                before, after = bisect_left(rows, first), bisect_right(rows, last)
                if before and after < len(rows) and marked[rows[before - 1]] and marked[rows[after]]:
                    found.add(region)
    return found


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Whole pages are read. A null or empty page, and one without text outside menus
    and the like, has an empty text. Input columns of the two names are replaced
    unless they are the page itself. Repeated pages get equal texts.
    """
    small_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    kept = without(pages, *{"text", "n_chars"} - {html.lower()})
    return kept.withColumn("text", texts(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))
