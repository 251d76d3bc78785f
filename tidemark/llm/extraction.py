"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block of the page. What the markup itself names as a
menu, advert, form and the like is blanked; blocks named so in part are decided by how much of
their text lies outside of links. Text lengths, links outside of paragraphs not counted, are summed
over a window sliding along the lines; the window with the most text lies in the main text, which
goes from the surge, where the sums first rise above nothing on the way to ``SURGE``, to the dive,
where they have last been above it and fall to nothing, whatever elements the lines are nested in.
Article and main elements are bounds: if the peak lies in one, lines outside of them are nothing,
and no line of the outermost element around the peak is lost.

A page is read once; the work is in proportion to its length, whatever is not closed in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements, attributes and usual class words.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr br noscript".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())
FOREIGN = frozenset(("svg", "math"))
ASIDE = frozenset("nav footer aside form menu dialog button fieldset head select svg template object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note".split())
CLASS_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus dropdown flyout foot footer form gdpr head header login masthead menu menus modal nav navbar navigation navi newsletter "
    "notice notices notification overlay pager pagination paywall popup promo promoted promotion promotions recommended related replies respond "
    "search share sharing sidebar sidebars sidenav signup social sponsor sponsored sponsors subscribe subscription toolbar topbar warning widget "
    "widgets".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTENT = frozenset({"article", "main"})
#: Elements that end an svg or math element which is not closed.
BREAKOUT = frozenset("article main section div p ul ol li dl table pre blockquote h1 h2 h3 h4 h5 h6 hr nav footer header body".split())
#: Elements that a rule on class words never blanks.
PAGE = frozenset({"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"})

OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
COMMENT_END = re.compile(r"--!?>")
TAG_STOP = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WINDOW = 3
#: Characters that make a window's sum a surge.
SURGE = 50


class Element:
    __slots__ = ("name", "parent", "inline", "aside", "link", "length", "linked", "blank", "block", "content", "foreign", "outer", "doubt")

    def __init__(self, name: str, parent: Element | None, inline: bool = False, aside: bool = False, link: bool = False, doubtful: bool = False):
        self.name, self.parent, self.inline, self.aside, self.link = name, parent, inline, aside, link
        #: Characters outside of links and in links, of a doubtful block and all blocks in it.
        self.length = self.linked = 0
        self.blank = False
        #: The nearest block, this element or one around it.
        self.block: Element = parent.block if parent and inline else self
        #: The outermost article or main element around this one.
        self.content: Element | None = parent.content if parent else None
        if not self.content and name in CONTENT:
            self.content = self
        #: The nearest svg or math element.
        self.foreign: Element | None = self if name in FOREIGN else parent.foreign if parent else None
        #: The nearest doubtful block, this element or one around it, and the next one around that.
        self.outer: Element | None = parent.doubt if parent else None
        self.doubt: Element | None = self if doubtful and not inline else self.outer


class Line:
    __slots__ = ("holder", "parts", "length", "linked", "text")

    def __init__(self, holder: Element):
        self.holder, self.parts, self.length, self.linked, self.text = holder, [], 0, 0, ""


def _named_aside(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is named as no part of the text, and whether that is in doubt.

    Inside an article or main only a role or a whole class is sure, elsewhere a class or id made of
    the listed words alone; one that holds a listed word besides others is doubtful.
    """
    if name in ASIDE or name == "header" and not inside:
        return True, False
    if name in PAGE or not attributes:
        return False, False
    doubtful = False
    for key, value in ATTRIBUTE.findall(attributes):
        for token in value.strip("\"'").split():
            if key.lower() == "role":
                if token.lower() in ROLES:
                    return True, False
                continue
            words = set(WORDS.findall(CAMEL.sub(" ", token).lower()))
            if inside:
                words -= {"head", "header"}
            if not words & CLASS_WORDS:
                continue
            if key.lower() == "class" and token.lower() in CLASS_WORDS if inside else words <= CLASS_WORDS:
                return True, False
            doubtful = True
    return False, doubtful


class Tags:
    """The markup of a page in order; every search goes on where the last one ended."""

    def __init__(self, html: str):
        self.html = html
        self.ended = False  # no tag is closed from here on
        self.missing: set[str] = set()  # quotes of which there is no further one

    def _end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``: behind a ``>`` outside of quotes."""
        while stop := TAG_STOP.search(self.html, at):
            at, quote = stop.end(), stop[0]
            if quote == ">":
                return at
            if quote not in self.missing:
                closed = self.html.find(quote, at)
                if closed < 0:
                    self.missing.add(quote)
                else:
                    at = closed + 1
        self.ended = True
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start and end of the next markup at or behind ``at``, whether it ends an element, name, attributes."""
        while not self.ended and (found := OPENING.search(self.html, at)):
            if found[1]:
                close = COMMENT_END.search(self.html, found.end())
                return found.start(), close.end() if close else len(self.html), False, "", ""
            if found[2]:
                end = self.html.find(">", found.end()) + 1
                self.ended = not end
            else:
                end = self._end(found.end())
            if end > 0:
                return found.start(), end, bool(found[3]), (found[4] or "").lower(), self.html[found.end() : end - 1]
            at = found.end()
        return None


def lines_of(html: str) -> tuple[list[Line], list[Element]]:
    """The page's blocks in order, and its doubtful elements; a block ends where a block element
    starts or ends."""
    here = Element("", None)
    root = here
    line, lines, at, doubtful = Line(here), [], 0, []
    opened: dict[str, int] = {}

    def add(text: str) -> None:
        if text and not here.aside:
            text = unescape(text)
            line.parts.append(text)
            size = sum(map(len, text.split()))
            if here.link:
                line.linked += size
            else:
                line.length += size

    def cut() -> None:
        nonlocal line
        if line.parts:
            line.text = " ".join("".join(line.parts).split())
            if line.text:
                lines.append(line)
            line = Line(here.block)
        elif line.holder is not here.block:
            line.holder = here.block

    def leave(last: Element) -> None:
        nonlocal here
        while True:
            opened[here.name] -= 1
            done, here = here is last, here.parent or root
            if done:
                return

    tags = Tags(html)
    while found := tags.next(at):
        start, end, closes, name, attributes = found
        add(html[at:start])
        at = end
        if not name:
            continue
        inline = name in INLINE or name in FOREIGN or here.foreign is not None and name not in BREAKOUT
        if not inline and name not in RAW:
            cut()
        if closes:
            if opened.get(name):
                last = here
                while last.name != name:
                    last = last.parent
                leave(last)
                if not inline:
                    cut()
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else len(html)
            continue
        if not inline:
            if here.foreign:
                leave(here.foreign)
            if here.block.name == "p" or here.block.name in CLOSES.get(name, ()):
                leave(here.block)
                cut()
        if name in VOID:
            add(" ")
            if not inline:
                cut()
            continue
        if here.foreign and attributes.endswith("/"):
            continue
        aside, doubt = (True, False) if here.aside else _named_aside(name, attributes, here.content is not None)
        here = Element(name, here, inline, aside, here.link or name == "a", doubt)
        opened[name] = opened.get(name, 0) + 1
        if here.doubt is here:
            doubtful.append(here)
        if not inline:
            cut()
    add(html[at:])
    cut()
    return lines, doubtful


def without_doubtful(lines: list[Line], doubtful: list[Element]) -> list[Line]:
    """Blanks doubtful blocks with more text in links than outside; what lies in one goes with it."""
    for line in lines:
        if own := line.holder.doubt:
            own.length += line.length
            own.linked += line.linked
    for own in reversed(doubtful):
        if own.outer:
            own.outer.length += own.length
            own.outer.linked += own.linked
    for own in doubtful:
        own.blank = own.linked > own.length or own.outer is not None and own.outer.blank
    return [x for x in lines if not (x.holder.doubt and x.holder.doubt.blank)]


def window_sums(lengths: list[int]) -> list[int]:
    return [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]


def peak_of(lengths: list[int]) -> tuple[int, int]:
    """The window with the most text, the first of equal ones, and its longest line."""
    sums = window_sums(lengths)
    peak = max(range(len(sums)), key=lambda i: (sums[i], -i))
    return peak, max(range(peak, min(peak + WINDOW, len(lengths))), key=lambda i: lengths[i])


def surge_and_dive(lengths: list[int], sums: list[int], peak: int) -> tuple[int, int]:
    """The first line of the main text and the one behind its last.

    A window without text separates stretches; the main text goes from the first to the last
    stretch that holds the peak or surges. Fewer lines without text than a window separate nothing.
    """
    texty = [i for i, x in enumerate(lengths) if x]
    stretches = [[texty[0], texty[0]]]
    for i in texty[1:]:
        if i - stretches[-1][1] > WINDOW:
            stretches.append([i, i])
        stretches[-1][1] = i
    kept = [(a, b) for a, b in stretches if a <= peak + WINDOW - 1 and b >= peak or max(sums[a : b + 1]) >= SURGE]
    first, behind = kept[0][0], kept[-1][1] + 1
    before = next((first - 1 - i for i in range(first - 1, -1, -1) if lengths[i]), first)
    after = next((i - behind for i in range(behind, len(lengths)) if lengths[i]), len(lengths) - behind)
    return first - (before if before < WINDOW else 0), behind + (after if after < WINDOW else 0)


def main_text(html: str) -> str:
    lines, doubtful = lines_of(html)
    lines = without_doubtful(lines, doubtful)
    lengths = [x.length + (x.linked if x.holder.name == "p" else 0) for x in lines]
    if not any(lengths):  # an article may be made of links, a page outside of articles is a menu then
        lengths = [x.linked if x.holder.content else 0 for x in lines]
    if not any(lengths):
        return ""
    peak, core = peak_of(lengths)
    held = lines[core].holder.content
    if held:
        lengths = [n if x.holder.content else 0 for n, x in zip(lengths, lines, strict=True)]
        peak, core = peak_of(lengths)
    first, behind = surge_and_dive(lengths, window_sums(lengths), peak)
    kept = (x for i, x in enumerate(lines) if (held is not None and x.holder.content is held) or first <= i < behind and (not held or x.holder.content))
    return "\n".join(x.text for x in kept)


def extract_main_text(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """``keys``, ``text`` and ``n_chars`` (its code points) for every row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by a line feed. A null or empty page, and one without text outside of menus and the
    like, has empty text. Markup that is cut off or not closed ends where its parent ends. Other
    columns are not read; equal rows give equal rows.
    """
    schema = pages.select(*keys).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py() or "") for x in batch.column(len(keys))], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keys))], texts], names=schema.fieldNames())

    return pages.select(*keys, F.col(html).alias("_html")).mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
