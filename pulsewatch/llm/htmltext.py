"""Main text of web pages by line-block distribution.

Markup is stripped into lines (one per block element). A line's weight is
the length of its text, or zero where the line belongs to a part that is
never main text (navigation, forms, scripts, adverts, comments and the like,
told by element or by class) or is mostly links. A paragraph that reads as a sentence
weighs :data:`SURGE` at least. The sum of weights over a
sliding window of lines is the distribution: it surges where main text
starts and dives to zero where it ends. A stretch between a surge and the next
dive is kept from its first to its last line of weight if the distribution reaches :data:`SURGE` characters in it
(or the page's highest sum, if that is less); links between kept lines stay with them.

Where the page marks an ``article`` or ``main`` element that holds text, the element weights its lines:
those inside count :data:`INSIDE` times and links among them as text, those outside
:data:`OUTSIDE` times. The distribution decides as before, so a body that the element leaves out is found by
its length, and every marked article is kept.

Cases: null, empty or text-free pages give an empty text. Cut-off pages and
unclosed elements are read to their end; an unfinished tag at the end is
markup. Character references are decoded once, also those without a
semicolon that HTML allows. Nothing is shortened or dropped but whole lines.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

WINDOW = 3
SURGE = 80
LINK_SHARE = 0.5
# Inside a marked element any character is a surge; outside, only a window of 16 * SURGE characters is one.
INSIDE = 100
OUTSIDE = 1 / 16

# Element and class names by role.
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
NOISE = frozenset("nav header footer aside form button dialog menu fieldset".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent notice notices alert newsletter "
    "subscribe subscription comment comments disqus respond replies share sharing social related recommended popup "
    "modal overlay pager pagination widget login signup toolbar skip tags".split())

# Words that name a place or a container: next to a noise word they do not change what it says.
PLACE_WORDS = frozenset(
    "site page main top bottom left right inner outer primary secondary global local mobile desktop sticky fixed inline box "
    "section sections list lists wrapper wrap block container holder area region zone module panel unit slot bar rail strip "
    "item items group row column col content body form link links button buttons text title heading label meta info message "
    "messages icon logo image img count author avatar thread threads article articles post posts story stories entry entries "
    "blog user users reader readers native id".split())
PARAGRAPHS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 figcaption".split())
# Signs that end a sentence, and those that may close around it.
STOPS = ".!?\u2026:;\u3002\uff01\uff1f"
CLOSERS = "\"'\u201d\u2019\u00bb)]"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\s++|/|[^\s=>/]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)(?:>|\Z)",
    re.S)
_NAMED = re.compile(r"""(?:^|[\s/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s/])(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[a-z]+")


def _names_noise(value: str) -> bool:
    """Whether one of the names says noise: as a whole, not as a part of something else.

    ``sidebar``, ``site-footer`` and ``post-comments`` do; ``no-sidebar``, ``article-with-ads`` and
    ``related-work`` do not, as they hold a word that is neither noise nor a place.
    """
    for name in value.strip("\"'").lower().split():
        parts = set(_WORD.findall(name))
        if not NOISE_WORDS.isdisjoint(parts) and parts <= NOISE_WORDS | PLACE_WORDS:
            return True
    return False


def _is_sentence(text: str) -> bool:
    """Several words with a stop at their end."""
    return " " in text and text.rstrip(CLOSERS)[-1:] in STOPS and not text.isspace()


class Line(NamedTuple):
    """One line: text, link characters, noise, main element number or -1, and whether it is a paragraph."""

    text: str
    links: int = 0
    noisy: bool = False
    main: int = -1
    paragraph: bool = False


def _is_noise(name: str, attributes: str) -> bool:
    if name in NOISE:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(_names_noise(m[2]) for m in _NAMED.finditer(attributes))


class _Page:
    """Lines of a page: text, link characters, noise, and the main element that holds them."""

    def __init__(self):
        self.lines: list[Line] = []
        self.block = ""
        self.parts: list[str] = []
        self.links = 0
        self.in_link = 0
        self.noise: list[list] = []  # [element, open elements of that name, header in an article]
        self.mains: list[tuple[str, int]] = []
        self.main_count = 0
        self.heading = 0

    def text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.in_link:
                self.links += len(text)

    def close_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            noisy = any(not (n[2] and self.heading) for n in self.noise)
            self.lines.append(Line(text, self.links, noisy, self.mains[0][1] if self.mains else -1, self.block in PARAGRAPHS))
        self.parts, self.links = [], 0

    def tag(self, closing: bool, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name == "a":
            self.in_link = 0 if closing else 1
        block = name in BLOCKS
        if block:
            self.close_line()
            self.block = "" if closing else name
            self.in_link = 0 if name in ("body", "article") else self.in_link
        if name in HEADINGS:
            self.heading = 0 if closing else 1
        if closing:
            self._close(name)
        elif name not in VOID and not attributes.endswith("/"):
            self._open(name, attributes)

    def _open(self, name: str, attributes: str) -> None:
        if name in MAIN and not _is_noise(name, attributes):
            self.noise.clear()  # an article inside an unclosed menu or a page-wide form is no part of it
            if not self.mains or name == "article" and self.mains[-1][0] == "main":
                self.main_count += 1
                self.mains = [(name, self.main_count)] + self.mains
            else:
                self.mains.append((name, self.mains[-1][1]))
            return
        for entry in self.noise:
            entry[1] += entry[0] == name
        if _is_noise(name, attributes) and not any(e[0] == name for e in self.noise):
            if name not in BLOCKS:
                self.close_line()
            self.noise.append([name, 1, name == "header" and bool(self.mains)])

    def _close(self, name: str) -> None:
        if name in MAIN and any(m[0] == name for m in self.mains) and not any(e[0] == name for e in self.noise):
            self.noise.clear()
            at = next(i for i, m in enumerate(self.mains) if m[0] == name) if self.mains[0][0] == name \
                else max(i for i, m in enumerate(self.mains) if m[0] == name)
            del self.mains[at]
            return
        for i, entry in enumerate(self.noise):
            if entry[0] == name:
                entry[1] -= 1
                if not entry[1]:
                    self.close_line()
                    del self.noise[i:]
                return


def lines_of(page: str) -> list[Line]:
    """Each line with text."""
    out, at, n = _Page(), 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            out.text(page[at:])
            break
        out.text(page[at:start])
        found = _TAG.match(page, start)
        if not found:  # a bare "<" is text
            out.text("<")
            at = start + 1
            continue
        at = found.end()
        if found[2]:
            name = found[2].lower()
            out.tag(bool(found[1]), name, found[3] or "")
            if name in RAW and not found[1] and not (found[3] or "").endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
                at = end.start() if end else n
    out.close_line()
    return out.lines


def weights_of(lines: list[Line]) -> list[float]:
    """What each line adds to the distribution."""
    marked = any(x.main >= 0 and not x.noisy for x in lines)

    def weight(x: Line) -> float:
        if x.noisy:
            return 0
        inside = marked and x.main >= 0
        if not inside and x.links > LINK_SHARE * len(x.text):
            return 0
        size = max(len(x.text), SURGE) if x.paragraph and len(x.text) < SURGE and _is_sentence(x.text) else len(x.text)
        return INSIDE * size if inside else OUTSIDE * len(x.text) if marked else size

    return [weight(x) for x in lines]


def regions(lines: list[Line]) -> list[tuple[int, int]]:
    """Runs of lines on one side of the marked elements' borders; a border is a dive."""
    cuts = [i for i in range(1, len(lines)) if (lines[i].main >= 0) != (lines[i - 1].main >= 0)]
    return list(zip([0, *cuts], [*cuts, len(lines)], strict=True))


def kept_lines(lines: list[Line]) -> list[str]:
    """Texts between the surges and dives of the line-block distribution."""
    weights = weights_of(lines)
    spans = regions(lines)
    sums = [sum(weights[i:min(i + WINDOW, stop)]) for first, stop in spans for i in range(first, stop)]
    if not any(sums):
        return []
    least = min(SURGE, max(sums))
    kept = []
    for first, stop in spans:
        i = first
        while i < stop:
            if not weights[i]:
                i += 1
                continue
            end = i  # the dive: the first window from here that is all zero
            while end < stop and sums[end]:
                end += 1
            if max(sums[i:end]) >= least:
                last = max(j for j in range(i, end) if weights[j])
                kept += [x.text for x in lines[i:last + 1] if not x.noisy]
            i = end
    return kept


def main_text(page: str) -> str:
    return "\n".join(kept_lines(lines_of(page)))


def with_main_text(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page; no shuffle."""
    @F.arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in column], pa.string())

    return pages.withColumn(out, extracted(text_or_empty(source)))
