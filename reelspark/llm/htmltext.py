"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of text; elements that never hold
the article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments of readers) become gaps. Line lengths are summed
over sliding windows of ``WINDOW`` lines, in which link lists and gaps of the
page's frame (menus, headers, footers, comments; not those of a section) count
0. Other gaps, such as adverts and notices, leave no trace: the text goes on
after them. A surge point starts a stretch where the sum rises above the threshold, a
dive point ends it where a whole window is 0, and the lines between them that
are no link lists are kept, whatever other stretches hold. This runs on every page. ``article`` and ``main``
elements take part in it in two ways: each line of an ``article``, and of a
``main`` without one, weighs enough to be a surge point, however short or
linked it is; and stretches end where an outermost such element starts or
ends, so that its weight lifts no line outside. Every such element counts, but
those mostly of links beside others that are not. Text outside is kept or left
by its own windows, as on pages without such elements.

A word in a class or id, such as ``sidebar``, is evidence only. It says nothing
behind ``no``, ``with`` or ``has``, nothing as part of another name of a
paragraph, heading, quote or figure (``share-price``), and nothing of an
element that holds most of the page's text outside links and left-out
elements, unless the word names readers' comments. ``discussion`` inside an
article is a section of it; the comments in it are left out themselves.

Tags, quoted values and elements are each visited a bounded number of times,
so the time is linear in the page's length, whatever its markup. A ``<`` that
no ``>`` closes before the next ``<`` is text, unless quoted values follow it.

Defined results: a null or empty page, and one without text, give the empty
text. Unclosed elements reach to the end of what holds them. Rows are mapped
one by one, so repeated rows give equal results; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80               # characters in a window
LINK_SHARE = 0.5         # a line with more of its text in links counts 0
MOST = 2 / 3             # of the page's text: an element with more is none to leave out by a class word

_ATTRS = r"""(?:=\s*+(?:"[^"]*"|'[^']*')|[^<>])*+"""
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|canvas|object|textarea|select|title|audio|video)\b"
    + _ATTRS + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<attrs>" + _ATTRS + r")(?P<shut>>?)", re.S | re.I)
_QUOTED = re.compile(r"""=\s*["']""")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PART = re.compile(r"[a-z0-9]+")
_OPPOSITE = re.compile(r"(?:^|[-_])(?:no|not|with|without|has|have)(?:[-_]|$)")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_NEVER = frozenset("nav header footer aside form button menu dialog fieldset head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_HOLDERS = frozenset("html body article main".split())
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar "
    "toolbar comment comments commentlist disqus discussion respond reply replies related recommended recommendations widget "
    "widgets search searchbox form".split())
_FRAME_TAGS = frozenset("nav header footer menu".split())
_FRAME_ROLES = frozenset("navigation banner contentinfo menu menubar".split())
_FRAME_WORDS = frozenset(
    "menu nav navbar navigation footer masthead topbar comment comments commentlist disqus discussion respond reply replies".split())
_FRAME_PHRASES = ("site-header", "page-header", "site-footer", "page-footer")
_PHRASES = ("side-bar", "site-header", "page-header", "site-footer", "page-footer", "skip-link", "read-more", "see-also")


_READERS = frozenset("comment comments commentlist disqus respond reply replies".split())
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())
_GENERIC = frozenset("unit slot label box block wrapper wrap container text link links item items bar area body title inner "
                     "image img icon".split())
NO, BY_WORD, CERTAIN = 0, 1, 2


def _named(tag: str, value: str, in_article: bool) -> int:
    """What the words of a class or id say about an element."""
    found = NO
    for name in value.split():
        name = _OPPOSITE.split(name, maxsplit=1)[0]
        parts = set(_PART.findall(name))
        words = parts & _WORDS
        if in_article:
            words.discard("discussion")
        if tag in _TEXTUAL and any(x not in _WORDS and x not in _GENERIC and not x.isdigit() for x in parts):
            continue
        if words & _READERS:
            return CERTAIN
        if words or any(p in name for p in _PHRASES):
            found = BY_WORD
    return found


def _chrome(tag: str, attrs: str, in_article: bool) -> int:
    """Whether an element's tag, role, class or id names it as no article text."""
    if tag in _NEVER:
        return CERTAIN
    if not attrs:
        return NO
    if tag in _HOLDERS and "hidden" not in attrs.lower():
        return CERTAIN if _names_comment(attrs) else NO
    found = NO
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            found = max(found, _named(tag, value, in_article))
        elif name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return CERTAIN
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return CERTAIN
    return found


def _is_frame(tag: str, attrs: str) -> bool:
    """Whether an element that holds no article text belongs to the page's frame."""
    if tag in _FRAME_TAGS:
        return True
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if not _FRAME_WORDS.isdisjoint(_PART.findall(value)) or any(p in value for p in _FRAME_PHRASES):
                return True
        elif name == "role" and value in _FRAME_ROLES:
            return True
    return False


def _names_comment(attrs: str) -> bool:
    """Comments of readers may be articles of their own, inside the article."""
    return any(name.lower() in ("class", "id") and not {"comment", "comments", "reply"}.isdisjoint(_PART.findall(value.lower()))
               for name, value in _ATTR.findall(attrs))


class _Line:
    __slots__ = ("text", "linked", "holder", "gap")

    def __init__(self, text: str, linked: int, holder: int, gap: bool):
        self.text, self.linked, self.holder, self.gap = text, linked, holder, gap


def _events(html: str):
    """('text', str), ('open', tag, attrs) and ('close', tag) in page order."""
    at = 0
    for m in _MARKUP.finditer(html):
        if m.start() > at:
            yield "text", html[at:m.start()], ""
        at = m.end()
        tag = m["tag"]
        if tag and not m["shut"] and not _QUOTED.search(m["attrs"]):
            yield "text", m[0], ""
        elif tag:
            tag = tag.lower()
            if m["end"]:
                yield "close", tag, ""
            else:
                yield "open", tag, m["attrs"]
                if tag not in _VOID and m["attrs"].rstrip().endswith("/") and tag not in _INLINE:
                    yield "close", tag, ""
        elif m["raw"]:
            yield "raw", "", ""
    if at < len(html):
        yield "text", html[at:], ""


class _Open:
    """The open elements, with the number of each tag, so that a stray end costs nothing."""

    def __init__(self):
        self.stack: list[tuple] = []
        self.count: dict[str, int] = {}

    def push(self, tag: str, *more) -> None:
        self.stack.append((tag, *more))
        self.count[tag] = self.count.get(tag, 0) + 1

    def pop(self, tag: str) -> list[tuple]:
        """The elements that an end tag closes, innermost first; none if it is stray."""
        closed = []
        while self.count.get(tag):
            closed.append(self.stack.pop())
            name = closed[-1][0]
            self.count[name] -= 1
            if name == tag:
                break
        return closed


def _left_out(events: list) -> set[int]:
    """Places of the open tags whose elements hold no article text."""
    elements = _Open()
    holding: set[int] = set()          # elements around an article or main element
    certain: set[int] = set()
    by_word: dict[int, int] = {}       # place: text before it, then text in it
    total, hidden, links, articles = 0, 0, 0, 0

    def ended(element: tuple) -> None:
        nonlocal hidden, links, articles
        name, place, chrome, article = element
        hidden -= chrome == CERTAIN and place not in holding
        links -= name == "a"
        articles -= article
        if chrome == BY_WORD:
            by_word[place] = total - by_word[place]

    for k, (kind, tag, attrs) in enumerate(events):
        if kind == "text":
            if not hidden and not links:
                total += len(tag.strip())
        elif kind == "open" and tag not in _VOID:
            article = tag in ("article", "main") and not _names_comment(attrs)
            if article:
                for _, place, chrome, _ in reversed(elements.stack):
                    if place in holding:
                        break
                    holding.add(place)
                    hidden -= chrome == CERTAIN
            chrome = _chrome(tag, attrs, articles > 0)
            if chrome == CERTAIN:
                certain.add(k)
                hidden += 1
            elif chrome == BY_WORD:
                by_word[k] = total
            elements.push(tag, k, chrome, article)
            links += tag == "a"
            articles += article
        elif kind == "close":
            for element in elements.pop(tag):
                ended(element)
    while elements.stack:
        ended(elements.stack.pop())
    return (certain | {k for k, n in by_word.items() if n <= max(MOST * total, SURGE)}) - holding


def lines_of(html: str) -> tuple[list[_Line], dict[int, tuple[str, int]]]:
    """Lines in page order; tag and outermost holder of each article or main element."""
    events = list(_events(html))
    left_out = _left_out(events)
    lines: list[_Line] = []
    holders: dict[int, tuple[str, int]] = {}
    elements = _Open()                          # with gap and holder before it
    gap, holder, links, linked, sections = 0, 0, 0, 0, 0
    parts: list[str] = []

    def flush():
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append(_Line(text, linked, holder, False))
        linked = 0

    for k, (kind, tag, attrs) in enumerate(events):
        if kind == "text":
            if not gap:
                parts.append(tag)
                if links:
                    linked += len(tag.strip())
        elif kind == "open":
            if tag in _VOID:
                if tag == "br":
                    parts.append(" ")
                elif tag not in _INLINE:
                    flush()
                continue
            chrome = k in left_out
            if chrome or tag not in _INLINE:
                flush()
            elements.push(tag, chrome, holder)
            if chrome:
                if not gap and not sections and _is_frame(tag, attrs):
                    lines.append(_Line("", 0, holder, True))
                gap += 1
            links += tag == "a"
            sections += tag in ("article", "section")
            if tag in ("article", "main") and not gap:
                outermost = holders[holder][1] if holder else k + 1
                holder = k + 1
                holders[holder] = tag, outermost
        elif kind == "close":
            closed = elements.pop(tag)
            if any(x[0] not in _INLINE or x[1] for x in closed):
                flush()
            for name, chrome, before in closed:
                gap -= chrome
                links -= name == "a"
                sections -= name in ("article", "section")
                holder = before
    flush()
    return lines, holders


def _ranges(weights: list[int], threshold: int) -> list[tuple[int, int]]:
    """(surge, dive) pairs of line places."""
    n = len(weights)
    sums = [sum(weights[i:i + WINDOW]) for i in range(n)] + [0]
    out, at = [], 0
    while at < n:
        if sums[at] > threshold and weights[at]:
            end = at
            while end < n and sums[end]:
                end += 1
            while end > at and not weights[end - 1]:
                end -= 1
            out.append((at, end))
            at = end
        at += 1
    return out


def _raised(lines: list[_Line], holders: dict[int, tuple[str, int]]) -> set[int]:
    """The holders whose lines are surge points."""
    length: dict[int, int] = {}
    linked: dict[int, int] = {}
    for line in lines:
        if line.holder and line.text:
            length[line.holder] = length.get(line.holder, 0) + len(line.text)
            linked[line.holder] = linked.get(line.holder, 0) + line.linked
    around = {holders[h][1] for h in length if holders[h][0] == "article"}
    found = {h for h in length if holders[h][0] == "article" or h not in around}
    # Teasers are poorer than the article that they stand beside.
    return {h for h in found if linked[h] <= LINK_SHARE * length[h]} or found


def main_text(html: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    lines, holders = lines_of(html or "")
    raised = _raised(lines, holders)
    weights: list[int] = []
    places: list[int] = []
    region = 0
    for k, line in enumerate(lines):
        outermost = holders[line.holder][1] if line.holder else 0
        if line.gap or outermost != region:
            weights += [0] * WINDOW
            places += [k] * WINDOW
            region = outermost
        if line.holder in raised:
            weights.append(max(len(line.text), SURGE + 1) if line.text else 0)
        else:
            weights.append(0 if line.linked > LINK_SHARE * len(line.text) else len(line.text))
        places.append(k)
    ranges = _ranges(weights, SURGE) or _ranges(weights, 0)
    keep = {places[i] for a, z in ranges for i in range(a, z) if weights[i]}
    return "\n\n".join(x.text for k, x in enumerate(lines) if k in keep)


def main_text_udf():
    """Arrow UDF html -> main text."""
    @F.arrow_udf("string")
    def extract_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([main_text(h) for h in b.to_pylist()], pa.string())

    return extract_text


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) in place of like-named columns."""
    out = pages.withColumn("text", main_text_udf()(F.col(html)))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
