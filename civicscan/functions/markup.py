"""One pass over a page's markup, for every signal of the page.

``tokens`` cuts a page into text, tags and comments by HTML's own rules: a
quote counts only where a value begins, a bare value ends at white space or
'>', an attribute that is repeated counts at its first place, script and style
bodies are no markup, and an unclosed comment, or a tag that never ends, takes
the rest of the page.  A quote that is never closed is an ordinary character.
Every pattern is possessive, so time and stack are linear in the page whatever
it holds.

``Page`` keeps the open elements and collects what the callers ask for in one
walk: JSON-LD scripts, <meta> and <time> elements, the text pieces outside
hidden subtrees, containers with their links, and link-keeping text.  A start
tag of a block closes an open paragraph; an end tag closes the elements in it;
one of an inline element doesn't close blocks, and one without an open element
is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

_S = r"[\t\n\f\r ]"
_NAME = r"(?:=[^\t\n\f\r />=]*+|[^\t\n\f\r />=]++)"
_MARK = re.compile(r"<(?:(/?)([A-Za-z][^\t\n\f\r />]*+)|(!--)|[!?/])")
_REST = re.compile(rf"""(?:(?:{_S}|/)++|{_NAME}{_S}*+(?:={_S}*+(?:"[^"]*+"|'[^']*+'|[^\t\n\f\r >]*+))?+)*+>""")
_ATTR = re.compile(rf"""(?:{_S}|/)*+({_NAME}){_S}*+(?:={_S}*+(?:"([^"]*+)"|'([^']*+)'|([^\t\n\f\r >]*+)))?+""")
_RAW_END = {name: re.compile(rf"(?i)</{name}(?=[\t\n\f\r />])") for name in ("script", "style")}
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*+[;=]?)")

VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
#: Elements that an inline element's end tag doesn't close, and whose start closes an open paragraph.
BLOCKS = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 head header hgroup html li main menu nav noscript ol pre section summary table tbody td template tfoot th thead tr ul""".split())
HEAD_PARTS = frozenset("title meta link script style base noscript template".split())

TEXT, START, END = "text", "start", "end"


def attributes(page: str, at: int, end: int) -> dict[str, str]:
    """The attributes that stand between a tag's name and its '>': names in
    lower case, the first of equal ones, references decoded."""
    out: dict[str, str] = {}
    while at < end and (m := _ATTR.match(page, at, end)):
        value = next((v for v in m.group(2, 3, 4) if v is not None), "")
        out.setdefault(m.group(1).lower(), attribute_text(value) if "&" in value else value)
        at = m.end()
    return out


def attribute_text(value: str) -> str:
    """References of an attribute value decoded: a named one without its
    semicolon only if it isn't the beginning of a longer word or of a query's
    next parameter."""
    def one(m: re.Match) -> str:
        ref = m.group()
        return unescape(ref) if ref[1] == "#" or ref[1:] in html5 else ref
    return _REFERENCE.sub(one, value)


def _closes_itself(page: str, at: int, end: int) -> bool:
    """Whether the '/' before a tag's '>' belongs to no bare value."""
    while at < end and (m := _ATTR.match(page, at, end)):
        at = m.end()
    return at < end


def tokens(page: str) -> Iterator[tuple[str, str, int, int]]:
    """``(kind, what, from, to)`` in order.  A text's ``what`` is the text as
    written; a tag's is its name in lower case, and from and to bound its
    attributes.  A script's or style's body comes as a text after its start
    tag, followed by its end tag."""
    at, n = 0, len(page)
    while at < n:
        m = _MARK.search(page, at)
        if m is None:
            yield TEXT, page[at:], at, n
            return
        if m.start() > at:
            yield TEXT, page[at:m.start()], at, m.start()
        name = m.group(2)
        if name is None:
            # '<!-->' is a whole comment
            end = page.find("-->", m.start() + 2) + 3 if m.group(3) else page.find(">", m.end()) + 1
            if end < m.end():
                return
            at = end
            yield "comment", "", m.start(), at
            continue
        rest = _REST.match(page, m.end())
        if rest is None:
            return
        at = rest.end()
        name = name.lower()
        if m.group(1):
            yield END, name, at, at
            continue
        yield START, name, m.end(), at - 1
        if name in _RAW_END:
            close = _RAW_END[name].search(page, at)
            body = page[at:close.start() if close else n]
            if body:
                yield TEXT, body, at, at + len(body)
            yield END, name, at, at
            if close is None:
                return
            rest = _REST.match(page, close.end())
            if rest is None:
                return
            at = rest.end()
        elif page[at - 2] == "/" and _closes_itself(page, m.end(), at - 1):
            yield END, name, at, at


def _hidden(*names: str) -> frozenset[str]:
    return frozenset(names)


#: What a text piece is hidden from, by the elements around it.
PAGE_HIDDEN = _hidden("script", "style", "template")
ARTICLE_HIDDEN = _hidden("script", "style", "template", "noscript", "form", "footer", "nav", "aside")
DENSE_HIDDEN = _hidden("script", "style", "template", "noscript", "form")
LINKED_HIDDEN = _hidden("script", "style", "template", "head")
VIEWS = {"page": (1, PAGE_HIDDEN), "article": (2, ARTICLE_HIDDEN), "dense": (4, DENSE_HIDDEN), "linked": (8, LINKED_HIDDEN)}
_MASK = {name: sum(bit for bit, hidden in VIEWS.values() if name in hidden) for _, hidden in VIEWS.values() for name in hidden}

CONTAINERS = frozenset(("article", "section", "div", "main"))
HEADINGS = {f"h{i}": "\n\n" + "#" * i + " " for i in range(1, 7)}
LINE_TAGS = frozenset("""p div br li ul ol tr table article section main header footer nav aside blockquote pre h1 h2 h3 h4 h5 h6
title hr""".split())
MARKS = {"b": "**", "strong": "**", "i": "_", "em": "_"}
JSONLD_TYPE = "application/ld+json"


class Page:
    """What one walk over a page finds.  ``linked`` is written only if asked for."""

    def __init__(self, page: str, linked: bool = False) -> None:
        self.source = page
        self.scripts: list[str] = []  # JSON-LD texts
        self.metas: list[dict[str, str]] = []
        self.times: list[tuple[dict[str, str], list[str]]] = []  # attributes and text pieces
        self.pieces: list[tuple[int, str]] = []  # the views a piece is hidden from, its stripped text
        self.nodes: list[list] = []  # containers: tag, first and end piece, links before and at the end
        self.links = 0
        self.linked: list[str] = []
        self._open: list[tuple[str, int, int | None, str | None]] = []  # name, mask outside, container, link target
        self._places: dict[str, list[int]] = {}
        self._blocks = [-1]
        self._mask = 0
        self._time: list[str] | None = None
        self._walk(page, linked)

    def _walk(self, page: str, linked: bool) -> None:
        script = False
        for kind, what, a, b in tokens(page):
            if kind == TEXT:
                if script:
                    self.scripts.append(what)
                elif self._mask != 15:
                    text = unescape(what) if "&" in what else what
                    if piece := text.strip():
                        self.pieces.append((self._mask, piece))
                        if self._time is not None:
                            self._time.append(piece)
                    if linked and not self._mask & 8:
                        self.linked.append(text)
            elif kind == START:
                script = self._start(page, what, a, b, linked)
            elif kind == END:
                script = False
                self._end(what, linked)
        self._pop_to(0)

    def _start(self, page: str, name: str, a: int, b: int, linked: bool) -> bool:
        places = self._places
        if name in BLOCKS or name == "p":
            if (p := places.get("p")) and p[-1] > self._blocks[-1]:
                self._pop_to(p[-1])
        elif name == "a" and (p := places.get("a")) and p[-1] > self._blocks[-1]:
            self._pop_to(p[-1])
        if name not in HEAD_PARTS and (p := places.get("head")):
            self._pop_to(p[-1])
        container = target = None
        if name == "meta":
            self.metas.append(attributes(page, a, b))
        elif name == "time":
            self._time = []
            self.times.append((attributes(page, a, b), self._time))
        elif name == "a":
            self.links += not self._mask & 4
            if linked and not self._mask & 8:
                target = attributes(page, a, b).get("href")
        elif name in CONTAINERS and not self._mask & 4:
            container = len(self.nodes)
            self.nodes.append([name, len(self.pieces), None, self.links, None])
        if linked and not self._mask & 8:
            if target is not None:
                self.linked.append("[")
            self.linked.append(HEADINGS.get(name) or ("\n* " if name == "li" else MARKS.get(name) or ("\n" if name in LINE_TAGS else "")))
        if name in VOID:
            return False
        at = len(self._open)
        self._open.append((name, self._mask, container, target))
        places.setdefault(name, []).append(at)
        if name in BLOCKS:
            self._blocks.append(at)
        self._mask |= _MASK.get(name, 0)
        return name == "script" and attributes(page, a, b).get("type", "").strip().lower() == JSONLD_TYPE

    def _end(self, name: str, linked: bool) -> None:
        p = self._places.get(name)
        if p and (name in BLOCKS or p[-1] > self._blocks[-1]):
            self._pop_to(p[-1])
        elif name == "time":
            self._time = None
        if linked and not self._mask & 8:
            self.linked.append(MARKS.get(name) or ("\n" if name in LINE_TAGS else ""))

    def _pop_to(self, depth: int) -> None:
        while len(self._open) > depth:
            name, self._mask, container, target = self._open.pop()
            self._places[name].pop()
            if name in BLOCKS:
                self._blocks.pop()
            if name == "time":
                self._time = None
            if container is not None:
                self.nodes[container][2], self.nodes[container][4] = len(self.pieces), self.links
            if target is not None:
                self.linked.append(f"]({target})")

    def text(self, view: str, sep: str) -> str:
        """The text pieces of a view (see ``VIEWS``) joined by ``sep``."""
        bit = VIEWS[view][0]
        return sep.join([t for mask, t in self.pieces if not mask & bit])


def densest(page: Page, min_chars: int) -> tuple[int, str, int, float, str] | None:
    """The container with the most text per link among those of more than
    ``min_chars`` characters, the first of equals: its number among the
    containers, tag, links, score and text (pieces on lines of their own)."""
    seen = [(t if not mask & VIEWS["dense"][0] else None) for mask, t in page.pieces]
    chars, count = [0], [0]
    for t in seen:
        chars.append(chars[-1] + len(t or ""))
        count.append(count[-1] + (t is not None))
    best = None
    for i, (tag, a, b, before, after) in enumerate(page.nodes):
        n = chars[b] - chars[a] + max(0, count[b] - count[a] - 1)
        score = n / (after - before + 1)
        if n > min_chars and (best is None or score > best[0]):
            best = score, i, tag, after - before, a, b
    if best is None:
        return None
    score, i, tag, links, a, b = best
    return i, tag, links, score, "\n".join([t for t in seen[a:b] if t is not None])
