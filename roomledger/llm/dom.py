"""Leaf blocks of a web page: the runs of text between block tags, with the open elements around them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

# Element names by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = "script|style|noscript|template|title|textarea|iframe|svg|object"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li".split()
)
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select div section article main aside nav body".split())

HIDDEN = re.compile(rf"(?:{UNSEEN})\b", re.I)
HIDDEN_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in UNSEEN.split("|")}
TAG = re.compile(r"(/?)([a-z][^\s/>\"'<]*)", re.I)
MARK = re.compile("[>\"']")
BRACKET = re.compile("[<>]")
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Node:
    """An open element that counts for the blocks in it, below another one."""

    __slots__ = ("tag", "names", "above")

    def __init__(self, tag: str, names: str, above: Node | None):
        self.tag, self.names, self.above = tag, names, above


class Block(NamedTuple):
    """A block's text, the innermost element around it, and its characters in links."""

    text: str
    inside: Node | None
    linked: int

    @property
    def path(self) -> tuple[tuple[str, str], ...]:
        """The open elements around it as (tag, names) from the outside in."""
        found, node = [], self.inside
        while node is not None:
            found.append((node.tag, node.names))
            node = node.above
        return tuple(reversed(found))


class _TagEnds:
    """Finds where tags end, in time that grows with the page, however its quotes stand."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.places: dict[str, list[int]] | None = None  # of marks; needed once a tag has no end
        self.dead: set[int] = set()  # places outside quotes from which no end is found

    def _next(self, kind: str, at: int) -> int:
        if self.places is not None:
            found = self.places[kind]
            k = bisect_left(found, at)
            return found[k] if k < len(found) else -1
        if kind != "any":
            return self.html.find(kind, at)
        found = MARK.search(self.html, at)
        return found.start() if found else -1

    def after(self, at: int) -> int:
        """Place of the first ``>`` from ``at`` on that is outside quotes, -1 without one."""
        seen = []
        while at <= self.last and at not in self.dead:
            seen.append(at)
            mark = self._next("any", at)
            if mark < 0 or self.html[mark] == ">":
                return mark
            close = self._next(self.html[mark], mark + 1)
            if close < 0:
                break
            at = close + 1
        # Two ways through the page that meet outside quotes go on alike, so there are few.
        self.dead.update(seen)
        if self.places is None:
            marks = [m.start() for m in MARK.finditer(self.html)]
            self.places = {"any": marks, **{q: [k for k in marks if self.html[k] == q] for q in "\"'"}}
        return -1


class _Open:
    """The open elements of a page, with the places of each tag."""

    def __init__(self):
        self.stack: list[tuple[str, Node | None]] = []
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []  # places of elements that are not inline

    @property
    def inside(self) -> Node | None:
        return self.stack[-1][1] if self.stack else None

    def top(self, tags) -> int:
        """Place of the innermost element with one of ``tags``, -1 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, tag: str, names: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.solid.append(len(self.stack))
        counts = tag not in INLINE or names
        self.stack.append((tag, Node(tag, names, self.inside) if counts else self.inside))

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all in it."""
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.solid.pop()

    def close(self, tag: str) -> None:
        place, block = self.top([tag]), self.solid[-1] if self.solid else -1
        if place >= 0 and (tag not in INLINE or place > block):
            self.cut(place)

    def make_room(self, tag: str) -> None:
        """Close what ``tag`` ends by opening."""
        if tag in CLOSES_P and self.solid and self.stack[self.solid[-1]][0] == "p":
            self.cut(self.solid[-1])
        if tag in SELF_CLOSING:
            place = self.top(SELF_CLOSING[tag])
            if place > self.top(SCOPE):
                self.cut(place)


def _pieces(html: str) -> Iterator[tuple[int, int, re.Match | None, int]]:
    """Start and end of all that is not text, with the match of a tag's name and the end of its attributes."""
    ends, size, at = _TagEnds(html), len(html), 0

    def end_of(place: int, length: int = 1) -> int:
        return size if place < 0 else place + length

    while (start := html.find("<", at)) >= 0:
        first = html[start + 1: start + 2]
        hidden, tag = HIDDEN.match(html, start + 1), TAG.match(html, start + 1)
        name, close = None, 0
        if html.startswith("<!--", start):
            at = end_of(html.find("-->", start + 4), 3)
        elif hidden:
            at = end_of(html.find(">", hidden.end()))
            if html[at - 2: at] != "/>" and at < size:
                closed = HIDDEN_ENDS[hidden[0].lower()].search(html, at)
                at = closed.end() if closed else size
        elif tag and (close := ends.after(tag.end())) >= 0:
            name, at = tag, close + 1
        elif first and first in "!?/":
            at = end_of(html.find(">", start))
        elif tag:
            bracket = BRACKET.search(html, start + 1)
            if bracket and bracket[0] == "<":
                at = bracket.start()
                continue
            at = bracket.end() if bracket else size
        else:
            at = start + 1
            continue
        yield start, at, name, close


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, white space made single spaces and character references decoded.

    Elements left open are closed where HTML closes them; whatever else does
    not match is passed over. Blocks without visible text are left out. Time
    and memory grow with the page's length, whatever it holds.
    """
    found: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, open_.inside, min(linked, len(text))))
            pieces.clear()
        linked = 0

    at = 0
    for start, end, name, close in _pieces(html):
        if start > at:
            pieces.append(html[at:start])
            if open_.places.get("a"):
                linked += start - at
        at = end
        if name is None:
            continue
        tag = name[2].lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if name[1]:
            open_.close(tag)
            continue
        open_.make_room(tag)
        if tag not in VOID:
            attributes = html[name.end():close].rstrip("/")
            names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)).lower() if "=" in attributes else ""
            open_.push(tag, names)
    if at < len(html):
        pieces.append(html[at:])
    flush()
    return found
