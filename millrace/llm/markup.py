"""Leaf blocks of HTML pages: text, tag path and share of linked text.

Tags, attributes and comments end where the HTML standard ends them. Time and memory grow with
the length of the page however deep or broken it is: no pattern looks at a character again and
again, open elements are found by their names, and blocks share their paths.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any, NamedTuple


class Path:
    """Open elements as a linked node: ``words`` are the tag and, with a dot, the words of class, id and role.

    ``fresh``: those of the words that no outer element has. ``last``: the innermost tag but html and body.
    """

    __slots__ = ("parent", "words", "fresh", "last", "_inner")

    def __init__(self, parent: Path | None = None, words: tuple[str, ...] = (), fresh: tuple[str, ...] = ()):
        self.parent, self.words, self.fresh = parent, words, fresh
        self.last = words[0] if words and words[0] not in ("html", "body") else parent.last if parent else ""
        self._inner: dict[tuple[str, ...], Path] = {}

    @classmethod
    def of(cls, words: tuple[str, ...]) -> Path:
        node, seen = cls(), defaultdict(int)
        for k, word in enumerate(words):
            if word[0] != ".":
                end = next((j for j in range(k + 1, len(words)) if words[j][0] != "."), len(words))
                node = node.inner(words[k:end], seen)
                for x in words[k:end]:
                    seen[x] += 1
        return node

    def inner(self, words: tuple[str, ...], seen: dict[str, int]) -> Path:
        """The node of an element in this one; equal ones share it. ``seen``: counts of the open elements' words."""
        node = self._inner.get(words)
        if node is None:
            node = self._inner[words] = Path(self, words, tuple(x for x in dict.fromkeys(words) if not seen.get(x)))
        return node

    def derive(self, kept: dict[Path | None, Any], step: Callable[[Any, Path], Any]) -> Any:
        """A value that follows from the parent's, found once for each node; ``kept[None]`` is the outermost."""
        todo, node = [], self
        while node not in kept:
            todo.append(node)
            node = node.parent
        value = kept[node]
        for node in reversed(todo):
            value = kept[node] = step(value, node)
        return value

    def __reversed__(self) -> Iterator[str]:
        node = self
        while node:
            yield from reversed(node.words)
            node = node.parent

    def __iter__(self) -> Iterator[str]:
        return iter([*reversed(self)][::-1])

    def __getitem__(self, at):
        return tuple(self)[at]


class Block(NamedTuple):
    """Text between two block boundaries. ``path``: its words, a node or all of them in order."""

    path: Path | tuple[str, ...]
    text: str
    linked: float


# Elements by kind, as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript noframes noembed iframe svg math object canvas video audio".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())  # all others close an open head
RAW = frozenset("script style textarea title noscript noframes noembed iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("button label option optgroup caption td th tr tbody thead tfoot".split())
TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FOREIGN = frozenset("svg math".split())
# An element of the key closes open ones of its values, up to the nearest of the stops.
CLOSES = {
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_SPACE = r"[ \t\n\f\r]"
_ATTRIBUTE = (
    r"[ \t\n\f\r/]*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)"  # a name, which may begin with =
    rf"(?:{_SPACE}*+={_SPACE}*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^ \t\n\f\r>\"'][^ \t\n\f\r>]*+))?+)?+"
)
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?:[!?]|/[^a-zA-Z>])[^>]*+(?:>|\Z)|</>"
    r"|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:" + re.sub(r"(?<!\\)\((?!\?)", "(?:", _ATTRIBUTE) + r")*+)([ \t\n\f\r/]*+)(>|\Z)",
    re.S,
)
_GIVEN = re.compile(_ATTRIBUTE)
_WORDS = re.compile(r"[a-z]+")
_ZEROS = re.compile(r"&#([xX]?)0++(?=[0-9a-fA-F])")
_LARGE = re.compile(r"&#(?:[0-9]{8,}+|[xX][0-9a-fA-F]{8,}+);?")


def _marks(given: str) -> tuple[str, ...]:
    if "=" not in given:
        return ()
    found: dict[str, str] = {}
    for name, *values in _GIVEN.findall(given):
        found.setdefault(name.lower(), "".join(values))
    return tuple(f".{w}" for k in ("class", "id", "role") if k in found for w in _WORDS.findall(found[k].lower()))


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I)


def decode(text: str) -> str:
    """``text`` with its character references read, numbers of any length among them."""
    if "&#" in text:
        text = _LARGE.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return html.unescape(text)


def blocks(page: str) -> list[Block]:
    """Blocks with text of a page in their order; unclosed, misnested and cut tags are coped with.

    A tag that the page's end cuts is dropped, as is all that an open comment, quote or script holds.
    """
    out: list[Block] = []
    root = Path()
    stack: list[Path] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
    bounds: list[int] = []  # places of open block elements
    hidden: list[int] = []  # places of open elements whose text isn't shown
    seen: defaultdict[str, int] = defaultdict(int)
    texts: list[str] = []
    path = root
    linked = total = 0

    def flush() -> None:
        nonlocal texts, linked, total
        if texts:
            joined = " ".join("".join(texts).split())
            if joined:
                out.append(Block(path, joined, linked / max(1, total)))
            texts, linked, total = [], 0, 0

    def push(tag: str, given: str) -> None:
        words = (tag, *_marks(given))
        stack.append((stack[-1] if stack else root).inner(words, seen))
        for x in words:
            seen[x] += 1
        place = len(stack) - 1
        places[tag].append(place)
        if tag in BLOCKS:
            bounds.append(place)
        if tag in UNSEEN:
            hidden.append(place)

    def pop(to: int) -> None:
        while len(stack) > to:
            words = stack.pop().words
            for x in words:
                seen[x] -= 1
            place = len(stack)
            for own in (places[words[0]], bounds, hidden):
                if own and own[-1] == place:
                    own.pop()
            if texts and words[0] in BLOCKS:
                flush()

    def nearest(tags: frozenset[str] | set[str]) -> int:
        found = -1
        for t in tags:
            if (own := places.get(t)) and own[-1] > found:
                found = own[-1]
        return found

    def close(tags: frozenset[str] | set[str], stops: frozenset[str] | set[str]) -> None:
        if nearest(tags) < 0:
            return
        stop = nearest(stops)
        found = [own[k] for t in tags if (k := bisect_right(own := places[t], stop)) < len(own)]
        if found:
            pop(min(found))

    def end(tag: str) -> None:
        own = places[tag]
        if tag in HEADINGS:
            place = nearest(HEADINGS)
            own = [place] if place >= 0 else []
        if not own:
            return
        if tag not in BLOCKS and tag not in UNSEEN and bounds and bounds[-1] > own[-1]:
            own.pop()  # it ends here, and the blocks that began in it go on
        elif tag in TABLE or tag in UNSEEN or tag in ("html", "body") or nearest(TABLE) <= own[-1]:
            pop(own[-1])

    def add(text: str) -> None:
        nonlocal path, linked, total
        if hidden:
            return
        if not texts:
            if text.isspace():
                return
            path = stack[-1] if stack else root
        text = decode(text)
        texts.append(text)
        size = len(text.strip())
        total += size
        linked += size if places["a"] else 0

    def in_head() -> bool:
        return bool(places["head"]) and places["head"][-1] == len(stack) - 1

    at = 0
    while m := _TOKEN.search(page, at):
        text = page[at : m.start()]
        at = m.end()
        if text:
            if in_head() and text.strip():
                pop(len(stack) - 1)
            add(text)
        ending, tag, given, rest, closing = m.groups()
        if tag is None:
            continue
        if not closing:
            break
        tag = tag.lower()
        if ending and tag != "br":
            if tag == "p":
                flush()
            end(tag)
            continue
        if in_head() and tag not in IN_HEAD:
            pop(len(stack) - 1)
        if tag == "br":
            if texts:
                texts.append(" ")
            continue
        if tag in BLOCKS:
            if texts:
                flush()
            if tag in ENDS_PARAGRAPH:
                close({"p"}, {"button", "caption", "td", "th", "table", "body"})
            if tag in HEADINGS and stack and stack[-1].words[0] in HEADINGS:
                pop(len(stack) - 1)
            if tag in CLOSES:
                close(*CLOSES[tag])
        if tag in VOID or rest.endswith("/") and (tag in FOREIGN or nearest(FOREIGN) >= 0):
            continue
        if tag in RAW:
            closed = _raw_end(tag).search(page, at)
            if tag == "textarea" and not hidden:
                push(tag, given)
                add(page[at : closed.start() if closed else len(page)])
                pop(len(stack) - 1)
            elif tag == "xmp":
                add(page[at : closed.start() if closed else len(page)].replace("&", "&amp;"))
            at = _TOKEN.match(page, closed.start()).end() if closed else len(page)
            continue
        if tag == "body" and places["head"]:
            pop(places["head"][0])
        push(tag, given)
    if in_head():
        pop(len(stack) - 1)
    if not m:
        add(page[at:])
    pop(0)
    flush()
    return out
