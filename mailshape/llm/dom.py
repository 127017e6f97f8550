"""A small tolerant HTML reader: block elements and the text blocks between their boundaries."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements that begin and end a block. All others are part of the block's running text.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav
ol p pre section summary table tbody td tfoot th thead tr ul""".split())
# Elements whose content is no text of the page.
_RAW = frozenset("script style title textarea xmp noframes noembed iframe".split())
_DROPPED = frozenset("head noscript template svg math object select button canvas audio video".split())
# Elements without content, those not of a block and those that make one.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                   "td": {"td", "th"}, "th": {"td", "th"}}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTES = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in _RAW}


@dataclass
class Block:
    """A node of the tree: an element, or a text block (``tag`` is empty)."""

    tag: str
    parent: int
    attributes: str = ""
    text: str = ""
    linked: int = 0  # code points of the text inside links


@dataclass
class _State:
    nodes: list[Block] = field(default_factory=lambda: [Block("html", -1)])
    stack: list[int] = field(default_factory=lambda: [0])
    open: dict[str, int] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    dropped: list[str] = field(default_factory=list)

    def text(self, raw: str) -> None:
        if self.dropped or not raw:
            return
        part = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(part)
        if self.links:
            self.linked += len(part)

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.nodes.append(Block("", self.stack[-1], "", text, min(self.linked, len(text))))
        self.pieces.clear()
        self.linked = 0

    def push(self, tag: str, attributes: str) -> None:
        self.nodes.append(Block(tag, self.stack[-1], attributes))
        self.stack.append(len(self.nodes) - 1)
        self.open[tag] = self.open.get(tag, 0) + 1

    def pop(self) -> str:
        tag = self.nodes[self.stack.pop()].tag
        self.open[tag] -= 1
        return tag

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.links = 1
        elif tag == "br":
            self.pieces.append(" ")
        elif tag in BLOCKS:
            self.flush()
            self.links = 0
            top = self.nodes[self.stack[-1]].tag
            if len(self.stack) > 1 and (top == "p" or top in _CLOSED_BY_SAME.get(tag, ())):
                self.pop()
            if tag not in _VOID and tag not in ("html", "body"):
                self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag in BLOCKS:
            self.flush()
            self.links = 0
            if self.open.get(tag):
                while self.pop() != tag:
                    pass


def read(source: str) -> list[Block]:
    """Nodes of a page in document order, each after its parent; node 0 is the root.

    Never fails: what is no tag is text, elements left open end with the page, end tags without a
    start do nothing, comments and declarations are left out. Time is linear in the source.
    """
    state, at, lenient = _State(), 0, False
    while True:
        mark = source.find("<", at)
        if mark < 0:
            state.text(source[at:])
            break
        state.text(source[at:mark])
        if source.startswith("<!--", mark):
            end = source.find("-->", mark + 4)
            at = end + 3 if end >= 0 else len(source)
            continue
        closing = source.startswith("/", mark + 1)
        name = _NAME.match(source, mark + 1 + closing)
        if not name:
            if source[mark + 1:mark + 2] in ("!", "?", "/"):
                end = source.find(">", mark)
                at = end + 1 if end >= 0 else len(source)
            else:
                state.text("<")
                at = mark + 1
            continue
        rest = None if lenient else _ATTRIBUTES.match(source, name.end())
        if rest:
            end = rest.end()
        else:
            # A quote is never closed: from here on a tag ends with the next >.
            lenient = True
            end = source.find(">", name.end()) + 1
            if not end:
                break
        tag = name.group().lower()
        at = end
        if state.dropped:
            if tag == state.dropped[-1] and closing:
                state.dropped.pop()
            elif tag in _DROPPED and not closing:
                state.dropped.append(tag)
            elif tag == "body" and not closing:
                state.dropped.clear()  # a head left open
            if tag not in _RAW or closing:
                continue
        if tag in _RAW and not closing:
            found = _END[tag].search(source, end)
            close = source.find(">", found.start()) if found else -1
            at = close + 1 if close >= 0 else len(source)
        elif tag in _DROPPED:
            if not closing and source[end - 2] != "/":
                state.dropped.append(tag)
        elif closing:
            state.end(tag)
        else:
            state.start(tag, source[name.end():end - 1])
    state.flush()
    return state.nodes
