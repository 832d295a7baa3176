"""Pages as trees of elements and text leaves, in page order, with the structure's measures.

Only what shapes the tree is parsed: tags, implied ends of paragraphs, items and cells,
raw text elements and comments.  Inline elements without attributes are part of their
parent, so a paragraph with bold words is one leaf.
"""

from __future__ import annotations

import html
import re

import numpy as np

#: Fixed names of HTML: elements without content, with raw text, and those that start a block of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu "
    "nav noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul".split()
)
#: Elements whose text is never part of the page's prose.
UNSEEN = frozenset("head template select option optgroup button svg object".split())
HEAD = frozenset("title meta link base script style noscript template head".split())
#: An element's start ends an open one of these, up to a border.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "thead": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead", "tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
BORDER = frozenset("td th table caption body html".split())
NAMES = ["#text", "#page", *sorted(BLOCK), "span", "a", "b", "i", "em", "strong", "small", "font", "abbr", "time", "cite", "code", "q", "u", "s", "sub", "sup", "ins", "del", "mark"]
PLACE = {name: k for k, name in enumerate(NAMES)}
OTHER = len(NAMES)

MARKUP = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)|[!?/][^>]*+>?)", re.DOTALL)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
LINK = re.compile(r"\bhref\b", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Nodes in page order: the page itself, elements, and leaves with text."""

    __slots__ = ("name", "parent", "depth", "end", "attributes", "text", "block", "linked")

    def __init__(self, source: str):
        self.name: list[int] = [1]
        self.parent: list[int] = [-1]
        self.depth: list[int] = [0]
        self.attributes: list[str] = [""]
        self.text: dict[int, str] = {}
        self.block: dict[int, int] = {}
        self.linked: dict[int, int] = {}
        self._read(source)
        n = len(self.name)
        self.end = list(range(1, n + 1))
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            if self.end[p] < self.end[k]:
                self.end[p] = self.end[k]

    def _node(self, name: int, parent: int, attributes: str = "") -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.attributes.append(attributes)
        return len(self.name) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]
        count: dict[str, int] = {}
        block, link, unseen, last, at = 0, False, 0, -1, 0

        def pop_to(depth: int) -> None:
            nonlocal unseen
            while len(stack) > depth:
                tag, _ = stack.pop()
                count[tag] -= 1
                unseen -= tag in UNSEEN

        def text(lo: int, hi: int) -> None:
            nonlocal last
            piece = source[lo:hi]
            node = stack[-1][1]
            blank = piece.isspace()
            same = last >= 0 and self.block[last] == block
            if blank or same and self.parent[last] == node:
                if same:  # white space between inline elements belongs to what is before it
                    self.text[last] += piece
                    if link and not blank:
                        self.linked[last] += hi - lo
                return
            last = self._node(0, node)
            self.text[last], self.block[last], self.linked[last] = piece, block, (hi - lo) * link

        size = len(source)
        while at < size:
            found = MARKUP.search(source, at)
            lo = found.start() if found else size
            if lo > at and not unseen:
                text(at, lo)
            if not found:
                break
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:  # an end tag
                if tag == "a":
                    link = False
                if tag in BLOCK:
                    block += 1
                if count.get(tag):
                    for depth in range(len(stack) - 1, 0, -1):
                        above = stack[depth][0]
                        if above == tag:
                            pop_to(depth)
                            break
                        if tag not in BLOCK and above in BLOCK or above in BORDER and tag not in BORDER and tag not in ENDS:
                            break
                continue
            rest = found[3]
            if tag in RAW:
                if not rest.endswith("/>"):
                    close = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(source, at)
                    at = close.end() if close else size
                continue
            if tag == "br" or tag == "hr" or tag in VOID:
                if tag == "hr":
                    block += 1
                elif tag == "br" and last >= 0 and self.block[last] == block:
                    self.text[last] += " "
                continue
            if count.get("head") and tag not in HEAD:
                pop_to(next(k for k, (name, _) in enumerate(stack) if name == "head"))
            if tag == "a":
                link = LINK.search(rest) is not None
            if tag in BLOCK:
                block += 1
                if count.get("p"):
                    for depth in range(len(stack) - 1, 0, -1):
                        above = stack[depth][0]
                        if above == "p":
                            pop_to(depth)
                            break
                        if above in BLOCK:
                            break
                if tag in ENDS:
                    closed, border = ENDS[tag]
                    for depth in range(len(stack) - 1, 0, -1):
                        above = stack[depth][0]
                        if above in border:
                            break
                        if above in closed:
                            pop_to(depth)
                            break
            node = stack[-1][1]
            attributes = " ".join(f"{a[0]} {a[1]}" if a[0].lower() in ("hidden", "style") else a[1] for a in ATTRIBUTE.findall(rest)) if len(rest) > 4 else ""
            if not unseen and (tag in BLOCK or attributes and tag != "a"):
                node = self._node(PLACE.get(tag, OTHER), node, attributes)
            if not rest.endswith("/>") or tag in BLOCK:
                stack.append((tag, node))
                count[tag] = count.get(tag, 0) + 1
                unseen += tag in UNSEEN

    def prose(self, kept: np.ndarray) -> str:
        """The text of kept leaves: white space as one space, blocks parted by an empty line."""
        blocks: dict[int, list[str]] = {}
        for k, piece in self.text.items():
            if kept[k]:
                blocks.setdefault(self.block[k], []).append(piece)
        return "\n\n".join(filter(None, (" ".join(html.unescape("".join(b)).split()) for b in blocks.values())))


def tokens(attributes: str) -> list[str]:
    """Lower-case words of attribute values, parted at case changes too."""
    return WORD.findall(CAMEL.sub(" ", attributes).lower())
