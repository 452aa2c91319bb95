"""Web pages as sequences of text blocks, each with the path of tags that leads to it.

A block is the text between two tags that break the line: paragraphs, headings, list items, table cells, captions. Inline tags and
line breaks do not end a block. What is never text of a page is left out here: scripts, styles, comments, head, form controls,
embedded media. Character references are decoded and white space becomes single blanks.

A page is read once from left to right. Unclosed and stray tags are taken as browsers roughly do: a new paragraph, item or
cell ends the open one, an end tag without a start is passed over, a tag cut off by the end of the page is dropped. Elements
nested deeper than `DEPTH` count as their parents.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

DEPTH = 256

#: Fixed by HTML: elements without end tags, elements that stay in a line, and elements whose content is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe noframes noembed template xmp".split())
UNSEEN = frozenset("head select button datalist object svg math canvas video audio map".split())
#: Fixed by HTML: what a new element of a kind closes, up to the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
CONTAINERS = frozenset("body div section article main aside nav header footer form table ul ol dl blockquote figure fieldset".split())
_IN_PARAGRAPHS = CONTAINERS | {"td", "th", "li", "dd"}

_START = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # of the first text: tags, and the words of their classes, ids and roles with a dot before
    linked: int  # characters inside links


def _words_of(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    words = []
    for m in _ATTRIBUTE.finditer(attributes):
        words += ["." + w.lower() for w in _NAME_PARTS.findall(m[2] or m[3] or m[4] or "")[:12]]
    return words


class _Reader:
    def __init__(self):
        self.blocks: list[Block] = []
        self.names: list[str] = []
        self.paths: list[tuple[str, ...]] = [()]
        self.unseen = 0  # open elements whose content is no text
        self.links = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.at: tuple[str, ...] = ()

    def text(self, raw: str) -> None:
        if self.unseen:
            return
        if "&" in raw:
            raw = html.unescape(raw)
        if not self.at and raw.strip():
            self.at = self.paths[-1] or ("body",)
        self.pieces.append(raw)
        if self.links:
            self.linked += len(raw.strip())

    def end_block(self) -> None:
        if self.at:
            text = " ".join("".join(self.pieces).split())
            self.blocks.append(Block(text, self.at, min(self.linked, len(text))))
        self.pieces, self.linked, self.at = [], 0, ()

    def pop(self) -> None:
        name = self.names.pop()
        self.paths.pop()
        self.unseen -= name in UNSEEN
        self.links -= name == "a"

    def close_to(self, wanted: set[str] | frozenset[str], stops: frozenset[str]) -> None:
        """Close the nearest open element of the wanted ones, if no stop lies above it."""
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] in wanted:
                while len(self.names) > depth:
                    self.pop()
                return
            if self.names[depth] in stops:
                return

    def start(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self.end_block()
            if name in CLOSES:
                self.close_to(CLOSES[name], CONTAINERS)
            else:
                self.close_to({"p"}, _IN_PARAGRAPHS)
        elif name == "a" and self.links:
            self.close_to({"a"}, CONTAINERS)
        elif name == "br":
            self.pieces.append(" ")
        if name in VOID or len(self.names) >= DEPTH or name in ("html", "body"):
            return
        self.names.append(name)
        self.paths.append((*self.paths[-1], name, *_words_of(attributes)))
        self.unseen += name in UNSEEN
        self.links += name == "a"

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.end_block()
        self.close_to({name}, frozenset() if name not in INLINE else CONTAINERS)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order; null and empty pages have none."""
    if not page:
        return []
    reader, at, size = _Reader(), 0, len(page)
    lowered = None
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            reader.text(page[at:])
            break
        if mark > at:
            reader.text(page[at:mark])
        after = page[mark + 1 : mark + 2]
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 2)
            at = size if end < 0 else end + 3
        elif after in ("!", "?"):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
        elif after == "/":
            end = page.find(">", mark)
            if end < 0:
                break
            name = page[mark + 2 : end].split(None, 1)
            if name and name[0][:1].isalpha():  # else it is a comment
                reader.end(name[0].rstrip("/").lower())
            at = end + 1
        elif after.isascii() and after.isalpha():
            found = _START.match(page, mark)
            if not found:
                break  # cut off
            name = found[1].lower()
            at = found.end()
            if name in RAW:
                if name not in ("script", "style", "noscript", "template"):
                    reader.end_block()
                lowered = page.lower() if lowered is None else lowered
                # lower() may change lengths beyond ASCII; then look for the end tag as it is written
                end = (lowered if len(lowered) == size else page).find(f"</{name}", at)
                end = page.find(">", end) if end >= 0 else -1
                at = size if end < 0 else end + 1
            else:
                reader.start(name, found[2])
        else:
            reader.text("<")
            at = mark + 1
    reader.end_block()
    return reader.blocks
