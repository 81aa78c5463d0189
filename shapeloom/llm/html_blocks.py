"""A page's text as a sequence of leaf blocks.

A block is a run of text between block-level tags; inline tags don't part it.
Each block keeps the names and class, id and role words of the elements around
it, and how much of it is link text. Scripts, styles, templates and the head's
title hold no blocks; all else does, and what is main text the labeller says.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from dataclasses import dataclass
from html import unescape

import numpy as np

_COMMENT = re.compile(r"<(!--)")
_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
# a quote opens a value only directly after '='; anywhere else it is a character of the tag
_REST = re.compile(r"(?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)|=)*+>")
_PLACES = re.compile(r"[=>]")
_VALUE = re.compile(r"=\s*+")
_STOP = re.compile(r"[\s>]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGIT = re.compile(r"\d")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img kbd mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle merror "
                   "mpadded mphantom menclose mmultiscripts mprescripts semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; it ends at their own end tag. A template's
#: content is markup: without an end tag of its own it is an element as any other.
RAW = frozenset("script style template title".split())
_TEMPLATE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1\b|\Z)|<(/?)template\b", re.S | re.I)
#: An open element of the first kind ends where one of the second begins.
ENDS = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                       "section table ul".split()),
        "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
        "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

PATH, WORDS, SHAPES = 256, 48, 8
WIDTH = PATH + WORDS + SHAPES


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[int, ...]
    link: float


def _slots(word: str) -> tuple[int, int]:
    """Two places of a word, so that hardly two words share both."""
    code = zlib.crc32(word.encode())
    return code % PATH, (code >> 16) % PATH


def _marks(name: str, attributes: str) -> tuple[int, ...]:
    """Places of the element's name and of the words in its class, id and role."""
    out = [*_slots("<" + name)]
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            for w in _WORD.findall(m[1] or m[2] or m[3] or ""):
                out += _slots(w.lower())
    return tuple(out)


def _template_ends(html: str) -> dict[int, int]:
    """Where the end tag of each template begins, by the place of its start tag, for those that have one."""
    ends: dict[int, int] = {}
    begun: list[int] = []
    for m in _TEMPLATE.finditer(html):
        if m[2] == "":
            begun.append(m.start())
        elif m[2] and begun:
            ends[begun.pop()] = m.start()
    return ends


class _TagEnds:
    """Where a tag whose attributes begin at a place ends, quoted values left out, for the rest of a page.

    Found from the page's end backwards, so that a page of tags that don't
    end is read once and not once for each tag.
    """

    def __init__(self, html: str, start: int):
        n = len(html)
        self.at = [m.start() for m in _PLACES.finditer(html, start)]
        stops = [m.start() for m in _STOP.finditer(html, start)]
        quotes = {q: [m.start() for m in re.finditer(q, html[start:])] for q in "\"'"}
        self.ends = [0] * len(self.at)
        for k in range(len(self.at) - 1, -1, -1):
            place = self.at[k]
            if html[place] == ">":
                self.ends[k] = place + 1
                continue
            value = _VALUE.match(html, place).end()
            follow = place + 1
            if value < n and html[value] in quotes:
                mine = quotes[html[value]]
                closing = bisect_left(mine, value + 1 - start)
                if closing < len(mine):
                    follow = mine[closing] + start + 1
            elif value < n and html[value] != ">":
                stop = bisect_left(stops, value)
                follow = stops[stop] if stop < len(stops) else n
            self.ends[k] = self.after(follow)

    def after(self, place: int) -> int:
        """End of the tag whose rest begins at ``place``; 0 if it has none."""
        k = bisect_left(self.at, place)
        return self.ends[k] if k < len(self.at) else 0


class Tags:
    """The tags of a page, one after another from any place; comments and declarations have no name.

    A quoted value may hold '>'. If by that rule a tag doesn't end, it ends at
    the next '>'; without one it is text.
    """

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.ends: _TagEnds | None = None

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, name, attributes) of the first tag from ``at`` on."""
        html = self.html
        m = _OPEN.search(html, at)
        if m and not m[1] and self.last < m.end():  # no tag ends any more, but a comment may still come
            m = _COMMENT.search(html, m.start() + 1)
        if not m:
            return None
        start, at = m.start(), m.end()
        if m[1]:
            end = html.find("-->", at)
            return start, end + 3 if end >= 0 else len(html), False, "", ""
        first = html.find(">", at)
        end = first + 1
        if not m[3]:
            return start, end, False, "", ""
        if "\"" in (between := html[at:first]) or "'" in between:
            rest = None if self.ends else _REST.match(html, at)
            if rest:
                end = rest.end()
            else:
                self.ends = self.ends or _TagEnds(html, at)
                end = self.ends.after(at) or end
        return start, end, bool(m[2]), m[3].lower(), html[at:end - 1]


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page, white space inside each turned into one space; blank ones are none."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []  # name, marks of it and all around it
    known: dict[tuple[str, str], tuple[int, ...]] = {}
    depth: dict[str, int] = {}
    parts: list[str] = []
    in_link = linked = 0
    path: tuple[int, ...] = ()
    templates: dict[int, int] | None = None
    at, n = 0, len(html)
    tags = Tags(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def leave(name: str) -> None:
        while stack:
            top, _ = stack.pop()
            depth[top] -= 1
            if top == name:
                return

    while True:
        found = tags.after(at)
        stop = found[0] if found else n
        if stop > at:
            if not parts:
                path = stack[-1][1] if stack else ()
            parts.append(html[at:stop])
            if in_link:
                linked += stop - at
        if not found:
            break
        begin, at, closing, name, attributes = found
        if not name:
            continue
        if name in INLINE:  # neither a boundary nor a part of the path
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            continue
        raw, start = name in RAW, at
        if raw and name == "template" and not closing:
            templates = _template_ends(html) if templates is None else templates
            start = templates.get(begin, n)
            raw = start < n
        if closing or not raw:
            flush()
            in_link = 0
        if closing:
            if depth.get(name):
                leave(name)
            continue
        if raw:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, start)
                at = html.find(">", end.end()) + 1 if end else 0
                at = at or n
            continue
        while stack and name in ENDS.get(stack[-1][0], ()):
            leave(stack[-1][0])
        if name in ENDS["p"] and depth.get("p"):
            leave("p")
        # within drawings a slash ends an element
        if name in VOID or attributes.endswith("/") and (name == "svg" or depth.get("svg")):
            continue
        marks = known.get((name, attributes))
        if marks is None:
            marks = known[name, attributes] = _marks(name, attributes)
        around = stack[-1][1] if stack else ()
        # the same marks again add nothing, so a path is never longer than PATH
        stack.append((name, around + tuple(x for x in dict.fromkeys(marks) if x not in around)))
        depth[name] = depth.get(name, 0) + 1
    flush()
    return out


def vectors(page: list[Block], begin: int = 0, end: int | None = None) -> np.ndarray:
    """blocks x WIDTH: tag path, hashed words and shape of the blocks begin:end (all by default) of a page."""
    total = len(page)
    stretch = page[begin:end]
    n = len(stretch)
    x = np.zeros((n, WIDTH), dtype=np.float32)
    rows, cols, word_rows, word_cols = [], [], [], []
    for k, b in enumerate(stretch):
        rows += [k] * len(b.path)
        cols += b.path
        words = b.text.lower().split()
        word_cols += [zlib.crc32(w.encode()) for w in words]
        word_rows.append(len(words))
        size = len(b.text)
        x[k, PATH + WORDS:] = (b.link, np.log1p(size) / 6, min(1.0, len(words) / 40), b.text[-1] in ".!?:;…»”\"", (begin + k) / total,
                               (total - 1 - begin - k) / total, len(_DIGIT.findall(b.text)) / size, b.text[0].isupper())
    x[rows, cols] = 1.0
    code = np.array(word_cols, dtype=np.int64)
    sign = np.where(code >> 31 & 1, 1.0, -1.0)
    flat = np.repeat(np.arange(n), word_rows) * WORDS + code % WORDS
    sums = np.bincount(flat, weights=sign, minlength=n * WORDS).reshape(n, WORDS)
    x[:, PATH:PATH + WORDS] = sums / np.maximum(np.linalg.norm(sums, axis=1), 1.0)[:, None]  # however long the block
    return x
