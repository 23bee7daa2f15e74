"""Blocks of a web page: text between block-level tags, with the path of open elements."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np

PATH_SIZE, WORD_SIZE, DENSE = 1024, 1024, 8
_TAG = re.compile(r"/?[A-Za-z][A-Za-z0-9:-]*")
_GAP, _NAME, _IS, _BARE = (re.compile(x) for x in (r"[\s/]*", r"[^\s/>][^\s/>=]*", r"\s*=\s*", r"[^\s>]*"))
_CODE_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style")}
#: What is between the tags of these is no text of the page; an element that is never closed drops nothing.
_DROPPED = frozenset("template noscript svg math iframe textarea select title".split())
_NAMED = frozenset("class id role itemprop aria-label".split())
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th "
    "thead tr ul video audio".split()
)
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
#: A start tag closes an open element of these names, up to the nearest element in the second set.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # names of all open elements, outermost first, each hashed place once
    links: int  # characters inside links


class _Tags:
    """Comments, code and tags of a page, each character looked at a bounded number of times.

    A quotation mark counts only where a value begins, and only if there is another one; what looks like a tag but has
    no end is text up to the end of the page.
    """

    def __init__(self, page: str) -> None:
        self.page, self.lost = page, set()

    def __iter__(self):
        """(start, end, name or None, closing, self-closed, attributes)"""
        page, at = self.page, 0
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = self._after("-->", at + 4)
                yield at, end, None, False, False, ()
                at = end
                continue
            found = _TAG.match(page, at + 1)
            if found is None:
                if page[at + 1 : at + 2] in ("!", "?", "/"):
                    end = self._after(">", at + 2)
                    yield at, end, None, False, False, ()
                    at = end
                else:
                    at += 1
                continue
            name = found[0].lower()
            rest = self._rest_of_tag(found.end())
            if rest is None:
                return
            end, empty, attributes = rest
            if name in _CODE_ENDS:
                close = _CODE_ENDS[name].search(page, end)
                end = len(page) if close is None else self._after(">", close.end())
                yield at, end, None, False, False, ()
            else:
                yield at, end, name.lstrip("/"), name[0] == "/", empty, attributes
            at = end

    def _after(self, mark: str, at: int) -> int:
        end = self.page.find(mark, at)
        return len(self.page) if end < 0 else end + len(mark)

    def _rest_of_tag(self, at: int):
        """End of the tag, whether it closes itself, and its attributes; None: the page ends first."""
        page, attributes = self.page, []
        while True:
            end = _GAP.match(page, at).end()
            if end >= len(page):
                return None
            if page[end] == ">":
                return end + 1, end > at and page[end - 1] == "/", attributes
            name = _NAME.match(page, end)
            at = name.end()
            if (equal := _IS.match(page, at)) is None:
                continue
            at = equal.end()
            mark = page[at : at + 1]
            close = self._quote(mark, at + 1) if mark in ("'", '"') else -1
            if close >= 0:
                value, at = page[at + 1 : close], close + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare[0], bare.end()
            attributes.append((name[0].lower(), value))

    def _quote(self, mark: str, at: int) -> int:
        if mark in self.lost:
            return -1
        if (end := self.page.find(mark, at)) < 0:
            self.lost.add(mark)
        return end


class _Open:
    """Open block elements: name, names on the whole path to it, and their places (as many as there are places at most)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[str, ...], frozenset[int]]] = []
        self.at: dict[str, list[int]] = defaultdict(list)

    def last(self, names) -> int:
        """Place of the innermost element of these names, or -1."""
        return max((self.at[n][-1] for n in names if self.at[n]), default=-1)

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.at[self.stack.pop()[0]].pop()

    def push(self, name: str, attributes) -> None:
        tokens = [f"tag {name}"]
        for key, value in attributes:
            if key in _NAMED:
                tokens += [f"name {t.lower()}" for t in _TOKEN.findall(value)]
        path, places = self.stack[-1][1:] if self.stack else ((), frozenset())
        if new := {p: t for t in reversed(tokens) if (p := _place(t, PATH_SIZE)) not in places}:
            path, places = (*path, *reversed(new.values())), places | new.keys()
        self.at[name].append(len(self.stack))
        self.stack.append((name, path, places))

    def path(self) -> tuple[str, ...]:
        return (*self.stack[-1][1], f"last {self.stack[-1][0]}") if self.stack else ("last ",)


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order: references decoded, white space made one space and trimmed."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[tuple[str, int]] = []  # pieces of the block so far, and their characters inside links
    # Open elements whose content is dropped when they close: name, depth, and what there was before them.
    dropped: list[tuple[str, int, int, int]] = []
    names: Counter[str] = Counter()
    base, in_link, at = 0, 0, 0

    def block(pieces: list[tuple[str, int]]) -> Block | None:
        raw = "".join(p for p, _ in pieces)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        return Block(text, open_.path(), sum(n for _, n in pieces)) if text else None

    def flush() -> None:
        if len(parts) > base:
            if (found := block(parts[base:])) is not None:
                out.append(found)
            del parts[base:]

    def add(piece: str) -> None:
        if piece:
            parts.append((piece, len(piece) * (in_link > 0)))

    for start, end, name, closing, empty, attributes in _Tags(page):
        add(page[at:start])
        at = end
        if name is None:
            continue
        if name in _DROPPED:
            if not closing and not empty:
                dropped.append((name, len(open_.stack), len(out), len(parts)))
                names[name] += 1
                base = len(parts)
            elif closing and names[name]:
                while True:
                    inner, depth, blocks_before, parts_before = dropped.pop()
                    names[inner] -= 1
                    if inner == name:
                        break
                del out[blocks_before:], parts[parts_before:]
                open_.cut(depth)
                base = dropped[-1][3] if dropped else 0
        if name == "a":
            in_link = max(0, in_link + (-1 if closing else 1))
        elif name == "br":
            add(" ")
        if name not in BLOCK:
            continue
        flush()
        if closing:
            if (k := open_.last((name,))) >= 0:
                open_.cut(k)
            continue
        if name in _VOID:
            continue
        closes, stop = _CLOSES.get(name, (frozenset(), frozenset()))
        if (k := open_.last((*closes, "p"))) > open_.last(stop):
            open_.cut(k)
        open_.push(name, attributes)
        in_link = 0
    add(page[at:])
    flush()
    if not dropped:
        return out
    # Elements that were never closed drop nothing: the text before each goes where it belongs.
    open_.cut(0)
    whole, done = [], 0
    for n, (_, _, blocks_before, parts_before) in enumerate(dropped):
        whole += out[done:blocks_before]
        done = blocks_before
        if (found := block(parts[dropped[n - 1][3] if n else 0 : parts_before])) is not None:
            whole.append(found)
    return whole + out[done:]


def _place(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


def inputs(found: list[Block]) -> tuple[list[list[int]], list[Counter[int]], np.ndarray]:
    """Hashed path tokens of each block, how often it has each hashed word, and a few plain numbers."""
    paths = [[_place(t, PATH_SIZE) for t in b.path] for b in found]
    bags = [Counter(_place(w, WORD_SIZE) for w in b.text.lower().split()) for b in found]
    dense = np.zeros((len(found), DENSE), np.float32)
    for i, b in enumerate(found):
        n = len(b.text)
        words = b.text.count(" ") + 1
        dense[i] = (
            np.log1p(n) / 6,
            np.log1p(words) / 4,
            min(1.0, b.links / n),
            b.text[-1] in ".!?:;…\"”»",
            (b.text.count(",") + b.text.count(".")) / words,
            i / len(found),
            np.log1p(len(found)) / 5,
            words < 4,
        )
    return paths, bags, dense
