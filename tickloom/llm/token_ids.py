"""Token ids of whole texts by the `tokenizers` library, with each distinct piece encoded once.

A byte-level BPE first cuts a text into pieces (words with a leading space, numbers, signs,
white space) and encodes each piece by itself. `Encoder` finds the pieces of a batch with
NumPy, asks the library for the ids of pieces not met before, and puts the ids together. A
piece encoded alone is cut into itself, so this gives the library's ids for the whole text.
Texts with characters whose class isn't listed here, or with a special token's string, go to
the library whole.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np

from tickloom.llm.words import hashes

#: Pieces remembered by a Python worker, some 30 bytes each; beyond it, it starts anew.
MOST_PIECES = 4_000_000
#: Pieces given to the library at once; what it returns takes far more memory than the ids.
AT_ONCE = 8192
LETTER, NUMBER, BLANK, SIGN = 1, 2, 3, 4

_CLASS = np.full(256, SIGN, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = BLANK
_CLASS[[*range(0x30, 0x3A)]] = NUMBER
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
#: U+00C0 to U+024F are letters, but for the two signs of multiplication and division.
_CLASS[0xC3:0xCA] = LETTER
_KNOWN = np.zeros(256, bool)
_KNOWN[:0x80] = _KNOWN[0x80:0xC0] = _KNOWN[0xC3:0xC9] = True


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.width)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the number of ids before each row (rows + 1)."""
        whole = self._whole(data, at)
        if not whole.any():
            return self._fast(data, at)
        out, sizes = [], np.zeros(len(at) - 1, np.int64)
        edges = np.flatnonzero(np.diff(whole, prepend=~whole[:1], append=~whole[-1:]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if whole[a]:
                texts = [data[at[i] : at[i + 1]].tobytes().decode() for i in range(a, b)]
                got = [np.array(e.ids, self.width) for e in self.library.encode_batch(texts, add_special_tokens=False)]
                sizes[a:b] = [len(x) for x in got]
                out += got
            else:
                ids, ends = self._fast(data[at[a] : at[b]], at[a : b + 1] - at[a])
                sizes[a:b] = np.diff(ends)
                out.append(ids)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])

    def _whole(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows that the library encodes whole."""
        odd = ~_KNOWN[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        odd[lead] |= np.isin(data[lead + 1], (0x97, 0xB7))
        out = np.zeros(len(at) - 1, bool)
        places = [np.flatnonzero(odd)]
        raw = data.tobytes() if (data == 0x3C).any() else b""
        for special in self.special:
            p = raw.find(special)
            while p >= 0:
                places.append(np.array([p]))
                p = raw.find(special, p + 1)
        out[np.searchsorted(at, np.concatenate(places), "right") - 1] = True
        return out

    def _fast(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.width), np.zeros(len(at), np.int64)
        starts = piece_starts(data, at)
        stops = np.append(starts[1:], len(data))
        names, back = np.unique(hashes(data, starts, stops, lower=False), return_inverse=True)
        place = np.searchsorted(self.keys, names)
        new = np.ones(len(names), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != names[inside]
        if new.any():
            if len(self.keys) + len(names) > MOST_PIECES:
                self._forget()
                new[:] = True
            self._learn(data, starts, stops, names, back, np.flatnonzero(new))
            place = np.searchsorted(self.keys, names)
        counts, firsts = self.count[place][back], self.first[place][back]
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(firsts - before[:-1], counts) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, at)]

    def _learn(self, data, starts, stops, names, back, new) -> None:
        example = np.empty(len(names), np.int64)
        example[back] = np.arange(len(back))
        raw = data.tobytes()
        pieces = [raw[a:b].decode() for a, b in zip(starts[example[new]].tolist(), stops[example[new]].tolist(), strict=True)]
        sizes, ids = [], [self.ids]
        for n in range(0, len(pieces), AT_ONCE):
            got = [e.ids for e in self.library.encode_batch_fast(pieces[n : n + AT_ONCE], add_special_tokens=False)]
            sizes += map(len, got)
            ids.append(np.fromiter((i for x in got for i in x), self.width))
        firsts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate(ids)
        where = np.searchsorted(self.keys, names[new])
        self.keys = np.insert(self.keys, where, names[new])
        self.first = np.insert(self.first, where, firsts)
        self.count = np.insert(self.count, where, sizes)


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First byte of every piece: contraction, or letters, numbers or signs with at most one space before, or white space."""
    kind = _CLASS[data]
    inner = (data >= 0x80) & (data < 0xC0)  # further bytes of a character: all known ones are letters
    kind[inner] = LETTER
    row = np.zeros(len(data) + 1, bool)
    row[at] = True
    start = np.ones(len(data), bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= row[:-1]
    blank = kind == BLANK
    # The last blank before something else stands alone, or as a space begins the next piece.
    last = np.zeros(len(data), bool)
    last[:-1] = blank[:-1] & ~blank[1:] & ~row[1:-1]
    joined = np.zeros(len(data), bool)
    joined[1:] = last[:-1] & (data[:-1] == 0x20)
    start = (start & ~joined) | last
    # 's 't 're 've 'm 'll 'd
    quote = np.flatnonzero((data == 0x27) & start)
    quote = quote[quote + 1 < len(data)]
    quote = quote[~row[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        one = data[quote + 1]
        two = np.where((quote + 2 < len(data)) & ~row[np.minimum(quote + 2, len(data))], data[np.minimum(quote + 2, len(data) - 1)], 0)
        size = np.where(np.isin(one, list(b"stmd")), 1, 0)
        for a, b in (b"re", b"ve", b"ll"):
            size = np.where((one == a) & (two == b), 2, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + 1 + size
        after = after[after < len(data)]
        start[after[~row[after] & (kind[after] == LETTER)]] = True
    return np.flatnonzero(start)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
