"""Words and shingles of whole Arrow text columns as NumPy arrays, without a Python object per word.

A word is a run of bytes other than the six ASCII white space bytes, so the rule is the
same on bytes and on code points. Hashes are 64 bits wide; two different words or
shingles share a hash with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: What parts words when punctuation doesn't count: every ASCII byte but letters and digits.
MARKS = np.ones(256, bool)
MARKS[0x80:] = False
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes worked on at once; temporaries take some forty times as much.
CHUNK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C55)
STEP = np.uint64(0xD6E8FEB86659FD93)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a string column; NULL is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each row (rows + 1)."""
    word = ~gap[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = at[(at > 0) & (at < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        _TABLES[:] = [_powers(BASE, n), _powers(np.uint64(pow(int(BASE), -1, 1 << 64)), n)]
    return _TABLES


def hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash per word, of its bytes with A-Z lower-cased."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(stops, starts[first] + CHUNK, "right")))
        a, b = int(starts[first]), int(stops[last - 1])
        up, down = _tables(max(b - a, CHUNK) + 1)
        raw = data[a:b]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((LOWER[raw] if lower else raw).astype(np.uint64) * up[: b - a] + up[: b - a], out=sums[1:])
        s, e = starts[first:last] - a, stops[first:last] - a
        out[first:last] = mix((sums[e] - sums[s]) * down[s])
        first = last
    return out


def shingles(words: np.ndarray, at: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a row, in order, and the number of runs before each row.

    With `short`, a row with fewer words (but one at least) has its whole sequence as one run.
    """
    counts = np.diff(at)
    runs = np.maximum(counts - size + 1, 0)
    total = len(words) - size + 1
    if total > 0:
        whole = np.zeros(total, np.uint64)
        for j in range(size):
            whole = whole * STEP + words[j : j + total]
        place = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]) if len(runs) else runs, runs) + np.arange(runs.sum())
        out = mix(whole[place])
    else:
        out = np.zeros(0, np.uint64)
    if not short:
        return out, np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    few = np.flatnonzero((counts > 0) & (counts < size))
    kept = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    extra = np.empty(len(few), np.uint64)
    for n, row in enumerate(few):
        value = np.uint64(counts[row])
        for w in words[at[row] : at[row + 1]]:
            value = np.uint64((int(value) * int(STEP) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        extra[n] = value
    out = np.insert(out, kept[few], mix(extra))
    runs = runs.copy()
    runs[few] = 1
    return out, np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted, once each, and the number before each row."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(at)))


def slices(batch: pa.RecordBatch, column: str, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each; a longer single text stays whole."""
    if not batch.num_rows:
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def nested(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column over flat values."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, kind))
