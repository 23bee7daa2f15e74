"""Passages of a benchmark in documents: SimHash of item-sized windows, Hamming blocks, exact similarity.

Words are lower-cased runs of letters and digits. A window has as many words as an item; its shingles
are its five-word runs (an item with fewer words is one run). Windows that share no shingle with any
item of their size can't be similar and are passed over. Every other window has a 64-bit SimHash of its
shingles. Four indexes, one per 16-bit block, list each item under all values within a quarter of the
radius of its own block: two fingerprints within the radius are that close in one block at least, so
the indexes return all of them. Each candidate is then compared exactly: the sum of the smaller
shingle counts over the sum of the larger ones must reach `least`.

A document with fewer words than an item has one window for it, the whole document. It is compared with every
item of which it has as many shingles as `least` asks for, without fingerprints.

The benchmark is the stated query set. It is read in blocks of at most `items_at_once` items and about
16 MB, each block going with one pass over the documents; the documents are never shuffled.

Cases: NULL, empty and word-free texts match nothing, as document or as item; repeated rows are each
judged; among several windows the most similar, then the first, is reported; NULL ids are carried; empty
tables give no hits; other columns are ignored by `leaks` and carried by `decontaminate`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.words import MARKS, hashes, shingles, slices, spans, text_bytes
from tickloom.llm.workers import ship

SHINGLE = 5
BLOCK_BITS, BLOCKS = 16, 4
BITS_AT_ONCE = 1 << 15
_LOW = np.uint64(0xFFFF)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, and the number of words before each row."""
    data, at = text_bytes(pc.utf8_lower(column))
    starts, stops, rows = spans(data, at, MARKS)
    return hashes(data, starts, stops), rows


def fingerprints(values: np.ndarray, first: np.ndarray, runs: int) -> np.ndarray:
    """SimHash of `runs` values from each place of `first` (ascending) on."""
    out = np.empty(len(first), np.uint64)
    n = 0
    while n < len(first):
        m = max(n + 1, int(np.searchsorted(first, first[n] + BITS_AT_ONCE - runs, "right")))
        a, b = int(first[n]), int(first[m - 1]) + runs
        ones = np.zeros((b - a + 1, 64), np.int32)
        np.cumsum(np.unpackbits(values[a:b].view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.int32, out=ones[1:])
        at = first[n:m] - a
        out[n:m] = np.packbits(2 * (ones[at + runs] - ones[at]) > runs, axis=1).view(np.uint64)[:, 0]
        n = m
    return out


def similarity(one: np.ndarray, two: np.ndarray) -> float:
    """Sum of smaller over sum of larger counts; both sorted."""
    names, counts = np.unique(one, return_counts=True)
    others, times = np.unique(two, return_counts=True)
    _, i, j = np.intersect1d(names, others, assume_unique=True, return_indices=True)
    both = int(np.minimum(counts[i], times[j]).sum())
    return both / (len(one) + len(two) - both)


def _near(bits: int) -> np.ndarray:
    """All 16-bit masks with at most so many ones."""
    return np.array([sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(BLOCK_BITS), n)], np.uint64)


@dataclass
class Items:
    """Items of the benchmark: ids, shingles and words of each. What is derived from them is built in each worker."""

    ids: list[int | None]
    shingles: list[np.ndarray]
    sizes: np.ndarray
    radius: int

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ids", "shingles", "sizes", "radius")}

    @cached_property
    def known(self) -> tuple[np.ndarray, np.ndarray]:
        """All shingles in order, and the item of each."""
        values = np.concatenate([*self.shingles, np.zeros(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        return values[order], np.repeat(np.arange(len(self.ids)), [len(x) for x in self.shingles])[order]

    @cached_property
    def filter(self) -> np.ndarray:
        out = np.zeros(1 << 20, bool)
        out[self.known[0] & np.uint64((1 << 20) - 1)] = True
        return out

    @cached_property
    def prints(self) -> np.ndarray:
        return np.array([fingerprints(x, np.zeros(1, np.int64), len(x))[0] for x in self.shingles], np.uint64)

    @cached_property
    def index(self) -> np.ndarray:
        """Block, value, size and item as one number, sorted."""
        masks = _near(self.radius // BLOCKS)
        entries = [np.zeros(0, np.uint64)]
        for block in range(BLOCKS):
            value = (self.prints >> np.uint64(BLOCK_BITS * block)) & _LOW
            key = self._key(block, value[:, None] ^ masks, self.sizes[:, None])
            entries.append(((key << np.uint64(12)) | np.arange(len(self.ids), dtype=np.uint64)[:, None]).ravel())
        return np.sort(np.concatenate(entries))

    def _key(self, block: int, value: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (np.uint64(block) << np.uint64(48)) | (value << np.uint64(32)) | size.astype(np.uint64)

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (fingerprint, item of that size) within the radius."""
        pairs = []
        for block in range(BLOCKS):
            value = (prints >> np.uint64(BLOCK_BITS * block)) & _LOW
            key = self._key(block, value, np.full(len(prints), size)) << np.uint64(12)
            lo, hi = np.searchsorted(self.index, key), np.searchsorted(self.index, key + np.uint64(1 << 12))
            n = hi - lo
            place = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs.append(np.repeat(np.arange(len(prints)), n) << 12 | (self.index[place] & np.uint64(0xFFF)).astype(np.int64))
        pairs = np.unique(np.concatenate(pairs))
        window, item = pairs >> 12, pairs & 0xFFF
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
        return window[close], item[close]


def read_items(rows: list, radius: int) -> Items:
    column = pa.array([r[1] for r in rows], pa.string())
    words, at = words_of(column)
    n = np.diff(at)
    kept = np.flatnonzero(n > 0)
    runs = [shingles(words[at[i] : at[i + 1]], np.array([0, n[i]]), min(SHINGLE, int(n[i])))[0] for i in kept]
    return Items([rows[i][0] for i in kept], runs, n[kept], radius)


def find(items: Items, column: pa.Array, least: float) -> list[tuple[int, int, int, float]]:
    """(row, item, first word, similarity) of the best window for each row and item."""
    words, at = words_of(column)
    known, owners = items.known
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for width in sorted({min(SHINGLE, int(s)) for s in items.sizes}):
        values, before = shingles(words, at, width)
        seen = np.flatnonzero(items.filter[values & np.uint64((1 << 20) - 1)])
        lo, hi = np.searchsorted(known, values[seen]), np.searchsorted(known, values[seen], "right")
        n = hi - lo
        owner = owners[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        spot, sizes = np.repeat(seen, n), items.sizes[owner]
        for size in np.unique(sizes):
            if min(SHINGLE, size) != width:
                continue
            runs = int(size) - width + 1
            near, far = spot[sizes == size], owner[sizes == size]
            held = np.searchsorted(before, near, "right") - 1
            have = before[held + 1] - before[held]
            short = (have < runs) & (have >= least * runs - 1e-9)
            pairs, hits = np.unique(held[short] * len(items.ids) + far[short], return_counts=True)
            for pair, both in zip(pairs.tolist(), hits.tolist(), strict=True):
                r, i = divmod(pair, len(items.ids))
                whole = values[before[r] : before[r + 1]]
                # `both` counts no less than the shared shingles.
                if both >= least * (len(whole) + runs) / (1 + least) - 1e-9 and (alike := similarity(whole, items.shingles[i])) >= least:
                    best[r, i] = alike, 0
            touched = np.unique(near)
            row = np.searchsorted(before, touched, "right") - 1
            low, high = np.maximum(touched - runs + 1, before[row]), np.minimum(touched, before[row + 1] - runs)
            marks = np.zeros(len(values) + 1, np.int32)
            ok = high >= low
            np.add.at(marks, low[ok], 1)
            np.add.at(marks, high[ok] + 1, -1)
            first = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
            if not len(first):
                continue
            window, item = items.within(fingerprints(values, first, runs), int(size))
            for w, i in zip(window.tolist(), item.tolist(), strict=True):
                start = int(first[w])
                alike = similarity(values[start : start + runs], items.shingles[i])
                if alike >= least:
                    r = int(np.searchsorted(before, start, "right")) - 1
                    found = (alike, -(start - int(before[r])))
                    best[r, i] = max(best.get((r, i), found), found)
    return [(r, i, -start, alike) for (r, i), (alike, start) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, items_at_once: int, radius: int) -> Iterator[Items]:
    """The benchmark's items, some at a time on the driver."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // (items_at_once)), -(-size // (16 << 20)))
    for block in range(blocks):
        found = sorted(map(tuple, rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()), key=lambda x: (x[0] is None, x))
        for first in range(0, max(len(found), blocks == 1), items_at_once):
            yield read_items(found[first : first + items_at_once], radius)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 19, items_at_once: int = 1024, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, item_id, start (word), n_words and similarity of the best window for each document and item it holds."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in item_blocks(benchmark, item_col, "text", items_at_once, radius):

        def scan(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    if hits := find(items, part.column("text"), least):
                        row, item, start, alike = zip(*hits, strict=True)
                        ids = pa.array([items.ids[i] for i in item], pa.int64())
                        _, at = words_of(part.column("text"))
                        size = pa.array(np.minimum(items.sizes[list(item)], np.diff(at)[list(row)]))
                        yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), ids, pa.array(start, pa.int64()), size, pa.array(alike)], ["doc_id", "item_id", "start", "n_words", "similarity"])

        found = rows.mapInArrow(scan, "doc_id long, item_id long, start long, n_words long, similarity double")
        out = found if out is None else out.union(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 19, items_at_once: int = 1024, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of `docs`, all columns, that hold no item."""
    ship(docs.sparkSession)
    for items in item_blocks(benchmark, item_col, "text", items_at_once, radius):

        def keep(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    clean = np.ones(part.num_rows, bool)
                    clean[[hit[0] for hit in find(items, part.column(text_col), least)]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of the benchmark, with the item and the window."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
