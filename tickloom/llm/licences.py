"""Licence scan: normalised text against templates by the Dice coefficient over word bigrams.

Words are lower-cased runs of letters and digits. Three kinds of passages of a text are compared: each line,
each block (lines between empty ones) and the whole text. With a and b bigrams, repeats counted, the coefficient
is 2 common / (a + b); it can't reach `least` unless 2 min(a, b) >= least (a + b), nor with fewer bigrams of any
template than that asks for. These size bounds leave few templates, which are compared exactly. The best template
of a passage counts; per document and licence the best passage does.

With `anywhere`, every run of bigrams inside a text is a passage too, whatever lines and blocks it crosses. A run
that can reach `least` begins and ends with a bigram of the template, has least / (2 - least) of its bigrams and
is at most (2 - least) / least times as long, so only such runs are counted, around known bigrams. Of runs that
overlap, the most similar counts (then the longest, then the licence that is first by name).

The templates are the stated query set and go to every task with the code; texts are never shuffled.

Cases: NULL, empty and word-free texts, and texts of one word, have no licence; ties go to the licence that is
first by name; repeated rows are each scanned; NULL ids are carried; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.words import MARKS, hashes, shingles, slices, spans, text_bytes
from tickloom.llm.workers import ship

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {0} of the License, or (at your option) any later version."""
#: Published licence notices (fixed values): the short forms in use, and the longer standard ones.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", _APACHE),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "Released under the GNU GPL version 2.", _GPL.format(2)),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL version 3.", _GPL.format(3)),
    "ISC": ("Released under the ISC License.", _ISC),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", _MIT),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
SCOPES = ("line", "block", "text", "window")
_FILTER = 1 << 16


def bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bigram hashes, their first word's byte, the bigrams before each row, and the bytes of the lower-cased texts."""
    data, at = text_bytes(pc.utf8_lower(column))
    starts, stops, rows = spans(data, at, MARKS)
    values, before = shingles(hashes(data, starts, stops), rows, 2)
    row = np.repeat(np.arange(len(at) - 1), np.diff(before))
    word = np.arange(len(values)) - before[row] + rows[row]
    return values, np.column_stack([starts[word], starts[word + 1]]) if len(values) else np.zeros((0, 2), np.int64), before, data


class Templates:
    """Bigram counts of all templates. What is derived from them is built in each worker."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]]) -> None:
        named = sorted((name, text) for name, texts in templates.items() for text in texts)
        values, _, before, _ = bigrams(pa.array([text for _, text in named], pa.string()))
        self.names = [name for name, _ in named]
        self.counts = [Counter(values[a:b].tolist()) for a, b in zip(before[:-1], before[1:], strict=True)]
        self.sizes = np.diff(before)

    @cached_property
    def known(self) -> np.ndarray:
        return np.array(sorted({v for c in self.counts for v in c}), np.uint64)

    @cached_property
    def members(self) -> np.ndarray:
        """Whether each template (row) has each known bigram (column)."""
        return np.array([np.isin(self.known, np.array(list(c), np.uint64)) for c in self.counts]).reshape(len(self.counts), -1)

    @cached_property
    def filter(self) -> np.ndarray:
        out = np.zeros(_FILTER, bool)
        out[self.known & np.uint64(_FILTER - 1)] = True
        return out

    def best(self, values: np.ndarray, hits: int, least: float) -> tuple[float, str] | None:
        """The most similar template of a passage with so many bigrams of any template."""
        n, found = len(values), None
        near = np.flatnonzero((2 * np.minimum(self.sizes, hits) >= least * (self.sizes + n)) & (2 * n >= least * (self.sizes + n)))
        if not len(near):
            return None
        mine = Counter(values.tolist())
        for t in near.tolist():
            dice = 2 * sum(min(c, mine[v]) for v, c in self.counts[t].items()) / (n + int(self.sizes[t]))
            if dice >= least and (found is None or dice > found[0]):
                found = dice, self.names[t]
        return found


def _passages(data: np.ndarray, place: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """For lines, blocks and texts: the passage of each bigram, -1 where its two words lie in two passages."""
    breaks = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(breaks, place)
    gaps = np.diff(breaks) > 1
    blank = np.zeros(len(breaks), bool)  # a break that follows nothing but white space since the one before
    for k in np.flatnonzero(gaps):
        inside = data[breaks[k] + 1 : breaks[k + 1]]
        blank[k + 1] = bool(np.isin(inside, (0x20, 0x09, 0x0B, 0x0C, 0x0D)).all())
    blank[1:] |= ~gaps
    block = np.searchsorted(breaks[blank], place)
    out = []
    for unit in (line, block):
        name = row * (len(breaks) + 1) + unit[:, 0]
        out.append(np.where(unit[:, 0] == unit[:, 1], name, -1))
    return [*out, row]


def _windows(templates: Templates, values: np.ndarray, row: np.ndarray, hits: np.ndarray, least: float) -> Iterator[tuple[int, str, float]]:
    """(row, licence, coefficient) of the best runs of bigrams that don't overlap; `hits` are the places of known bigrams."""
    codes, ends = np.searchsorted(templates.known, values[hits]), np.searchsorted(row, row[hits], "right")
    found = defaultdict(list)
    for t, size in enumerate(templates.sizes.tolist()):
        mine = np.flatnonzero(templates.members[t, codes]) if size else []
        if not len(mine):
            continue
        place = hits[mine]
        longest, fewest = math.floor(size * (2 - least) / least + 1e-9), math.ceil(size * least / (2 - least) - 1e-9)
        stop = np.searchsorted(place, np.minimum(place + longest, ends[mine]))
        for k in np.flatnonzero(stop - np.arange(len(place)) >= fewest).tolist():
            left, common, best = dict(templates.counts[t]), 0, (0.0, 0)
            for at, value in zip(place[k : stop[k]].tolist(), values[place[k : stop[k]]].tolist(), strict=True):
                if left[value]:
                    left[value] -= 1
                    common += 1
                    n = at - int(place[k]) + 1
                    best = max(best, (2 * common / (n + size), n))
            if best[0] >= least:
                found[int(row[place[k]])].append((-best[0], -best[1], templates.names[t], int(place[k])))
    for r, runs in found.items():
        taken: list[tuple[int, int]] = []
        for dice, n, name, first in sorted(runs):
            at = bisect(taken, (first, 0))
            if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or taken[at][0] >= first - n):
                taken.insert(at, (first, first - n))
                yield r, name, -dice


def scan(templates: Templates, column: pa.Array, least: float, anywhere: bool = False) -> list[tuple[int, str, str, float]]:
    """(row, licence, scope, coefficient): the best passage of each row and licence."""
    values, place, before, data = bigrams(column)
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    maybe = templates.filter[values & np.uint64(_FILTER - 1)]
    maybe[maybe] = np.isin(values[maybe], templates.known)
    touched = np.unique(row[maybe])
    if not len(touched):
        return []
    best: dict[tuple[int, str], tuple[float, int]] = {}
    rows = np.isin(row, touched)
    values, place, row, maybe = values[rows], place[rows], row[rows], maybe[rows]
    for scope, passage in enumerate(_passages(data, place, row)):
        used = np.flatnonzero(passage >= 0)
        edges = np.append(np.flatnonzero(np.diff(passage[used], prepend=-1)), len(used))
        hits = np.add.reduceat(maybe[used], edges[:-1], dtype=np.int64) if len(used) else np.zeros(0, np.int64)
        for k in np.flatnonzero(2 * hits >= least * (hits + np.diff(edges))).tolist():
            mine = used[edges[k] : edges[k + 1]]
            if found := templates.best(values[mine], int(hits[k]), least):
                key = int(row[mine[0]]), found[1]
                best[key] = max(best.get(key, (0.0, 0)), (found[0], -scope))
    if anywhere:
        for r, name, dice in _windows(templates, values, row, np.flatnonzero(maybe), least):
            best[r, name] = max(best.get((r, name), (0.0, 0)), (dice, -3))
    return [(r, name, SCOPES[-scope], dice) for (r, name), (dice, scope) in sorted(best.items())]


def licences(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", anywhere: bool = False) -> DataFrame:
    """doc_id, licence (the best one, or NULL), scope, dice, and found: every licence of the text by name. One row per document."""
    ship(docs.sparkSession)
    known = Templates(TEMPLATES if templates is None else templates)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found: list[list[tuple[str, str, float]]] = [[] for _ in range(part.num_rows)]
                for row, *rest in scan(known, part.column("text"), least, anywhere):
                    found[row].append(tuple(rest))
                best = [max(f, key=lambda x: x[2]) if f else (None, None, None) for f in found]
                columns = [pa.array(c, k) for c, k in zip(zip(*best, strict=True), (pa.string(), pa.string(), pa.float64()), strict=True)]
                names = pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, names], ["doc_id", "licence", "scope", "dice", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(read, "doc_id long, licence string, scope string, dice double, found array<string>")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, licence, scope, dice and found of every document."""
    return licences(spark.read.parquet(f"{sf_dir}/documents.parquet"), anywhere=True)
