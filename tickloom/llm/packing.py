"""Pack documents into fixed-length sequences by shortest-pack-first over the length histogram.

A document's ids are cut into pieces of `size` ids and a rest. Only the histogram of piece lengths
(at most `size` rows) reaches the driver. There, lengths are placed longest first, each into the packs
that hold least so far; what is updated is a count per pattern of lengths, never a pack by itself, so
the work depends on `size` and not on the data. A pattern's places take the pieces of their length by
rank. Ranks come from counts per task and length: no piece is sorted, and one very common length is
never gathered in one task. Checksums are made where the ids are; ids travel to their rank only where they are
asked for.

Cases: a NULL or empty text is one piece of the end id; a NULL id is carried; repeated rows are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.staging import staged
from tickloom.llm.token_ids import default_path, encoder
from tickloom.llm.words import slices, text_bytes
from tickloom.llm.workers import ship

PIECE = "doc_id long, start long, length int, doc_tokens long, ids_crc32 long, task int, place long"


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths that share a sequence) and how many sequences have each."""
    open_packs: dict[int, Counter] = defaultdict(Counter)  # by what they hold
    holds: list[int] = []  # heap of keys of open_packs
    done: Counter = Counter()

    def put(pattern: tuple[int, ...], held: int, count: int) -> None:
        if held == size:
            done[pattern] += count
            return
        if not open_packs[held]:
            heapq.heappush(holds, held)
        open_packs[held][pattern] += count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while holds and not open_packs[holds[0]]:
                heapq.heappop(holds)
            if holds and holds[0] + length <= size:
                held = holds[0]
                pattern, count = next(iter(open_packs[held].items()))
                del open_packs[held][pattern]
                each = min((size - held) // length, max(1, left // count))
                if left < count:
                    put(pattern, held, count - left)
                    count = left
                put(pattern + (length,) * each, held + length * each, count)
                left -= count * each
            else:  # as many as fit together, so that equal lengths need no pack each
                each = min(size // length, left)
                put((length,) * each, length * each, left // each)
                left -= left // each * each
    for packs in open_packs.values():
        done.update(packs)
    return sorted(done.items(), reverse=True)


def places(patterns: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of pieces of one length with neighbouring ranks: length and first rank as one sorted number, first sequence, offset."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length << 44 | taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return tuple(np.array(x, np.int64) for x in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 3


def token_pieces(docs: DataFrame, path: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The pieces of every document with their checksums (of little-endian 32-bit ids) and, on demand, ids, and each
    piece's rank among those of its length in its task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        seen = np.zeros(size + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = coder.encode(*text_bytes(part.column("text")))
                rows = np.diff(at)
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
                n = -(-(rows + 1) // size)
                row = np.repeat(np.arange(len(rows)), n)
                start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * size
                length = np.minimum(size, rows[row] + 1 - start)
                order = np.argsort(length, kind="stable")
                in_order = length[order]
                run = np.arange(len(order)) - np.searchsorted(in_order, in_order)
                place = np.empty(len(order), np.int64)
                place[order] = seen[in_order] + run
                seen += np.bincount(length, minlength=size + 1)
                first = at[row] + start
                ends = list(zip(first.tolist(), (first + length).tolist(), strict=True))
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in ends]
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(row)),
                    "start": pa.array(start),
                    "length": pa.array(length, pa.int32()),
                    "doc_tokens": pa.array(rows[row] + 1),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "task": pa.array(np.full(len(row), task), pa.int32()),
                    "place": pa.array(place),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].tobytes() for a, b in ends], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def pack(
    docs: DataFrame, path: str | None = None, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset and, on demand, ids (little-endian, 2 bytes each
    where the vocabulary allows)."""
    pieces = staged(token_pieces(docs, path or default_path(), size, end_id, id_col, text_col, with_ids), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, sequences, offsets = places(pack_histogram(histogram, size), size)

    kept = [c for c in pieces.columns if c not in ("task", "place")]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("length").to_numpy().astype(np.int64) << 44 | batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            seats = [pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *seats], [*kept, "sequence_id", "offset"])

    ranked = pieces.join(base, ["task", "length"]).withColumn("rank", F.col("place") + F.col("base"))
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select(*kept, "rank").mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame) -> DataFrame:
    """The places of all pieces, with checksums for ids."""
    out = pack(docs, with_ids=False).withColumn("length", F.col("length").cast("long"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 ids."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
