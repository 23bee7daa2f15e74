"""Vector codes: parts of integer vectors, each replaced by the nearest entry of its position's codebook.

Components become floor(scale * x); all arithmetic after that is on integers and exact. A codebook starts
from the parts of the vectors of least id and moves to its parts' means (rounded down) a fixed number of
times. What makes a round cheap is the layout that is stored once before the rounds:

1. Blocks. A task sorts some 65,536 parts of one position along a Hilbert curve and cuts them into flat
   blocks of 64 neighbours. A block holds its parts as 32-bit integers, its bounding box (least and greatest
   component per place) and its sums. Nothing is shuffled for that.
2. Shortlists. In a round, distances come from the boxes alone. The entry nearest to a box's middle is its best;
   another entry is compared with it at the box's corner that favours that entry most. If even this corner is
   nearer to the best one, so is every part of the block, and the entry is off the block's list. One entry left:
   the block's stored sums are its contribution, no part is looked at.
3. Kernels. Otherwise the block's parts are compared with the few entries of its shortlist, in 64-bit integers.

A task returns one row per (position, entry), with count and sums, so a round shuffles a few rows per task and
the driver holds the codebooks alone (parts x entries x part length numbers). The codes are made in a last
pass over the vectors, which sorts and prunes in the same way and needs no shuffle to bring parts together.

Cases: rows whose vector is NULL or holds NULL, NaN or an infinite component are dropped. All others are kept,
repeated rows and ids too (equal ids are ordered by their vectors; a NULL id comes after all others). The
vectors' length is that of most kept rows (the longer one on a tie) and must be a multiple of `parts`; a kept
row of another length has NULL as code and error and moves no codebook. Fewer vectors than entries give
fewer entries; an empty table gives no rows. NULL labels are summed together. A component must be within
2**26 / scale, else the query fails and says so. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.staging import staged
from tickloom.llm.workers import ship

BLOCK = 64
#: Vectors sorted together; a block is as tight as its chunk is large.
CHUNK = 1 << 16
#: Bytes of components in a chunk at most.
CHUNK_BYTES = 32 << 20
MOST = 1 << 26
FINITE = 1.7976931348623157e308


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of every point on a Hilbert curve through the box of all of them; at most 16 dimensions count."""
    n, width = points.shape
    width = min(width, 16)
    if not n or not width:
        return np.zeros(n, np.uint64)
    bits = min(8, 63 // width)
    low, high = points[:, :width].min(0), points[:, :width].max(0)
    x = np.ascontiguousarray((((points[:, :width] - low) << bits) // (high - low + 1)).T.astype(np.uint32))
    # Inverse undoing of the curve's reflections and exchanges, from the highest bit down.
    for bit in range(bits - 1, 0, -1):
        mask, below = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(width):
            hit = (x[i] & mask) > 0
            swap = np.where(hit, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(hit, below, swap)
            x[i] ^= swap
    for i in range(1, width):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) > 0, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    key = np.zeros(n, np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(width):
            key = key << np.uint64(1) | ((x[i] >> np.uint32(bit)) & np.uint32(1)).astype(np.uint64)
    return key


@dataclass
class Blocks:
    """Flat blocks of one chunk: `order` lists the chunk's vectors by position, block and place."""

    part: np.ndarray  # position of each block
    first: np.ndarray  # first place of each block in `order` and `points`, and the end
    order: np.ndarray
    points: np.ndarray  # (parts x vectors, part length), 64-bit
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def blocks_of(vectors: np.ndarray, parts: int) -> Blocks:
    n, length = vectors.shape[0], vectors.shape[1] // parts
    cuts = np.arange(0, n, BLOCK)
    order, points = [], []
    for p in range(parts):
        own = vectors[:, p * length : (p + 1) * length]
        along = np.argsort(hilbert_keys(own), kind="stable")
        order.append(along)
        points.append(own[along])
    points = np.concatenate(points) if n else np.zeros((0, length), np.int64)
    first = (np.arange(parts)[:, None] * n + cuts).ravel()
    if n and length:
        low, high, sums = (f.reduceat(points, first, axis=0) for f in (np.minimum, np.maximum, np.add))
    else:
        low = high = sums = np.zeros((len(first), length), np.int64)
    return Blocks(np.repeat(np.arange(parts), len(cuts)), np.append(first, parts * n), np.concatenate(order) if n else np.zeros(0, np.int64), points, low, high, sums)


def shortlists(part: np.ndarray, low: np.ndarray, high: np.ndarray, books: np.ndarray) -> np.ndarray:
    """For every block, which entries can be nearest to a point of its box (blocks x entries)."""
    out = np.empty((len(part), books.shape[1]), bool)
    for k in range(0, len(part), 4096):
        entries, lo, hi = books[part[k : k + 4096]], low[k : k + 4096, None], high[k : k + 4096, None]
        middle = ((2 * entries - lo - hi) ** 2).sum(2).argmin(1)
        best = entries[np.arange(len(entries)), middle][:, None]
        corner = np.where(entries > best, hi, lo)  # where the box is nearest to the entry and farthest from the best one
        out[k : k + 4096] = ((corner - entries) ** 2).sum(2) <= ((corner - best) ** 2).sum(2)
    return out


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower one on a tie) and its squared distance, for every point."""
    far = np.zeros((len(entries), len(points)), np.int64)
    for d in range(points.shape[1]):
        far += (points[:, d] - entries[:, d, None]) ** 2
    pick = far.argmin(0)
    return pick, far[pick, np.arange(len(points))]


def whole_numbers(column: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of that length, and their components as integers."""
    if pa.types.is_large_list(column.type) or pa.types.is_list(column.type):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    else:
        raise TypeError(f"vectors must be arrays, not {column.type}")
    rows = np.flatnonzero(sizes == length)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * scale).reshape(len(rows), length)
    if x.size and np.abs(x).max() > MOST:
        raise ValueError(f"a component is beyond {MOST // scale}, where distances may leave 64 bits")
    return rows, x.astype(np.int64)


def kept_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, vec, label of the rows whose components are all finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    return rows.where(F.forall("vec", lambda x: F.abs(x.cast("double")) <= F.lit(FINITE)))  # NULL and NaN don't pass


def chunks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to a chunk."""
    most = max(BLOCK, min(CHUNK, CHUNK_BYTES // (8 * max(1, length))))
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, most - rows))
            rows, at = rows + held[-1].num_rows, at + held[-1].num_rows
            if rows == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def stored_blocks(rows: DataFrame, length: int, parts: int, scale: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, length):
            b = blocks_of(whole_numbers(chunk.column("vec"), length, scale)[1], parts)
            raw = lambda x, kind: pa.array([y.tobytes() for y in x.astype(kind)], pa.binary())
            flat = b.points.astype("<i4")
            points = pa.array([flat[i:j].tobytes() for i, j in zip(b.first[:-1].tolist(), b.first[1:].tolist(), strict=True)], pa.binary())
            out = [pa.array(b.part.astype(np.int32)), raw(b.low, "<i4"), raw(b.high, "<i4"), raw(b.sums, "<i8"), points]
            for k in range(0, len(b.part), 512):
                yield pa.RecordBatch.from_arrays([x.slice(k, 512) for x in out], ["part", "low", "high", "sums", "points"])

    return staged(rows.select("vec").mapInArrow(build, "part int, low binary, high binary, sums binary, points binary"), "blocks")


def _numbers(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64).reshape(-1, width)


def round_sums(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Count and componentwise sums of the parts nearest to every entry (positions x entries x (1 + part length))."""
    parts, size, width = books.shape
    names = ["part", "entry", *(f"s{d}" for d in range(width + 1))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            part = batch.column("part").to_numpy().astype(np.int64)
            low, high, sums = (_numbers(batch.column(c), k, width) for c, k in (("low", "<i4"), ("high", "<i4"), ("sums", "<i8")))
            short = shortlists(part, low, high, books)
            few = short.sum(1)
            points = batch.column("points")
            counts = pa.compute.binary_length(points).to_numpy() // (4 * width)
            one = np.flatnonzero(few == 1)
            np.add.at(total, (part[one], short[one].argmax(1)), np.column_stack([counts[one], sums[one]]))
            for k in np.flatnonzero(few > 1).tolist():
                own = np.frombuffer(points[k].as_buffer(), "<i4").astype(np.int64).reshape(-1, width)
                listed = np.flatnonzero(short[k])
                pick, _ = nearest(own, books[part[k], listed])
                chosen = (pick == np.arange(len(listed))[:, None]).astype(np.int64)
                total[part[k], listed, 0] += chosen.sum(1)
                total[part[k], listed, 1:] += chosen @ own
        p, e = np.nonzero(total[:, :, 0])
        columns = [p.astype(np.int32), e.astype(np.int32), *total[p, e].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    schema = "part int, entry int, " + ", ".join(f"{c} long" for c in names[2:])
    out = np.zeros((parts, size, width + 1), np.int64)
    for r in blocks.mapInArrow(add, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect():
        out[r["part"], r["entry"]] = r[2:]  # parts x entries rows at most
    return out


def first_books(rows: DataFrame, length: int, parts: int, entries: int, scale: int) -> np.ndarray:
    """The parts of the `entries` vectors of least id (positions x entries x part length)."""
    own = rows.where(F.size("vec") == length)
    least = own.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").toArrow()
    _, x = whole_numbers(least.column("vec").combine_chunks(), length, scale)
    return np.ascontiguousarray(x.reshape(len(x), parts, length // parts).transpose(1, 0, 2))


def trained_books(rows: DataFrame, length: int, parts: int, entries: int, rounds: int, scale: int) -> np.ndarray:
    books = first_books(rows, length, parts, entries, scale)
    if not books.size:
        return books
    blocks = stored_blocks(rows, length, parts, scale)
    for _ in range(rounds):
        total = round_sums(blocks, books)
        moved = np.where(total[:, :, :1] > 0, total[:, :, 1:] // np.maximum(1, total[:, :, :1]), books)
        if (moved == books).all():  # a further round would change nothing either
            break
        books = moved
    return books


def encoded(rows: DataFrame, books: np.ndarray, length: int, scale: int) -> DataFrame:
    """vec_id, label, code (one index per position, as bytes), error."""
    parts, size, width = books.shape

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, length):
            where, x = whole_numbers(chunk.column("vec"), length, scale)
            b = blocks_of(x, parts)
            n = len(where)
            picks, far = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            short = shortlists(b.part, b.low, b.high, books)
            for k, p in enumerate(b.part.tolist()):
                i, j = b.first[k], b.first[k + 1]
                listed = np.flatnonzero(short[k])
                pick, distance = nearest(b.points[i:j], books[p, listed])
                picks[b.order[i:j], p] = listed[pick]
                far[b.order[i:j]] += distance
            back = np.full(chunk.num_rows, -1)
            back[where] = np.arange(n)
            back = pa.array(back, mask=back < 0)
            code = pa.array([y.tobytes() for y in picks], pa.binary()).take(back)
            for k in range(0, chunk.num_rows, 8192):
                yield pa.RecordBatch.from_arrays([x.slice(k, 8192) for x in (chunk.column("vec_id"), chunk.column("label"), code, pa.array(far).take(back))], ["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(encode, f"vec_id long, label {label}, code binary, error long")


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks (positions x entries x part length)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per position")
    ship(vectors.sparkSession)
    rows = kept_rows(vectors, id_col, vec_col, label_col)
    length = max(((r["n"], r["size"]) for r in _lengths(rows)), default=(0, 0))[1]
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    books = trained_books(rows, length, parts, entries, rounds, scale)
    if not books.size:  # no rows, or only empty vectors
        books = np.zeros((parts, 1, length // parts), np.int64)
    return encoded(rows, books, length, scale), books


def _lengths(rows: DataFrame) -> list:
    """The most frequent length; one row, or none."""
    return rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector of `embeddings`."""
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    # Stored, and summed per label into a stored table: the planner knows that one's size, and a hot label can be split.
    codes = staged(codes, "codes")
    per_label = staged(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    out = codes.join(per_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in plain SQL, one assignment after the other."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, label,
          list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pieces AS MATERIALIZED (SELECT place, p, v[1 + p * (len(v) // {parts}) : (p + 1) * (len(v) // {parts})] AS x
          FROM kept, range({parts}) r(p))""",
        f"books0 AS MATERIALIZED (SELECT p, place - 1 AS e, x AS b FROM pieces WHERE place <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT place, p, min(struct_pack(d := d, e := e)) AS best FROM (
              SELECT place, p, e, list_sum(list_transform(list_zip(x, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
              FROM pieces JOIN books{k} USING (p)) GROUP BY place, p)"""
        )
        if k < rounds:
            steps.append(
                f"""books{k + 1} AS MATERIALIZED (SELECT p, o.e, coalesce(m, o.b) AS b FROM books{k} o LEFT JOIN (
                  SELECT p, e, list(m ORDER BY i) AS m FROM (
                    SELECT p, best.e AS e, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
                    FROM near{k} JOIN pieces USING (place, p), range(1, (SELECT max(len(x)) + 1 FROM pieces)) r(i) GROUP BY p, best.e, i)
                  GROUP BY p, e) n USING (p, e))"""
            )
    steps.append(f"codes AS (SELECT place, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY place)")
    return f"""WITH {", ".join(steps)}
      SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, e)) FROM books{rounds}) AS codebooks_sha256
      FROM kept JOIN codes USING (place)"""


OP13_SQL = _oracle_sql()
