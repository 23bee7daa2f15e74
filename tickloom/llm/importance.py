"""Importance resampling: draw the documents whose hashed n-grams look most like a target's.

Features are runs of 1 to `longest` words; a feature's bucket is a CRC-32. A bucket's gain is the logarithm of
its share in the target over its share in the documents; a document's weight is the mean gain of its
features; Gumbel noise (a hash of the id) added to the weights makes "highest scores" a draw without
replacement. Counting works on segments instead of texts:

1. Newlines cut a text into lines. A task counts equal lines of its batches once, then lines are grouped over
   all tasks: a line that very many documents repeat travels once per batch, not once per document.
2. The features inside a distinct line are counted once and multiplied by the line's occurrences.
3. Runs that cross a line's end belong to no line. They are counted apart where the text is read, per bucket.
   A line of more than SEGMENT words is cut there too, so that no segment is unbounded, and the runs across the
   cuts are counted in the same way.

Only counts per bucket (`buckets` numbers) reach the driver. For the weights, equal lines of a batch are again
worked out once. Ranks come from one range shuffle of the scores and counts per partition: no window, no task
that has all rows. Rows with one and the same score and id are told apart by where they are stored.

Cases: a NULL or empty text, or one without words, has no features, weight 0 and is never drawn; a NULL id hashes
like an empty one and comes after all others on a tie; repeated rows are scored and drawn each; an empty target or an empty
table is counted as no features; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.staging import staged
from tickloom.llm.words import LOWER, MARKS, hashes, mix, slices, spans, text_bytes
from tickloom.llm.workers import ship

SEGMENT = 1024
NEWLINE = 0x0A
#: Bytes of a word that go through the table; the rest of a longer one goes to zlib.
TABLE_BYTES = 64
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 registers (not yet inverted) after the bytes of a word more each."""
    order = np.argsort(starts - stops, kind="stable")  # longest first, so that those not yet at their end are a prefix
    size, at, out = (stops - starts)[order], starts[order], state[order]
    for j in range(min(TABLE_BYTES, int(size[0])) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, "left"))  # words of more than j bytes
        out[:n] = _TABLE[(out[:n] ^ data[at[:n] + j]) & 255] ^ out[:n] >> np.uint32(8)
    for i in range(int(np.searchsorted(-size, -TABLE_BYTES, "left"))):
        rest = data[at[i] + TABLE_BYTES : at[i] + size[i]].tobytes()
        out[i] = zlib.crc32(rest, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    back = np.empty_like(out)
    back[order] = out
    return back


@dataclass
class Words:
    """Words of a batch of texts: bytes (lower case), first and last byte, text and segment of each word."""

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    row: np.ndarray
    segment: np.ndarray
    first: np.ndarray  # first word of each segment, and the end

    def buckets_of(self, i: np.ndarray, size: int, buckets: int) -> np.ndarray:
        """Buckets of the runs of `size` words that begin with the words `i`."""
        state = crc_on(np.full(len(i), 0xFFFFFFFF, np.uint32), self.data, self.starts[i], self.stops[i])
        for j in range(1, size):
            state = _TABLE[(state ^ np.uint32(0x20)) & 255] ^ state >> np.uint32(8)
            state = crc_on(state, self.data, self.starts[i + j], self.stops[i + j])
        return ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)

    def inside(self, chosen: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(segment, bucket) of the runs inside the segments marked in `chosen`, by size of run."""
        i = np.flatnonzero(chosen[self.segment]) if len(self.row) else np.zeros(0, np.int64)
        state = np.full(len(i), 0xFFFFFFFF, np.uint32)
        for size in range(1, longest + 1):
            if size > 1:
                fits = i + size - 1 < self.first[self.segment[i] + 1]
                i, state = i[fits], state[fits]
                state = _TABLE[(state ^ np.uint32(0x20)) & 255] ^ state >> np.uint32(8)
            state = crc_on(state, self.data, self.starts[i + size - 1], self.stops[i + size - 1])
            yield self.segment[i], ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)

    def across(self, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of the runs that begin in one segment and end in another of the same text."""
        for size in range(2, longest + 1):
            i = np.arange(max(0, len(self.row) - size + 1))
            i = i[(self.row[i] == self.row[i + size - 1]) & (self.segment[i] != self.segment[i + size - 1])]
            yield self.row[i], self.buckets_of(i, size, buckets)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One segment of each content, each segment's content, and the contents' occurrences."""
        if not len(self.row):
            return (np.zeros(0, np.int64),) * 3
        place = (np.arange(len(self.row)) - self.first[self.segment]).astype(np.uint64)
        names = mix(hashes(self.data, self.starts, self.stops) ^ mix(place * _PLACE + _PLACE))
        _, example, content, count = np.unique(np.add.reduceat(names, self.first[:-1]), return_index=True, return_inverse=True, return_counts=True)
        return example, content, count

    def lines(self, segments: np.ndarray) -> pa.Array:
        """The words of each of these segments with one space between."""
        a, b = self.first[segments], self.first[segments + 1]
        words = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
        size = self.stops[words] - self.starts[words] + 1
        ends = np.cumsum(size)
        raw = np.full(ends[-1] if len(ends) else 0, 0x20, np.uint8)
        where = np.arange(len(raw)) - np.repeat(ends - size, size)
        kept = where < np.repeat(size - 1, size)
        raw[kept] = self.data[(np.repeat(self.starts[words], size) + where)[kept]]
        last = np.concatenate([[0], np.cumsum(b - a)])
        offsets = np.concatenate([[0], ends])[last]
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(segments), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
        return pa.compute.utf8_rtrim(text.cast(pa.large_string()), " ").cast(pa.string())


def words_of(column: pa.Array) -> Words:
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, stops, before = spans(data, at, MARKS)
    row = np.repeat(np.arange(len(at) - 1), np.diff(before))
    line = np.searchsorted(np.flatnonzero(data == NEWLINE), starts)
    new = np.ones(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(starts)) - (first[np.cumsum(new) - 1] if len(starts) else 0)
    new |= place % SEGMENT == 0
    return Words(data, starts, stops, row, np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(starts)))


def feature_counts(docs: DataFrame, text_col: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossing = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                example, _, count = words.distinct()
                for _, bucket in words.across(longest, buckets):
                    crossing += np.bincount(bucket, minlength=buckets)
                yield pa.RecordBatch.from_arrays([words.lines(example), pa.nulls(len(example), pa.int32()), pa.array(count)], ["line", "bucket", "n"])
        some = np.flatnonzero(crossing)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(crossing[some])], ["line", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            crossing = batch.filter(batch.column("line").is_null())
            np.add.at(total, crossing.column("bucket").to_numpy(), crossing.column("n").to_numpy())
            for part in slices(batch.filter(batch.column("line").is_valid()), "line"):
                words = words_of(part.column("line"))
                n = part.column("n").to_numpy()[words.row[words.first[:-1]]]  # a line is one segment
                for segment, bucket in words.inside(np.ones(len(n), bool), longest, buckets):
                    np.add.at(total, bucket, n[segment])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    segments = docs.select(F.col(text_col).alias("text")).mapInArrow(cut, "line string, bucket int, n long")
    once = segments.groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in once.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n  # `buckets` rows at most
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of smoothed shares, rounded down."""
    of_source, of_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * of_source / ((s + 1) * of_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features, weight, place (a number of its own) of every row."""
    ship(docs.sparkSession)
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                words, rows = words_of(part.column("text")), part.num_rows
                example, content, _ = words.distinct()
                chosen = np.zeros(len(content), bool)
                chosen[example] = True
                inner, n_inner = np.zeros(len(content)), np.zeros(len(content))  # sums below 2**53 are exact in doubles
                for segment, bucket in words.inside(chosen, longest, buckets):
                    inner += np.bincount(segment, gain[bucket], len(content))
                    n_inner += np.bincount(segment, minlength=len(content))
                owner = words.row[words.first[:-1]]
                total = np.bincount(owner, inner[example[content]], rows)
                n = np.bincount(owner, n_inner[example[content]], rows)
                for row, bucket in words.across(longest, buckets):
                    total += np.bincount(row, gain[bucket], rows)
                    n += np.bincount(row, minlength=rows)
                n, total = n.astype(np.int64), total.astype(np.int64)
                columns = [np.bincount(words.row, minlength=rows), n, np.where(n > 0, total // np.maximum(1, n), 0), place + np.arange(rows)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight", "place"])
                place += rows

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, place long")


def with_scores(weighed: DataFrame, seed: int) -> DataFrame:
    """Add `score`: the weight and Gumbel noise from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, share: int, least_words: int) -> DataFrame:
    """Add `rank`: 1, 2, 3 ... for the highest scores among rows of enough words, NULL for rows that are not drawn."""
    scored = staged(scored.withColumn("enough", F.col("n_words") >= least_words), "scored")
    most = scored.where("enough").count() * share // 100
    keys = [F.desc("enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    order = scored.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    order = staged(order, "ordered")
    part = F.shiftright("at", 33)
    sizes = sorted((r["part"], r["n"]) for r in order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row per partition
    before, total = {}, 0
    for p, n in sizes:
        before[p] = total - (p << 33)
        total += n
    if not before:
        return order.withColumn("rank", F.lit(None).cast("long")).drop("at", "enough", "place")
    first = order.sparkSession.createDataFrame(list(before.items()), "part int, before long")
    rank = F.col("at") + F.col("before") + 1
    ranked = order.withColumn("part", part.cast("int")).join(first, "part")
    return ranked.withColumn("rank", F.when(F.col("enough") & (rank <= most), rank)).drop("part", "before", "at", "enough", "place")


def resample(
    docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row; `share` percent of those of enough words are drawn."""
    gain = gains(feature_counts(docs, text_col, longest, buckets), feature_counts(target, target_col, longest, buckets))
    return drawn(with_scores(weights(docs, gain, longest, id_col, text_col), seed), share, least_words)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document, drawn to look like `benchmark`."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


_CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: The same in plain SQL; a checksum goes byte by byte through a table made by its rule.
OP11_SQL = f"""WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
      docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_CUT} AS w FROM documents),
      runs AS MATERIALIZED (SELECT r, unnest(list_concat(w, list_transform(list_zip(w, w[2 :], true), lambda z: z[1] || ' ' || z[2]))) AS f FROM docs),
      counts AS (SELECT r, f, count(*) AS n FROM runs GROUP BY r, f),
      goal AS (SELECT unnest(list_concat(w, list_transform(list_zip(w, w[2 :], true), lambda z: z[1] || ' ' || z[2]))) AS f FROM (SELECT {_CUT} AS w FROM benchmark)),
      bytes AS (SELECT f, list_transform(range(0, len(hex(f)) // 2), lambda i:
        (instr('0123456789ABCDEF', substr(hex(f), 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex(f), 2 * i + 2, 1)) - 1) AS b
        FROM (SELECT f FROM counts UNION SELECT f FROM goal)),
      hashed AS MATERIALIZED (SELECT f, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
      source AS (SELECT bucket, sum(n)::BIGINT AS s FROM counts JOIN hashed USING (f) GROUP BY bucket),
      target AS (SELECT bucket, count(*) AS t FROM goal JOIN hashed USING (f) GROUP BY bucket),
      gain AS MATERIALIZED (SELECT k AS bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM source), 0) + 10000)
          / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM target), 0) + 10000))))::BIGINT AS g
        FROM range(10000) b(k) LEFT JOIN source ON source.bucket = k LEFT JOIN target ON target.bucket = k),
      weighed AS (SELECT r, sum(n)::BIGINT AS n, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight
        FROM counts JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY r),
      scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
          coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 8))::UBIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
        FROM docs LEFT JOIN weighed USING (r)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, 25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS most FROM scored)
      SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= most THEN place END AS rank FROM ranked"""
