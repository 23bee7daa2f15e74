"""Quality classifier learnt from trusted positives and unlabelled text (positive-unlabelled learning).

Only label 1 is used. P are texts with that label, U are all texts, whatever their label. With
the class prior p, a linear score g and the logistic loss l, the risk that is minimised is

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])

whose second part estimates the risk on negatives without bias and, cut at zero, can't be driven below
what any risk can be. The prior comes from the data too: a classifier of P against U is fitted on one
half of the sample; p is the least ratio of the share of all of U and the share of the other half of P above
any threshold that leaves most of P above it.

Features of a whole text, all made with NumPy in the tasks: shares of hashed runs of three character
classes, and a few ratios (capitals, signs, digits, repeated and distinct words, word and line lengths).

Mean and scale of the features and the shares that the prior comes from cover all rows of U. The weights are
fitted on the driver from a sample of about `most_positive` labelled rows and `most_unlabelled` rows of U at most,
chosen by a hash of id and text, so that a repeated id isn't chosen whole; these bounds are the operator's
parameters. The sample is held once, as 32-bit numbers, and worked on in place. All rows are scored.

Cases: NULL and empty texts have all features zero and get the score of such a text; without any positive
every score is 0.5; ids with contradicting labels count as unlabelled; NULL ids are scored but never learnt
from; repeated rows get equal scores; other columns are carried by `keep_good` and ignored by `score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.staging import staged
from tickloom.llm.words import distinct, hashes, slices, spans, text_bytes
from tickloom.llm.workers import ship

BUCKETS = 1024
RATIOS = 12
RIDGE = 1e-3
_CLASS = np.full(256, 3, np.uint32)  # further bytes of a character count as letters
_CLASS[:0x80] = np.arange(0x80) + 8
_CLASS[[*range(0x61, 0x7B)]] = 3
_CLASS[[*range(0x41, 0x5B)]] = 4
_CLASS[[*range(0x30, 0x3A)]] = 5
_UPPER, _DIGIT, _LETTER = _CLASS == 4, _CLASS == 5, (_CLASS == 3) | (_CLASS == 4)


def features(column: pa.Array) -> np.ndarray:
    """One row of BUCKETS + RATIOS numbers per text."""
    data, at = text_bytes(column)
    rows, size = len(at) - 1, np.diff(at)
    out = np.zeros((rows, BUCKETS + RATIOS), np.float32)
    if not len(data):
        return out
    kind = _CLASS[data]
    code = kind.copy()
    code[:-1] = code[:-1] * np.uint32(151) + kind[1:]
    code[:-2] = code[:-2] * np.uint32(151) + kind[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(22)
    whole = np.ones(len(data), bool)  # runs that end in the same text
    for back in (1, 2):
        whole[(at[1:] - back)[size >= back]] = False
    row = np.repeat(np.arange(rows), size)
    runs = np.bincount((row * BUCKETS + code)[whole], minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    out[:, :BUCKETS] = np.sqrt(runs / np.maximum(1, size - 2)[:, None])

    starts, stops, before = spans(data, at)
    names = hashes(data, starts, stops)
    n = np.diff(before)
    again = np.zeros(len(names), bool)
    again[1:] = names[1:] == names[:-1]
    inner = before[(before > 0) & (before < len(names))]
    again[inner] = False
    different = np.diff(distinct(names, before)[1])
    share = lambda mask: np.bincount(row[mask], minlength=rows) / np.maximum(1, size)
    per_word = lambda x: x / np.maximum(1, n)
    owner = np.repeat(np.arange(rows), n)
    ends = data[stops - 1] if len(stops) else np.zeros(0, np.uint8)
    capitals = _UPPER[data[starts]] & _UPPER[ends] & (stops - starts > 1) if len(starts) else np.zeros(0, bool)
    out[:, BUCKETS:] = np.column_stack(
        [
            np.log1p(size) / 10,
            np.log1p(n) / 10,
            per_word(np.bincount(owner, stops - starts, minlength=rows)) / 10,
            per_word(np.bincount(owner, again, minlength=rows)),
            per_word(different),
            per_word(np.bincount(owner, ~_LETTER[ends] & (stops - starts > 1), minlength=rows)),
            per_word(np.bincount(owner, stops - starts == 1, minlength=rows)),
            per_word(np.bincount(owner, capitals, minlength=rows)),
            share(_UPPER[data]),
            share(_DIGIT[data]),
            share(~_LETTER[data] & ~_DIGIT[data] & (data > 0x20)),
            share(data == 0x0A) * 10,
        ]
    )
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        g = np.einsum("ij,j->i", (x - self.mean) / self.scale, self.weights) + self.bias
        return np.round(1 / (1 + np.exp(-np.clip(g, -30, 30))), 6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _minimise(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w.astype(np.float32))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _loss(g: np.ndarray) -> float:
    return float(np.logaddexp(0, -g).mean())


def against(p: np.ndarray, u: np.ndarray, steps: int = 150) -> np.ndarray:
    """Weights of a classifier of P against U."""

    def gradient(w: np.ndarray) -> np.ndarray:
        up, down = -_sigmoid(-(p @ w)), _sigmoid(u @ w)
        return p.T @ up / len(up) + u.T @ down / len(down) + RIDGE * w

    return _minimise(gradient, p.shape[1], steps, 0.02)


def prior_of(positive: np.ndarray, below: np.ndarray) -> float:
    """Share of positives in U, from sorted scores of held-out positives and how many rows of U score below each (and in all).

    The least share of U per share of P above a threshold. Only thresholds that leave most of P above count, where
    the shares are least uncertain; the result is one standard error below the estimate, since too high a prior
    makes the risk spare the rarer kinds of bad text.
    """
    n, all_u = len(positive), int(below[-1])
    above_p = 1 - np.arange(n) / n
    above_u = 1 - below[:n] / all_u
    counts = above_p >= 0.8
    ratio = above_u / above_p
    best = int(np.flatnonzero(counts)[ratio[counts].argmin()])
    error = ratio[best] * np.sqrt((1 - above_p[best]) / (above_p[best] * n) + (1 - above_u[best]) / max(above_u[best] * all_u, 1e-9))
    return float(np.clip(min(1.0, ratio[best]) - error, 0.01, 0.99))


def risk_step(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative risk with a small ridge; where its second part is below zero, of minus that part."""
    gp, gu = p @ w, u @ w
    as_negative = u.T @ _sigmoid(gu) / len(u) - prior * (p.T @ _sigmoid(gp)) / len(p)
    if _loss(-gu) - prior * _loss(-gp) < 0:
        return -as_negative
    return prior * (p.T @ -_sigmoid(-gp)) / len(p) + as_negative + RIDGE * w


def fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 300) -> np.ndarray:
    """Minimise the non-negative risk."""
    return _minimise(lambda w: risk_step(w, p, u, prior), p.shape[1], steps, 0.01)


def learnable(id_col: Column) -> Column:
    """Rows whose labels may be learnt."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) != 1


def train(docs: DataFrame, labels: DataFrame, most_positive: int = 4000, most_unlabelled: int = 12000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on P: label 1 in learnable rows, U: learnable rows of any kind."""
    ship(docs.sparkSession)
    size = BUCKETS + RATIOS
    part = 1 << 40
    place = lambda salt, *of: F.pmod(F.xxhash64(*of, F.lit(salt)), F.lit(part))
    good = labels.where(learnable(F.col(id_col))).groupBy(id_col).agg(F.min(label_col).alias("low")).where("low = 1")
    learnt = docs.where(learnable(F.col(id_col))).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    all_good, all_docs = good.count(), learnt.count()
    if not all_good or not all_docs:
        return Model(np.zeros(size), 0.0, np.zeros(size), np.ones(size), 0.5)
    chosen = good.where(place(1, id_col) < int(part * min(1, most_positive / all_good))).select(F.col(id_col).alias("_id"), F.lit(True).alias("_p"))
    wanted = lambda salt, n: place(salt, "_id", "text") < int(part * min(1, n / all_docs))
    rows = learnt.join(F.broadcast(chosen), "_id", "left")  # about `most_positive` rows at most
    key = F.xxhash64("_id", "text")
    # An id's label stands for all its texts, of which there may be very many.
    texts = rows.where("_p").agg(F.approx_count_distinct(key)).first()[0]
    labelled = F.col("_p").isNotNull() & wanted(3, all_docs * min(1, 2 * most_positive / max(1, texts)))
    rows = rows.select("text", wanted(2, most_unlabelled).alias("u"), labelled.alias("p"), key.alias("key"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The features of chosen rows, and at last the sums of all rows' features and of their squares."""
        names = ["p", "u", "key", "x", "k", "n", "s", "q"]
        n, total, squares, given = 0, np.zeros(size), np.zeros(size), set()
        for batch in batches:
            for piece in slices(batch, "text"):
                x = features(piece.column("text"))
                n, total = n + len(x), total + x.sum(0, dtype=np.float64)
                squares += np.einsum("ij,ij->j", x, x, dtype=np.float64)
                kept = pc.or_(piece.column("p"), piece.column("u")).to_numpy(zero_copy_only=False)
                fresh = {k: i for i, k in enumerate(piece.column("key").to_pylist()) if kept[i] and k not in given}
                given.update(fresh)
                at = sorted(fresh.values())
                chosen = piece.take(pa.array(at, pa.int64()))
                raw = pa.array([v.tobytes() for v in x[at]], pa.binary())
                empty = [pa.nulls(len(raw), t) for t in (pa.int32(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([chosen.column("p"), chosen.column("u"), chosen.column("key"), raw, *empty], names)
        empty = [pa.nulls(size, t) for t in (pa.bool_(), pa.bool_(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n)), pa.array(total), pa.array(squares)], names)

    made = staged(rows.mapInArrow(build, "p boolean, u boolean, key long, x binary, k int, n long, s double, q double"), "features")
    mean, scale = np.zeros(size), np.ones(size)
    for k, n, s, q in made.where("k is not null").groupBy("k").agg(F.sum("n"), F.sum("s"), F.sum("q")).collect():  # one row per feature
        mean[k], scale[k] = s / n, np.sqrt(max(0.0, q / n - (s / n) ** 2)) + 1e-3
    sides = F.explode(F.array_compact(F.array(F.when(F.col("p"), 0), F.when(F.col("u"), 1)))).alias("side")
    sample = staged(made.where("k is null").dropDuplicates(["key"]), "sample").select(sides, "key", "x")
    counts = {r["side"]: r["n"] for r in sample.groupBy("side").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = counts.get(0, 0), counts.get(1, 0)
    if not n_p or not n_u:
        return Model(np.zeros(size), 0.0, np.zeros(size), np.ones(size), 0.5)
    held = np.empty((n_p + n_u, size + 1), np.float32)
    held[:, size] = 1  # the bias
    for i, r in enumerate(sample.sort("side", "key").toLocalIterator()):  # the same order whatever the order of tasks
        held[i, :size] = np.frombuffer(r["x"], np.float32)
    held[:, :size] -= mean.astype(np.float32)
    held[:, :size] /= scale.astype(np.float32)
    p, u = held[:n_p], held[n_p:]
    prior = 0.5
    if min(n_p, n_u) >= 8:
        w = against(p[: n_p // 2], u[: n_u // 2]).astype(np.float32)
        marks = np.sort(p[n_p // 2 :] @ w)
        prior = prior_of(marks, _below(rows.select("text"), mean, scale, w, marks))
    w = fit(p, u, prior)
    return Model(w[:-1], float(w[-1]), mean, scale, prior)


def _below(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """How many of all rows score below each of the sorted marks, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(marks) + 1, np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                g = ((features(piece.column("text")) - mean.astype(np.float32)) / scale.astype(np.float32)) @ w[:-1] + w[-1]
                found += np.bincount(np.searchsorted(marks, g, "right"), minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], ["at", "n"])

    total = np.zeros(len(marks) + 1, np.int64)
    for at, n in rows.mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # one row per mark
        total[at] = n
    return np.cumsum(total)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher is better) of every row."""
    ship(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(model(features(piece.column("text"))))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judge, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, with a score of at least `least`."""
    ship(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                yield piece.filter(pa.array(model(features(piece.column(text_col))) >= least))

    return docs.mapInArrow(keep, docs.schema)


def op10_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    ship(spark)
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, train(docs, labels))
    held_out = F.coalesce(~learnable(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
