"""Language-model scoring by prediction by partial matching (PPM) over bytes.

Learning counts every run of ORDER + 1 bytes of the learning texts: in each task with NumPy, then over
all tasks by Spark. Shorter runs are sums of longer ones. All of them are kept, in tables.

Scoring walks from the longest context down. Where a context has c occurrences of the byte, T of all and D
different ones, the byte has c / (T + D), the escape D / (T + D). After an escape, what the longer context
could have given is excluded: as its bytes are a subset of the shorter one's, the excluded sums are one
number per context. Below the empty context all symbols not yet excluded are equally likely. A text
begins with ORDER start symbols and closes with an end symbol; these bytes never occur in UTF-8.

A run's score depends on the run alone. The scores of the most frequent learnt runs (`most_edges`) are sent to all
tasks: that spares most positions the join and changes no result. What other runs a text has, each once with its
number, is joined by Spark with the scores of all learnt runs and of those never learnt. The latter are found order
by order; no group is large there, as one more byte on either side of a run has 255 values at most.

The base score is an add-one unigram model over all words of the learning texts. The most frequent words
(`most_words`) are sent to all tasks; occurrences of rarer ones are joined with the count table by Spark.

Cases: a NULL or empty text has the end symbol alone; a NULL id counts as the empty text for the fold and
is carried; repeated rows are learnt and scored each; without learning texts all symbols are equally likely
and no word is known; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations


from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.staging import staged
from tickloom.llm.words import hashes, nested, slices, spans, text_bytes
from tickloom.llm.workers import ship

ORDER = 5
START, END, SYMBOLS = 0xFE, 0xFF, 255
#: Text bytes worked on at once, and counts held by a task before it gives some out.
AT_ONCE, MOST_HELD = 1 << 19, 1 << 20
RUN, WORD = 0, 1
_TAG, _BYTES = np.uint64(56), np.uint64((1 << 56) - 1)


def runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol to predict, its ORDER bytes of context and itself as one number; and symbols before each row."""
    rows, size = len(at) - 1, np.diff(at)
    row = np.repeat(np.arange(rows), size)
    text = np.full(len(data) + rows * (ORDER + 1), START, np.uint8)
    text[np.arange(len(data)) + (row + 1) * ORDER + row] = data
    text[at[1:] + np.arange(1, rows + 1) * (ORDER + 1) - 1] = END
    wide = text.astype(np.uint64)
    out = wide.copy()
    for back in range(1, ORDER + 1):
        out[back:] |= wide[:-back] << np.uint64(8 * back)
    return out[text != START], at + np.arange(rows + 1)


def at_order(run: np.ndarray, order: int) -> np.ndarray:
    """The run with `order` bytes of context, marked with its length."""
    return (run & np.uint64((1 << 8 * (order + 1)) - 1)) | np.uint64((order + 1) << 56)


class Table:
    """A fixed hash table from 64-bit keys (never 0) to their places."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.place = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[left[free]]
            mine = self.keys[slot] == keys[left]
            self.place[slot[mine]] = left[mine]
            left, slot = left[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key or -1."""
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.place[slot], -1)
        left = np.flatnonzero((got != keys) & (got != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            got = self.keys[slot]
            hit = got == keys[left]
            out[left[hit]] = self.place[slot[hit]]
            on = ~hit & (got != 0)
            left, slot = left[on], slot[on]
        return out


class Trie:
    """All learnt runs: `runs` (key, n, gain) of ORDER + 1 bytes, gain being the score, and `edges` (depth, key, n) with `depth` bytes of context."""

    def __init__(self, runs: DataFrame, edges: DataFrame) -> None:
        self.runs, self.edges = runs, edges

    def gains(self, asked: DataFrame) -> DataFrame:
        """key and gain of the runs `asked` (key): log10 probability of each run's last symbol after its context."""
        asked = asked.select(F.inline(_orders(F.col("key")))).distinct()
        context, lower = F.expr("shiftright(key, 8)"), F.expr("key & (shiftleft(1L, 8 * depth) - 1)")
        # The count of the edge one order below, which one more byte of context parts.
        edges = self.edges.select("depth", "key", "n", F.sum("n").over(Window.partitionBy("depth", lower)).alias("below"), F.lit(1).alias("edge"))
        rows = edges.union(asked.select("depth", "key", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0)))
        node = Window.partitionBy("depth", context)
        found = F.sum("n").over(Window.partitionBy("depth", context, "key"))
        sums = [F.sum(of).over(node).alias(name) for of, name in (("n", "total"), ("edge", "kinds"), ("below", "excluded"))]
        placed = staged(rows.select("depth", "key", "edge", found.alias("n"), *sums).where("edge = 0").drop("edge"), "placed")
        out = None
        for order in range(ORDER + 1):
            at = placed.where(F.col("depth") == order).drop("depth")
            if out is None:
                rest, other = -F.log10(SYMBOLS - F.col("kinds")), F.lit(-float(np.log10(SYMBOLS)))
            else:
                at = at.withColumn("low", F.col("key").bitwiseAND(F.lit((1 << 8 * order) - 1).cast("long")))
                at = at.join(out.select(*[F.col(c).alias("low" if c == "key" else f"low_{c}") for c in out.columns]), "low")
                both, open_ = F.expr("low_total + low_kinds - excluded - kinds"), F.expr("low_kinds - kinds")
                escape = F.when(open_ > 0, F.log10(open_) - F.log10(both)).otherwise(0.0)
                rest = F.when(F.col("low_n") > 0, F.log10("low_n") - F.log10(both)).otherwise(escape + F.col("low_rest"))
                other = F.col("low_gain")
            whole = F.log10(F.col("total") + F.col("kinds"))
            gain = F.when(F.col("n") > 0, F.log10("n") - whole).when(F.col("kinds") > 0, F.log10("kinds") - whole + rest).otherwise(other)
            # `rest` is the score from the next lower context on, after an escape out of this one.
            out = at.select("key", "n", "total", "kinds", rest.alias("rest"), gain.alias("gain"))
        return out.select("key", "gain")

    def log10(self, run: np.ndarray) -> np.ndarray:
        """The same for the runs of an array, on the driver."""
        spark = self.runs.sparkSession
        asked = spark.createDataFrame([(k,) for k in np.unique(run).tolist()], "key long")
        got = self.gains(asked).toArrow()
        key, gain = got.column("key").to_numpy(), got.column("gain").to_numpy()
        order = np.argsort(key)
        return gain[order][np.searchsorted(key[order], run.view(np.int64))]


def _orders(key: Column) -> Column:
    """A run of ORDER + 1 bytes with 0 to ORDER of its bytes of context: depth and key."""
    return F.array(*[F.struct(F.lit(o).alias("depth"), key.bitwiseAND(F.lit((1 << 8 * (o + 1)) - 1).cast("long")).alias("key")) for o in range(ORDER + 1)])


class _Tally:
    """Sums of counts by key, held sorted and given out when there are many."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        new, n = np.unique(keys, return_counts=True)
        self.keys, back = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(back, np.concatenate([self.counts, n]), minlength=len(self.keys)).astype(np.int64)

    def take(self, kind: int) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(self.keys), kind, np.int32)), pa.array(self.keys.view(np.int64)), pa.array(self.counts)], ["kind", "key", "n"])
        self.__init__()
        return out


def learnt(id_col: Column) -> Column:
    """Whether a document is learnt from; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2


def count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """kind (RUN or WORD), key, n: counts of all byte runs and words."""
    ship(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (_Tally(), _Tally())
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                data, at = text_bytes(part.column("text"))
                starts, stops, _ = spans(data, at)
                for kind, keys in ((RUN, runs(data, at)[0]), (WORD, hashes(data, starts, stops))):
                    held[kind].add(keys)
                    if len(held[kind].keys) > MOST_HELD:
                        yield held[kind].take(kind)
        for kind in (RUN, WORD):
            yield held[kind].take(kind)

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(tally, "kind int, key long, n long")
    return counts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _least(counts: DataFrame, most: int) -> int:
    """The least count that leaves at most `most` rows; counts from 65,536 on are told apart by their first 16 bits."""
    coarse = F.expr("n - n % shiftleft(1L, greatest(length(bin(n)) - 16, 0))")
    found = counts.groupBy(coarse.alias("n")).agg(F.count("*").alias("rows")).collect()
    left, least = 0, (1 << 63) - 1
    for n, rows in sorted(found, reverse=True):
        left += rows
        if left > most:
            break
        least = n
    return least


def _collected(counts: DataFrame, most: int, value: str = "n") -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the most frequent rows, `most` of them at most."""
    got = counts.where(F.col("n") >= _least(counts, most)).select("key", value).toArrow()
    return got.column("key").to_numpy().view(np.uint64), got.column(value).to_numpy()


class Model:
    """The trie, its most frequent runs with their scores, the frequent words with their counts, and the numbers of the unigram model.

    Sent without the trie; hash tables are built in each worker.
    """

    def __init__(self, trie: Trie, runs: np.ndarray, gains: np.ndarray, words: np.ndarray, counts: np.ndarray, texts: int, tokens: int, kinds: int) -> None:
        self.trie, self.runs, self.gains = trie, runs, gains
        self.words, self.counts, self.texts, self.tokens, self.kinds = words, counts, texts, tokens, kinds

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("trie", "table", "held")}

    @cached_property
    def table(self) -> Table:
        return Table(self.words)

    @cached_property
    def held(self) -> Table:
        return Table(at_order(self.runs, ORDER))


def train(docs: DataFrame, text_col: str = "text", most_edges: int = 1_000_000, most_words: int = 500_000) -> tuple[Model, DataFrame]:
    """The model of all `docs`, and the counts of the words (key, n) that it doesn't hold."""
    counts = staged(count(docs, text_col), "counts")
    node = Window.partitionBy(F.expr("shiftright(key, 8)"))
    gain = F.log10("n") - F.log10(F.sum("n").over(node) + F.count("*").over(node))
    runs = staged(counts.where(F.col("kind") == RUN).select("key", "n", gain.alias("gain")), "runs")
    edges = staged(runs.select(F.inline(_orders(F.col("key"))), "n").groupBy("depth", "key").agg(F.sum("n").alias("n")), "edges")
    words = counts.where(F.col("kind") == WORD)
    held, n = _collected(words, most_words)
    kinds, tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    texts = docs.count()
    model = Model(Trie(runs, edges), *_collected(runs, most_edges, "gain"), held, n, texts, tokens + texts, kinds + (texts > 0))
    least = int(n.min()) if len(n) else None
    return model, words.select("key", "n") if least is None else words.where(F.col("n") < least).select("key", "n")


def _tallied(run: np.ndarray, before: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's chosen runs, once each, their numbers, and how many lie before each row."""
    place = np.flatnonzero(chosen)
    row, left = np.searchsorted(before, place, "right") - 1, run[place]
    order = np.lexsort((left, row))
    row, left = row[order], left[order]
    new = np.flatnonzero(np.diff(left, prepend=~left[:1]).astype(bool) | np.diff(row, prepend=-1).astype(bool))
    return left[new], np.diff(np.append(new, len(left))), np.searchsorted(row[new], np.arange(len(before)))


def score(docs: DataFrame, model: Model, rare: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    floor = -float(np.log10(model.tokens + model.kinds + 1))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = sent.value, TaskContext.get().partitionId() << 33
        table, held = model.table, model.held
        gains = np.log10(model.counts + 1)
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                n = part.num_rows
                data, at = text_bytes(part.column("text"))
                run, before = runs(data, at)
                at_run = held.find(at_order(run, ORDER))
                sums = np.concatenate([[0], np.cumsum(np.where(at_run >= 0, np.append(model.gains, 0.0)[at_run], 0.0))])
                others, times, ends = _tallied(run, before, at_run < 0)
                starts, stops, words = spans(data, at)
                names = hashes(data, starts, stops)
                place = table.find(names)
                owner = np.repeat(np.arange(n), np.diff(words))
                known = place >= 0
                tokens = np.diff(words) + 1
                base = tokens * floor + np.bincount(owner[known], gains[place[known]], minlength=n) + np.log10(model.texts + 1)
                n_known = np.bincount(owner[known], minlength=n) + (model.texts > 0)
                rest = np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=n))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), part.column("doc_id"), pa.array(tokens), pa.array(n_known), pa.array(base), pa.array(sums[before[1:]] - sums[before[:-1]]), nested(names[~known], rest, pa.int64()), nested(others, ends, pa.int64()), nested(times, ends, pa.int64())],
                    ["row", "doc_id", "n_tokens", "n_known", "base", "held_score", "rest", "runs", "times"],
                )
                row += n

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rated = staged(rows.mapInArrow(rate, f"row long, doc_id {kind}, n_tokens long, n_known long, base double, held_score double, rest array<long>, runs array<long>, times array<long>"), "rated")
    more = rated.select("row", F.explode("rest").alias("key")).join(rare, "key")
    more = more.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("gain"))
    asked = rated.select("row", F.inline(F.arrays_zip("runs", "times"))).select("row", F.col("runs").alias("key"), "times")
    learnt_runs = model.trie.runs.select("key", "gain")
    novel = staged(asked.select("key").distinct().join(learnt_runs, "key", "left_anti"), "novel")
    missed = asked.join(learnt_runs.union(model.trie.gains(novel)), "key").groupBy("row").agg(F.sum(F.col("times") * F.col("gain")).alias("missed"))
    out = rated.drop("rest", "runs", "times").join(more, "row", "left").join(missed, "row", "left")
    known = F.col("n_known") + F.coalesce("more", F.lit(0))
    return out.select("doc_id", "n_tokens", known.alias("n_known"), (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"), (F.col("held_score") + F.coalesce("missed", F.lit(0.0))).alias("score"))


def op9_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, rare = train(docs.where(learnt(F.col("doc_id"))))
    rare = staged(rare, "rare")
    out = score(docs, model, rare)
    return out.select("doc_id", (~learnt(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
