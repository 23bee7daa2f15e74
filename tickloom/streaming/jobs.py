"""Quote and bar streams.  Each job reuses the batch operator on a stream."""

from pyspark.sql import functions as F

from tickloom.operators import features, models, resume
from tickloom.operators.bars import time_rank
from tickloom.operators.quality import rejected_quotes, valid_quotes
from tickloom.operators.select import last_n
from tickloom.operators.upkeep import KEYS, newest_copy, upsert_months, write_by_month


def stream_validate(quotes, good, bad, checkpoint):
    """Write valid quotes to ``good`` and the others to ``bad``.

    Each batch lands in a folder of its own number, so a batch repeated after a failure
    replaces its first try.
    """

    def split(batch, number):
        batch.persist()
        try:
            for rows, path in ((valid_quotes(batch), good), (rejected_quotes(batch), bad)):
                rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    return (
        quotes.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_ohlc(quotes, width="1 hour", lateness="1 hour", ts="ts", keys=("pair",), price="price", tie=None):
    """Tumbling bars; a bar is emitted once the watermark passes its end, later quotes
    are dropped.  State is one row per open bar and key; ``tie`` orders equal times."""
    bars = (
        quotes.withWatermark(ts, lateness)
        .withColumn("_rank", time_rank(ts, tie))
        .groupBy(F.window(ts, width), *keys)
        .agg(
            F.min_by(price, "_rank").alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "_rank").alias("close"),
            F.avg(price).alias("avg_rate"),
        )
    )
    return bars.select(
        *keys, F.col("window.start").alias("date"), "open", "high", "low", "close", "avg_rate"
    )


def stream_dedup(rows, keys, ts="ts", lateness="1 day"):
    """Drop re-delivered rows seen within ``lateness``."""
    return rows.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def stream_upsert(bars, target, checkpoint, keys=KEYS, ts_col=None, run_ts=None):
    """Merge each batch of bars into the month-partitioned table at ``target``.

    The merge is idempotent by key, so a repeated batch changes nothing.  Stateless:
    what was loaded is remembered by the checkpoint.
    """

    def merge(batch, number):
        if batch.isEmpty():
            return
        write_by_month(batch.limit(0), target, "ignore")  # only if there is no table yet
        upsert_months(batch.sparkSession, target, batch, keys, ts_col, run_ts)

    return (
        bars.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


BAR = ("pair", "date", "open", "high", "low", "close")


def remember(bars, path, number=-1, tail=None, state=None):
    """Store what scoring of later bars needs: the newest bars of each instrument, and the recursive state after them."""
    seen = bars if tail is None else tail.select(*bars.columns).unionByName(bars)
    last_n(seen, features.TAIL).write.mode("overwrite").parquet(f"{path}/tail/after={number}")
    rows = resume.recursive_indicators(bars, state)
    resume.state_after(rows, state).write.mode("overwrite").parquet(f"{path}/state/after={number}")


def stream_scores(bars, fitted, memory, out, checkpoint):
    """Score new daily bars as they come; ``memory`` is a folder that ``remember`` has started.

    A batch reads its own bars, at most TAIL bars per instrument and one row of state each, however
    long the history is.  It writes its predictions, the next tail and the next state under its
    number, so a batch repeated after a failure replaces its first try.  Bars that are not newer
    than the state of their instrument are dropped; of several bars of a day one counts.
    """

    def score(batch, number):
        spark = batch.sparkSession
        tail, state = (spark.read.parquet(f"{memory}/{kind}/after={number - 1}") for kind in ("tail", "state"))
        fresh = newest_copy(resume.newer_bars(batch.select(*BAR), state)).select(*BAR).persist()
        try:
            rows = features.features_of_new(fresh, tail, state)
            models.score(fitted, rows).write.mode("overwrite").parquet(f"{out}/batch={number}")
            remember(fresh, memory, number, tail, state)
        finally:
            fresh.unpersist()

    return (
        bars.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(rows, path, checkpoint):
    """Append a stream to Parquet files exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
