"""Streaming jobs run to the end of the given tables; each equals its batch operator."""

from pyspark.sql import functions as F

from tickloom.operators import bars as bar_ops, features, models, select, upkeep
from tickloom.plans import inputs
from tickloom.plans.q_models import FEATURES_SQL
from tickloom.plans.registry import query
from tickloom.session import scratch_path, stored
from tickloom.streaming import jobs


def event_stream(spark, sf):
    schema = inputs.table(spark, sf, "events").schema
    # A pattern, because a stream over a plain path must be a folder.
    events = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    # The files hold times without a zone; a watermark needs instants.
    return events.select(
        "event_id", F.col("event_type").alias("pair"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
    )


def _finish(started):
    started.awaitTermination()


@query(
    "stream_validated_quotes",
    "event_id:l base target rate:4 ts:t",
    """SELECT event_id, 'USD' AS base, pair AS target, price AS rate, ts FROM ticks WHERE price >= 10""",
)
def stream_validated_quotes(spark, sf):
    """Prices under 10 are turned negative first, so that some rows are rejected."""
    price = F.col("price")
    quotes = event_stream(spark, sf).select(
        "event_id", "ts", F.lit("USD").alias("base"), F.col("pair").alias("target"),
        F.when(price < 10, -price).otherwise(price).alias("rate"),
    )
    out = scratch_path(spark, "quotes")
    _finish(jobs.stream_validate(quotes, f"{out}/good", f"{out}/bad", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/good")


@query(
    "stream_ohlc_hourly",
    "pair date:t open:4 high:4 low:4 close:4 avg_rate:4",
    """SELECT * FROM hourly_bars
       WHERE date + INTERVAL 1 HOUR <= (SELECT max(ts) FROM ticks) - INTERVAL 1 HOUR""",
)
def stream_ohlc_hourly(spark, sf):
    """Bars still open at the end of the stream are not emitted."""
    out = scratch_path(spark, "bars")
    bars = jobs.stream_ohlc(event_stream(spark, sf), tie="event_id")
    _finish(jobs.append_stream(bars, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.schema(bars.schema).parquet(f"{out}/table")


@query(
    "stream_dedup",
    "event_id:l pair ts:t price:4",
    "SELECT * FROM ticks",
)
def stream_dedup(spark, sf):
    """Every quote is delivered twice and kept once."""
    events = event_stream(spark, sf)
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = scratch_path(spark, "dedup")
    once = jobs.stream_dedup(twice, ["event_id"])
    _finish(jobs.append_stream(once, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table")


@query(
    "stream_upsert_bars",
    "pair date:d open:4 high:4 low:4 close:4",
    """SELECT pair, date, open, high, low, close FROM changes
       UNION ALL SELECT pair, date, open, high, low, close FROM bars ANTI JOIN changes USING (pair, date)""",
)
def stream_upsert_bars(spark, sf):
    """A table of bars, then a stream of changed and new bars merged into it."""
    out = scratch_path(spark, "upsert")
    rows = inputs.bars(spark, sf)
    upkeep.write_by_month(rows, f"{out}/table")
    inputs.updates(spark, sf).write.parquet(f"{out}/landing")
    landing = spark.readStream.schema(rows.schema).parquet(f"{out}/landing")
    _finish(jobs.stream_upsert(landing, f"{out}/table", f"{out}/checkpoint"))
    return upkeep.read_months(spark, f"{out}/table", rows.schema)


@query(
    "stream_daily_bars",
    "pair date:d open:4 high:4 low:4 close:4",
    """SELECT pair, CAST(ts AS DATE) AS date, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close FROM ticks GROUP BY 1, 2""",
)
def stream_daily_bars(spark, sf):
    """Validated quotes streamed to files, then the batch bar operator over them."""
    out = scratch_path(spark, "daily")
    quotes = event_stream(spark, sf).withColumn("date", F.to_date("ts"))
    _finish(jobs.append_stream(quotes, f"{out}/table", f"{out}/checkpoint"))
    return bar_ops.build_bars(spark.read.parquet(f"{out}/table"), order=bar_ops.time_rank("ts", "event_id"))


SCORED = ("rsi", "macd", "stoch")
CUT = "1998-03-01"


@query(
    "stream_scores",
    "pair date:d rsi:6 ema_26:4 macd:4 stoch:6 bb_high:4 close_roll_std_10:4 bullish_engulfing:i same:b",
    f"SELECT *, true AS same FROM ({FEATURES_SQL}) WHERE date > DATE '{CUT}'",
)
def stream_scores(spark, sf):
    """Bars after a cut come in two files and are scored from the tail and the state before them: the features
    and predictions are those of one batch over the whole history."""
    out = scratch_path(spark, "scores")
    rows = inputs.stored_bars(spark, sf).select(*jobs.BAR)
    later = F.col("date") > F.lit(CUT).cast("date")
    whole, _ = stored(features.ml_features(rows), "features")
    fitted = {name: models.logistic(SCORED, whole.count(), c).fit(whole) for name, c in (("random_forest", 1.0), ("boosted_trees", 0.01), ("logistic_regression", 100.0))}
    jobs.remember(rows.filter(~later), f"{out}/memory")
    days = F.datediff("date", F.lit(CUT).cast("date"))
    for between in (days <= 60, days > 60):
        rows.filter(later & between).coalesce(1).write.mode("append").parquet(f"{out}/landing")
    landing = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/landing")
    _finish(jobs.stream_scores(landing, fitted, f"{out}/memory", f"{out}/table", f"{out}/checkpoint"))
    batch = models.score(fitted, whole).select("pair", "date", F.struct(*fitted, "voting").alias("at_once"))
    found = spark.read.parquet(f"{out}/table")
    return found.join(batch, ["pair", "date"], "left").withColumn("same", F.struct(*fitted, "voting").eqNullSafe(F.col("at_once")))
