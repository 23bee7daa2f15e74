"""Candle patterns and the model feature table."""

from dataclasses import replace

from pyspark.sql import Window, functions as F, types as T

from tickloom.functions import candles, dates
from tickloom.layout import layout_of, numbered, over_series
from tickloom.operators.averages import add_recursive
from tickloom.operators.bands import bollinger_frames, rolling_frames, with_bollinger
from tickloom.operators.ladder import add_frames
from tickloom.operators.oscillators import (
    _PARTS,
    add_gains_losses,
    macd_means,
    stochastic_frames,
    wilder_means,
    with_macd_warm,
    with_rsi_wilder,
    with_stochastic,
)


def candle_geometry(bars):
    return bars.withColumns(candles.geometry())


def _add_patterns(df, w):
    df = df.withColumns({"prev_open": F.lag("open").over(w.spec), "prev_close": F.lag("close").over(w.spec)})
    return df.withColumns({**candles.single_patterns(), **candles.engulfing_patterns()})


def candle_patterns(bars, layout=None):
    """Geometry, one-candle patterns and engulfing patterns per row."""
    return over_series(candle_geometry(bars), _add_patterns, back=1, layout=layout)


PATTERNS = ("is_doji", "is_hammer", "is_inv_hammer", "bullish_engulfing", "bearish_engulfing")


def pattern_markers(patterns):
    """Long form: one row per bar and pattern found there."""
    found = [F.when(F.col(p) == 1, F.lit(p)) for p in PATTERNS]
    return patterns.select(
        "pair", "date", "close", F.explode(F.array_compact(F.array(*found))).alias("pattern")
    )


def target_up(df, w):
    """1 where the next close is higher; the last row counts as 0."""
    return df.withColumn("target", candles.flag(F.lead("close").over(w.spec) > F.col("close")))


def ml_features(bars, layout=None):
    """All features and the target, without rows that miss any value.

    One shuffle of the rows: frames are at most TAIL rows, and recursive means hand on one row per block.
    """

    def build(df, w):
        return _add_frame_features(target_up(df, w), w)

    rows = over_series(candle_geometry(bars), build, 20, 1, layout, pos=True, then=_add_recursive_features)
    return _with_time(rows).dropna()


def _add_frame_features(df, w):
    """Features that look at neighbours: patterns, bands, %K, rolling means and deviations."""
    df = _add_patterns(add_gains_losses(df, w), w)
    df = add_frames(df, w, {**bollinger_frames(population=True), **stochastic_frames(), **rolling_frames()})
    df = with_bollinger(df).drop("bb_middle", "bb_std").withColumnsRenamed({"bb_upper": "bb_high", "bb_lower": "bb_low"})
    return with_stochastic(df, "stoch")


def _add_recursive_features(df, w):
    df = add_recursive(df, w, {**wilder_means(), **macd_means()})
    return with_macd_warm(with_rsi_wilder(df).drop(*_PARTS))


def _with_time(rows):
    return rows.withColumns({"hour": F.hour(F.col("date").cast("timestamp")), "day_of_week": dates.monday_based_dow("date")})


TAIL = 20  # bars that the frames of a new bar reach back


def features_of_new(bars, tail, state):
    """Features, without the target, of new daily bars, from the last TAIL bars before and the recursive state.

    ``tail`` holds the newest bars of each instrument seen before, ``state`` what
    ``resume.state_after`` gave for them.  Nothing older is read; rows that miss a value are left out.
    """
    kept = {"close": "close", "ema_12": "ema_12", "ema_26": "ema_26", "_up": "avg_gain", "_down": "avg_loss"}
    handed = state.select("pair", F.col("n").alias("_start"), *[F.col(c).alias(f"_in_{k}") for k, c in kept.items()])
    both = tail.select(*bars.columns).withColumn("_new", F.lit(False)).unionByName(bars.withColumn("_new", F.lit(True)))

    def build(df, w):
        older = F.count(F.when(~F.col("_new"), 1)).over(w.rows(Window.unboundedPreceding, 0))
        return _add_frame_features(df.withColumn("_older", older), w)

    def then(df, w):
        fresh = df.filter("_new").withColumn("_pos", F.col("_pos") - F.col("_older")).drop("_new", "_older")
        return _add_recursive_features(fresh, w)

    whole = replace(layout_of(bars), split=False)
    rows = over_series(candle_geometry(both), build, TAIL, layout=whole, pos=True, then=then, state=handed)
    return _with_time(rows).dropna()


def feature_columns(df, exclude=("target",)):
    """Numeric columns except ``exclude``; read from the schema, no job."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def time_split(rows, share=0.8, layout=None):
    """Mark the first int(share * n) rows of each series as training rows."""
    layout = layout or layout_of(rows)
    counted = numbered(rows, layout, total="_n")
    return counted.withColumn("is_train", F.col("_pos") < F.floor(F.col("_n") * share)).drop(
        "_pos", "_n"
    )


def scaled_columns(rows, columns, train="is_train"):
    """(x - mean) / sample deviation, both taken over the training rows."""
    stats = []
    for c in columns:
        x = F.when(F.col(train), F.col(c))
        stats += [F.avg(x).alias(f"_{c}_mean"), F.stddev_samp(x).alias(f"_{c}_std")]
    one = rows.agg(F.struct(*stats).alias("s")).scalar()
    return rows.withColumn("_s", one).withColumns(
        {
            c: F.try_divide(F.col(c) - F.col("_s")[f"_{c}_mean"], F.col("_s")[f"_{c}_std"])
            for c in columns
        }
    ).drop("_s")
