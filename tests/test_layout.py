"""The split layout must give what an uncut series gives."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from tickloom.layout import Layout, layout_of, numbered, over_series
from tickloom.operators import averages, bands, changes, features, oscillators, swings

STEP = 60


@pytest.fixture(scope="module")
def minutes(spark):
    """Minute bars: one long series, one with wide gaps, one of a single row."""
    rng = random.Random(7)
    rows = []
    start = dt.datetime(2024, 1, 1)
    for pair, n, gap in (("HOT", 700, 1), ("THIN", 120, 97), ("ONE", 1, 1)):
        for i in range(n):
            c = 100 + rng.random() * 10
            o = 100 + rng.random() * 10
            rows.append((pair, start + dt.timedelta(minutes=i * gap), o, max(o, c) + 1, min(o, c) - 1, c))
    schema = T.StructType(
        [T.StructField("pair", T.StringType()), T.StructField("date", T.TimestampType())]
        + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")]
    )
    return spark.createDataFrame(rows, schema).repartition(4).cache()


def plain():
    return Layout(step=STEP)


def split(rows):
    return Layout(step=STEP, block_rows=rows, split=True)


def same(a, b):
    def frame(df):
        return df.toPandas().sort_values(["pair", "date"], ignore_index=True)[sorted(a.columns)]

    pd.testing.assert_frame_equal(frame(a), frame(b), check_dtype=False, rtol=1e-9, atol=1e-9)


OPERATORS = {
    "moving_averages": averages.moving_averages,
    "sma_strict": averages.sma_strict,
    "technical_ema": averages.technical_ema,
    "ema": averages.ema,
    "macd": oscillators.macd,
    "technical_macd": oscillators.technical_macd,
    "technical_rsi": oscillators.technical_rsi,
    "rsi_strict": oscillators.rsi_strict,
    "rsi_wilder": oscillators.rsi_wilder,
    "stochastic": oscillators.stochastic,
    "bollinger": bands.bollinger,
    "price_band": bands.price_band,
    "swing_points": swings.swing_points,
    "rate_changes": changes.rate_changes,
    "period_returns": changes.period_returns,
    "normalized_close": changes.normalized_close,
    "cumulative_return": changes.cumulative_return,
    "candle_patterns": features.candle_patterns,
    "ml_features": features.ml_features,
    "support_resistance_levels": swings.support_resistance_levels,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_split_equals_whole(minutes, name):
    op = OPERATORS[name]
    same(op(minutes, layout=plain()), op(minutes, layout=split(64)))


@pytest.mark.parametrize("rows", [16, 33, 1000])
def test_positions(minutes, rows):
    got = numbered(minutes, split(rows), total="n").toPandas().sort_values(["pair", "date"])
    for _, g in got.groupby("pair"):
        assert list(g["_pos"]) == list(range(len(g)))
        assert set(g["n"]) == {len(g)}


def test_frames_longer_than_a_block(minutes):
    """A frame may be longer than the block length asked for; blocks then grow."""
    same(averages.sma_strict(minutes, layout=plain()), averages.sma_strict(minutes, layout=split(8)))


def test_fill_carries_over_blocks(minutes):
    gappy = minutes.withColumn("close", F.when(F.minute("date") == 0, F.col("close")))
    a = changes.forward_fill(gappy, ["close"], plain())
    b = changes.forward_fill(gappy, ["close"], split(16))
    same(a, b)


def test_running_count_over_blocks(minutes):
    labelled = minutes.withColumn("label", F.when(F.col("close") > F.col("open"), "up").otherwise("down"))
    a = changes.running_count(labelled, "label", "n", plain())
    b = changes.running_count(labelled, "label", "n", split(16))
    same(a, b)


def test_layout_follows_the_order_type(minutes, make_bars):
    assert not layout_of(make_bars(A=[1.0])).split
    assert layout_of(minutes, step=STEP).split
    with pytest.raises(ValueError):
        layout_of(minutes)


def test_daily_pass_shuffles_once(make_bars):
    """All indicators of a daily series share one exchange."""
    bars = make_bars(A=[1.0, 2.0, 3.0])

    def build(df, w):
        df = averages.add_means(df, w, {"m": ("close", 200)})
        return oscillators.add_rsi_partial(df, w)

    plan = over_series(bars, build, back=200, pos=True, then=oscillators.add_macd_recursive)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
