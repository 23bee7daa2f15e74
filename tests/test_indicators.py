"""Hand-made edge series and pandas as an independent reference."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tickloom.functions.labels import INSUFFICIENT
from tickloom.layout import Layout, over_series
from tickloom.operators import (
    averages, bands, changes, features, oscillators, signals, star, summary, swings,
)


def walk(n, seed=1):
    rng, x, out = random.Random(seed), 100.0, []
    for _ in range(n):
        x *= 1 + rng.uniform(-0.02, 0.02)
        out.append(x)
    return out


def close_to(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        missing = w is None or (isinstance(w, float) and math.isnan(w))
        assert (g is None) if missing else g == pytest.approx(w, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("span", [1, 2, 9, 26, 200])
@pytest.mark.parametrize("n", [1, 127, 1300, 3000])
def test_recursive_mean_equals_ewm(make_bars, span, n):
    x = walk(n)
    got = values(averages.ema(make_bars(A=x), (span,)), f"ema_{span}")
    close_to(got, list(pd.Series(x).ewm(span=span, adjust=False).mean()))


def test_recursive_means_of_very_different_speed(make_bars):
    x = walk(2500)
    out = averages.ema(make_bars(A=x), (2, 500))
    for span in (2, 500):
        close_to(values(out, f"ema_{span}"), list(pd.Series(x).ewm(span=span, adjust=False).mean()))


def test_recursive_mean_after_a_large_drop(make_bars):
    x = [1e9] * 50 + walk(1500)
    got = values(averages.ema(make_bars(A=x), (26,)), "ema_26")
    close_to(got, list(pd.Series(x).ewm(span=26, adjust=False).mean()))


def test_macd_equals_pandas(make_bars):
    x = pd.Series(walk(1500))
    line = x.ewm(span=12, adjust=False).mean() - x.ewm(span=26, adjust=False).mean()
    out = oscillators.macd(make_bars(A=list(x)))
    close_to(values(out, "macd_signal"), list(line.ewm(span=9, adjust=False).mean()))


@pytest.mark.parametrize("n", [1, 7, 90, 91, 200, 201, 450])
def test_means_equal_pandas(make_bars, n):
    x = walk(n)
    partial = averages.moving_averages(make_bars(A=x))
    full = averages.sma_strict(make_bars(A=x))
    for size in (7, 30, 90):
        close_to(values(partial, f"ma_{size}_day"), list(pd.Series(x).rolling(size, min_periods=1).mean()))
    for size in (20, 50, 200):
        close_to(values(full, f"sma_{size}"), list(pd.Series(x).rolling(size).mean()))


def test_long_means_skip_missing_values(make_bars):
    x = [None if i % 5 == 0 else v for i, v in enumerate(walk(400))]
    s = pd.Series(x, dtype=float)
    bars = make_bars(A=x)
    close_to(
        values(averages.moving_averages(bars), "ma_90_day"), list(s.rolling(90, min_periods=1).mean())
    )
    assert set(values(averages.sma_strict(bars), "sma_200")) == {None}


def test_first_rows(make_bars):
    bars = make_bars(A=[5.0], B=[5.0, 6.0])
    rsi = oscillators.technical_rsi(bars)
    assert values(rsi, "rsi_14", pair="A") == [100.0]
    assert values(rsi, "rsi_14", pair="B") == [100.0, 100.0]
    assert values(averages.technical_ema(bars), "ema_9", pair="A") == [None]
    assert values(oscillators.technical_macd(bars), "macd_line", pair="A") == [None]


@pytest.mark.parametrize("n", [13, 14, 15])
def test_strict_and_partial_rsi(make_bars, n):
    bars = make_bars(A=walk(n))
    partial = values(oscillators.technical_rsi(bars), "rsi_14")
    strict = values(oscillators.rsi_strict(bars), "rsi")
    assert strict[:13] == [None] * 13
    close_to(strict[13:], partial[13:])


def test_rsi_extremes(make_bars):
    bars = make_bars(UP=[float(i) for i in range(1, 30)], DOWN=[float(i) for i in range(40, 10, -1)], FLAT=[5.0] * 30)
    assert values(oscillators.technical_rsi(bars), "rsi_14", pair="UP")[-1] == 100.0
    assert values(oscillators.technical_rsi(bars), "rsi_14", pair="DOWN")[-1] == 0.0
    assert values(oscillators.technical_rsi(bars), "rsi_14", pair="FLAT")[-1] == 100.0
    assert values(oscillators.rsi_strict(bars), "rsi", pair="UP")[-1] == 100.0
    assert values(oscillators.rsi_strict(bars), "rsi", pair="FLAT")[-1] is None
    wilder = values(oscillators.rsi_wilder(bars), "rsi", pair="FLAT")
    assert wilder[12] is None and wilder[13] == 100.0


def test_bollinger_warm_up_and_deviation(make_bars):
    x = walk(21)
    for population, ddof in ((False, 1), (True, 0)):
        out = bands.bollinger(make_bars(A=x), population=population)
        close_to(values(out, "bb_std"), list(pd.Series(x).rolling(20).std(ddof=ddof)))


def test_stochastic_of_a_flat_series_is_missing(make_bars):
    assert set(values(oscillators.stochastic(make_bars(A=[3.0] * 20)), "stoch_k")) == {None}


def test_lags_count_rows_not_days(spark, make_bars):
    gappy = make_bars(A=[float(i) for i in range(1, 40)]).filter(F.dayofweek("date").between(2, 6))
    out = changes.rate_lags(gappy)
    closes, lagged = values(out, "close"), values(out, "prev_week_rate")
    assert lagged == [None] * 7 + closes[:-7]


def test_forward_fill(make_bars):
    got = values(changes.forward_fill(make_bars(A=[None, 1.0, None, None, 2.0]), ["close"]), "close")
    assert got == [None, 1.0, 1.0, 1.0, 2.0]


def test_cumulative_and_normalized(make_bars):
    bars = make_bars(A=[(10.0, 12.0, 9.0, 11.0), (11.0, 11.0, 9.0, 9.9)])
    close_to(values(changes.cumulative_return(bars), "cumulative_return"), [0.1, 1.1 * 0.9 - 1])
    close_to(values(changes.normalized_close(bars), "normalized_close"), [100.0, 90.0])


def test_first_date_wins_for_extremes(make_bars):
    bars = make_bars(A=[(1.0, 5.0, 1.0, 2.0), (1.0, 5.0, 1.0, 2.0), (1.0, 4.0, 1.0, 3.0)])
    row = summary.period_stats(bars).first()
    assert str(row.high_date) == "2020-01-01" and str(row.low_date) == "2020-01-01"
    assert row.current_price == 3.0 and row.previous_price == 2.0 and row.trend_signal == "Bearish"


def test_deviation_of_one_row_is_missing(make_bars):
    assert summary.volatility_summary(make_bars(A=[(1.0, 2.0, 1.0, 2.0)])).first().volatility is None


def test_correlation_without_variance_is_missing(make_bars):
    bars = make_bars(A=walk(30, 1), B=walk(30, 2), C=[5.0] * 30)
    got = {(r.pair_a, r.pair_b): r["corr"] for r in summary.returns_correlation(bars, ("A", "B", "C")).collect()}
    want = pd.DataFrame({"A": walk(30, 1), "B": walk(30, 2)}).pct_change().corr()
    assert got["A", "B"] == pytest.approx(want.loc["A", "B"])
    assert got["A", "A"] == pytest.approx(1.0)
    assert got["A", "C"] is None and got["C", "C"] is None


def test_plateau_rows_are_all_swing_points(make_bars):
    lows = [9.0] * 3 + [5.0, 5.0] + [9.0] * 3
    found = values(swings.swing_points(make_bars(A=lows), n=2), "is_support")
    assert [i for i, f in enumerate(found) if f] == [3, 4]


def test_thinning_compares_with_the_last_kept(spark):
    levels = [100.0, 100.9, 101.5, 101.5, 100.0]
    df = spark.createDataFrame(
        [("A", f"2020-01-{i + 1:02d}", "support", v) for i, v in enumerate(levels)],
        "pair string, date string, side string, level double",
    ).withColumn("date", F.to_date("date"))
    assert values(swings.thin_levels(df), "level") == [100.0, 101.5, 100.0]


def brute_levels(bars, n, threshold):
    out = []
    for side, better in (("low", min), ("high", max)):
        kept = []
        for i in range(n, len(bars) - n):
            v = bars[i][side]
            if v == better(b[side] for b in bars[i - n : i + n + 1]):
                if not kept or abs((v - kept[-1]) / kept[-1]) > threshold:
                    kept.append(v)
        out.append(kept)
    return out


@pytest.mark.parametrize("step", [0.2, 1, 5])
def test_levels_equal_a_plain_walk(make_bars, step):
    """Small steps give one long fold, large ones many short folds."""
    coarse = [float(100 + step * round(v - 100)) for v in walk(400, 3)]
    bars = make_bars(A=coarse)
    got = swings.support_resistance_levels(bars, n=3)
    support, resistance = brute_levels([{"low": v, "high": v} for v in coarse], 3, 0.01)
    assert values(got, "level", side="support") == support
    assert values(got, "level", side="resistance") == resistance


@pytest.mark.parametrize("n, text", [(199, INSUFFICIENT), (200, None), (201, None)])
def test_signal_gate(make_bars, n, text):
    row = signals.trading_signals(make_bars(A=walk(n))).first()
    assert (row.overall == INSUFFICIENT) == (text is not None)
    assert (row.rsi is None) == (text is not None)


def test_crossover_on_the_last_row(make_bars):
    bars = make_bars(UP=[100.0] * 150 + [99.0] * 49 + [100.0, 1000.0])
    row = signals.trading_signals(bars).first()
    assert row.moving_average == "Strong Buy (Golden Cross)"
    assert row.bollinger == "Sell (Above Upper Band)"
    assert row.macd.startswith("Buy") or row.macd.startswith("Hold Buy")


def test_signal_counts_include_the_vote(make_bars):
    full = signals.trading_signals(make_bars(A=walk(250)))
    row, counts = full.first(), signals.signal_counts(full).first()
    texts = [row.moving_average, row.rsi, row.macd, row.bollinger, row.overall]
    assert (counts.buy, counts.sell, counts.neutral) == tuple(
        sum(w in t for t in texts) for w in ("Buy", "Sell", "Neutral")
    )


def test_candles(make_bars):
    bars = make_bars(
        A=[
            (10.0, 10.0, 10.0, 10.0),  # no range: no doji, no hammer
            (10.0, 11.0, 9.0, 10.05),  # doji
            (10.0, 10.1, 7.0, 10.05),  # hammer
            (10.0, 10.2, 8.9, 9.0),  # falling
            (8.9, 10.6, 8.8, 10.5),  # bullish engulfing
        ]
    )
    out = features.candle_patterns(bars)
    assert values(out, "is_doji") == [0, 1, 1, 0, 0]
    assert values(out, "is_hammer") == [0, 0, 1, 0, 0]
    assert values(out, "bullish_engulfing") == [0, 0, 0, 0, 1]


def test_last_target_is_zero(make_bars):
    out = over_series(make_bars(A=[1.0, 2.0, 1.0]), features.target_up, ahead=1)
    assert values(out, "target") == [1, 0, 0]


def test_cross_rates_agree(make_bars):
    bars = make_bars(AB=[2.0, 4.0], AC=[6.0, 8.0], BC=[3.0])
    one = star.cross_rates(bars, "AB", "AC", "BC").collect()
    joined = star.cross_rates_joined(bars, "AB", "AC", "BC").collect()
    assert one == joined and len(one) == 1 and one[0].cross_rate_diff_pct == 0.0


def test_synthetic_cross_keeps_the_left_dates(make_bars):
    out = star.synth_cross(make_bars(L=[1.5, 2.0], R=[2.0]), "L", "R", "LR")
    assert values(out, "close") == [3.0, None]


def test_histogram_edges(make_bars):
    out = summary.histogram(make_bars(A=[0.0, 1.0, 50.0], FLAT=[3.0, 3.0]), "close")
    got = {(r.pair, r.bin): r.n for r in out.collect()}
    assert got == {("A", 1): 1, ("A", 2): 1, ("A", 50): 1, ("FLAT", 1): 2}


def test_describe_equals_pandas(make_bars):
    x = walk(37)
    row = summary.describe_exact(make_bars(A=x), ["close"]).first()
    want = pd.Series(x).describe()
    close_to([row["count"], row["mean"], row["std"], row["min"], row.p25, row.p50, row.p75, row["max"]], list(want))
    near = summary.describe_exact(make_bars(A=x), ["close"], exact=False).first()
    assert near.p50 == pytest.approx(row.p50, rel=0.05)


def test_calendar(spark):
    days = star.calendar(star.date_series(spark, "2024-02-28"))
    assert days.count() == 1828
    leap = days.filter("date = DATE '2024-02-29'").first()
    assert (leap.month_name, leap.day_name, leap.day_of_week, leap.is_weekend) == ("February", "Thursday", 4, False)
    assert days.filter("date = DATE '2024-03-03'").first().is_weekend


def test_split_pair(spark):
    base, quote = star.split_pair("p")
    row = spark.createDataFrame([("EUR/USD",)], "p string").select(base.alias("b"), quote.alias("q")).first()
    assert (row.b, row.q) == ("EUR", "USD")


def wilder(x, n=14):
    """Row by row."""
    up = down = None
    out = []
    for i, v in enumerate(x):
        d = 0.0 if i == 0 else v - x[i - 1]
        gain, loss = max(d, 0.0), max(-d, 0.0)
        up, down = (gain, loss) if i == 0 else (up + (gain - up) / n, down + (loss - down) / n)
        out.append(None if i < n - 1 else 100.0 if down == 0 else 100 - 100 / (1 + up / down))
    return out


@pytest.mark.parametrize("layout", [None, Layout(block_rows=64, split=True), Layout(block_rows=4000, split=True)])
def test_wilder_rsi_keeps_its_value_when_a_series_stops(make_bars, layout):
    x = walk(40) + [walk(40)[-1]] * 5000
    got = values(oscillators.rsi_wilder(make_bars(A=x), layout=layout), "rsi")
    close_to(got, wilder(x))
    assert got[-1] == pytest.approx(got[39], rel=1e-6) and got[-1] < 99


@pytest.mark.parametrize("layout", [None, Layout(block_rows=64, split=True)])
def test_recursive_means_over_a_long_series(make_bars, layout):
    x = walk(6000)
    spans = (3, 26, 500)
    out = averages.ema(make_bars(A=x, B=x[:100]), spans, layout=layout)
    for span in spans:
        close_to(values(out, f"ema_{span}", pair="A"), list(pd.Series(x).ewm(span=span, adjust=False).mean()))
        close_to(values(out, f"ema_{span}", pair="B"), list(pd.Series(x[:100]).ewm(span=span, adjust=False).mean()))


def test_a_value_that_left_the_frame_leaves_no_trace(make_bars):
    x = [1.0] * 150 + [1e17] + [1.0] * 450
    out = averages.sma_strict(make_bars(A=x))
    for n in (20, 50, 200):
        assert values(out, f"sma_{n}")[150 + n :] == [1.0] * (450 - n + 1)


def test_a_mean_does_not_depend_on_the_sizes_beside_it(make_bars):
    bars = make_bars(A=walk(300))
    alone = values(averages.technical_ema(bars, (9,)), "ema_9")
    assert alone == values(averages.technical_ema(bars, (9, 26)), "ema_9") == values(averages.technical_ema(bars, (9, 50, 200)), "ema_9")


def test_correlation_mirrors_its_triangle(make_bars):
    bars = make_bars(A=walk(50, 1), B=walk(50, 2), C=[5.0] * 50)
    got = {(r.pair_a, r.pair_b): r.corr for r in summary.returns_correlation(bars, ["A", "B", "C"]).collect()}
    assert len(got) == 9 and got["A", "B"] == got["B", "A"] and got["C", "A"] is None
    assert got["A", "A"] == pytest.approx(1)


def test_calendar_holds_every_date(spark):
    """A wrong date adds its own year only; years between others are filled."""
    days = spark.sql("SELECT explode(array(DATE'0001-01-01', DATE'2199-12-30', DATE'9999-01-01', NULL)) AS date")
    span = star.date_span(days)
    assert span.count() == 365 + 365 + 1
    facts = days.select(F.lit("A").alias("pair"), "date")
    pairs = star.dim_pairs(spark, [("A", "X", "Y")])
    assert star.star_join(facts, star.calendar(span), pairs).count() == 3
    days = spark.sql("SELECT explode(array(DATE'2019-12-30', DATE'2021-01-02')) AS date")
    assert [str(r.date) for r in star.date_span(days).orderBy("date").collect()][::366] == ["2019-12-30", "2020-12-30"]
    assert star.date_span(days.limit(0)).count() == 0
