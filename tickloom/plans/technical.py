"""The combined technical view and the analyses that read it."""

from pyspark.sql import Window, functions as F

from tickloom.functions import labels
from tickloom.layout import over_series
from tickloom.operators.averages import one_step_frames, technical_ema, with_one_step_emas
from tickloom.operators.bands import price_band, usual_move
from tickloom.operators.changes import running_count
from tickloom.operators.ladder import add_frames
from tickloom.operators.oscillators import (
    add_gains_losses,
    gain_loss_frames,
    technical_macd,
    technical_rsi,
    with_macd_simple,
    with_rsi_partial,
)
from tickloom.operators.select import as_of_column, last_n, latest_date, trailing
from tickloom.operators.summary import performance_summary as summarize

LOOK_BACK = 51  # a lag of a 50-row mean, from running sums
COLUMNS = (
    "date", "pair", "close", "daily_change_percent", "rsi_14", "ema_9", "ema_22", "ema_50",
    "macd_line", "signal_line", "macd_histogram",
)


def _with_labels(rows):
    return rows.select(
        *COLUMNS,
        labels.rsi_signal().alias("rsi_signal"),
        labels.trend_signal().alias("trend_signal"),
        labels.macd_signal().alias("macd_signal"),
    )


def recent_with_history(rows, cut, back):
    """Rows from ``cut`` on plus each series' last ``back`` rows before it.

    The older part is cut to ``back`` rows per series before it is shuffled, so a
    trailing view over decades of bars moves only the trailing part.
    """
    older = last_n(rows.filter(F.col("date") < cut), back)
    return rows.filter(F.col("date") >= cut).unionByName(older)


def technical_analysis(fact, as_of=None, days=90, layout=None):
    """All indicators and labels of the last ``days`` days in one windowed pass."""
    needed = fact.select("pair", "date", "close", "daily_change_percent")
    cut = F.date_sub(as_of_column(fact, as_of), days)

    def build(df, w):
        sizes = (9, 12, 22, 26, 50)
        df = add_frames(add_gains_losses(df, w), w, {**gain_loss_frames(14), **one_step_frames(sizes)})
        df = with_one_step_emas(with_rsi_partial(df), w, sizes)
        return with_macd_simple(df, w, keep_emas=False)

    needed = recent_with_history(needed, cut, LOOK_BACK)
    rows = over_series(needed, build, LOOK_BACK, layout=layout)
    return _with_labels(rows.filter(F.col("date") >= cut))


def technical_analysis_joined(fact, as_of=None, days=90, layout=None):
    """The same view as a join of the three indicator views."""
    keys = ["date", "pair"]
    bars = fact.select("pair", "date", "close")
    rsi = technical_rsi(bars, layout=layout).select(*keys, "rsi_14")
    ema = technical_ema(bars, layout=layout).select(*keys, "ema_9", "ema_22", "ema_50")
    macd = technical_macd(bars, layout=layout).select(
        *keys, "macd_line", "signal_line", "macd_histogram"
    )
    recent = trailing(fact, days, as_of)
    joined = recent.join(rsi, keys, "left").join(ema, keys, "left").join(macd, keys, "left")
    return _with_labels(joined)


def latest_signals(ta, newest=None):
    """Rows of the newest date of the view; pass it if known, to save looking for it."""
    return ta.filter(F.col("date") == (latest_date(ta) if newest is None else newest))


def strong_signals(ta, as_of=None, days=7):
    """Rows where indicators point the same way."""
    rsi, trend, macd = F.col("rsi_signal"), F.col("trend_signal"), F.col("macd_signal")
    aligned = (
        ((rsi == "Oversold") & (macd == "Buy"))
        | ((rsi == "Overbought") & (macd == "Sell"))
        | (trend.startswith("Strong") & (macd != "Hold"))
    )
    return trailing(ta, days, as_of).filter(aligned)


def volatility_signal(ta, as_of=None, days=30, layout=None):
    """Today's move against the 21-row mean move, taken over the whole view."""
    rows = usual_move(ta, layout=layout)
    level = labels.volatility_level(F.abs("daily_change_percent"), "avg_volatility_21d")
    return trailing(
        rows.select("pair", "date", "close", "daily_change_percent", "avg_volatility_21d",
                    level.alias("volatility_signal")),
        days,
        as_of if as_of is not None else latest_date(ta),
    )


def trend_duration(ta):
    """Rows of the newest trend label so far (all of them, consecutive or not).

    One aggregate per (instrument, label); the label seen last wins.  No series is
    ordered for it.
    """
    per_label = ta.filter(F.col("trend_signal") != "Neutral").groupBy("pair", "trend_signal").agg(
        F.count(F.lit(1)).alias("days_in_current_trend"),
        F.max("date").alias("latest_date"),
        F.max_by("close", "date").alias("close"),
    )
    newest = F.max("latest_date").over(Window.partitionBy("pair"))
    return per_label.withColumn("_newest", newest).filter("latest_date = _newest").drop("_newest")


def trend_running_days(ta, layout=None):
    """Per row: how many rows of the series had this row's trend label so far."""
    trending = ta.filter(F.col("trend_signal") != "Neutral")
    return running_count(trending, "trend_signal", "trend_duration", layout)


def rsi_divergence(ta, as_of=None, days=14, layout=None):
    """Price and RSI moving apart; the period is cut before looking at the row before."""

    def build(df, w):
        price, rsi = F.col("close"), F.col("rsi_14")
        label = labels.divergence(price, F.lag("close").over(w.spec), rsi, F.lag("rsi_14").over(w.spec))
        return df.withColumn("divergence_signal", label)

    rows = over_series(trailing(ta, days, as_of), build, back=1, layout=layout)
    return rows.filter(F.col("divergence_signal") != "No Divergence").select(
        "pair", "date", "close", "rsi_14", "divergence_signal"
    )


def support_resistance_band(ta, as_of=None, days=30, layout=None):
    rows = price_band(ta.select("pair", "date", "close"), 20, layout)
    return trailing(rows, days, as_of if as_of is not None else latest_date(ta))


def multi_timeframe(ta, as_of=None, days=30, layout=None):
    """Close against its 5-row and 22-row partial means over the view."""

    def build(df, w):
        week = F.avg("close").over(w.rows(-4, 0))
        month = F.avg("close").over(w.rows(-21, 0))
        df = df.withColumns({"_week": week, "_month": month})
        label = labels.timeframe_trend("close", "_week", "_month")
        return df.withColumn("multi_timeframe_trend", label).drop("_week", "_month")

    view = ta.select("pair", "date", "close", F.col("trend_signal").alias("daily_trend"))
    rows = over_series(view, build, back=21, layout=layout)
    return trailing(rows, days, as_of if as_of is not None else latest_date(ta))


def performance_summary(ta, as_of=None, days=30):
    return summarize(trailing(ta, days, as_of))


def recent_signals(ta, n=10):
    """Newest n rows per series whose trend label is not neutral."""
    loud = ta.filter(F.col("trend_signal") != "Neutral")
    return last_n(loud.select("pair", "date", "close", "trend_signal", "rsi_14"), n)


