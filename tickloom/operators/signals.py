"""Dashboard signals: state of four indicators at the newest row and their vote."""

from pyspark.sql import functions as F

from tickloom.functions import labels
from tickloom.layout import over_series
from tickloom.operators import ladder
from tickloom.operators.bands import bollinger_frames, with_bollinger
from tickloom.operators.ladder import add_frames
from tickloom.operators.oscillators import (
    add_gains_losses,
    add_macd_recursive,
    gain_loss_frames,
    with_rsi_strict,
)
from tickloom.operators.select import latest_per_pair

STATES = ("moving_average", "rsi", "macd", "bollinger")


_SMAS = {f"sma_{n}": ladder.mean("close", n, True) for n in (50, 200)}


def _add_smas(df, w, others=None):
    df = add_frames(df, w, {**_SMAS, **(others or {})})
    return df.withColumns({f"_prev_sma_{n}": F.lag(f"sma_{n}").over(w.spec) for n in (50, 200)})


def _sma_state():
    return labels.sma_state(*(F.col(c) for c in ("sma_50", "sma_200", "_prev_sma_50", "_prev_sma_200")))


def ma_crossovers(bars, layout=None):
    """Rows where the 50-row mean crosses the 200-row mean."""
    states = over_series(
        bars,
        lambda df, w: _add_smas(df, w).withColumn("ma_signal", _sma_state()),
        back=201,
        layout=layout,
    )
    return states.filter(F.col("ma_signal").startswith("Strong")).drop(
        "_prev_sma_50", "_prev_sma_200"
    )


def signal_states(bars, within=None, layout=None):
    """Labels of all four indicators at the newest row of each series.

    ``within`` (a condition on the date) picks the shown period: indicators see the
    whole series, the newest row and the 200-row gate see the period.
    """

    def build(df, w):
        df = _add_smas(add_gains_losses(df, w), w, {**gain_loss_frames(14, True), **bollinger_frames()})
        return with_bollinger(with_rsi_strict(df, "rsi_value"))

    def then(df, w):
        df = add_macd_recursive(df, w, lagged=("ema_12", "ema_26", "macd_signal"))
        df = df.withColumn("_prev_macd", F.col("_prev_ema_12") - F.col("_prev_ema_26"))
        macd = (F.col(c) for c in ("macd", "macd_signal", "_prev_macd", "_prev_macd_signal"))
        return df.select(
            "pair",
            "date",
            (F.col("_pos") + 1).alias("rows"),
            _sma_state().alias("moving_average"),
            labels.rsi_state("rsi_value").alias("rsi"),
            labels.macd_state(*macd).alias("_macd_state"),
            labels.band_state("close", "bb_upper", "bb_lower").alias("bollinger"),
            *([c for c in df.columns if c in ("_blk", "_pos")]),
        ).withColumnRenamed("_macd_state", "macd")

    states = over_series(bars, build, back=201, layout=layout, pos=True, then=then)
    if within is not None:
        held = bars.filter(within).groupBy("pair").agg(F.count(F.lit(1)).alias("rows"))
        newest = latest_per_pair(states.filter(within).drop("rows")).join(held, "pair")
    else:
        newest = latest_per_pair(states)
    return newest.withColumn("enough_rows", F.col("rows") >= labels.MIN_SIGNAL_ROWS)


def trading_signals(bars, within=None, layout=None):
    """One row per series: the four states and the overall vote."""
    states = signal_states(bars, within, layout)
    vote = labels.vote_text(F.array(*STATES))
    gate = F.col("enough_rows")
    return states.select(
        "pair",
        "date",
        *[F.when(gate, F.col(s)).alias(s) for s in STATES],
        F.when(gate, vote).otherwise(labels.INSUFFICIENT).alias("overall"),
    )


def signal_counts(signals):
    """How many of a series' labels, the overall one included, name each side."""
    present = F.array_compact(F.array(*STATES, "overall"))
    return signals.select(
        "pair",
        *[
            labels.count_containing(present, word).cast("long").alias(word.lower())
            for word in ("Buy", "Sell", "Neutral")
        ],
    )
