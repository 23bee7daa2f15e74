"""Recursive indicators that go on where an earlier run stopped.

A daily load brings a few new bars; an EMA, a Wilder RSI or a MACD of them depends on all
bars before.  What those amount to is one row per instrument, the *state*: how many
rows there were, the last date and close, and the last value of every recursive mean.  A run
starts from the state, reads the new bars only, and gives the next state.
"""

from pyspark.sql import functions as F

from tickloom.layout import over_series
from tickloom.operators.averages import add_recursive
from tickloom.operators.oscillators import (
    add_gains_losses,
    macd_means,
    macd_signal,
    wilder_means,
    with_macd,
    with_rsi_wilder,
)
from tickloom.operators.select import with_marks


def _kept(fast, slow):
    """Columns of the state: name of the mean -> name in the state."""
    return {"close": "close", f"ema_{fast}": f"ema_{fast}", f"ema_{slow}": f"ema_{slow}", "macd_signal": "macd_signal", "_up": "avg_gain", "_down": "avg_loss"}


def newer_bars(bars, state):
    """Bars after the last date of their instrument in ``state``; all bars of new instruments."""
    marked = with_marks(bars, state.select("pair", F.col("date").alias("_last")), "pair", "left")
    return marked.filter(F.col("_last").isNull() | (F.col("date") > F.col("_last"))).select(*bars.columns)


def recursive_indicators(bars, state=None, layout=None, rsi=14, fast=12, slow=26, signal=9):
    """EMAs, MACD and Wilder's RSI of ``bars``, which continue ``state`` if there is one.

    ``bars`` must be newer than the state (see ``newer_bars``).  ``n`` numbers the rows of the
    whole series.
    """
    kept = _kept(fast, slow)
    if state is not None:
        state = state.select("pair", F.col("n").alias("_start"), *[F.col(c).alias(f"_in_{k}") for k, c in kept.items()])

    def then(df, w):
        df = add_recursive(df, w, {**wilder_means(rsi), **macd_means(fast, slow)}, macd_signal(fast, slow, signal))
        before = F.col("_start") if "_start" in df.columns else F.lit(0)
        df = with_rsi_wilder(with_macd(df, fast, slow), rsi).withColumn("n", F.col("_pos") + before + 1)
        return df.withColumnsRenamed({k: c for k, c in kept.items() if k != c}).drop("_diff", "_gain", "_loss")

    needed = bars.select("pair", "date", "close")
    return over_series(needed, add_gains_losses, back=1, layout=layout, pos=True, then=then, state=state)


def state_after(indicators, before=None, fast=12, slow=26):
    """The state after these rows; instruments without new rows keep what they had ``before``."""
    columns = ["n", *_kept(fast, slow).values()]
    last = indicators.groupBy("pair").agg(F.max("date").alias("date"), *[F.max_by(c, "date").alias(c) for c in columns])
    if before is None:
        return last
    return last.unionByName(before.select(*last.columns).join(last, "pair", "left_anti"))
