"""RSI (three definitions), stochastic %K and MACD (three definitions)."""

from pyspark.sql import functions as F

from tickloom.functions.prices import percent_of
from tickloom.layout import over_series
from tickloom.operators import ladder
from tickloom.operators.averages import (
    add_one_step_emas,
    add_recursive,
    alpha_of_span,
    last_rows,
    warm,
)
from tickloom.operators.ladder import Frame, add_frames


def add_gains_losses(df, w, c="close"):
    """_gain and _loss against the row before (or the close of an earlier run); the first row counts as 0 / 0."""
    before = F.lag(c).over(w.spec)
    if f"_in_{c}" in df.columns:
        before = F.coalesce(before, F.col(f"_in_{c}"))
    df = df.withColumn("_diff", F.col(c) - before)
    return df.withColumns(
        {
            "_gain": F.when(F.col("_diff") > 0, F.col("_diff")).otherwise(0.0),
            "_loss": F.when(F.col("_diff") < 0, -F.col("_diff")).otherwise(0.0),
        }
    )


_PARTS = ("_diff", "_gain", "_loss", "_up", "_down")


def rsi_of(up, down):
    return F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + F.try_divide(up, down))


def gain_loss_frames(n, full=False):
    return {"_up": ladder.mean("_gain", n, full), "_down": ladder.mean("_loss", n, full)}


def with_rsi_partial(df, out="rsi_14"):
    """From partial means; no loss at all gives 100."""
    up, down = F.col("_up"), F.col("_down")
    return df.withColumn(out, F.when(down == 0, 100.0).otherwise(rsi_of(up, down))).drop(*_PARTS)


def with_rsi_strict(df, out="rsi"):
    """From full means; only gains give 100, a flat frame gives NULL."""
    up, down = F.col("_up"), F.col("_down")
    value = F.when((down == 0) & (up > 0), 100.0).otherwise(rsi_of(up, down))
    return df.withColumn(out, value).drop(*_PARTS)


def add_rsi_partial(df, w, n=14, out="rsi_14"):
    """Simple means over the rows there are; no loss at all gives 100."""
    return with_rsi_partial(add_frames(add_gains_losses(df, w), w, gain_loss_frames(n)), out)


def add_rsi_strict(df, w, n=14, out="rsi"):
    """Simple means over full frames; only gains give 100, a flat frame gives NULL."""
    return with_rsi_strict(add_frames(add_gains_losses(df, w), w, gain_loss_frames(n, True)), out)


def wilder_means(n=14):
    """Recursive means with weight 1/n of gains and losses (Wilder 1978)."""
    return {"_up": ("_gain", 1 / n), "_down": ("_loss", 1 / n)}


def with_rsi_wilder(df, n=14, out="rsi"):
    """From Wilder's means; NULL for the first n - 1 rows of a series."""
    up, down = F.col("_up"), F.col("_down")
    value = F.when(down == 0, 100.0).otherwise(rsi_of(up, down))
    place = F.col("_pos") + (F.col("_start") if "_start" in df.columns else 0)
    return df.withColumn(out, F.when(place >= n - 1, value))


def technical_rsi(bars, n=14, layout=None):
    return over_series(bars, lambda df, w: add_rsi_partial(df, w, n), back=n, layout=layout)


def rsi_strict(bars, n=14, layout=None):
    return over_series(bars, lambda df, w: add_rsi_strict(df, w, n), back=n, layout=layout)


def rsi_wilder(bars, n=14, layout=None):
    return over_series(
        bars,
        add_gains_losses,
        back=1,
        layout=layout,
        pos=True,
        then=lambda df, w: with_rsi_wilder(add_recursive(df, w, wilder_means(n)), n).drop(*_PARTS),
    )


def stochastic_frames(n=14):
    return {"_lo": Frame(ladder.LOW, "low", n, True), "_hi": Frame(ladder.HIGH, "high", n, True)}


def with_stochastic(df, out="stoch_k"):
    """Place of the close inside the range of a full frame, 0..100; NULL if the range is 0."""
    place = percent_of(F.col("close") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.withColumn(out, place).drop("_lo", "_hi")


def stochastic(bars, n=14, layout=None):
    return over_series(
        bars, lambda df, w: with_stochastic(add_frames(df, w, stochastic_frames(n))), back=n - 1, layout=layout
    )


def with_macd_simple(df, w, fast=12, slow=26, signal=9, keep_emas=True):
    """Line of two one-step EMAs and a simple mean of the line as signal."""
    df = df.withColumn("macd_line", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    df = df.withColumn("signal_line", F.avg("macd_line").over(last_rows(w, signal)))
    df = df.withColumn("macd_histogram", F.col("macd_line") - F.col("signal_line"))
    return df if keep_emas else df.drop(f"ema_{fast}", f"ema_{slow}")


def add_macd_simple(df, w, fast=12, slow=26, signal=9, keep_emas=True):
    return with_macd_simple(add_one_step_emas(df, w, (fast, slow)), w, fast, slow, signal, keep_emas)


def technical_macd(bars, fast=12, slow=26, signal=9, layout=None):
    return over_series(
        bars,
        lambda df, w: add_macd_simple(df, w, fast, slow, signal),
        back=slow + signal,
        layout=layout,
    )


def macd_means(fast=12, slow=26):
    return {f"ema_{n}": ("close", alpha_of_span(n)) for n in (fast, slow)}


def macd_signal(fast=12, slow=26, signal=9):
    """The signal, a recursive mean of the difference of two."""
    return {"macd_signal": ({f"ema_{fast}": 1.0, f"ema_{slow}": -1.0}, alpha_of_span(signal))}


def with_macd(df, fast=12, slow=26):
    df = df.withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    return df.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def add_macd_recursive(df, w, fast=12, slow=26, signal=9, lagged=()):
    """Recursive EMAs and a recursive mean of the line as signal; see ``add_recursive``."""
    return with_macd(add_recursive(df, w, macd_means(fast, slow), macd_signal(fast, slow, signal), lagged), fast, slow)


def macd(bars, fast=12, slow=26, signal=9, layout=None):
    return over_series(
        bars,
        then=lambda df, w: add_macd_recursive(df, w, fast, slow, signal),
        layout=layout,
        pos=True,
    )


def with_macd_warm(df, fast=12, slow=26):
    """EMAs with warm-up and their difference."""
    return warm(df, (fast, slow)).withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
