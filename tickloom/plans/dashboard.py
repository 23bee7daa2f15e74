"""Dashboard tables: indicators over the whole series first, the shown period after.

The order matters: a mean over 200 rows needs rows from before the period, while a
cumulative return or a rolling volatility starts with the period.
"""

from pyspark.sql import functions as F

from tickloom.functions.prices import percent_of
from tickloom.layout import over_series
from tickloom.operators import ladder
from tickloom.operators.bands import bollinger_frames, with_bollinger
from tickloom.operators.bars import with_changes
from tickloom.operators.ladder import add_frames
from tickloom.operators.oscillators import (
    add_gains_losses,
    add_macd_recursive,
    gain_loss_frames,
    with_rsi_strict,
)

RETURN_ROWS = {"weekly_return": 5, "monthly_return": 20}


def add_indicators(bars, layout=None):
    """All dashboard indicators of every row, in one windowed pass."""

    def build(df, w):
        smas = {f"sma_{n}": ladder.mean("close", n, True) for n in (20, 50, 200)}
        df = add_frames(add_gains_losses(df, w), w, {**smas, **gain_loss_frames(14, True), **bollinger_frames()})
        df = with_bollinger(with_rsi_strict(df))

        def n_row_return(n):
            before = F.lag("close", n).over(w.spec)
            return percent_of(F.col("close") - before, before)

        return df.withColumns({k: n_row_return(n) for k, n in RETURN_ROWS.items()})

    return with_changes(over_series(bars, build, back=200, layout=layout, pos=True, then=add_macd_recursive))


def price_panel(bars, within, layout=None):
    """Candles with the three strict means."""
    return add_indicators(bars, layout).filter(within).select(
        "pair", "date", "open", "high", "low", "close", "sma_20", "sma_50", "sma_200"
    )


def indicator_panel(bars, within, layout=None):
    """MACD, RSI and Bollinger panels."""
    return add_indicators(bars, layout).filter(within).select(
        "pair", "date", "close", "macd", "macd_signal", "macd_histogram", "rsi",
        "bb_upper", "bb_middle", "bb_lower",
    )
