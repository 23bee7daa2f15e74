"""Bands and rolling spread: Bollinger (two deviations), price band, volatility."""

from pyspark.sql import functions as F

from tickloom.functions.prices import change_percent, percent_of
from tickloom.layout import over_series
from tickloom.operators import ladder
from tickloom.operators.ladder import Frame, add_frames


def bollinger_frames(n=20, population=False):
    return {"bb_middle": ladder.mean("close", n, True), "bb_std": ladder.std("close", n, population)}


def with_bollinger(df, k=2):
    return df.withColumns(
        {
            "bb_upper": F.col("bb_middle") + k * F.col("bb_std"),
            "bb_lower": F.col("bb_middle") - k * F.col("bb_std"),
        }
    )


def add_bollinger(df, w, n=20, k=2, population=False):
    """Strict mean +- k deviations; sample deviation unless ``population``."""
    return with_bollinger(add_frames(df, w, bollinger_frames(n, population)), k)


def bollinger(bars, n=20, k=2, population=False, layout=None):
    return over_series(
        bars, lambda df, w: add_bollinger(df, w, n, k, population), back=n - 1, layout=layout
    )


def rolling_frames(sizes=(3, 5, 10)):
    """Strict mean and deviation of close, mean of range and body, per frame size.

    Needs the columns hl and oc.
    """
    frames = {}
    for n in sizes:
        frames[f"close_roll_mean_{n}"] = ladder.mean("close", n, True)
        frames[f"close_roll_std_{n}"] = ladder.std("close", n)
        frames[f"hl_roll_mean_{n}"] = ladder.mean("hl", n, True)
        frames[f"oc_roll_mean_{n}"] = ladder.mean("oc", n, True)
    return frames


def rolling_features(bars, sizes=(3, 5, 10), layout=None):
    sized = bars.withColumns(
        {"hl": F.col("high") - F.col("low"), "oc": F.col("close") - F.col("open")}
    )
    return over_series(
        sized, lambda df, w: add_frames(df, w, rolling_frames(sizes)), max(sizes) - 1, layout=layout
    )


def rolling_volatility(bars, n=20, layout=None):
    """Strict n-row deviation of the daily change percent.  Slice first, then call."""
    moved = bars.withColumn("daily_change_percent", change_percent())
    return over_series(
        moved,
        lambda df, w: add_frames(df, w, {"rolling_volatility": ladder.std("daily_change_percent", n)}),
        back=n - 1,
        layout=layout,
    )


def price_band(rows, n=20, layout=None):
    """Lowest and highest close within n rows on both sides, and the width in percent."""

    def build(df, w):
        ends = {"support_level": (ladder.LOW, F.least), "resistance_level": (ladder.HIGH, F.greatest)}
        sides = {f"_{out}_{s}": Frame(kind, "close", n + 1, forward=s == "on") for out, (kind, _) in ends.items() for s in ("back", "on")}
        df = add_frames(df, w, sides)
        df = df.withColumns({out: both(f"_{out}_back", f"_{out}_on") for out, (_, both) in ends.items()}).drop(*sides)
        width = F.col("resistance_level") - F.col("support_level")
        return df.withColumn("price_channel_width_pct", percent_of(width, "support_level"))

    return over_series(rows, build, back=n, ahead=n, layout=layout)


def usual_move(rows, n=21, layout=None):
    """Partial n-row mean of the absolute daily change percent."""
    return over_series(
        rows.withColumn("_size", F.abs("daily_change_percent")),
        lambda df, w: add_frames(df, w, {"avg_volatility_21d": ladder.mean("_size", n)}).drop("_size"),
        back=n - 1,
        layout=layout,
    )
