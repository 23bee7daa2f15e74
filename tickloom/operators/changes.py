"""Lags, returns, fills and other changes along a series."""

from pyspark.sql import Window, functions as F

from tickloom.functions.prices import change_percent, percent_of
from tickloom.layout import layout_of, over_prefix, over_series
from tickloom.schema import OHLC


def add_rate_lags(df, w, c="close"):
    """Close 1, 7 and 30 rows (not calendar days) before."""
    return df.withColumns(
        {
            "prev_day_rate": F.lag(c, 1).over(w.spec),
            "prev_week_rate": F.lag(c, 7).over(w.spec),
            "prev_month_rate": F.lag(c, 30).over(w.spec),
        }
    )


def rate_lags(bars, layout=None):
    return over_series(bars, add_rate_lags, back=30, layout=layout)


def rate_changes(bars, layout=None):
    """Change in percent against the close 7 and 30 rows before."""
    lagged = rate_lags(bars, layout)
    return lagged.withColumns(
        {
            f"{name}_change_pct": percent_of(
                F.col("close") - F.col(f"prev_{source}_rate"), f"prev_{source}_rate"
            )
            for name, source in (("weekly", "week"), ("monthly", "month"))
        }
    )


def period_returns(bars, names=(("weekly_return", 5), ("monthly_return", 20)), layout=None):
    """Percent return over n rows."""
    return over_series(
        bars,
        lambda df, w: df.withColumns(
            {
                out: percent_of(F.col("close") - F.lag("close", n).over(w.spec), F.lag("close", n).over(w.spec))
                for out, n in names
            }
        ),
        back=max(n for _, n in names),
        layout=layout,
    )


def forward_fill(bars, columns=OHLC, layout=None):
    """Replace NULL by the last value before it; leading NULLs stay."""
    layout = layout or layout_of(bars)

    def build(df, w):
        so_far = w.rows(Window.unboundedPreceding, 0)
        return df.withColumns(
            {
                c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_{c}_before"))
                for c in columns
            }
        )

    def latest(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(layout.order)))

    return over_prefix(
        bars,
        build,
        {f"_{c}_last": latest(c) for c in columns},
        {
            f"_{c}_before": (lambda w, c=c: F.last(f"_{c}_last", ignorenulls=True).over(w))
            for c in columns
        },
        layout,
    )


def cumulative_return(bars, layout=None):
    """Running product of 1 + daily change, minus 1.  Slice first, then call."""
    growth = 1 + F.col("daily_change_percent") / 100
    moved = bars.withColumn("daily_change_percent", change_percent())

    def build(df, w):
        so_far = F.product(growth).over(w.rows(Window.unboundedPreceding, 0))
        before = F.coalesce(F.col("_growth_before"), F.lit(1.0))
        return df.withColumn("cumulative_return", so_far * before - 1)

    return over_prefix(
        moved,
        build,
        {"_growth": F.product(growth)},
        {"_growth_before": lambda w: F.product("_growth").over(w)},
        layout,
    )


def normalized_close(bars, layout=None):
    """Close as a share of the first close of the series, base 100."""
    layout = layout or layout_of(bars)

    def build(df, w):
        own = F.first("close").over(w.rows(Window.unboundedPreceding, 0))
        base = F.coalesce(F.col("_first_before"), own)
        return df.withColumn("normalized_close", percent_of("close", base))

    return over_prefix(
        bars,
        build,
        {"_first": F.min_by("close", layout.order)},
        {"_first_before": lambda w: F.first("_first").over(w)},
        layout,
    )


def running_count(rows, within, out, layout=None):
    """Rows so far in the series with the same value of ``within``.

    The count is per (series, value), so the series key is widened by the value.
    """
    layout = layout or layout_of(rows)
    if not layout.split:
        w = layout.window(within).rows(Window.unboundedPreceding, 0)
        return rows.withColumn(out, F.count(F.lit(1)).over(w))
    joint = F.concat_ws("\x1f", layout.key, within)
    keyed = rows.withColumn("_joint", joint)

    def build(df, w):
        here = F.count(F.lit(1)).over(w.rows(Window.unboundedPreceding, 0))
        return df.withColumn(out, here + F.coalesce(F.col("_n_before"), F.lit(0)))

    wide = type(layout)("_joint", layout.order, layout.step, layout.block_rows, True)
    return over_prefix(
        keyed,
        build,
        {"_n": F.count(F.lit(1))},
        {"_n_before": lambda w: F.sum("_n").over(w)},
        wide,
    ).drop("_joint")
