"""Bars from quotes, and derived columns of a bar."""

from pyspark.sql import functions as F

from tickloom.functions import dates, prices


def build_bars(ticks, keys=("pair", "date"), price="price", order="k", average=None):
    """Open, high, low and close of each group of ticks.

    One hash aggregate with a map-side half, so a group holding a third of all
    ticks reaches its reducer as one row per map task.  ``order`` is one column or
    expression of fixed width that ranks the ticks inside a bar (see ``one_rank``);
    it should be unique there.
    """
    rank = F.col(order) if isinstance(order, str) else order
    aggs = [
        F.min_by(price, rank).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, rank).alias("close"),
    ]
    if average:
        aggs.append(F.avg(price).alias(average))
    return ticks.groupBy(*keys).agg(*aggs)


def one_rank(first, second, digits=20):
    """Two whole numbers as one that sorts by the first, then the second (of at most ``digits`` digits).

    A decimal is of fixed width, so min_by and max_by over it stay hash aggregates; over a
    struct Spark would sort all rows.
    """
    shift = F.lit(str(10**digits)).cast("decimal(38,0)")
    return (F.col(first) if isinstance(first, str) else first).cast("decimal(38,0)") * shift + (
        F.col(second) if isinstance(second, str) else second
    ).cast("decimal(38,0)")


def time_rank(ts, tie=None):
    """Order of quotes inside a bar: by time, then by the column ``tie`` if there is one."""
    if tie is None:
        return F.col(ts)
    return one_rank(F.unix_micros(F.col(ts).cast("timestamp")), F.col(tie))


def ohlc_bars(quotes, width, ts="ts", keys=("pair",), price="price", average="avg_rate", tie=None):
    """Bars of ``width`` seconds; the bar time is the start of its slot, ``tie`` orders equal times."""
    start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / width) * width)
    slotted = quotes.withColumn("date", start)
    ranked = slotted.withColumn("_rank", time_rank(ts, tie))
    return build_bars(ranked, (*keys, "date"), price, "_rank", average)


def with_changes(bars):
    """Open-to-close change and high-low range, absolute and in percent."""
    return bars.withColumns(
        {
            "daily_change": prices.change(),
            "daily_change_percent": prices.change_percent(),
            "daily_range": prices.spread(),
            "daily_range_percent": prices.spread_percent(),
        }
    )


def rates_analytics(bars):
    """Validated bars with date parts and change columns."""
    return with_changes(bars).withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "day_of_week": dates.sunday_based_dow("date"),
        }
    )


def fact_daily_rates(bars, loaded_at=None):
    """The fact table: bars plus change, change percent and volatility percent."""
    fact = bars.withColumns(
        {
            "daily_change_amount": prices.change(),
            "daily_change_percent": prices.change_percent(),
            "volatility_percent": prices.spread_percent(),
        }
    )
    return fact if loaded_at is None else fact.withColumn("updated_at", F.lit(loaded_at))


def split_timestamp(quotes, ts="ts"):
    return quotes.withColumns({"date": F.to_date(ts), "time": dates.time_of_day(ts)})


def time_features(rows, ts="ts"):
    return rows.withColumns(
        {"hour": F.hour(ts), "day_of_week": dates.monday_based_dow(F.to_date(ts))}
    )
