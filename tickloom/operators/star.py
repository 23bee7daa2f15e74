"""Star schema: dimensions and the views joined over them."""

from pyspark.sql import Window, functions as F

from tickloom.functions import dates, prices
from tickloom.operators.changes import rate_lags
from tickloom.schema import DIM_PAIRS


def dim_pairs(spark, rows):
    """Instrument dimension from (pair, base, quote) rows given by the caller."""
    data = [(p, b, q, f"{b} to {q}", True) for p, b, q in rows]
    return spark.createDataFrame(data, DIM_PAIRS)


def split_pair(c):
    """(base, quote) of a name such as EUR/USD."""
    parts = F.split(prices.as_col(c), "/")
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


def date_series(spark, start, end=None, years=5):
    """One row per day, both ends included; ``years`` after the start by default."""
    first = F.lit(start).cast("date")
    last = F.add_months(first, 12 * years) if end is None else F.lit(end).cast("date")
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))


GAP_YEARS = 50  # a longer stretch of years without any fact comes from a wrong date and is left out


def date_span(facts):
    """One row per day from the first to the last date of ``facts``, whatever these are.

    The years that occur come first (ten thousand at most), then the days of each: no row holds
    more than a year.  Years between two of them are filled in unless they are more than
    GAP_YEARS, so a wrong date adds its own year and not the millennia before it.
    """
    known = facts.filter("date IS NOT NULL")
    seen = known.groupBy(F.year("date").alias("y")).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    whole = Window.partitionBy()
    before = F.lag("y").over(whole.orderBy("y"))
    from_year = F.when(F.col("y") - before <= GAP_YEARS, before + 1).otherwise(F.col("y"))
    spans = seen.select(from_year.alias("_from"), F.col("y").alias("_to"), F.min("a").over(whole).alias("a"), F.max("b").over(whole).alias("b"))
    years = spans.select("a", "b", F.explode(F.sequence("_from", "_to")).alias("y"))
    first = F.greatest("a", F.make_date("y", F.lit(1), F.lit(1)))
    last = F.least("b", F.make_date("y", F.lit(12), F.lit(31)))
    return years.select(F.explode(F.sequence(first, last)).alias("date"))


def calendar(days):
    """Calendar attributes of each day; holidays and fiscal periods are not known."""
    dow = dates.sunday_based_dow("date")
    unknown = F.lit(None)
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week_number"),
        dow.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        unknown.cast("boolean").alias("is_holiday"),
        unknown.cast("int").alias("fiscal_year"),
        unknown.cast("int").alias("fiscal_quarter"),
    )


def dim_calendar(facts):
    return calendar(date_span(facts))


def star_join(fact, days, pairs):
    """Fact with both dimensions.

    Both dimensions are left to the size-based choice of the planner: a calendar of some
    ten thousand days is broadcast, whatever a wrong date in the facts makes of it is not.
    """
    return fact.join(days, "date").join(pairs, "pair")


def exchange_rate_analysis(fact, days, pairs, layout=None):
    """Lags are taken along the fact, then the dimensions are attached."""
    joined = star_join(rate_lags(fact, layout), days, pairs)
    return joined.select(
        "date", "year", "month", "quarter", "month_name", "pair", "base_currency",
        "quote_currency", F.col("close").alias("exchange_rate"), "daily_change_percent",
        "volatility_percent", "prev_day_rate", "prev_week_rate", "prev_month_rate",
    )


def active_pairs(fact, pairs):
    """Instruments of the dimension that have at least one fact row."""
    return pairs.join(fact.select("pair").distinct(), "pair", "left_semi").orderBy("pair")


def cross_rates(fact, ab, ac, bc):
    """Rate B/C implied by A/C over A/B against the quoted one, per common date.

    One aggregation by date instead of a three-way self join: each leg has at most
    one row per date.
    """
    def leg(pair):
        return F.max(F.when(F.col("pair") == pair, F.col("close")))

    legs = fact.filter(F.col("pair").isin(ab, ac, bc)).groupBy("date").agg(
        leg(ab).alias("ab_rate"), leg(ac).alias("ac_rate"), leg(bc).alias("bc_rate")
    )
    return _cross_columns(legs.dropna(subset=["ab_rate", "ac_rate", "bc_rate"]))


def cross_rates_joined(fact, ab, ac, bc):
    """The same as an equi-join of the three legs."""
    def leg(pair, name):
        return fact.filter(F.col("pair") == pair).select("date", F.col("close").alias(name))

    legs = leg(ab, "ab_rate").join(leg(ac, "ac_rate"), "date").join(leg(bc, "bc_rate"), "date")
    return _cross_columns(legs)


def _cross_columns(legs):
    implied = F.try_divide("ac_rate", "ab_rate")
    off = F.abs(implied - F.col("bc_rate"))
    return legs.withColumns(
        {"calculated_bc_rate": implied, "cross_rate_diff_pct": prices.percent_of(off, "bc_rate")}
    )


def synth_cross(bars, leg1, leg2, out, rounding=prices.round4):
    """Bars of a product instrument: leg1 x leg2 per column on leg1's dates.

    Dates leg2 lacks stay with NULL prices.
    """
    cols = ("open", "high", "low", "close")
    left = bars.filter(F.col("pair") == leg1).select("date", *cols)
    right = bars.filter(F.col("pair") == leg2).select("date", *[F.col(c).alias(f"_{c}") for c in cols])
    joined = left.join(right, "date", "left")
    return joined.select(
        F.lit(out).alias("pair"),
        "date",
        *[rounding(F.col(c) * F.col(f"_{c}")).alias(c) for c in cols],
    )
