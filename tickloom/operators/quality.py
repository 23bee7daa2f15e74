"""Quality rules for bars and quotes, with the reason of each rejection."""

from pyspark.sql import Column, functions as F

from tickloom.functions.prices import parse_date, parse_number
from tickloom.operators.select import as_of_column
from tickloom.schema import FIRST_VALID_DATE, OHLC


def clean_raw(raw):
    """Landed text to typed bars: trim, blank to NULL, cast, bad values to NULL."""
    return raw.select(
        "pair", parse_date("date").alias("date"), *[parse_number(c).alias(c) for c in OHLC]
    )


def _bar_rules(first, last):
    o, h, l, c = (F.col(n) for n in OHLC)
    d = F.col("date")
    return {
        "missing_date": d.isNotNull(),
        "non_positive_price": (o > 0) & (h > 0) & (l > 0) & (c > 0),
        "high_below_low": h >= l,
        "open_outside_range": (o >= l) & (o <= h),
        "close_outside_range": (c >= l) & (c <= h),
        "date_out_of_range": d.between(first, last),
    }


def _bounds(bars, as_of, min_date):
    first = F.lit(min_date).cast("date")
    return first, as_of if isinstance(as_of, Column) else as_of_column(bars, as_of)


def valid_bars(bars, as_of=None, min_date=FIRST_VALID_DATE):
    """Rows that pass every rule; a rule on a missing value fails."""
    keep = F.lit(True)
    for rule in _bar_rules(*_bounds(bars, as_of, min_date)).values():
        keep = keep & rule
    return bars.filter(keep)


def rejected_bars(bars, as_of=None, min_date=FIRST_VALID_DATE):
    """Rows that fail a rule, with all failed rules in ``reasons``."""
    rules = _bar_rules(*_bounds(bars, as_of, min_date))
    failed = [F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]
    tagged = bars.withColumn("reasons", F.array_compact(F.array(*failed)))
    return tagged.filter(F.size("reasons") > 0)


def validate_bars(bars, as_of=None, min_date=FIRST_VALID_DATE):
    return valid_bars(bars, as_of, min_date), rejected_bars(bars, as_of, min_date)


def silver_rates(raw, as_of=None, min_date=FIRST_VALID_DATE):
    """Validated bars without exact duplicates."""
    return valid_bars(raw, as_of, min_date).dropDuplicates()


def _quote_rule():
    return (F.col("rate") > 0) & F.col("base").isNotNull() & F.col("target").isNotNull()


def valid_quotes(quotes):
    return quotes.filter(_quote_rule())


def rejected_quotes(quotes):
    return quotes.filter(~F.coalesce(_quote_rule(), F.lit(False)))


def union_tagged(tables):
    """One long table from per-instrument tables, tagged with the instrument."""
    tagged = [df.withColumn("pair", F.lit(pair)) for pair, df in tables.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def null_counts(rows):
    """Missing cells per column, one row per column, in a single pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns])
    return counted.unpivot([], rows.columns, "column_name", "null_count")
