"""Price arithmetic.  A zero or missing denominator gives NULL, never an error."""

from pyspark.sql import functions as F


def as_col(c):
    return F.col(c) if isinstance(c, str) else c


def percent_of(part, whole):
    return F.try_divide(as_col(part), as_col(whole)) * 100.0


def change(open_="open", close="close"):
    """Move within the bar: open to close, not previous close to close."""
    return as_col(close) - as_col(open_)


def change_percent(open_="open", close="close"):
    return percent_of(change(open_, close), open_)


def spread(high="high", low="low"):
    return as_col(high) - as_col(low)


def spread_percent(open_="open", high="high", low="low"):
    """High-low range over the open; also served under the name volatility."""
    return percent_of(spread(high, low), open_)


def real(c):
    """A double without NaN: NaN compares true in Spark, NULL never does."""
    return F.nanvl(as_col(c), F.lit(None).cast("double"))


def round4(c):
    """Four decimals, halves to the even digit (as numeric array libraries round)."""
    return F.bround(as_col(c), 4)


def parse_number(c):
    """Text to double; blanks and anything non-numeric become NULL."""
    return real(F.nullif(F.trim(as_col(c)), F.lit("")).try_cast("double"))


def parse_date(c):
    return F.nullif(F.trim(as_col(c)), F.lit("")).try_cast("date")
