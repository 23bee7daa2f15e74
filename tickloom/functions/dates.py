"""Date parts.  Two weekday numberings are in use; they are never mixed."""

from pyspark.sql import functions as F

from tickloom.functions.prices import as_col


def sunday_based_dow(d):
    """0 = Sunday ... 6 = Saturday (warehouse views and calendar)."""
    return F.dayofweek(as_col(d)) - 1


def monday_based_dow(d):
    """0 = Monday ... 6 = Sunday (model features)."""
    return F.weekday(as_col(d))


def month_start(d):
    return F.trunc(as_col(d), "month")


def month_key(d):
    return F.date_format(as_col(d), "yyyy-MM")


def padded_month(year, month):
    """YYYY-MM from separate year and month numbers."""
    return F.concat_ws("-", as_col(year).cast("string"), F.lpad(as_col(month).cast("string"), 2, "0"))


def time_of_day(ts):
    return F.date_format(as_col(ts), "HH:mm:ss.SSSSSS")
