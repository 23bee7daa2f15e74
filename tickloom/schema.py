"""Table shapes and the fixed values shared by several operators."""

import datetime as dt

from pyspark.sql import types as T

OHLC = ("open", "high", "low", "close")

# One row per instrument and day (or per instrument and bar time).
BARS = T.StructType(
    [
        T.StructField("pair", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
    ]
)

# Landed text, before any cast.
RAW_BARS = T.StructType([T.StructField(f.name, T.StringType()) for f in BARS.fields])

QUOTES = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("base", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

DIM_PAIRS = T.StructType(
    [
        T.StructField("pair", T.StringType(), False),
        T.StructField("base_currency", T.StringType()),
        T.StructField("quote_currency", T.StringType()),
        T.StructField("pair_description", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

# First date the quality rules accept unless the caller says otherwise.
FIRST_VALID_DATE = dt.date(2000, 1, 1)
