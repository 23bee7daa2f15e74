"""Landed JSON payloads: triage, daily series and snapshot quotes."""

from pyspark.sql import functions as F

from tickloom.functions.prices import parse_date, parse_number

# Field names of the payloads.
SERIES_FIELD = "Time Series FX (Daily)"
ERROR_FIELD = "Error Message"
LIMIT_FIELD = "Note"
DAILY_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close"}
_SERIES_TYPE = f"struct<`{SERIES_FIELD}`: map<string, map<string, string>>>"
_STATUS_TYPE = (
    f"struct<`{ERROR_FIELD}`: string, `{LIMIT_FIELD}`: string, `{SERIES_FIELD}`: string>"
)


def triage_payload(payloads, body="payload"):
    """Add ``status``: accepted, retry (rate limited) or rejected."""
    fields = F.from_json(body, _STATUS_TYPE)
    status = (
        F.when(fields[ERROR_FIELD].isNotNull(), "rejected")
        .when(fields[LIMIT_FIELD].isNotNull(), "retry")
        .when(fields[SERIES_FIELD].isNull(), "rejected")
        .otherwise("accepted")
    )
    return payloads.withColumn("status", F.coalesce(status, F.lit("rejected")))


def by_status(triaged):
    return {s: triaged.filter(F.col("status") == s) for s in ("accepted", "retry", "rejected")}


def parse_daily_json(payloads, body="payload", key="pair"):
    """Bars of daily-series payloads; anything non-numeric becomes NULL."""
    series = F.from_json(body, _SERIES_TYPE)[SERIES_FIELD]
    days = payloads.select(key, F.explode(series).alias("_day", "_bar"))
    return days.select(
        key,
        parse_date("_day").alias("date"),
        *[parse_number(F.col("_bar")[f]).alias(c) for c, f in DAILY_FIELDS.items()],
    )


def parse_snapshot_json(payloads, base, targets, body="payload", ts="ts"):
    """Quotes of snapshot payloads for the wanted currencies that are present."""
    rates = F.from_json(body, "struct<rates: map<string, double>>")["rates"]
    quotes = payloads.select(ts, F.explode(rates).alias("target", "rate"))
    return quotes.filter(F.col("target").isin(*targets)).select(
        ts, F.lit(base).alias("base"), "target", "rate"
    )


def daily_payload(bars, key="pair"):
    """Bars as one daily-series payload per instrument and year (a test source).

    A year bounds the size of a payload.
    """
    bar = F.create_map(*[x for c, f in DAILY_FIELDS.items() for x in (F.lit(f), F.col(c).cast("string"))])
    entry = F.struct(F.col("date").cast("string").alias("k"), bar.alias("v"))
    days = F.map_from_entries(F.collect_list(entry))
    body = F.to_json(F.struct(days.alias(SERIES_FIELD)))
    return bars.groupBy(key, F.year("date").alias("year")).agg(body.alias("payload"))
