"""Landed text to fact table: clean, validate, set rejects aside, merge by key."""

from tickloom.operators import quality, upkeep
from tickloom.operators.changes import forward_fill
from tickloom.operators.bars import fact_daily_rates
from tickloom.schema import FIRST_VALID_DATE, OHLC
from tickloom.session import discard, stored
from tickloom.sources import csv_files


def load(raw, fact_path, reject_path, as_of, min_date=FIRST_VALID_DATE):
    """Merge landed rows into the month-partitioned fact table at ``fact_path``.

    The cleaned rows are stored once, because good rows and rejects both read them.
    ``reject_path`` holds the rejects of one load.  Running the same load again leaves
    both as they are.
    """
    spark = raw.sparkSession
    cleaned, cleaned_path = stored(quality.clean_raw(raw), "cleaned")
    good, bad = quality.validate_bars(cleaned, as_of, min_date)
    bad.write.mode("overwrite").parquet(reject_path)
    fact = fact_daily_rates(upkeep.newest_copy(good.dropDuplicates(), upkeep.KEYS))
    upkeep.write_by_month(fact.limit(0), fact_path, "ignore")
    upkeep.upsert_months(spark, fact_path, fact)
    discard(cleaned_path)
    return upkeep.read_months(spark, fact_path, fact.schema)


def load_filled(bars, folder):
    """Land bars as CSV, read them back, and fill missing prices forward if the audit finds any."""
    csv_files.write_bars_csv(bars, folder)
    read, _ = csv_files.read_bars_csv(bars.sparkSession, f"{folder}/file=historical_*.csv")
    missing = {r.column_name for r in quality.null_counts(read).filter("null_count > 0").collect()}  # a row per column
    return forward_fill(read, [c for c in OHLC if c in missing]) if missing & set(OHLC) else read
