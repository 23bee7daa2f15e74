"""Queries over sources, quality rules and table maintenance."""

from pyspark.sql import functions as F

from tickloom.operators import bars as bar_ops
from tickloom.operators import quality, select, star, summary, upkeep
from tickloom.plans import inputs, medallion
from tickloom.plans.registry import query
from tickloom.schema import OHLC
from tickloom.session import scratch_path, stored
from tickloom.sources import csv_files, payloads

OHLC_4 = "open:4 high:4 low:4 close:4"


@query("csv_roundtrip", f"pair date:d {OHLC_4}", "SELECT * FROM bars")
def csv_roundtrip(spark, sf):
    """Write one CSV per instrument, read them back by file name and header."""
    path = scratch_path(spark, "csv")
    csv_files.write_bars_csv(inputs.bars(spark, sf), path)
    good, _ = csv_files.read_bars_csv(spark, f"{path}/file=historical_*.csv")
    return good


@query(
    "csv_quarantine",
    "pair reason n:l",
    """SELECT pair, CASE WHEN rn % 50 = 0 THEN 'bad number' ELSE 'bad date' END AS reason, count(*) AS n
       FROM counted WHERE rn % 50 = 0 OR rn % 33 = 0 GROUP BY ALL""",
)
def csv_quarantine(spark, sf):
    """Lines with a broken date or number are set aside, the others load."""
    rows = inputs.counted_bars(spark, sf)
    date = F.when(inputs.every(33) & ~inputs.every(50), F.lit("soon")).otherwise(F.col("date").cast("string"))
    close = F.when(inputs.every(50), F.lit("n/a")).otherwise(F.col("close").cast("string"))
    text = rows.select(
        date.alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), close.alias("Close"), csv_files.file_name(F.col("pair")).alias("file"),
    )
    path = scratch_path(spark, "csv")
    text.write.partitionBy("file").option("header", True).csv(path)
    _, bad = csv_files.read_bars_csv(spark, f"{path}/file=historical_*.csv")
    return bad.groupBy("pair", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("parse_daily_json", f"pair date:d {OHLC_4}", "SELECT * FROM bars")
def parse_daily_json(spark, sf):
    return payloads.parse_daily_json(payloads.daily_payload(inputs.bars(spark, sf)))


@query(
    "parse_snapshot_json",
    "ts:t base target rate:4",
    """SELECT ts, 'USD' AS base, pair AS target, price AS rate FROM ticks
       WHERE pair IN ('click', 'view', 'purchase')""",
)
def parse_snapshot_json(spark, sf):
    rates = F.create_map("pair", "price", F.lit("XXX"), F.lit(5.0))
    landed = inputs.ticks(spark, sf).select("ts", F.to_json(F.struct(rates.alias("rates"))).alias("payload"))
    return payloads.parse_snapshot_json(landed, "USD", ["click", "view", "purchase"])


@query(
    "props_json",
    "event_id:l field value:l",
    "SELECT event_id, 'k' AS field, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM ticks",
)
def props_json(spark, sf):
    fields = F.from_json("props", "map<string, bigint>")
    return inputs.ticks(spark, sf).select("event_id", F.explode(fields).alias("field", "value"))


_KINDS = (
    ("error", '{"Error Message": "unknown symbol"}'),
    ("signup", '{"Note": "call limit reached"}'),
    ("view", "{}"),
    ("click", "not json"),
)


@query(
    "payload_triage",
    "event_id:l status",
    """SELECT event_id, CASE pair WHEN 'signup' THEN 'retry' WHEN 'purchase' THEN 'accepted'
       ELSE 'rejected' END AS status FROM ticks""",
)
def payload_triage(spark, sf):
    body = F.lit('{"Time Series FX (Daily)": {"2024-01-02": {"4. close": "1.1"}}}')
    for kind, text in _KINDS:
        body = F.when(F.col("pair") == kind, text).otherwise(body)
    landed = inputs.ticks(spark, sf).select("event_id", body.alias("payload"))
    return payloads.triage_payload(landed)


@query(
    "clean_raw_strings",
    f"pair date:d {OHLC_4}",
    "SELECT pair, date, "
    + ", ".join(f"CASE WHEN rn % 50 <> 0 AND rn % 60 <> 0 THEN {c} END AS {c}" for c in OHLC)
    + " FROM counted",
)
def clean_raw_strings(spark, sf):
    return quality.clean_raw(inputs.raw_strings(spark, sf))


_VALID = """date IS NOT NULL AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low
    AND open BETWEEN low AND high AND close BETWEEN low AND high
    AND date BETWEEN DATE '2000-01-01' AND (SELECT max(date) FROM bars)"""


def _as_of(spark, sf):
    return select.latest_date(inputs.bars(spark, sf))


@query("silver_rates", f"pair date:d {OHLC_4}", f"SELECT DISTINCT * FROM dirty WHERE {_VALID}")
def silver_rates(spark, sf):
    return quality.silver_rates(inputs.dirty_bars(spark, sf), _as_of(spark, sf))


@query(
    "silver_rejects",
    "pair reasons n:l",
    """SELECT pair, reasons, count(*) AS n FROM (SELECT pair, concat_ws(',',
         CASE WHEN date IS NULL THEN 'missing_date' END,
         CASE WHEN NOT (open > 0 AND high > 0 AND low > 0 AND close > 0) THEN 'non_positive_price' END,
         CASE WHEN high < low THEN 'high_below_low' END,
         CASE WHEN open < low OR open > high THEN 'open_outside_range' END,
         CASE WHEN close < low OR close > high THEN 'close_outside_range' END,
         CASE WHEN date IS NULL OR date < DATE '2000-01-01' OR date > (SELECT max(date) FROM bars)
              THEN 'date_out_of_range' END) AS reasons
       FROM dirty) WHERE reasons <> '' GROUP BY 1, 2""",
)
def silver_rejects(spark, sf):
    bad = quality.rejected_bars(inputs.dirty_bars(spark, sf), _as_of(spark, sf))
    return bad.groupBy("pair", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("silver_union", f"pair date:d {OHLC_4}", f"SELECT DISTINCT * FROM dirty WHERE {_VALID}")
def silver_union(spark, sf):
    """The same rows loaded from one untagged table per instrument, which are the folders found."""
    path = scratch_path(spark, "landed")
    inputs.dirty_bars(spark, sf).write.partitionBy("pair").parquet(path)
    landed = spark.read.parquet(path)
    names = sorted(r["pair"] for r in landed.select("pair").distinct().collect())  # one row per table
    tables = {p: landed.filter(F.col("pair") == p).drop("pair") for p in names}
    return quality.silver_rates(quality.union_tagged(tables), _as_of(spark, sf))


@query(
    "validated_quotes",
    "event_id:l base target rate:4",
    "SELECT event_id, 'USD' AS base, pair AS target, price AS rate FROM ticks WHERE price > 0",
)
def validated_quotes(spark, sf):
    quotes = inputs.ticks(spark, sf).select(
        "event_id", F.lit("USD").alias("base"), F.col("pair").alias("target"), F.col("price").alias("rate")
    )
    return quality.valid_quotes(quotes)


@query(
    "null_audit",
    "column_name null_count:l",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM gappy"
        for c in ("pair", "date", *OHLC)
    ),
)
def null_audit(spark, sf):
    return quality.null_counts(inputs.gappy_bars(spark, sf))


@query("pair_counts", "pair n:l", "SELECT pair, count(*) AS n FROM bars GROUP BY 1")
def pair_counts(spark, sf):
    return summary.count_by_pair(inputs.bars(spark, sf))


@query(
    "newest_5",
    f"pair date:d {OHLC_4}",
    "SELECT * FROM bars ORDER BY date DESC, pair LIMIT 5",
)
def newest_5(spark, sf):
    return select.newest(inputs.bars(spark, sf), 5)


@query(
    "ohlc_daily",
    f"pair date:d avg_rate:4 {OHLC_4}",
    """SELECT pair, CAST(ts AS DATE) AS date, avg(price) AS avg_rate, arg_min(price, (ts, event_id)) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close FROM ticks GROUP BY 1, 2""",
)
def ohlc_daily(spark, sf):
    quotes = inputs.ticks(spark, sf).withColumn("date", F.to_date("ts"))
    return bar_ops.build_bars(quotes, order=bar_ops.time_rank("ts", "event_id"), average="avg_rate")


@query(
    "ohlc_equal_times",
    f"pair date:t avg_rate:4 {OHLC_4}",
    """SELECT pair, date_trunc('hour', ts) AS date, avg(price) AS avg_rate, arg_min(price, (date_trunc('hour', ts), event_id)) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, (date_trunc('hour', ts), event_id)) AS close FROM ticks GROUP BY 1, 2""",
)
def ohlc_equal_times(spark, sf):
    """Quotes that only know their hour: the event's number settles the order inside a bar."""
    quotes = inputs.ticks(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    return bar_ops.ohlc_bars(quotes, inputs.HOUR, tie="event_id")


@query("ohlc_hourly", f"pair date:t avg_rate:4 {OHLC_4}", "SELECT * FROM hourly_bars")
def ohlc_hourly(spark, sf):
    return inputs.hourly_bars(spark, sf)


@query("supplier_bars", f"pair date:d {OHLC_4}", "SELECT * FROM supplier_bars")
def supplier_bars(spark, sf):
    return inputs.supplier_bars(spark, sf)


@query(
    "split_timestamp",
    "event_id:l date:d time",
    "SELECT event_id, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S.%f') AS time FROM ticks",
)
def split_timestamp(spark, sf):
    return bar_ops.split_timestamp(inputs.ticks(spark, sf))


@query(
    "time_features",
    "event_id:l hour:i day_of_week:i",
    "SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week FROM ticks",
)
def time_features(spark, sf):
    return bar_ops.time_features(inputs.ticks(spark, sf))


@query(
    "append_roundtrip",
    f"pair date:d {OHLC_4}",
    "SELECT pair, date, open, high, low, close FROM counted WHERE rn % 2 = 0 "
    "UNION ALL SELECT pair, date, open, high, low, close FROM counted WHERE rn % 3 = 0",
)
def append_roundtrip(spark, sf):
    """Two loads appended to one table; overlapping rows appear twice."""
    rows, path = inputs.counted_bars(spark, sf), scratch_path(spark, "bronze")
    for n in (2, 3):
        upkeep.append(rows.filter(inputs.every(n)).drop("rn"), path)
    return spark.read.parquet(path)


@query(
    "upsert_latest",
    f"pair date:d {OHLC_4}",
    """SELECT pair, date, open, high, low, close FROM changes
       UNION ALL SELECT pair, date, open, high, low, close FROM bars ANTI JOIN changes USING (pair, date)""",
)
def upsert_latest(spark, sf):
    return upkeep.upsert(inputs.bars(spark, sf), inputs.updates(spark, sf))


@query(
    "insert_if_absent",
    f"pair date:d {OHLC_4}",
    """SELECT pair, date, open, high, low, close FROM bars
       UNION ALL SELECT pair, date, open, high, low, close FROM changes ANTI JOIN bars USING (pair, date)""",
)
def insert_if_absent(spark, sf):
    return upkeep.insert_missing(inputs.bars(spark, sf), inputs.updates(spark, sf))


@query(
    "incremental_slice",
    f"pair date:d {OHLC_4}",
    """WITH old AS (SELECT pair, max(date) AS mark FROM bars
                    WHERE date <= (SELECT max(date) FROM bars) - INTERVAL 60 DAY AND pair <> '5-LOW' GROUP BY 1)
       SELECT bars.* FROM bars LEFT JOIN old USING (pair)
       WHERE date > coalesce(mark, (SELECT max(date) FROM bars) - INTERVAL 30 DAY)""",
)
def incremental_slice(spark, sf):
    """The target ends 60 days early and has never seen one instrument."""
    rows = inputs.stored_bars(spark, sf)
    as_of = select.latest_date(rows)
    old = rows.filter((F.col("date") <= F.date_sub(as_of, 60)) & (F.col("pair") != "5-LOW"))
    return upkeep.incremental_slice(rows, old, as_of)


@query(
    "dim_currency_pairs",
    "pair base_currency quote_currency first_date:d bars:l",
    """SELECT pair, base_currency, quote_currency, min(date) AS first_date, count(*) AS bars
       FROM pairs_dim JOIN bars USING (pair) GROUP BY ALL""",
)
def dim_currency_pairs(spark, sf):
    dim = star.dim_pairs(spark, inputs.PAIRS)
    seen = inputs.bars(spark, sf).groupBy("pair").agg(
        F.min("date").alias("first_date"), F.count(F.lit(1)).alias("bars")
    )
    return seen.join(dim, "pair")


@query(
    "dim_calendar",
    "date:d year:i quarter:i month:i month_name week_number:i day_of_week:i day_name is_weekend:b",
    """SELECT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month,
       monthname(date) AS month_name, weekofyear(date) AS week_number, dayofweek(date) AS day_of_week,
       dayname(date) AS day_name, dayofweek(date) IN (0, 6) AS is_weekend FROM days""",
)
def dim_calendar(spark, sf):
    return star.dim_calendar(inputs.bars(spark, sf))


@query(
    "medallion_fact",
    "pair date:d open:4 high:4 low:4 close:4 daily_change_amount:4 daily_change_percent:6 volatility_percent:6",
    """SELECT * EXCLUDE rn FROM (SELECT f.*, c.rn FROM fact f JOIN counted c USING (pair, date))
       WHERE rn % 50 <> 0 AND rn % 60 <> 0 AND date >= DATE '2000-01-01'""",
)
def medallion_fact(spark, sf):
    """Landed text loaded twice into one fact table: the second load changes nothing."""
    out, as_of = scratch_path(spark, "medallion"), _as_of(spark, sf)
    raw = inputs.raw_strings(spark, sf)
    medallion.load(raw, f"{out}/fact", f"{out}/rejects", as_of)
    return medallion.load(raw, f"{out}/fact", f"{out}/rejects", as_of)


# --- NULL keys, audit times, exports, the loading path -------------------------

RUN_TS = "2024-01-02 03:04:05"
NULL_KEYED = "CASE WHEN rn % 40 = 3 THEN NULL ELSE date END"


@query(
    "upsert_null_keys",
    "pair date:d open:4 high:4 low:4 close:4 updated_at:t",
    f"""WITH target AS (SELECT * REPLACE ({NULL_KEYED} AS date) FROM counted WHERE rn % 2 = 1),
          fresh AS (SELECT * REPLACE (CAST(NULL AS DATE) AS date, close * 3 AS close) FROM counted WHERE rn = 6 AND pair < '3'
                    UNION ALL SELECT * REPLACE (close * 2 AS close) FROM counted WHERE rn % 10 = 1)
        SELECT pair, date, open, high, low, close, TIMESTAMP '{RUN_TS}' AS updated_at FROM fresh
        UNION ALL SELECT pair, date, open, high, low, close, TIMESTAMP '2020-01-01 00:00:00' FROM target t
        WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.pair = t.pair AND f.date IS NOT DISTINCT FROM t.date)""",
)
def upsert_null_keys(spark, sf):
    """A merge by month with missing dates on both sides, and the time of the run on changed rows."""
    rows, path = inputs.counted_bars(spark, sf), f"{scratch_path(spark, 'merge')}/table"
    old = rows.withColumn("date", F.when(F.col("rn") % 40 != 3, F.col("date"))).filter("rn % 2 = 1").drop("rn")
    upkeep.write_by_month(old.withColumn("updated_at", F.lit("2020-01-01 00:00:00").cast("timestamp")), path)
    missing = rows.filter((F.col("rn") == 6) & (F.col("pair") < "3"))
    fresh = missing.withColumns({"date": F.lit(None).cast("date"), "close": F.col("close") * 3}).unionByName(
        rows.filter("rn % 10 = 1").withColumn("close", F.col("close") * 2)
    )
    upkeep.upsert_months(spark, path, fresh.drop("rn"), ts_col="updated_at", run_ts=F.lit(RUN_TS).cast("timestamp"))
    return spark.read.parquet(path).drop("month")


@query(
    "csv_export",
    "pair date:d close:4",
    "SELECT pair, date, round(close, 4) AS close FROM bars WHERE date >= DATE '1998-01-01' AND pair <> '5-LOW'",
)
def csv_export(spark, sf):
    """A filtered view exported as CSV and read back."""
    path = scratch_path(spark, "export")
    shown = inputs.bars(spark, sf).filter("date >= '1998-01-01' AND pair <> '5-LOW'").select("pair", "date", "close")
    csv_files.export_csv(shown, path)
    return spark.read.option("header", True).schema("pair string, date date, close double").csv(path)


@query(
    "load_path",
    f"pair date:d {OHLC_4}",
    """SELECT pair, date, open, high, low, last_value(CASE WHEN rn % 7 <> 0 THEN close END IGNORE NULLS) OVER
       (PARTITION BY pair ORDER BY date ROWS UNBOUNDED PRECEDING) AS close FROM counted""",
)
def load_path(spark, sf):
    """CSV files with missing closes, read, audited for NULLs and filled forward."""
    return medallion.load_filled(inputs.gappy_bars(spark, sf), scratch_path(spark, "landing"))


@query("registered_views", "name kind n:l", """SELECT 'llv_bars' AS name, 'temporary' AS kind, count(*) AS n FROM bars
    UNION ALL SELECT 'llv_ticks', 'temporary', count(*) FROM ticks""")
def registered_views(spark, sf):
    """Views made for a run, found in the listing, counted and dropped again."""
    views = {"llv_bars": inputs.bars(spark, sf), "llv_ticks": inputs.ticks(spark, sf)}
    upkeep.register_views(views)
    listed = upkeep.list_tables(spark).filter(F.col("name").isin(*views))
    counts = spark.sql("SELECT 'llv_bars' AS name, count(*) AS n FROM llv_bars UNION ALL SELECT 'llv_ticks', count(*) FROM llv_ticks")
    found, _ = stored(listed.join(counts, "name").withColumn("kind", F.when(F.col("isTemporary"), "temporary")), "views")
    upkeep.drop_views(spark, *views)
    return found
