"""Bars and quotes derived from the given tables, for Spark and for the SQL checks."""

from pyspark.sql import functions as F

from tickloom.layout import layout_of, numbered, Layout
from tickloom.operators.bars import build_bars, fact_daily_rates, ohlc_bars, one_rank
from tickloom.schema import OHLC
from tickloom.session import stored

# The instrument dimension, and the legs of the cross rate.
PAIRS = (
    ("1-URGENT", "EUR", "USD"),
    ("2-HIGH", "EUR", "EGP"),
    ("3-MEDIUM", "USD", "EGP"),
    ("4-NOT SPECIFIED", "GBP", "USD"),
    ("5-LOW", "GBP", "EGP"),
)
PAIR_NAMES = tuple(p for p, _, _ in PAIRS)
LEG_AB, LEG_AC, LEG_BC = PAIR_NAMES[:3]

HOUR = 3600
HOURLY = Layout(step=HOUR, block_rows=256, split=True)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark, sf_dir):
    """Daily bars: instrument = order priority, price = order total."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("pair"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("k"),
    )
    return build_bars(orders)


def fact(spark, sf_dir):
    return fact_daily_rates(bars(spark, sf_dir))


def stored_bars(spark, sf_dir):
    """The bars, written once: for analyses that read them several times."""
    return stored(bars(spark, sf_dir), "bars")[0]


def stored_fact(spark, sf_dir):
    return stored(fact(spark, sf_dir), "fact")[0]


def flat_tail_bars(spark, sf_dir, rows=3000):
    """Every series followed by ``rows`` days at its last close."""
    seen = bars(spark, sf_dir).select("pair", "date", "close")
    last = seen.groupBy("pair").agg(F.max("date").alias("d"), F.max_by("close", "date").alias("close"))
    days = F.explode(F.sequence(F.lit(1), F.lit(rows)))
    return seen.unionByName(last.select("pair", days.alias("i"), "d", "close").select("pair", F.date_add("d", F.col("i")).alias("date"), "close"))


def spiked_bars(spark, sf_dir):
    """Small closes with a very large one every 97 rows."""
    rows = counted_bars(spark, sf_dir)
    close = F.when(every(97), 1e15).otherwise(F.floor(F.col("close") / 1000))
    return rows.withColumn("close", close.cast("double")).drop("rn")


def supplier_bars(spark, sf_dir):
    """Daily bars of many instruments: one per supplier."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("pair"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        "l_orderkey",
        "l_linenumber",
    )
    line = F.col("l_orderkey").cast("decimal(38,0)") * 16 + F.col("l_linenumber")
    # Lines are not unique: the price, to a millionth, settles equal ones.
    return build_bars(lines, order=one_rank(line, F.col("price").cast("decimal(18,6)") * 1000000, 18))


def ticks(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("pair"), "ts", F.col("value").alias("price"), "props"
    )


def hourly_bars(spark, sf_dir):
    return ohlc_bars(ticks(spark, sf_dir), HOUR, tie="event_id")


def counted_bars(spark, sf_dir):
    """Bars with rn, the 1-based place in the series; the defects below hang on it."""
    rows = bars(spark, sf_dir)
    return numbered(rows, layout_of(rows)).withColumn("rn", F.col("_pos") + 1).drop("_pos")


def every(n):
    return F.col("rn") % n == 0


def dirty_bars(spark, sf_dir):
    rows = counted_bars(spark, sf_dir)
    date = (
        F.when(every(79), F.lit(None))
        .when(every(73), F.add_months("date", -1200))
        .when(every(61), F.add_months("date", 1200))
        .otherwise(F.col("date"))
    )
    spoiled = rows.select(
        "pair",
        "rn",
        date.alias("date"),
        F.when(every(89), 0.0).otherwise(F.col("open")).alias("open"),
        F.when(every(97), F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        "low",
        F.when(every(83), F.col("high") + 1).otherwise(F.col("close")).alias("close"),
    )
    copies = F.when(every(71), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return spoiled.withColumn("_copy", F.explode(copies)).drop("_copy", "rn")


def raw_strings(spark, sf_dir):
    rows = counted_bars(spark, sf_dir)

    def text(c):
        padded = F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" "))
        return F.when(every(50), "").when(every(60), " n/a ").otherwise(padded).alias(c)

    return rows.select("pair", F.concat(F.lit(" "), F.col("date").cast("string")).alias("date"), *map(text, OHLC))


def gappy_bars(spark, sf_dir):
    rows = counted_bars(spark, sf_dir)
    return rows.withColumn("close", F.when(~every(7), F.col("close"))).drop("rn")


def flat_bars(spark, sf_dir):
    return bars(spark, sf_dir).withColumn("close", F.floor(F.col("close") / 100000).cast("double"))


def updates(spark, sf_dir):
    """Changed rows (close doubled) and new rows (dates moved far ahead)."""
    rows = counted_bars(spark, sf_dir).filter(every(10)).drop("rn")
    changed = rows.withColumn("close", F.col("close") * 2)
    return changed.unionByName(rows.withColumn("date", F.date_add("date", 10000)))


# The same inputs for the checks, in dependency order.
SQL_VIEWS = {
    "ticks": "SELECT event_id, event_type AS pair, ts, value AS price, props FROM events",
    "bars": """SELECT o_orderpriority AS pair, CAST(o_orderdate AS DATE) AS date,
        arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
        min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close
        FROM orders GROUP BY 1, 2""",
    "supplier_bars": """SELECT CAST(l_suppkey AS VARCHAR) AS pair, CAST(l_shipdate AS DATE) AS date,
        arg_min(p, (l_orderkey, l_linenumber, p)) AS open, max(p) AS high, min(p) AS low,
        arg_max(p, (l_orderkey, l_linenumber, p)) AS close
        FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2""",
    "hourly_bars": """SELECT pair, date_trunc('hour', ts) AS date, arg_min(price, ts) AS open,
        max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, avg(price) AS avg_rate
        FROM ticks GROUP BY 1, 2""",
    "fact": """SELECT *, close - open AS daily_change_amount,
        (close - open) / nullif(open, 0) * 100 AS daily_change_percent,
        (high - low) / nullif(open, 0) * 100 AS volatility_percent FROM bars""",
    "counted": "SELECT *, row_number() OVER (PARTITION BY pair ORDER BY date) AS rn FROM bars",
    "spoiled": """SELECT pair, rn,
        CASE WHEN rn % 79 = 0 THEN NULL
             WHEN rn % 73 = 0 THEN CAST(date - INTERVAL 100 YEAR AS DATE)
             WHEN rn % 61 = 0 THEN CAST(date + INTERVAL 100 YEAR AS DATE) ELSE date END AS date,
        CASE WHEN rn % 89 = 0 THEN 0.0 ELSE open END AS open,
        CASE WHEN rn % 97 = 0 THEN low - 1 ELSE high END AS high, low,
        CASE WHEN rn % 83 = 0 THEN high + 1 ELSE close END AS close FROM counted""",
    "dirty": """SELECT * EXCLUDE rn FROM spoiled
        UNION ALL SELECT * EXCLUDE rn FROM spoiled WHERE rn % 71 = 0""",
    "spiked": "SELECT * EXCLUDE rn REPLACE (CASE WHEN rn % 97 = 0 THEN 1e15 ELSE floor(close / 1000) END AS close) FROM counted",
    "flat_tail": """SELECT pair, date, close FROM bars UNION ALL
        SELECT pair, CAST(d + i * INTERVAL 1 DAY AS DATE) AS date, close
        FROM (SELECT pair, max(date) AS d, arg_max(close, date) AS close FROM bars GROUP BY 1), range(1, 3001) AS t(i)""",
    "tail_moves": """SELECT *, coalesce(greatest(close - p, 0), 0) AS gain, coalesce(greatest(p - close, 0), 0) AS loss
        FROM (SELECT *, lag(close) OVER w AS p, row_number() OVER w AS rn FROM flat_tail
              WINDOW w AS (PARTITION BY pair ORDER BY date))""",
    "tail_run": """SELECT pair, date, rn, gain AS up, loss AS down, close AS ema_26, close AS ema_500 FROM tail_moves WHERE rn = 1
        UNION ALL SELECT m.pair, m.date, m.rn, r.up * 13e0 / 14 + m.gain / 14, r.down * 13e0 / 14 + m.loss / 14,
          r.ema_26 * 25e0 / 27 + m.close * 2e0 / 27, r.ema_500 * 499e0 / 501 + m.close * 2e0 / 501
        FROM tail_run r JOIN tail_moves m ON m.pair = r.pair AND m.rn = r.rn + 1""",
    "gappy": "SELECT * REPLACE (CASE WHEN rn % 7 <> 0 THEN close END AS close) FROM counted",
    "flat": "SELECT * REPLACE (floor(close / 100000) AS close) FROM bars",
    "changes": """SELECT * EXCLUDE rn REPLACE (close * 2 AS close) FROM counted WHERE rn % 10 = 0
        UNION ALL SELECT * EXCLUDE rn REPLACE (CAST(date + INTERVAL 10000 DAY AS DATE) AS date)
        FROM counted WHERE rn % 10 = 0""",
    "pairs_dim": "SELECT * FROM (VALUES "
    + ", ".join(f"('{p}', '{b}', '{q}')" for p, b, q in PAIRS)
    + ") AS v(pair, base_currency, quote_currency)",
    "days": """SELECT CAST(unnest(generate_series((SELECT min(date) FROM bars)::TIMESTAMP,
        (SELECT max(date) FROM bars)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date""",
    "moves": """SELECT *, CASE WHEN diff > 0 THEN diff ELSE 0 END AS gain,
        CASE WHEN diff < 0 THEN -diff ELSE 0 END AS loss
        FROM (SELECT *, close - lag(close) OVER (PARTITION BY pair ORDER BY date) AS diff,
              row_number() OVER (PARTITION BY pair ORDER BY date) AS rn FROM fact)""",
    "smas": """SELECT *, avg(gain) OVER r14 AS up, avg(loss) OVER r14 AS down,
        avg(close) OVER (w ROWS 8 PRECEDING) AS s9, avg(close) OVER (w ROWS 21 PRECEDING) AS s22,
        avg(close) OVER (w ROWS 49 PRECEDING) AS s50, avg(close) OVER (w ROWS 11 PRECEDING) AS s12,
        avg(close) OVER (w ROWS 25 PRECEDING) AS s26 FROM moves
        WINDOW w AS (PARTITION BY pair ORDER BY date),
               r14 AS (PARTITION BY pair ORDER BY date ROWS 13 PRECEDING)""",
    "emas": """SELECT *, CASE WHEN down = 0 THEN 100 ELSE 100 - 100 / (1 + up / nullif(down, 0)) END AS rsi_14,
        close * 2e0 / 10 + lag(s9) OVER w * (1 - 2e0 / 10) AS ema_9,
        close * 2e0 / 23 + lag(s22) OVER w * (1 - 2e0 / 23) AS ema_22,
        close * 2e0 / 51 + lag(s50) OVER w * (1 - 2e0 / 51) AS ema_50,
        close * 2e0 / 13 + lag(s12) OVER w * (1 - 2e0 / 13) AS ema_12,
        close * 2e0 / 27 + lag(s26) OVER w * (1 - 2e0 / 27) AS ema_26
        FROM smas WINDOW w AS (PARTITION BY pair ORDER BY date)""",
    "macds": """SELECT *, macd_line - signal_line AS macd_histogram FROM (
        SELECT *, avg(macd_line) OVER (PARTITION BY pair ORDER BY date ROWS 8 PRECEDING) AS signal_line
        FROM (SELECT *, ema_12 - ema_26 AS macd_line FROM emas))""",
    "ta": """SELECT date, pair, close, daily_change_percent, rsi_14, ema_9, ema_22, ema_50, macd_line,
        signal_line, macd_histogram,
        CASE WHEN rsi_14 < 30 THEN 'Oversold' WHEN rsi_14 > 70 THEN 'Overbought' ELSE 'Neutral' END AS rsi_signal,
        CASE WHEN ema_9 > ema_22 AND ema_22 > ema_50 THEN 'Strong Uptrend'
             WHEN ema_9 < ema_22 AND ema_22 < ema_50 THEN 'Strong Downtrend'
             WHEN ema_9 > ema_22 THEN 'Potential Uptrend'
             WHEN ema_9 < ema_22 THEN 'Potential Downtrend' ELSE 'Neutral' END AS trend_signal,
        CASE WHEN macd_line > signal_line AND macd_histogram > 0 THEN 'Buy'
             WHEN macd_line < signal_line AND macd_histogram < 0 THEN 'Sell' ELSE 'Hold' END AS macd_signal
        FROM macds WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 90 DAY""",
    # Recursive averages, one step per row.
    "wilder_run": """SELECT pair, date, rn, gain AS up, loss AS down FROM moves WHERE rn = 1
        UNION ALL SELECT m.pair, m.date, m.rn, r.up * 13e0 / 14 + m.gain / 14, r.down * 13e0 / 14 + m.loss / 14
        FROM wilder_run r JOIN moves m ON m.pair = r.pair AND m.rn = r.rn + 1""",
    "ema_run": """SELECT pair, date, rn, close, close AS ema_12, close AS ema_26, CAST(0 AS DOUBLE) AS signal
        FROM counted WHERE rn = 1
        UNION ALL SELECT pair, date, rn, close, e12, e26, signal * 0.8e0 + (e12 - e26) * 0.2e0 FROM (
          SELECT c.pair, c.date, c.rn, c.close, r.ema_12 * 11e0 / 13 + c.close * 2e0 / 13 AS e12,
                 r.ema_26 * 25e0 / 27 + c.close * 2e0 / 27 AS e26, r.signal
          FROM ema_run r JOIN counted c ON c.pair = r.pair AND c.rn = r.rn + 1)""",
}
