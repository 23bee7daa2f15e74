"""Queries over period reports, correlations and dashboard signals."""

from pyspark.sql import functions as F

from tickloom.functions.prices import change_percent
from tickloom.operators import select, signals, summary
from tickloom.plans import dashboard, inputs
from tickloom.plans.q_indicators import strict_sql
from tickloom.plans.registry import query

W = "(PARTITION BY pair ORDER BY date)"


@query(
    "monthly_range",
    "pair month avg_daily_range_pct:6",
    """SELECT pair, strftime(date, '%Y-%m') AS month, avg(volatility_percent) AS avg_daily_range_pct
       FROM (SELECT *, count(*) OVER (PARTITION BY pair) AS n FROM fact
             WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 180 DAY) WHERE n > 30 GROUP BY 1, 2""",
)
def monthly_range(spark, sf):
    return summary.monthly_range(select.trailing(inputs.bars(spark, sf), 180))


PERIOD = (
    "pair current_price:4 previous_price:4 daily_change:4 daily_change_pct:6 period_high:4 period_low:4 "
    "high_date:d low_date:d period_return:6 volatility:6 avg_daily_range:6 max_daily_range:6 trend_signal"
)


def period_sql(condition):
    return f"""SELECT pair, arg_max(close, date) AS current_price, arg_max(prev, date) AS previous_price,
        current_price - previous_price AS daily_change, daily_change / previous_price * 100 AS daily_change_pct,
        max(high) AS period_high, min(low) AS period_low,
        min(date) FILTER (high = top) AS high_date, min(date) FILTER (low = bottom) AS low_date,
        (current_price - arg_min(close, date)) / arg_min(close, date) * 100 AS period_return,
        stddev_samp(daily_change_percent) AS volatility, avg(volatility_percent) AS avg_daily_range,
        max(volatility_percent) AS max_daily_range,
        CASE WHEN arg_max(s50, date) > arg_max(s200, date) AND max(rn) >= 200 THEN 'Bullish' ELSE 'Bearish' END AS trend_signal
        FROM (SELECT *, max(high) OVER (PARTITION BY pair) AS top, min(low) OVER (PARTITION BY pair) AS bottom
              FROM (SELECT *, lag(close) OVER w AS prev, row_number() OVER w AS rn,
                    {strict_sql('avg', 50)} AS s50, {strict_sql('avg', 200)} AS s200
                    FROM fact WINDOW w AS {W}) WHERE {condition}) GROUP BY pair"""


LAST_400 = "date >= (SELECT max(date) FROM bars) - INTERVAL 400 DAY"


def last_400(bars):
    return F.col("date") >= F.date_sub(select.latest_date(bars), 400)


@query("period_stats", PERIOD, period_sql("true"))
def period_stats(spark, sf):
    return summary.period_stats(inputs.bars(spark, sf))


@query("dashboard_period_stats", PERIOD, period_sql(LAST_400))
def dashboard_period_stats(spark, sf):
    """Statistics of the last 400 days; the trend means see the whole series."""
    bars = inputs.bars(spark, sf)
    return summary.period_stats(bars, last_400(bars))


INDICATORS_SQL = f"""SELECT *, mid + 2 * sd AS bb_upper, mid - 2 * sd AS bb_lower FROM (
        SELECT b.*, e.ema_12, e.ema_26, e.ema_12 - e.ema_26 AS macd, e.signal AS macd_signal,
          e.ema_12 - e.ema_26 - e.signal AS macd_histogram,
          CASE WHEN e.rn >= 14 THEN CASE WHEN down = 0 AND up > 0 THEN 100 WHEN down = 0 THEN NULL
               ELSE 100 - 100 / (1 + up / down) END END AS rsi
        FROM (SELECT *, {strict_sql('avg', 20)} AS sma_20, {strict_sql('avg', 50)} AS sma_50,
                {strict_sql('avg', 200)} AS sma_200, {strict_sql('avg', 20)} AS mid,
                {strict_sql('stddev_samp', 20)} AS sd, close - open AS daily_change, high - low AS daily_range,
                (close / nullif(lag(close, 5) OVER w, 0) - 1) * 100 AS weekly_return,
                (close / nullif(lag(close, 20) OVER w, 0) - 1) * 100 AS monthly_return
              FROM bars WINDOW w AS {W}) b JOIN ema_run e USING (pair, date)
        JOIN (SELECT pair, date, avg(gain) OVER f AS up, avg(loss) OVER f AS down FROM moves
              WINDOW f AS (PARTITION BY pair ORDER BY date ROWS 13 PRECEDING)) m USING (pair, date))
        WHERE {LAST_400}"""


@query(
    "dashboard_indicators",
    "pair date:d close:4 sma_20:4 sma_50:4 sma_200:4 ema_12:4 ema_26:4 macd:4 macd_signal:4 macd_histogram:4 "
    "rsi:6 bb_upper:4 bb_lower:4 daily_change:4 daily_range:4 weekly_return:6 monthly_return:6",
    INDICATORS_SQL,
)
def dashboard_indicators(spark, sf):
    """Indicators of the whole series, shown for the last 400 days."""
    bars = inputs.bars(spark, sf)
    return dashboard.add_indicators(bars).filter(last_400(bars))


@query(
    "dashboard_price_panel",
    "pair date:d open:4 high:4 low:4 close:4 sma_20:4 sma_50:4 sma_200:4",
    INDICATORS_SQL,
)
def dashboard_price_panel(spark, sf):
    bars = inputs.bars(spark, sf)
    return dashboard.price_panel(bars, last_400(bars))


@query(
    "dashboard_indicator_panel",
    "pair date:d close:4 macd:4 macd_signal:4 macd_histogram:4 rsi:6 bb_upper:4 bb_middle:4 bb_lower:4",
    f"SELECT *, mid AS bb_middle FROM ({INDICATORS_SQL})",
)
def dashboard_indicator_panel(spark, sf):
    bars = inputs.bars(spark, sf)
    return dashboard.indicator_panel(bars, last_400(bars))


@query(
    "last_change",
    "pair latest_close:4 previous_close:4 daily_change:4 daily_change_pct:6 period_return:6",
    f"""SELECT pair, arg_max(close, date) AS latest_close, arg_max(prev, date) AS previous_close,
        latest_close - previous_close AS daily_change, daily_change / previous_close * 100 AS daily_change_pct,
        (latest_close - arg_min(close, date)) / arg_min(close, date) * 100 AS period_return
        FROM (SELECT *, lag(close) OVER {W} AS prev FROM bars) GROUP BY pair""",
)
def last_change(spark, sf):
    return summary.last_change(inputs.bars(spark, sf))


@query(
    "daily_return_stats",
    "pair avg_daily_return:6 positive_days:l negative_days:l positive_share:6 negative_share:6",
    """SELECT pair, avg(daily_change_percent) AS avg_daily_return,
       count(*) FILTER (daily_change_percent > 0) AS positive_days,
       count(*) FILTER (daily_change_percent < 0) AS negative_days,
       positive_days / count(daily_change_percent) * 100 AS positive_share,
       negative_days / count(daily_change_percent) * 100 AS negative_share FROM fact GROUP BY pair""",
)
def daily_return_stats(spark, sf):
    return summary.daily_return_stats(inputs.bars(spark, sf))


@query(
    "volatility_summary",
    "pair avg_daily_range_pct:6 max_daily_range_pct:6 volatility:6 period_high:4 period_low:4 "
    "first_date:d last_date:d",
    """SELECT pair, avg(volatility_percent) AS avg_daily_range_pct, max(volatility_percent) AS max_daily_range_pct,
       stddev_samp(daily_change_percent) AS volatility, max(high) AS period_high, min(low) AS period_low,
       min(date) AS first_date, max(date) AS last_date FROM fact GROUP BY pair""",
)
def volatility_summary(spark, sf):
    return summary.volatility_summary(inputs.bars(spark, sf))


@query(
    "describe_bars",
    "pair column_name count:l mean:4 std:4 min:4 p25:4 p50:4 p75:4 max:4",
    " UNION ALL ".join(
        f"""SELECT pair, '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
            min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
            quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM fact GROUP BY pair"""
        for c in ("open", "high", "low", "close", "daily_change_percent")
    ),
)
def describe_bars(spark, sf):
    columns = ("open", "high", "low", "close", "daily_change_percent")
    return summary.describe_exact(inputs.fact(spark, sf), columns)


@query(
    "describe_ticks",
    "pair column_name count:l mean:4 std:4 min:4 p25:4 p50:4 p75:4 max:4",
    " UNION ALL ".join(
        f"""SELECT pair, '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
            min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
            quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM ticks GROUP BY pair"""
        for c in ("price", "event_id")
    ),
)
def describe_ticks(spark, sf):
    """Exact quartiles of quotes, of which a series may have any number: found by counting."""
    return summary.describe_exact(inputs.ticks(spark, sf), ("price", "event_id"))


TICK_QUANTILES = (0.0, 0.01, 0.5, 0.9, 0.999, 1.0)


@query(
    "tick_quantiles",
    "pair column_name quantile:4 value:6",
    " UNION ALL ".join(
        f"SELECT pair, 'price' AS column_name, {q} AS quantile, quantile_cont(price, {q}) AS value FROM ticks GROUP BY pair" for q in TICK_QUANTILES
    ),
)
def tick_quantiles(spark, sf):
    """The same with so few bins and rows that ranks are narrowed several times."""
    return summary.exact_quantiles(inputs.ticks(spark, sf), ("price",), TICK_QUANTILES, bins=8, few=4)


def histogram_sql(column):
    return f"""SELECT pair, CAST(bin AS INTEGER) AS bin, lo + (bin - 1) * (hi - lo) / 50 AS bin_from,
        lo + bin * (hi - lo) / 50 AS bin_to, count(*) AS n
        FROM (SELECT *, least(coalesce(floor(50 * ({column} - lo) / nullif(hi - lo, 0)) + 1, 1), 50) AS bin
              FROM (SELECT *, min({column}) OVER (PARTITION BY pair) AS lo,
                    max({column}) OVER (PARTITION BY pair) AS hi FROM fact)) GROUP BY pair, bin, lo, hi"""


BINS = "pair bin:i bin_from:4 bin_to:4 n:l"


@query("price_histogram", BINS, histogram_sql("close"))
def price_histogram(spark, sf):
    return summary.histogram(inputs.bars(spark, sf), "close")


@query("returns_histogram", BINS, histogram_sql("daily_change_percent"))
def returns_histogram(spark, sf):
    return summary.histogram(inputs.bars(spark, sf), change_percent())


def filled_sql(pairs):
    names = ", ".join(f"('{p}')" for p in pairs)
    return f"""SELECT pair, date, last_value(close IGNORE NULLS) OVER
        (PARTITION BY pair ORDER BY date ROWS UNBOUNDED PRECEDING) AS close
        FROM (SELECT date FROM bars WHERE pair = '{pairs[0]}') d CROSS JOIN (VALUES {names}) AS p(pair)
        LEFT JOIN bars USING (pair, date)"""


@query(
    "align_wide",
    "date:d urgent:4 high:4 low:4",
    f"""SELECT date, max(close) FILTER (pair = '1-URGENT') AS urgent, max(close) FILTER (pair = '2-HIGH') AS high,
        max(close) FILTER (pair = '5-LOW') AS low
        FROM ({filled_sql(('1-URGENT', '2-HIGH', '5-LOW'))}) GROUP BY date""",
)
def align_wide(spark, sf):
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
    return summary.align_wide(inputs.bars(spark, sf), list(names)).withColumnsRenamed(names)


@query(
    "returns_correlation",
    "pair_a pair_b corr:6",
    f"""WITH r AS (SELECT *, close / lag(close) OVER {W} - 1 AS ret FROM ({filled_sql(inputs.PAIR_NAMES)}))
        SELECT a.pair AS pair_a, b.pair AS pair_b, corr(a.ret, b.ret) AS corr
        FROM r a JOIN r b USING (date) GROUP BY 1, 2""",
)
def returns_correlation(spark, sf):
    return summary.returns_correlation(inputs.bars(spark, sf), inputs.PAIR_NAMES)


# --- dashboard signals -------------------------------------------------------

SMA_STATE_SQL = """CASE WHEN p50 < p200 AND s50 > s200 THEN 'Strong Buy (Golden Cross)'
    WHEN p50 > p200 AND s50 < s200 THEN 'Strong Sell (Death Cross)'
    WHEN s50 > s200 THEN 'Buy (Uptrend)' ELSE 'Sell (Downtrend)' END"""
SMAS_SQL = f"""SELECT *, lag(s50) OVER {W} AS p50, lag(s200) OVER {W} AS p200 FROM (
    SELECT *, {strict_sql('avg', 50)} AS s50, {strict_sql('avg', 200)} AS s200 FROM bars WINDOW w AS {W})"""


@query(
    "ma_crossovers",
    "pair date:d sma_50:4 sma_200:4 ma_signal",
    f"""SELECT *, s50 AS sma_50, s200 AS sma_200 FROM (SELECT *, {SMA_STATE_SQL} AS ma_signal FROM ({SMAS_SQL}))
        WHERE ma_signal LIKE 'Strong%'""",
)
def ma_crossovers(spark, sf):
    return signals.ma_crossovers(inputs.bars(spark, sf))


def naming(word, columns=signals.STATES):
    """How many of the label columns contain ``word``."""
    return " + ".join(f"CASE WHEN contains({c}, '{word}') THEN 1 ELSE 0 END" for c in columns)


def signals_sql(condition):
    return f"""WITH ind AS (
    SELECT a.pair, a.date, a.close, e.rn, {SMA_STATE_SQL} AS moving_average, up, down,
      e.ema_12 - e.ema_26 AS macd, e.signal, mid + 2 * sd AS upper_band, mid - 2 * sd AS lower_band
    FROM ({SMAS_SQL}) a JOIN ema_run e USING (pair, date)
    JOIN (SELECT pair, date, avg(gain) OVER f AS up, avg(loss) OVER f AS down FROM moves
          WINDOW f AS (PARTITION BY pair ORDER BY date ROWS 13 PRECEDING)) m USING (pair, date)
    JOIN (SELECT pair, date, avg(close) OVER f AS mid, stddev_samp(close) OVER f AS sd FROM bars
          WINDOW f AS (PARTITION BY pair ORDER BY date ROWS 19 PRECEDING)) b USING (pair, date)),
  lagged AS (SELECT *, lag(macd) OVER {W} AS p_macd, lag(signal) OVER {W} AS p_signal,
    CASE WHEN down = 0 AND up > 0 THEN 100 WHEN down = 0 THEN NULL ELSE 100 - 100 / (1 + up / down) END AS rsi_v
    FROM ind),
  states AS (SELECT pair, date, rn, moving_average,
    CASE WHEN rsi_v > 70 THEN 'Sell (Overbought)' WHEN rsi_v < 30 THEN 'Buy (Oversold)'
         WHEN rsi_v > 50 THEN 'Neutral to Bullish' ELSE 'Neutral to Bearish' END AS rsi,
    CASE WHEN p_macd < p_signal AND macd > signal THEN 'Buy (Bullish Crossover)'
         WHEN p_macd > p_signal AND macd < signal THEN 'Sell (Bearish Crossover)'
         WHEN macd > signal THEN 'Hold Buy (Bullish)' ELSE 'Hold Sell (Bearish)' END AS macd,
    CASE WHEN close > upper_band THEN 'Sell (Above Upper Band)' WHEN close < lower_band THEN 'Buy (Below Lower Band)'
         ELSE 'Neutral (Within Bands)' END AS bollinger
    FROM (SELECT * REPLACE (count(*) OVER (PARTITION BY pair) AS rn) FROM lagged WHERE {condition})
    QUALIFY row_number() OVER (PARTITION BY pair ORDER BY date DESC) = 1),
  votes AS (SELECT *, {naming('Buy')} AS buys, {naming('Sell')} AS sells FROM states)
  SELECT pair, date, CASE WHEN rn >= 200 THEN moving_average END AS moving_average,
    CASE WHEN rn >= 200 THEN rsi END AS rsi, CASE WHEN rn >= 200 THEN macd END AS macd,
    CASE WHEN rn >= 200 THEN bollinger END AS bollinger,
    CASE WHEN rn < 200 THEN 'Insufficient data for reliable signals'
         WHEN buys > sells THEN 'Buy (' || buys || '/4)' WHEN sells > buys THEN 'Sell (' || sells || '/4)'
         ELSE 'Neutral' END AS overall FROM votes"""


STATES = "pair date:d moving_average rsi macd bollinger overall"


@query("trading_signals", STATES, signals_sql("true"))
def trading_signals(spark, sf):
    return signals.trading_signals(inputs.bars(spark, sf))


@query("dashboard_signals", STATES, signals_sql(LAST_400))
def dashboard_signals(spark, sf):
    """Signals of the last 400 days; the indicators see the whole series."""
    bars = inputs.stored_bars(spark, sf)
    return signals.trading_signals(bars, last_400(bars))


@query(
    "signal_counts",
    "pair buy:l sell:l neutral:l",
    "SELECT pair, "
    + ", ".join(
        f"{naming(s, (*signals.STATES, 'overall'))} AS {s.lower()}"
        for s in ("Buy", "Sell", "Neutral")
    )
    + f" FROM ({signals_sql("true")})",
)
def signal_counts(spark, sf):
    return signals.signal_counts(signals.trading_signals(inputs.bars(spark, sf)))


@query(
    "trading_signals_slice",
    "pair date:d overall",
    """SELECT pair, max(date) AS date, 'Insufficient data for reliable signals' AS overall FROM bars
       WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 180 DAY GROUP BY 1""",
)
def trading_signals_slice(spark, sf):
    """The default 180-day period never holds 200 rows."""
    bars = inputs.bars(spark, sf)
    recent = F.col("date") >= F.date_sub(select.latest_date(bars), 180)
    return signals.trading_signals(bars, recent)
