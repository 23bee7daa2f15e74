"""Queries over the star schema, the warehouse-style views and the combined analysis."""

from pyspark.sql import functions as F

from tickloom.operators import averages, bars as bar_ops, changes, oscillators, select, star, summary
from tickloom.plans import inputs, technical
from tickloom.plans.registry import query

PRICES = "open:4 high:4 low:4 close:4"
TA = (
    "date:d pair close:4 daily_change_percent:6 rsi_14:6 ema_9:4 ema_22:4 ema_50:4 macd_line:4 "
    "signal_line:4 macd_histogram:4 rsi_signal trend_signal macd_signal"
)
AS_OF = "(SELECT max(date) FROM bars)"
W = "(PARTITION BY pair ORDER BY date)"


@query(
    "fact_daily_rates",
    f"pair date:d {PRICES} daily_change_amount:4 daily_change_percent:6 volatility_percent:6",
    "SELECT * FROM fact",
)
def fact_daily_rates(spark, sf):
    return inputs.fact(spark, sf)


@query(
    "rates_analytics",
    f"pair date:d {PRICES} daily_change:4 daily_change_percent:6 daily_range:4 daily_range_percent:6 "
    "year:i month:i quarter:i day_of_week:i",
    """SELECT *, close - open AS daily_change, high - low AS daily_range,
       volatility_percent AS daily_range_percent, year(date) AS year, month(date) AS month,
       quarter(date) AS quarter, dayofweek(date) AS day_of_week FROM fact""",
)
def rates_analytics(spark, sf):
    return bar_ops.rates_analytics(inputs.bars(spark, sf))


LAGS = f"""lag(close, 1) OVER {W} AS prev_day_rate, lag(close, 7) OVER {W} AS prev_week_rate,
    lag(close, 30) OVER {W} AS prev_month_rate"""


@query(
    "exchange_rate_analysis",
    "date:d year:i month:i quarter:i month_name pair base_currency quote_currency exchange_rate:4 "
    "daily_change_percent:6 volatility_percent:6 prev_day_rate:4 prev_week_rate:4 prev_month_rate:4",
    f"""SELECT fact.*, close AS exchange_rate, year(date) AS year, month(date) AS month,
        quarter(date) AS quarter, monthname(date) AS month_name, base_currency, quote_currency, {LAGS}
        FROM fact JOIN days USING (date) JOIN pairs_dim USING (pair)""",
)
def exchange_rate_analysis(spark, sf):
    fact = inputs.fact(spark, sf)
    return star.exchange_rate_analysis(
        fact, star.dim_calendar(fact), star.dim_pairs(spark, inputs.PAIRS)
    )


@query(
    "active_pairs",
    "pair base_currency quote_currency pair_description is_active:b",
    """SELECT *, base_currency || ' to ' || quote_currency AS pair_description, true AS is_active
       FROM pairs_dim SEMI JOIN bars USING (pair)""",
)
def active_pairs(spark, sf):
    return star.active_pairs(inputs.bars(spark, sf), star.dim_pairs(spark, inputs.PAIRS))


@query(
    "rate_changes",
    "date:d pair close:4 prev_day_rate:4 prev_week_rate:4 prev_month_rate:4 daily_change_percent:6 "
    "weekly_change_pct:6 monthly_change_pct:6",
    f"""SELECT *, (close - prev_week_rate) / nullif(prev_week_rate, 0) * 100 AS weekly_change_pct,
        (close - prev_month_rate) / nullif(prev_month_rate, 0) * 100 AS monthly_change_pct
        FROM (SELECT *, {LAGS} FROM fact)""",
)
def rate_changes(spark, sf):
    return changes.rate_changes(inputs.fact(spark, sf))


@query(
    "volatility_metrics",
    "month_start:d pair avg_daily_volatility:6 max_daily_volatility:6 min_daily_volatility:6 "
    "std_dev_daily_change:6",
    """SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, pair,
       avg(volatility_percent) AS avg_daily_volatility, max(volatility_percent) AS max_daily_volatility,
       min(volatility_percent) AS min_daily_volatility,
       stddev_samp(daily_change_percent) AS std_dev_daily_change FROM fact GROUP BY 1, 2""",
)
def volatility_metrics(spark, sf):
    return summary.volatility_metrics(inputs.fact(spark, sf))


@query(
    "volatility_by_year",
    "pair year:i month:i month_label avg_daily_volatility:6",
    """SELECT pair, year(date) AS year, month(date) AS month, strftime(date, '%Y-%m') AS month_label,
       avg(volatility_percent) AS avg_daily_volatility FROM fact GROUP BY ALL""",
)
def volatility_by_year(spark, sf):
    return summary.volatility_by_year(summary.volatility_metrics(inputs.fact(spark, sf)))


CROSS = "date:d ab_rate:4 ac_rate:4 bc_rate:4 calculated_bc_rate:6 cross_rate_diff_pct:6"
CROSS_SQL = """SELECT ab.date, ab.close AS ab_rate, ac.close AS ac_rate, bc.close AS bc_rate,
    ac.close / nullif(ab.close, 0) AS calculated_bc_rate,
    abs(ac.close / nullif(ab.close, 0) - bc.close) / nullif(bc.close, 0) * 100 AS cross_rate_diff_pct
    FROM bars ab JOIN bars ac ON ab.date = ac.date AND ab.pair = '1-URGENT' AND ac.pair = '2-HIGH'
    JOIN bars bc ON ab.date = bc.date AND bc.pair = '3-MEDIUM'"""
LEGS = (inputs.LEG_AB, inputs.LEG_AC, inputs.LEG_BC)


@query("cross_rates", CROSS, CROSS_SQL)
def cross_rates(spark, sf):
    return star.cross_rates(inputs.bars(spark, sf), *LEGS)


@query("cross_rates_joined", CROSS, CROSS_SQL)
def cross_rates_joined(spark, sf):
    return star.cross_rates_joined(inputs.bars(spark, sf), *LEGS)


@query(
    "cross_rate_synth",
    "pair date:d open:0 high:0 low:0 close:0",
    """SELECT 'EUR/EGP' AS pair, a.date, a.open * b.open AS open, a.high * b.high AS high,
       a.low * b.low AS low, a.close * b.close AS close
       FROM (SELECT * FROM bars WHERE pair = '1-URGENT') a
       LEFT JOIN (SELECT * FROM bars WHERE pair = '3-MEDIUM') b USING (date)""",
)
def cross_rate_synth(spark, sf):
    return star.synth_cross(inputs.bars(spark, sf), inputs.LEG_AB, inputs.LEG_BC, "EUR/EGP")


@query(
    "moving_averages",
    "date:d pair close:4 ma_7_day:4 ma_30_day:4 ma_90_day:4",
    f"""SELECT *, avg(close) OVER (w ROWS 6 PRECEDING) AS ma_7_day,
        avg(close) OVER (w ROWS 29 PRECEDING) AS ma_30_day,
        avg(close) OVER (w ROWS 89 PRECEDING) AS ma_90_day FROM bars WINDOW w AS {W}""",
)
def moving_averages(spark, sf):
    return averages.moving_averages(inputs.bars(spark, sf))


@query("technical_rsi", "date:d pair rsi_14:6", "SELECT * FROM emas")
def technical_rsi(spark, sf):
    return oscillators.technical_rsi(inputs.bars(spark, sf))


@query("technical_ema", "date:d pair close:4 ema_9:4 ema_22:4 ema_50:4", "SELECT * FROM emas")
def technical_ema(spark, sf):
    return averages.technical_ema(inputs.bars(spark, sf))


@query(
    "technical_macd",
    "date:d pair ema_12:4 ema_26:4 macd_line:4 signal_line:4 macd_histogram:4",
    "SELECT * FROM macds",
)
def technical_macd(spark, sf):
    return oscillators.technical_macd(inputs.bars(spark, sf))


def view(spark, sf):
    return technical.technical_analysis(inputs.stored_fact(spark, sf))


def as_of(spark, sf):
    return select.latest_date(inputs.bars(spark, sf))


@query("technical_analysis", TA, "SELECT * FROM ta")
def technical_analysis(spark, sf):
    return view(spark, sf)


@query("technical_analysis_joined", TA, "SELECT * FROM ta")
def technical_analysis_joined(spark, sf):
    return technical.technical_analysis_joined(inputs.stored_fact(spark, sf))


@query("latest_signals", TA, "SELECT * FROM ta WHERE date = (SELECT max(date) FROM ta)")
def latest_signals(spark, sf):
    return technical.latest_signals(view(spark, sf), as_of(spark, sf))


@query(
    "latest_per_pair",
    TA,
    "SELECT * FROM ta QUALIFY row_number() OVER (PARTITION BY pair ORDER BY date DESC) = 1",
)
def latest_per_pair(spark, sf):
    return select.latest_per_pair(view(spark, sf))


@query(
    "strong_signals",
    "pair date:d close:4 rsi_14:6 rsi_signal trend_signal macd_signal daily_change_percent:6",
    f"""SELECT * FROM ta WHERE date >= {AS_OF} - INTERVAL 7 DAY AND (
        (rsi_signal = 'Oversold' AND macd_signal = 'Buy') OR (rsi_signal = 'Overbought' AND macd_signal = 'Sell')
        OR (trend_signal LIKE 'Strong%' AND macd_signal <> 'Hold'))""",
)
def strong_signals(spark, sf):
    return technical.strong_signals(view(spark, sf), as_of(spark, sf))


@query(
    "volatility_signal",
    "pair date:d close:4 daily_change_percent:6 avg_volatility_21d:6 volatility_signal",
    f"""SELECT *, CASE WHEN abs(daily_change_percent) > 2 * avg_volatility_21d THEN 'High Volatility'
        WHEN abs(daily_change_percent) > avg_volatility_21d THEN 'Above Average' ELSE 'Normal' END
        AS volatility_signal FROM (SELECT *, avg(abs(daily_change_percent)) OVER
          (PARTITION BY pair ORDER BY date ROWS 20 PRECEDING) AS avg_volatility_21d FROM ta)
        WHERE date >= {AS_OF} - INTERVAL 30 DAY""",
)
def volatility_signal(spark, sf):
    return technical.volatility_signal(view(spark, sf), as_of(spark, sf))


DURATION_SQL = """SELECT *, count(*) OVER (PARTITION BY pair, trend_signal ORDER BY date) AS trend_duration
    FROM ta WHERE trend_signal <> 'Neutral'"""


@query(
    "trend_duration",
    "pair latest_date:d close:4 trend_signal days_in_current_trend:l",
    f"""SELECT *, date AS latest_date, trend_duration AS days_in_current_trend FROM ({DURATION_SQL}
        QUALIFY row_number() OVER (PARTITION BY pair ORDER BY date DESC) = 1)""",
)
def trend_duration(spark, sf):
    return technical.trend_duration(view(spark, sf))


@query("trend_running_days", "pair date:d trend_signal trend_duration:l", DURATION_SQL)
def trend_running_days(spark, sf):
    return technical.trend_running_days(view(spark, sf))


@query(
    "rsi_divergence",
    "pair date:d close:4 rsi_14:6 divergence_signal",
    f"""SELECT * FROM (SELECT *, CASE
        WHEN close > lag(close) OVER w AND rsi_14 < lag(rsi_14) OVER w THEN 'Bearish Divergence'
        WHEN close < lag(close) OVER w AND rsi_14 > lag(rsi_14) OVER w THEN 'Bullish Divergence'
        ELSE 'No Divergence' END AS divergence_signal
        FROM ta WHERE date >= {AS_OF} - INTERVAL 14 DAY WINDOW w AS {W})
        WHERE divergence_signal <> 'No Divergence'""",
)
def rsi_divergence(spark, sf):
    return technical.rsi_divergence(view(spark, sf), as_of(spark, sf))


@query(
    "support_resistance_band",
    "pair date:d close:4 support_level:4 resistance_level:4 price_channel_width_pct:6",
    f"""SELECT *, (resistance_level - support_level) / nullif(support_level, 0) * 100
        AS price_channel_width_pct FROM (SELECT *,
          min(close) OVER (w ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS support_level,
          max(close) OVER (w ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS resistance_level
          FROM ta WINDOW w AS {W}) WHERE date >= {AS_OF} - INTERVAL 30 DAY""",
)
def support_resistance_band(spark, sf):
    return technical.support_resistance_band(view(spark, sf), as_of(spark, sf))


@query(
    "multi_timeframe",
    "pair date:d close:4 daily_trend multi_timeframe_trend",
    f"""SELECT *, trend_signal AS daily_trend, CASE
        WHEN close > wk AND wk > mo THEN 'Strong Uptrend' WHEN close < wk AND wk < mo THEN 'Strong Downtrend'
        WHEN close > mo THEN 'Bullish' ELSE 'Bearish' END AS multi_timeframe_trend
        FROM (SELECT *, avg(close) OVER (w ROWS 4 PRECEDING) AS wk,
              avg(close) OVER (w ROWS 21 PRECEDING) AS mo FROM ta WINDOW w AS {W})
        WHERE date >= {AS_OF} - INTERVAL 30 DAY""",
)
def multi_timeframe(spark, sf):
    return technical.multi_timeframe(view(spark, sf), as_of(spark, sf))


@query(
    "performance_summary",
    "pair total_signals:l buy_signals:l sell_signals:l avg_buy_return:6 avg_sell_return:6 "
    "min_rsi:6 max_rsi:6 avg_rsi:6",
    f"""SELECT pair, count(*) AS total_signals, count(*) FILTER (macd_signal = 'Buy') AS buy_signals,
        count(*) FILTER (macd_signal = 'Sell') AS sell_signals,
        avg(daily_change_percent) FILTER (macd_signal = 'Buy') AS avg_buy_return,
        avg(daily_change_percent) FILTER (macd_signal = 'Sell') AS avg_sell_return,
        min(rsi_14) AS min_rsi, max(rsi_14) AS max_rsi, avg(rsi_14) AS avg_rsi
        FROM ta WHERE date >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1""",
)
def performance_summary(spark, sf):
    return technical.performance_summary(view(spark, sf), as_of(spark, sf))


@query(
    "recent_signals",
    "pair date:d close:4 trend_signal rsi_14:6",
    """SELECT * FROM ta WHERE trend_signal <> 'Neutral'
       QUALIFY row_number() OVER (PARTITION BY pair ORDER BY date DESC) <= 10""",
)
def recent_signals(spark, sf):
    return technical.recent_signals(view(spark, sf))


@query(
    "cross_rate_rounded",
    "pair date:d open:6 high:6 low:6 close:6",
    """SELECT 'EUR/EGP' AS pair, a.date, round_even(a.open * b.open / 1e12, 4) AS open, round_even(a.high * b.high / 1e12, 4) AS high,
       round_even(a.low * b.low / 1e12, 4) AS low, round_even(a.close * b.close / 1e12, 4) AS close
       FROM (SELECT * FROM bars WHERE pair = '1-URGENT') a
       LEFT JOIN (SELECT * FROM bars WHERE pair = '3-MEDIUM') b USING (date)""",
)
def cross_rate_rounded(spark, sf):
    """On prices around 0.1, where rounding to four places shows."""
    small = inputs.bars(spark, sf).withColumns({c: F.col(c) / 1e6 for c in ("open", "high", "low", "close")})
    return star.synth_cross(small, inputs.LEG_AB, inputs.LEG_BC, "EUR/EGP")


@query(
    "split_pairs",
    "pair base quote n:l",
    """SELECT pair || '/' || strftime(ts, '%H') AS pair, pair AS base, strftime(ts, '%H') AS quote, count(*) AS n
       FROM ticks GROUP BY ALL""",
)
def split_pairs(spark, sf):
    named = inputs.ticks(spark, sf).select(F.concat_ws("/", "pair", F.date_format("ts", "HH")).alias("pair"))
    base, quote = star.split_pair("pair")
    return named.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).select("pair", base.alias("base"), quote.alias("quote"), "n")


@query(
    "star_slice",
    "date:d year:i month_name pair base_currency exchange_rate:4 prev_week_rate:4",
    f"""SELECT * FROM (SELECT date, year(date) AS year, monthname(date) AS month_name, pair, base_currency,
          close AS exchange_rate, lag(close, 7) OVER {W} AS prev_week_rate
        FROM bars JOIN days USING (date) JOIN pairs_dim USING (pair))
        WHERE pair = '2-HIGH' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
)
def star_slice(spark, sf):
    """One instrument and date range of the joined view, with calendar columns."""
    fact = inputs.fact(spark, sf)
    joined = star.exchange_rate_analysis(fact, star.dim_calendar(fact), star.dim_pairs(spark, inputs.PAIRS))
    return select.between(joined, "1996-01-01", "1997-06-30", "2-HIGH")


@query(
    "technical_slice",
    TA,
    "SELECT * FROM ta WHERE pair = '2-HIGH' AND date BETWEEN DATE '2001-05-20' AND DATE '2001-07-10'",
)
def technical_slice(spark, sf):
    """The same over the technical view."""
    return select.between(view(spark, sf), "2001-05-20", "2001-07-10", "2-HIGH")


@query(
    "newest_first",
    "place:l pair date:d close:4",
    "SELECT row_number() OVER (ORDER BY date DESC, pair) AS place, pair, date, close FROM bars ORDER BY place LIMIT 50",
)
def newest_first(spark, sf):
    """The first 50 rows in the order of output, with their places."""
    first = select.order_for_output(inputs.bars(spark, sf)).limit(50)
    rows = first.agg(F.collect_list(F.struct("pair", "date", "close")).alias("rows"))  # 50 rows
    return rows.select(F.posexplode("rows").alias("at", "r")).select((F.col("at") + 1).alias("place"), "r.*")
