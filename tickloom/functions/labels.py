"""Signal labels.  The texts are output values that consumers match on."""

from functools import reduce

from pyspark.sql import functions as F

from tickloom.functions.prices import as_col

# Label texts and thresholds.
OVERSOLD, OVERBOUGHT, MIDLINE = 30, 70, 50
INSUFFICIENT = "Insufficient data for reliable signals"
MIN_SIGNAL_ROWS = 200


def first_match(*rules, default):
    """Label of the first rule that holds; NULL conditions do not hold."""
    head, *rest = rules
    chain = reduce(lambda c, r: c.when(r[0], F.lit(r[1])), rest, F.when(head[0], F.lit(head[1])))
    return chain.otherwise(F.lit(default) if isinstance(default, str) else default)


def rsi_signal(rsi="rsi_14"):
    r = as_col(rsi)
    return first_match(
        (r < OVERSOLD, "Oversold"), (r > OVERBOUGHT, "Overbought"), default="Neutral"
    )


def trend_signal(fast="ema_9", mid="ema_22", slow="ema_50"):
    f, m, s = as_col(fast), as_col(mid), as_col(slow)
    up, down = f > m, f < m
    return first_match(
        (up & (m > s), "Strong Uptrend"),
        (down & (m < s), "Strong Downtrend"),
        (up, "Potential Uptrend"),
        (down, "Potential Downtrend"),
        default="Neutral",
    )


def macd_signal(line="macd_line", signal="signal_line", histogram="macd_histogram"):
    ln, sg, hs = as_col(line), as_col(signal), as_col(histogram)
    return first_match(
        ((ln > sg) & (hs > 0), "Buy"), ((ln < sg) & (hs < 0), "Sell"), default="Hold"
    )


def volatility_level(size, usual):
    v, u = as_col(size), as_col(usual)
    return first_match(
        (v > u * 2, "High Volatility"), (v > u, "Above Average"), default="Normal"
    )


def timeframe_trend(close, week, month):
    c, wk, mo = as_col(close), as_col(week), as_col(month)
    return first_match(
        ((c > wk) & (wk > mo), "Strong Uptrend"),
        ((c < wk) & (wk < mo), "Strong Downtrend"),
        (c > mo, "Bullish"),
        default="Bearish",
    )


def divergence(close, prev_close, rsi, prev_rsi):
    return first_match(
        ((close > prev_close) & (rsi < prev_rsi), "Bearish Divergence"),
        ((close < prev_close) & (rsi > prev_rsi), "Bullish Divergence"),
        default="No Divergence",
    )


def sma_state(fast, slow, prev_fast, prev_slow):
    """Crossing of two averages between two rows, else which one is on top."""
    return first_match(
        ((prev_fast < prev_slow) & (fast > slow), "Strong Buy (Golden Cross)"),
        ((prev_fast > prev_slow) & (fast < slow), "Strong Sell (Death Cross)"),
        (fast > slow, "Buy (Uptrend)"),
        default="Sell (Downtrend)",
    )


def rsi_state(rsi):
    r = as_col(rsi)
    return first_match(
        (r > OVERBOUGHT, "Sell (Overbought)"),
        (r < OVERSOLD, "Buy (Oversold)"),
        (r > MIDLINE, "Neutral to Bullish"),
        default="Neutral to Bearish",
    )


def macd_state(line, signal, prev_line, prev_signal):
    return first_match(
        ((prev_line < prev_signal) & (line > signal), "Buy (Bullish Crossover)"),
        ((prev_line > prev_signal) & (line < signal), "Sell (Bearish Crossover)"),
        (line > signal, "Hold Buy (Bullish)"),
        default="Hold Sell (Bearish)",
    )


def band_state(close, upper, lower):
    c = as_col(close)
    return first_match(
        (c > as_col(upper), "Sell (Above Upper Band)"),
        (c < as_col(lower), "Buy (Below Lower Band)"),
        default="Neutral (Within Bands)",
    )


def count_containing(labels, word):
    return F.size(F.filter(labels, lambda s: F.contains(s, F.lit(word))))


def overall_signal(labels):
    """Vote over an array of labels: ``Buy (b/n)``, ``Sell (s/n)`` or ``Neutral``."""
    buys, sells = count_containing(labels, "Buy"), count_containing(labels, "Sell")
    return first_match(
        (buys > sells, "Buy"), (sells > buys, "Sell"), default="Neutral"
    ), buys, sells


def vote_text(labels):
    side, buys, sells = overall_signal(labels)
    n = F.size(labels)
    return (
        F.when(side == "Buy", F.format_string("Buy (%d/%d)", buys, n))
        .when(side == "Sell", F.format_string("Sell (%d/%d)", sells, n))
        .otherwise(side)
    )
