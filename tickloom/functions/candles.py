"""Shape of a single candle and of two neighbours, as 0/1 flags."""

from pyspark.sql import functions as F

# Thresholds of the candle patterns.
DOJI_BODY_SHARE = 0.1
HAMMER_RANGE_PER_BODY = 3
HAMMER_SHARE = 0.6
RANGE_FLOOR = 1e-9


def flag(condition):
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def geometry():
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    return {"hl": h - l, "oc": c - o, "body": F.abs(c - o)}


def single_patterns():
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    span, body = h - l, F.abs(c - o)
    floor = span + RANGE_FLOOR
    long_shadow = span > HAMMER_RANGE_PER_BODY * body

    def share(x):
        return F.try_divide(x, floor) > HAMMER_SHARE

    return {
        "is_bullish": flag(c > o),
        "is_bearish": flag(c < o),
        "is_doji": flag(body < span * DOJI_BODY_SHARE),
        "is_hammer": flag(long_shadow & share(c - l) & share(o - l)),
        "is_inv_hammer": flag(long_shadow & share(h - c) & share(h - o)),
    }


def engulfing_patterns():
    """Needs the columns prev_open and prev_close."""
    o, c, po, pc = (F.col(n) for n in ("open", "close", "prev_open", "prev_close"))
    return {
        "bullish_engulfing": flag((c > o) & (pc < po) & (o < pc) & (c > po)),
        "bearish_engulfing": flag((c < o) & (pc > po) & (o > pc) & (c < po)),
    }
