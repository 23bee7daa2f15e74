"""Aggregate reports.  All are hash aggregates with a map-side half unless noted."""

from pyspark.sql import Window, functions as F, types as T

from tickloom.functions import dates
from tickloom.functions.prices import change_percent, percent_of, spread_percent
from tickloom.layout import layout_of, over_series
from tickloom.operators.averages import add_means
from tickloom.operators.changes import forward_fill
from tickloom.operators.select import with_marks
from tickloom.session import stored


def count_by_pair(rows):
    return rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def volatility_metrics(fact):
    """Monthly volatility per instrument."""
    return fact.groupBy(dates.month_start("date").alias("month_start"), "pair").agg(
        F.avg("volatility_percent").alias("avg_daily_volatility"),
        F.max("volatility_percent").alias("max_daily_volatility"),
        F.min("volatility_percent").alias("min_daily_volatility"),
        F.stddev_samp("daily_change_percent").alias("std_dev_daily_change"),
    )


def volatility_by_year(metrics):
    """Monthly volatility with year, month and a YYYY-MM label."""
    return metrics.withColumns(
        {
            "year": F.year("month_start"),
            "month": F.month("month_start"),
            "month_label": dates.padded_month(F.year("month_start"), F.month("month_start")),
        }
    )


def performance_summary(signals):
    """Signals per instrument; slice to the period first."""
    move = F.col("daily_change_percent")
    buy, sell = F.col("macd_signal") == "Buy", F.col("macd_signal") == "Sell"
    return signals.groupBy("pair").agg(
        F.count(F.lit(1)).alias("total_signals"),
        F.count_if(buy).alias("buy_signals"),
        F.count_if(sell).alias("sell_signals"),
        F.avg(F.when(buy, move)).alias("avg_buy_return"),
        F.avg(F.when(sell, move)).alias("avg_sell_return"),
        F.min("rsi_14").alias("min_rsi"),
        F.max("rsi_14").alias("max_rsi"),
        F.avg("rsi_14").alias("avg_rsi"),
    )


def monthly_range(bars, min_rows=30):
    """Mean daily range percent per month, for series with more than ``min_rows`` rows.

    The row guard sums the months' counts, so only month rows meet per instrument.
    """
    months = bars.groupBy("pair", dates.month_key("date").alias("month")).agg(
        F.avg(spread_percent()).alias("avg_daily_range_pct"), F.count(F.lit(1)).alias("_n")
    )
    rows = F.sum("_n").over(Window.partitionBy("pair"))
    return months.withColumn("_rows", rows).filter(F.col("_rows") > min_rows).drop("_n", "_rows")


def period_stats(bars, within=None, layout=None):
    """One row per instrument: last close and change, extremes, return, volatility, trend.

    The first date wins when several dates share the extreme.  ``within`` (a condition
    on the date) picks the period after the trend's means were taken over all rows.
    """

    layout = layout or layout_of(bars)
    shown = F.lit(True) if within is None else within
    ends = {"high": F.max, "low": F.min}

    def build(df, w):
        df = add_means(df, w, {"_fast": ("close", 50), "_slow": ("close", 200)}, full=True)
        df = df.withColumn("_prev", F.lag("close").over(w.spec))
        if layout.split:
            return df
        series = Window.partitionBy(*w.by)
        return df.withColumns({f"_{c}_end": end(F.when(shown, F.col(c))).over(series) for c, end in ends.items()})

    def first_date(c):
        """The first date of an extreme.  A daily series has it beside every row, so that the aggregate stays one of
        fixed-width values; of a series in blocks, the extreme and its date are found together."""
        if layout.split:
            return F.min_by("date", F.struct(-F.col(c) if c == "high" else F.col(c), "date"))
        return F.min(F.when(F.col(c) == F.col(f"_{c}_end"), F.col("date")))

    move, wide = change_percent(), spread_percent()
    rows = over_series(bars, build, back=200, layout=layout)
    out = (rows if within is None else rows.filter(within)).groupBy("pair").agg(
        F.max_by("close", "date").alias("current_price"),
        F.max_by("_prev", "date").alias("previous_price"),
        F.min_by("close", "date").alias("_first"),
        F.max("high").alias("period_high"),
        F.min("low").alias("period_low"),
        first_date("high").alias("high_date"),
        first_date("low").alias("low_date"),
        F.stddev_samp(move).alias("volatility"),
        F.avg(wide).alias("avg_daily_range"),
        F.max(wide).alias("max_daily_range"),
        F.max_by("_fast", "date").alias("_fast"),
        F.max_by("_slow", "date").alias("_slow"),
    )
    step = F.col("current_price") - F.col("previous_price")
    return out.withColumns(
        {
            "daily_change": step,
            "daily_change_pct": percent_of(step, "previous_price"),
            "period_return": percent_of(F.col("current_price") - F.col("_first"), "_first"),
            "trend_signal": F.when(F.col("_fast") > F.col("_slow"), "Bullish").otherwise("Bearish"),
        }
    ).drop("_first", "_fast", "_slow")


def last_change(bars, layout=None):
    """Last close against the one before, and first-to-last return, per instrument."""
    lagged = over_series(
        bars, lambda df, w: df.withColumn("_prev", F.lag("close").over(w.spec)), 1, layout=layout
    )
    out = lagged.groupBy("pair").agg(
        F.max_by("close", "date").alias("latest_close"),
        F.max_by("_prev", "date").alias("previous_close"),
        F.min_by("close", "date").alias("_first"),
    )
    step = F.col("latest_close") - F.col("previous_close")
    return out.withColumns(
        {
            "daily_change": step,
            "daily_change_pct": percent_of(step, "previous_close"),
            "period_return": percent_of(F.col("latest_close") - F.col("_first"), "_first"),
        }
    ).drop("_first")


def daily_return_stats(bars):
    """Mean daily change and the share of rising and falling days (flat days in neither)."""
    move = F.col("_move")
    out = bars.select("pair", change_percent().alias("_move")).groupBy("pair").agg(
        F.avg(move).alias("avg_daily_return"),
        F.count_if(move > 0).alias("positive_days"),
        F.count_if(move < 0).alias("negative_days"),
        F.count(move).alias("_n"),
    )
    return out.withColumns(
        {
            "positive_share": percent_of("positive_days", "_n"),
            "negative_share": percent_of("negative_days", "_n"),
        }
    ).drop("_n")


def volatility_summary(bars):
    return bars.groupBy("pair").agg(
        F.avg(spread_percent()).alias("avg_daily_range_pct"),
        F.max(spread_percent()).alias("max_daily_range_pct"),
        F.stddev_samp(change_percent()).alias("volatility"),
        F.max("high").alias("period_high"),
        F.min("low").alias("period_low"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


QUARTILES = (0.25, 0.5, 0.75)


def describe_exact(rows, columns, key="pair", exact=True):
    """Count, mean, deviation, min, quartiles and max per series and column.

    Exact quartiles of daily bars hold the distinct values of a series, which the calendar
    bounds; for anything longer they are found by counting (see ``exact_quantiles``), which reads
    ``rows`` a few times.  ``exact=False`` uses mergeable sketches and one pass.
    """
    daily = "date" in rows.columns and isinstance(rows.schema["date"].dataType, T.DateType)
    counted = exact and not daily

    def stats(c):
        found = F.percentile(c, list(QUARTILES)) if exact else F.percentile_approx(c, list(QUARTILES), 10000)
        quartiles = [] if counted else [found[i].alias(f"p{int(100 * q)}") for i, q in enumerate(QUARTILES)]
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            *quartiles,
            F.max(c).alias("max"),
        )

    wide = rows.groupBy(key).agg(F.array(*[stats(c) for c in columns]).alias("_stats"))
    out = wide.select(key, F.inline("_stats"))
    if not counted:
        return out
    found = exact_quantiles(rows, columns, QUARTILES, key)
    named = [F.max(F.when(F.col("quantile") == q, F.col("value"))).alias(f"p{int(100 * q)}") for q in QUARTILES]
    quartiles = found.groupBy(key, "column_name").agg(*named)
    joined = out.join(quartiles, [key, "column_name"], "left")
    return joined.select(key, "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


BINS = 1024
FEW = 4096


def exact_quantiles(rows, columns, quantiles=QUARTILES, key="pair", bins=BINS, few=FEW):
    """key, column_name, quantile, value: linear interpolation between neighbours, as ``percentile``.

    No series is gathered.  A wanted rank starts from the range of all values; a pass counts the
    values in ``bins`` equal parts of its range, keeps the part that holds the rank, and narrows it to
    the values that occur there.  A part of one value is the answer; one of at most ``few`` rows is
    put in order.  What is held per series, column and quantile is two ranks, and ``bins`` counts while
    they are summed, whatever the length of a series.  NULLs and NaN don't count; a series without
    values has no row.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = rows.select(key, cells).filter("v IS NOT NULL AND NOT isnan(v)")
    unit = [key, "column_name"]
    ends = long.groupBy(*unit).agg(F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = ends.withColumn("quantile", F.explode(F.array(*map(F.lit, quantiles)))).withColumn("_at", (F.col("inside") - 1) * F.col("quantile"))
    sides = asked.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at"))))).withColumn("share", 1 - F.abs(F.col("_at") - F.col("rank")))
    wanted, _ = stored(sides.drop("_at"), "wanted")
    ranks = wanted.select(*unit, "rank", "lo", "hi", "inside", F.lit(0).cast("long").alias("before")).distinct()
    found = None
    while True:
        ranks, _ = stored(ranks, "ranks")
        sure = ranks.filter("lo = hi").select(*unit, "rank", F.col("lo").alias("v"))
        short = ranks.filter((F.col("lo") < F.col("hi")) & (F.col("inside") <= few))
        within = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
        listed = long.join(short, unit).filter(within).groupBy(*unit, "rank", "before").agg(F.sort_array(F.collect_list("v")).alias("_v"))
        settled = sure.unionByName(listed.select(*unit, "rank", F.element_at("_v", (F.col("rank") - F.col("before") + 1).cast("int")).alias("v")))
        found = settled if found is None else found.unionByName(settled)
        open_ = ranks.filter((F.col("lo") < F.col("hi")) & (F.col("inside") > few))
        if open_.isEmpty():
            break
        # The ends fall in the first and the last bin; in halves where the width is beyond the largest double.
        half = F.when(F.col("hi") - F.col("lo") < float("inf"), 1.0).otherwise(0.5)
        share = (F.col("v") * half - F.col("lo") * half) / (F.col("hi") * half - F.col("lo") * half)
        place = F.floor(share * bins)
        placed = long.join(open_, unit).filter(within).withColumn("bin", F.least(place, F.lit(bins - 1)))
        counts = placed.groupBy(*unit, "rank", "before", "bin").agg(F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        along = Window.partitionBy(*unit, "rank").orderBy("bin")
        upto = F.col("before") + F.sum("inside").over(along)
        counts = counts.withColumn("_upto", upto).filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("inside")))
        ranks = counts.select(*unit, "rank", "lo", "hi", "inside", (F.col("_upto") - F.col("inside")).alias("before"))
    values = wanted.select(*unit, "rank", "quantile", "share").join(found, [*unit, "rank"])
    return values.groupBy(*unit, "quantile").agg(F.sum(F.col("v") * F.col("share")).alias("value"))


def histogram(rows, value, bins=50, key="pair"):
    """Counts in ``bins`` equal bins per series; the top edge belongs to the last bin."""
    v = F.col("_v")
    values = rows.select(key, value.alias("_v") if not isinstance(value, str) else F.col(value).alias("_v"))
    ends = values.groupBy(key).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    place = F.floor(F.try_divide(bins * (v - F.col("_lo")), width)) + 1
    placed = with_marks(values.filter(v.isNotNull()), ends, key).withColumn(
        "bin", F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int")
    )
    counted = placed.groupBy(key, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")
    )
    one = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(
        key,
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * one).alias("bin_from"),
        (F.col("_lo") + F.col("bin") * one).alias("bin_to"),
        "n",
    )


def aligned_closes(bars, pairs, layout=None):
    """Closes of the chosen instruments on the first one's dates, forward-filled."""
    chosen = bars.filter(F.col("pair").isin(*pairs)).select("pair", "date", "close")
    days = chosen.filter(F.col("pair") == pairs[0]).select("date")
    grid = days.select(F.explode(F.array(*map(F.lit, pairs))).alias("pair"), "date")
    return forward_fill(grid.join(chosen, ["pair", "date"], "left"), ["close"], layout)


def align_wide(bars, pairs, layout=None):
    """One row per date of the first instrument, one filled close column per instrument."""
    filled = aligned_closes(bars, pairs, layout)
    return filled.groupBy("date").pivot("pair", list(pairs)).agg(F.max("close"))


def returns_correlation(bars, pairs, layout=None):
    """Pearson correlation of close-to-close changes for the chosen instruments.

    In long form: per date, one list of the chosen instruments' changes gives the pairs of
    its upper triangle, which are summed per pair of instruments with a map-side half; the
    lower triangle is its mirror.  The plan is the same for any number of instruments.  A
    series without variance gives NULL.
    """
    moved = over_series(
        aligned_closes(bars, pairs, layout),
        lambda df, w: df.withColumn(
            "_r", F.try_divide(F.col("close"), F.lag("close").over(w.spec)) - 1
        ),
        back=1,
        layout=layout,
    )
    place = F.array_position(F.array(*map(F.lit, pairs)), F.col("pair"))
    listed = moved.filter("_r IS NOT NULL").groupBy("date").agg(
        F.array_sort(F.collect_list(F.struct(place.alias("i"), F.col("pair").alias("p"), F.col("_r").alias("r")))).alias("_m")
    )
    upper = listed.select(F.explode("_m").alias("a"), "_m").select("a", F.explode("_m").alias("b")).filter("a.i <= b.i")
    both = upper.groupBy(F.col("a.p").alias("pair_a"), F.col("b.p").alias("pair_b")).agg(
        F.try_divide(
            F.covar_pop("a.r", "b.r"), F.stddev_pop("a.r") * F.stddev_pop("b.r")
        ).alias("corr")
    )
    mirror = both.filter("pair_a <> pair_b").select(F.col("pair_b").alias("pair_a"), F.col("pair_a").alias("pair_b"), "corr")
    return both.unionByName(mirror)


def confusion_matrix(scored, label="label", prediction="prediction"):
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def classification_report(scored, label="label", prediction="prediction"):
    """Precision, recall, F1 and support per class, and the overall accuracy.

    Works on the confusion matrix, which has one row per pair of classes.
    """
    cells = confusion_matrix(scored, label, prediction)
    n, hit = F.col("n"), F.col(label) == F.col(prediction)
    hits = F.when(hit, n).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col(label).alias("class"), n.alias("s"), zero.alias("p"), hits.alias("h")),
                F.struct(F.col(prediction).alias("class"), zero.alias("s"), n.alias("p"), zero.alias("h")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(
        F.sum("s").alias("support"), F.sum("p").alias("_p"), F.sum("h").alias("_h")
    )
    precision, recall = F.try_divide("_h", "_p"), F.try_divide("_h", "support")
    whole = Window.partitionBy()
    return per_class.select(
        "class",
        F.coalesce(precision, F.lit(0.0)).alias("precision"),
        F.coalesce(recall, F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
        "support",
        F.try_divide(F.sum("_h").over(whole), F.sum("support").over(whole)).alias("accuracy"),
    )
