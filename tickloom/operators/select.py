"""Slices, trailing windows, newest rows and top-k per series."""

from pyspark.sql import Column, Window, functions as F


def latest_date(rows, order="date"):
    """The newest date as a scalar subquery: planned with the query, never collected."""
    return rows.agg(F.max(order)).scalar()


def as_of_column(rows, as_of=None, order="date"):
    """``as_of`` as a column; None means the newest date of ``rows``."""
    if as_of is None:
        return latest_date(rows, order)
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def trailing(rows, days, as_of=None, order="date"):
    """Rows of the last ``days`` days up to and after ``as_of - days``."""
    return rows.filter(F.col(order) >= F.date_sub(as_of_column(rows, as_of, order), days))


def between(rows, start, end, pair=None, order="date"):
    """Inclusive date range, optionally of one instrument; both reach the scan."""
    kept = rows.filter(F.col(order).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept if pair is None else kept.filter(F.col("pair") == pair)


def default_range(rows, days=180, order="date"):
    """Rows from max(first date, last date - days) on."""
    ends = rows.agg(F.greatest(F.min(order), F.date_sub(F.max(order), days))).scalar()
    return rows.filter(F.col(order) >= ends)


def last_n(rows, n, key="pair", order="date"):
    """Newest n rows per series.  The row_number filter is applied map-side as well
    (window group limit), so at most n rows per series and task are shuffled."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_pair(rows, key="pair", order="date"):
    return last_n(rows, 1, key, order)


def newest(rows, n, order="date", key="pair"):
    return rows.orderBy(F.col(order).desc(), F.col(key)).limit(n)


def with_marks(rows, marks, key, how="inner"):
    """Join rows to one row of ``marks`` per key, where one key may hold most rows.

    Spark can't split a join side whose other side is an aggregate of the same key.  So the
    marks are repeated per salt and joined by key and salt: a hot key's rows meet in half as many
    tasks as a shuffle has partitions, and the planner may still broadcast marks that are small.
    """
    count = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)
    salts = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(count)).cast("int"))
    return salted.join(marks.select("*", salts), [key, "_salt"], how).drop("_salt")


def slice_or_tail(rows, start, end, min_rows=5, tail=30, key="pair", order="date"):
    """Rows in the range, or a series' newest ``tail`` rows if the range holds too few.

    The counts are one aggregated row per series; the tail is group-limited before
    its shuffle, so no series is gathered whole.
    """
    inside = F.col(order).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    counts = rows.groupBy(key).agg(F.count_if(inside).alias("_inside"))
    marked = with_marks(rows, counts, key)
    enough = F.col("_inside") >= min_rows
    short = last_n(marked.filter(~enough), tail, key, order)
    return marked.filter(inside & enough).unionByName(short).select(*rows.columns)


def select_pairs(rows, pairs):
    return rows.filter(F.col("pair").isin(*pairs))


def order_for_output(rows):
    """Newest date first, instruments by name."""
    return rows.orderBy(F.col("date").desc(), F.col("pair"))
