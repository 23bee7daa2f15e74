"""Swing levels and their thinning."""

from dataclasses import replace

from pyspark.sql import Window, functions as F, types as T

from tickloom.layout import Layout, over_prefix, over_series
from tickloom.operators import ladder
from tickloom.operators.ladder import Frame, add_frames

SIDES = {"support": ("low", F.min), "resistance": ("high", F.max)}


def swing_points(bars, n=10, layout=None):
    """Rows whose low (high) is the lowest (highest) within n full rows on both sides.

    Every row of a plateau counts.
    """

    def build(df, w):
        kinds = {"support": ladder.LOW, "resistance": ladder.HIGH}
        df = df.withColumns({"_back": F.lag(F.lit(1), n).over(w.spec), "_on": F.lead(F.lit(1), n).over(w.spec)})
        df = add_frames(df, w, {f"_{s}": Frame(kinds[s], c, 2 * n + 1, ahead=n) for s, (c, _) in SIDES.items()})
        whole = F.col("_back").isNotNull() & F.col("_on").isNotNull()
        found = {f"is_{s}": whole & (F.col(c) == F.col(f"_{s}")) for s, (c, _) in SIDES.items()}
        return df.withColumns(found).drop("_back", "_on", *[f"_{s}" for s in SIDES])

    return over_series(bars, build, back=n, ahead=n, layout=layout)


def swing_levels(points):
    """Long form: one row per swing point and side."""
    found = [
        F.when(F.col(f"is_{s}"), F.struct(F.lit(s).alias("side"), F.col(c).alias("level")))
        for s, (c, _) in SIDES.items()
    ]
    return points.select("pair", "date", F.inline(F.array_compact(F.array(*found))))


def thin_levels(levels, threshold=0.01, key="pair", layout=None):
    """Keep a level if it differs from the last kept one by more than ``threshold``.

    Each decision depends on the one before, so levels are folded in order, but not a
    whole series at a time.  After any level q the last kept one lies between
    q / (1 + threshold) and q / (1 - threshold).  A level far enough from that whole
    range is kept whatever came before, so a new fold can start there, and the folds
    between such levels are independent.  Repeats of the level just before are dropped
    first, as the last kept level already lies within the threshold of them.
    """
    layout = layout or Layout()
    series = replace(layout, key="_series")
    sided = levels.withColumn("_series", F.concat_ws("\x1f", key, "side"))
    seen = over_series(
        sided, lambda df, w: df.withColumn("_prev", F.lag("level").over(w.spec)), 1, layout=series
    )
    prev, level = F.col("_prev"), F.col("level")
    fresh = seen.filter(prev.isNull() | (prev != level))
    starts = fresh.withColumn("_start", (prev.isNull() | _surely_kept(level, prev, threshold)).cast("long"))
    folds = _running_sum(starts, "_start", "_fold", series).select(key, "side", "_fold", "date", "level")
    # Rows of a fold stream through one task in order; only the last kept level is held.
    ordered = folds.repartition(key, "side", "_fold").sortWithinPartitions(key, "side", "_fold", "date", "level")
    schema = T.StructType([f for f in folds.schema.fields if f.name != "_fold"])
    return ordered.mapInArrow(_keep_far(key, threshold), schema)


def _keep_far(key, threshold):
    """Pass the rows that differ enough from the last kept one of their fold; rows come sorted."""

    def keep(batches):
        import pyarrow as pa

        fold, last = None, None
        for batch in batches:
            names = (batch.column(c).to_pylist() for c in (key, "side", "_fold"))
            chosen = []
            for name, level in zip(zip(*names), batch.column("level").to_pylist()):
                if name != fold:
                    fold, last = name, None
                far = last is None or (last != 0 and abs((level - last) / last) > threshold)
                chosen.append(far)
                last = level if far else last
            yield batch.drop_columns(["_fold"]).filter(pa.array(chosen, pa.bool_()))

    return keep


def _surely_kept(level, prev, threshold):
    if threshold >= 1:
        return F.lit(False)
    ratio = (1 + threshold) / (1 - threshold) * (1 + 1e-9)  # clear of rounding
    return (prev > 0) & ((level > prev * ratio) | (level < prev / ratio))


def _running_sum(rows, c, out, layout):
    def build(df, w):
        here = F.sum(c).over(w.rows(Window.unboundedPreceding, 0))
        return df.withColumn(out, here + F.coalesce(F.col("_before").cast("long"), F.lit(0)))

    return over_prefix(
        rows, build, {"_sum": F.sum(c)}, {"_before": lambda w: F.sum("_sum").over(w)}, layout
    )


def support_resistance_levels(bars, n=10, threshold=0.01, layout=None):
    return thin_levels(swing_levels(swing_points(bars, n, layout)), threshold, layout=layout)
