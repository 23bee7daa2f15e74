"""Moving averages: partial, strict, one-step and recursive.

Four different things are called a moving average here; each has its own name:

* ``rolling_mean``      mean of the rows there are (partial frames allowed)
* ``strict``            NULL until the frame is full
* ``one_step_ema``      close * k + previous partial mean * (1 - k); not recursive
* ``recursive_means``   y = (1 - a) * y_previous + a * x, y_first = x_first
"""

import math

from pyspark.sql import Window, functions as F

from tickloom.functions.prices import as_col
from tickloom.layout import over_series
from tickloom.operators import ladder
from tickloom.operators.ladder import add_frames
from tickloom.session import stored


def last_rows(w, n):
    return w.rows(1 - n, 0)


def rolling_mean(c, w, n):
    return F.avg(as_col(c)).over(last_rows(w, n))


def strict(aggregate, c, w, n):
    """``aggregate`` over the last n rows, NULL while fewer than n values exist."""
    frame = last_rows(w, n)
    full = F.count(as_col(c)).over(frame) == n
    return F.when(full, aggregate(as_col(c)).over(frame))


def add_means(df, w, means, full=False):
    """Add means over the last n rows: name -> (column, n).

    With ``full`` a mean is NULL until its frame holds n values.
    """
    return add_frames(df, w, {k: ladder.mean(c, n, full) for k, (c, n) in means.items()})


def moving_averages(bars, sizes=(7, 30, 90), layout=None):
    return over_series(
        bars,
        lambda df, w: add_means(df, w, {f"ma_{n}_day": ("close", n) for n in sizes}),
        back=max(sizes),
        layout=layout,
    )


def sma_strict(bars, sizes=(20, 50, 200), layout=None):
    return over_series(
        bars,
        lambda df, w: add_means(df, w, {f"sma_{n}": ("close", n) for n in sizes}, full=True),
        back=max(sizes),
        layout=layout,
    )


def one_step_frames(sizes, c="close"):
    return {f"_sma_{n}": ladder.mean(c, n) for n in sizes}


def with_one_step_emas(df, w, sizes, c="close"):
    """ema_n columns from the partial mean of the row before; first row NULL."""

    def ema(n):
        k = 2.0 / (n + 1)
        return as_col(c) * k + F.lag(f"_sma_{n}").over(w.spec) * (1 - k)

    return df.withColumns({f"ema_{n}": ema(n) for n in sizes}).drop(*[f"_sma_{n}" for n in sizes])


def add_one_step_emas(df, w, sizes, c="close"):
    return with_one_step_emas(add_frames(df, w, one_step_frames(sizes, c)), w, sizes, c)


def technical_ema(bars, sizes=(9, 22, 50), layout=None):
    return over_series(
        bars,
        lambda df, w: add_one_step_emas(df, w, sizes),
        back=max(sizes) + 1,
        layout=layout,
    )


# --- recursive means -------------------------------------------------------
#
# y_i = a * x_i + (1 - a) * y_(i-1) is summed in chunks: inside a chunk, a running sum of
# x_j / b^j (b = 1 - a) that restarts before the powers leave double range; then the ends of
# the chunks before are handed on.  One chunk spans some e^-500, so a few ends reach below
# the smallest double, and nothing a recursion row by row would still hold is lost.
#
# A series in blocks is worked out in its blocks as if nothing came before, and stored.  What
# comes before adds b^(i+1) * (the end of the block before), so only the ends, one row per
# block, are summed again over the series, and joined back.  The same goes for what an
# earlier run left behind (``state``), and for a mean of other means: both are linear.

_SAFE = 500.0  # powers stay below e^500
_RANGE = 745.0  # e^-745 is zero in double precision
_ALIKE = 10.0  # rates that far apart still share their chunks, and so their sort


def alpha_of_span(n):
    return 2.0 / (n + 1)


def _rate(b):
    return -math.log(b)


def _alike(rates):
    """Names whose rates are alike, as lists; fastest first."""
    groups = []
    for name in sorted(rates, key=lambda n: -rates[n]):
        if groups and rates[groups[-1][0]] <= _ALIKE * rates[name]:
            groups[-1].append(name)
        else:
            groups.append([name])
    return groups


def linear_recurrence(df, by, order, place, terms, size=None):
    """Add y_i = term_i + b * y_(i-1), y before the first row 0: name -> (term, b, -ln b).

    ``place`` numbers the rows of a partition ``by`` without gaps, in the order of ``order``.
    Three window nodes for names of alike rates: the chunk so far, the end of the chunk
    before, and the ends of the chunks before that.  ``size`` sets the length of chunks.
    """
    for names in _alike({n: rate for n, (_, _, rate) in terms.items()}):
        members = {n: terms[n] for n in names}
        rows = size or max(1, int(_SAFE / members[names[0]][2]))
        df = df.withColumns({"_chunk": F.floor(F.col(place) / rows), "_j": F.pmod(F.col(place), F.lit(rows))})
        inside = Window.partitionBy(*by, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        along = Window.partitionBy(*by).orderBy("_chunk", order)
        ended = F.col("_j") == rows - 1
        df = df.withColumns(
            {n: F.sum(term * F.pow(F.lit(b), -F.col("_j"))).over(inside) * F.pow(F.lit(b), F.col("_j")) for n, (term, b, _) in members.items()}
        )
        so_far = along.rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumns({f"_end_{n}": F.coalesce(F.last(F.when(ended, F.col(n)), ignorenulls=True).over(so_far), F.lit(0.0)) for n in members})
        handed = {}
        for n, (_, b, rate) in members.items():
            handed[n] = F.col(f"_end_{n}")
            for back in range(1, int(_RANGE / (rate * rows)) + 1):
                handed[n] += b ** (rows * back) * F.lag(f"_end_{n}", rows * back, 0.0).over(along)
        df = df.withColumns({n: F.col(n) + handed[n] * F.pow(F.lit(b), F.col("_j") + 1) for n, (_, b, _) in members.items()})
        df = df.drop("_chunk", "_j", *[f"_end_{n}" for n in members])
    return df


def add_recursive(df, w, means, of=None, lagged=()):
    """Add recursive means: name -> (column, alpha), and means of these: ``of`` name -> ({mean: weight}, alpha).

    Belongs in the ``then`` step of ``over_series`` (with ``pos``): rows of a block without
    copies.  Inputs must not be NULL (forward-fill first).  For names in ``lagged`` the value
    of the row before is added as ``_prev_<name>``.  Columns ``_start`` (rows of the series before
    these) and ``_in_<name>`` (the value it had there), from ``state``, continue an earlier run.
    """
    of = of or {}
    copies = {n: as_col(c) for n, (c, a) in means.items() if a >= 1}
    df = df.withColumns(copies) if copies else df
    own = {n: m for n, m in means.items() if n not in copies}
    if not own and not of:
        return df
    first_run = "_start" not in df.columns
    df = df.withColumn("_start", F.lit(0).cast("long") if first_run else F.coalesce("_start", F.lit(0)))
    df = (_in_blocks if w.block else _whole)(df, w, own, of, lagged)
    return df.drop("_start") if first_run else df


def _weight(a):
    """A series' first value counts whole."""
    return F.when(F.col("_pos") + F.col("_start") == 0, 1.0).otherwise(a)


def _sum_of(weights):
    return sum((weight * F.col(n) for n, weight in weights.items()), F.lit(0.0))


def _before(df, name):
    """What an earlier run handed on, 0 where there was none."""
    return F.coalesce(F.col(f"_in_{name}"), F.lit(0.0)) if f"_in_{name}" in df.columns else F.lit(0.0)


def _in_line(df, w, place, means, of):
    """Recursive means along a window as if nothing came before, and what the means of these need."""
    rates = {n: _rate(1 - a) for n, (_, a) in (*means.items(), *of.items())}
    size = int(_SAFE / max(rates.values())) if len(_alike(rates)) == 1 else None
    df = linear_recurrence(df, w.by, w.order, place, {n: (as_col(c) * _weight(a), 1 - a, rates[n]) for n, (c, a) in means.items()}, size)
    return df, {n: (weights, a, 1 - a, rates[n], size) for n, (weights, a) in of.items()}


def _whole(df, w, means, of, lagged):
    df, nested = _in_line(df, w, "_pos", means, of)
    carried = [n for n in (*means, *of) if f"_in_{n}" in df.columns]
    power = lambda a: F.pow(F.lit(1 - a), F.col("_pos") + 1)
    known = [n for n in means if n in carried]
    df = df.withColumns({n: F.col(n) + _before(df, n) * power(means[n][1]) for n in known}) if known else df
    for n, (weights, a, b, rate, size) in nested.items():
        df = linear_recurrence(df, w.by, w.order, "_pos", {n: (_sum_of(weights) * _weight(a), b, rate)}, size)
        if n in carried:
            df = df.withColumn(n, F.col(n) + _before(df, n) * power(a))
    if lagged:
        first = {n: F.col(f"_in_{n}") if n in carried else F.lit(None).cast("double") for n in lagged}
        df = df.withColumns({f"_prev_{n}": F.coalesce(F.lag(n).over(w.spec), first[n]) for n in lagged})
    return df


def _in_blocks(df, w, means, of, lagged):
    df = df.withColumn("_at", F.col("_pos") - F.col("_blk") * w.block)
    df, nested = _in_line(df, w, "_at", means, of)
    for n, (weights, a, b, rate, size) in nested.items():
        df = linear_recurrence(df, w.by, w.order, "_at", {n: (_sum_of(weights) * _weight(a), b, rate)}, size)
    names = (*means, *of)
    if lagged:
        df = df.withColumns({f"_prev_{n}": F.coalesce(F.lag(n).over(w.spec), F.lit(0.0)) for n in lagged})
    rows, _ = stored(df, "blocks")
    states = [c for c in rows.columns if c.startswith("_in_")]
    ends = rows.groupBy(*w.by).agg(
        *[F.max_by(n, "_at").alias(f"_last_{n}") for n in names],
        *[F.first(c).alias(c) for c in states],
    )
    series = [k for k in w.by if k != "_blk"]
    along = Window.partitionBy(*series).orderBy("_blk")

    def over_blocks(ends, found):
        """The values handed to each block, from the ends of those before: name -> (end, b)."""
        terms = {f"_y_{n}": (end, b**w.block, _rate(b) * w.block) for n, (end, b) in found.items()}
        ends = linear_recurrence(ends, series, "_blk", "_blk", terms)
        first = {n: _before(ends, n) for n in found}
        ends = ends.withColumns({f"_y_{n}": F.col(f"_y_{n}") + first[n] * F.pow(F.lit(b**w.block), F.col("_blk") + 1) for n, (_, b) in found.items()})
        return ends.withColumns({f"_from_{n}": F.coalesce(F.lag(f"_y_{n}").over(along), first[n]) for n in found})

    ends = over_blocks(ends, {n: (F.col(f"_last_{n}"), 1 - a) for n, (_, a) in means.items()})
    for n, (weights, a, b, _, _) in nested.items():
        passed = _passed_on(weights, means, a, F.lit(w.block))
        ends = over_blocks(ends, {n: (F.col(f"_last_{n}") + passed, b)})
    rows = rows.join(ends.select(*w.by, *[f"_from_{n}" for n in names]), list(w.by))

    def full(n, column, so_far):
        if n in means:
            return F.col(column) + F.col(f"_from_{n}") * F.pow(F.lit(1 - means[n][1]), so_far)
        weights, a, b, _, _ = nested[n]
        return F.col(column) + F.col(f"_from_{n}") * F.pow(F.lit(b), so_far) + _passed_on(weights, means, a, so_far)

    known = {n: full(n, n, F.col("_at") + 1) for n in names}
    begins = F.col("_pos") + F.col("_start") == 0
    known |= {f"_prev_{n}": F.when(~begins, full(n, f"_prev_{n}", F.col("_at"))) for n in lagged}
    return rows.withColumns(known).drop("_at", *[f"_from_{n}" for n in names])


def _passed_on(weights, means, a, rows):
    """What the ends handed to ``rows`` rows of the means add to a recursive mean (weight a) of their weighted sum."""
    d, total = 1 - a, F.lit(0.0)
    for n, weight in weights.items():
        if n in means:
            b = 1 - means[n][1]
            reach = rows * F.pow(F.lit(b), rows) if b == d else b * (F.pow(F.lit(b), rows) - F.pow(F.lit(d), rows)) / (b - d)
            total += a * weight * F.col(f"_from_{n}") * reach
    return total


def ema(bars, spans=(12, 26), c="close", warm_up=False, layout=None):
    """Recursive EMAs; with ``warm_up`` the first span - 1 rows are NULL."""

    def then(df, w):
        df = add_recursive(df, w, {f"ema_{n}": (c, alpha_of_span(n)) for n in spans})
        return warm(df, spans) if warm_up else df

    return over_series(bars, then=then, layout=layout, pos=True)


def warm(df, spans):
    """NULL for a span's first rows of a series."""
    place = F.col("_pos") + (F.col("_start") if "_start" in df.columns else 0)
    return df.withColumns({f"ema_{n}": F.when(place >= n - 1, F.col(f"ema_{n}")) for n in spans})
