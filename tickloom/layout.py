"""How the rows of one instrument are spread over tasks.

Every indicator looks at neighbours in time, so rows of an instrument must meet
in order.  Two layouts make that safe:

* A *daily* series (order column of type DATE, one bar per day) is bounded by the
  calendar: a century is 36,525 rows, however large the table.  Its window partition
  is the instrument, which costs one shuffle.
* An *intraday* series (order column of type TIMESTAMP, one bar per ``step``
  seconds) has no such bound, and one busy instrument may hold a third of all
  rows.  It is cut into blocks of ``block_rows`` consecutive bars.  Each block also
  receives copies of the few neighbours its frames reach, is windowed on its own,
  and drops the copies again.  Results equal the uncut series.

Operators only see a DataFrame and a :class:`SeriesWindow`; they do not know the layout.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Window, functions as F, types as T

BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class SeriesWindow:
    """The window of one series (or of one block of it) in time order.

    ``block`` is the number of own rows of a block; None where a series is whole.
    """

    by: tuple
    order: str
    block: int | None = None

    @property
    def spec(self):
        return Window.partitionBy(*self.by).orderBy(self.order)

    def rows(self, first, last):
        return self.spec.rowsBetween(first, last)


@dataclass(frozen=True)
class Layout:
    key: str = "pair"
    order: str = "date"
    step: int | None = None  # seconds between bars; None: one bar per day
    block_rows: int = BLOCK_ROWS
    split: bool = False

    def window(self, *extra):
        """The window of a whole series (daily layout) or of a block of it."""
        return SeriesWindow((self.key, *extra), self.order)


def layout_of(bars, key="pair", order="date", step=None, block_rows=BLOCK_ROWS, split=None):
    """Choose the layout from the type of the order column; ``split`` overrides it for daily bars."""
    daily = isinstance(bars.schema[order].dataType, T.DateType)
    if not daily and not step:
        raise ValueError("an intraday series needs step=, the seconds between its bars")
    return Layout(key, order, None if daily else step, block_rows, not daily if split is None else split)


def _slot(layout):
    """Number of the bar slot a row falls in; at most one row per slot and series."""
    if layout.step is None:
        return F.unix_date(layout.order)
    return F.floor(F.unix_seconds(F.col(layout.order).cast("timestamp")) / layout.step)


def tag_time_block(bars, layout):
    """Add ``_tblk``: the stretch of ``block_rows`` time slots a row belongs to."""
    return bars.withColumn("_tblk", F.floor(_slot(layout) / layout.block_rows).cast("long"))


def carried(per_block, layout, **carry):
    """Fold block summaries of a series into what earlier blocks hand to each block.

    ``per_block`` has one row per (series, time block), already aggregated, so a
    series contributes at most (time span / block span) rows here.
    """
    w = Window.partitionBy(layout.key).orderBy("_tblk").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(layout.key, "_tblk", *[c(w).alias(n) for n, c in carry.items()])


def numbered(bars, layout, total=None, state=None):
    """Add ``_pos``, the 0-based place of a row in its series; with ``total``, the length.

    The columns of ``state`` (at most one row per series) are added to the rows of a series; they
    are NULL where it has none.
    """
    if not layout.split:
        if state is not None:
            bars = bars.join(state, layout.key, "left")
        out = bars.withColumn("_pos", (F.row_number().over(layout.window().spec) - 1).cast("long"))
        if total:
            out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(layout.key)))
        return out
    tagged = tag_time_block(bars, layout)
    sizes = tagged.groupBy(layout.key, "_tblk").agg(F.count(F.lit(1)).alias("_n"))
    offsets = carried(sizes, layout, _before=lambda w: F.coalesce(F.sum("_n").over(w), F.lit(0)))
    if total:
        lengths = sizes.groupBy(layout.key).agg(F.sum("_n").alias(total))
        offsets = offsets.join(lengths, layout.key)
    if state is not None:
        offsets = offsets.join(state, layout.key, "left")
    return (
        tagged.withColumn("_rn", F.row_number().over(layout.window("_tblk").spec))
        .join(offsets, [layout.key, "_tblk"])
        .withColumn("_pos", F.col("_before") + F.col("_rn") - 1)
        .drop("_tblk", "_rn", "_before")
    )


def over_series(bars, build=None, back=0, ahead=0, layout=None, pos=False, total=None, then=None, state=None):
    """Run ``build(rows, w)`` where every frame reaching ``back`` rows behind and
    ``ahead`` rows in front of a row is complete.

    ``back`` adds up over stacked windows: a lag of a 50-row mean reaches 50 rows.
    With ``pos`` the rows carry ``_pos`` (see :func:`numbered`) while building, with ``state``
    also its columns.  ``then(rows, w)`` runs last, on a series' (or block's) own rows only: for
    what is handed on along a series instead of being read from neighbours.
    """
    layout = layout or layout_of(bars)
    build = build or (lambda df, w: df)
    then = then or (lambda df, w: df)
    extra = ["_pos", *([] if state is None else [c for c in state.columns if c != layout.key])]
    if not layout.split:
        rows = numbered(bars, layout, total, state) if pos or total or state is not None else bars
        w = layout.window()
        return then(build(rows, w), w).drop(*extra)
    size = max(layout.block_rows, back, ahead)
    rows = numbered(bars, layout, total, state)
    block, off = F.floor(F.col("_pos") / size), F.col("_pos") % size

    def copy(number, own):
        return F.struct(number.cast("long").alias("_blk"), F.lit(own).alias("_own"))

    homes = [copy(block, True)]
    if back:
        homes.append(F.when(off >= size - back, copy(block + 1, False)))
    if ahead:
        homes.append(F.when((off < ahead) & (block > 0), copy(block - 1, False)))
    spread = rows.select("*", F.inline(F.array_compact(F.array(*homes))))
    # One exchange by block serves all windows below, also those by block and chunk.
    spread = spread.repartition(layout.key, "_blk")
    window = replace(layout.window("_blk"), block=size)
    return then(build(spread, window).filter("_own").drop("_own"), window).drop("_blk", *extra)


def over_prefix(bars, build, summaries, carry, layout=None):
    """Run ``build(rows, w)`` for frames that reach back to the start of a series.

    In the split layout ``summaries`` (name -> aggregate) describe one time block,
    ``carry`` (name -> function of a window) folds the blocks before a row's own
    one, and ``build`` finds the folded values as columns.  In the daily layout
    there is nothing before the only block, so those columns are NULL.
    """
    layout = layout or layout_of(bars)
    if not layout.split:
        rows = bars.withColumns({n: F.lit(None).cast("double") for n in carry})
        return build(rows, layout.window()).drop(*carry)
    tagged = tag_time_block(bars, layout)
    per_block = tagged.groupBy(layout.key, "_tblk").agg(
        *[a.alias(n) for n, a in summaries.items()]
    )
    before = carried(per_block, layout, **carry)
    joined = tagged.join(before, [layout.key, "_tblk"])
    return build(joined, layout.window("_tblk")).drop("_tblk", *carry)


def with_block_rows(layout, rows):
    """The same layout with another block length (tests force many blocks)."""
    return replace(layout, block_rows=rows, split=True)
