"""Runs that continue from a state against one run over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.layout import Layout
from tickloom.operators import averages, oscillators, resume
from tickloom.session import stored

from tests.test_indicators import close_to, walk, wilder

NAMES = ("n", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram", "rsi", "avg_gain", "avg_loss")
LAYOUTS = [None, Layout(block_rows=32, split=True)]


def column(df, pair, name):
    return [r[name] for r in sorted(df.filter(F.col("pair") == pair).collect(), key=lambda r: r.date)]


def day(i):
    return F.lit(dt.date(2020, 1, 1) + dt.timedelta(days=i))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_one_run_equals_the_single_operators(make_bars, layout):
    x = walk(300)
    bars = make_bars(A=x)
    out = resume.recursive_indicators(bars, layout=layout)
    out, _ = stored(out, "out")
    macd = oscillators.macd(bars)
    for name in ("ema_12", "ema_26", "macd", "macd_signal", "macd_histogram"):
        close_to(column(out, "A", name), column(macd, "A", name))
    close_to(column(out, "A", "rsi"), wilder(x))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_steps_equal_one_run(make_bars, layout):
    """Uneven steps, a step without rows for one series, a series that begins late."""
    bars = make_bars(A=walk(200, 1), B=walk(90, 2)).unionByName(make_bars(start=dt.date(2020, 4, 1), C=walk(60, 3)))
    bars, _ = stored(bars, "bars")
    whole, _ = stored(resume.recursive_indicators(bars), "whole")
    state, parts = None, []
    for cut in (1, 40, 130, 10_000):
        fresh = bars.filter(F.col("date") < day(cut))
        fresh = fresh if state is None else resume.newer_bars(fresh, state)
        rows, _ = stored(resume.recursive_indicators(fresh, state, layout), "rows")
        state, _ = stored(resume.state_after(rows, state), "state")
        parts.append(rows)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    assert found.count() == whole.count() == 350
    both = [{p: sorted((r for r in df.collect() if r.pair == p), key=lambda r: r.date) for p in "ABC"} for df in (found, whole)]
    for pair in "ABC":
        for name in NAMES:
            close_to(*([r[name] for r in rows[pair]] for rows in both))
    last = {r.pair: r for r in state.collect()}
    assert {p: r.n for p, r in last.items()} == {"A": 200, "B": 90, "C": 60}
    close_to([last["B"].ema_26], [both[1]["B"][-1].ema_26])


def test_a_run_without_new_bars_keeps_the_state(make_bars):
    bars = make_bars(A=walk(50))
    state, _ = stored(resume.state_after(resume.recursive_indicators(bars)), "state")
    assert resume.newer_bars(bars, state).count() == 0
    rows, _ = stored(resume.recursive_indicators(resume.newer_bars(bars, state), state), "rows")
    assert rows.count() == 0
    assert resume.state_after(rows, state).collect() == state.collect()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_values_of_the_row_before(make_bars, layout):
    from tickloom.layout import over_series

    x = walk(120, 4)

    def then(df, w):
        return oscillators.add_macd_recursive(df, w, lagged=("ema_12", "macd_signal"))

    out = over_series(make_bars(A=x), layout=layout, pos=True, then=then)
    out, _ = stored(out, "out")
    for name in ("ema_12", "macd_signal"):
        close_to(column(out, "A", f"_prev_{name}")[1:], column(out, "A", name)[:-1])
        assert column(out, "A", f"_prev_{name}")[0] is None


@pytest.mark.parametrize("layout", LAYOUTS)
def test_means_of_means_with_equal_and_full_weights(make_bars, layout):
    """A signal as slow as one of its means, and a mean that is its column."""
    import pandas as pd
    from tickloom.layout import over_series

    x = walk(150, 5)

    def then(df, w):
        means = {"a": ("close", 0.2), "b": ("close", 0.05), "c": ("close", 1.0)}
        return averages.add_recursive(df, w, means, {"s": ({"a": 1.0, "b": -2.0, "c": 0.5}, 0.2)})

    out = over_series(make_bars(A=x), layout=layout, pos=True, then=then)
    s = pd.Series(x)
    line = s.ewm(alpha=0.2, adjust=False).mean() - 2 * s.ewm(alpha=0.05, adjust=False).mean() + 0.5 * s
    close_to(column(out, "A", "s"), list(line.ewm(alpha=0.2, adjust=False).mean()))


def test_blocks_are_read_once(make_bars, spark, tmp_path):
    """The rows of a series in blocks come from one stored table; the bars are not read again for the ends."""
    make_bars(A=walk(200)).write.parquet(f"file://{tmp_path}/bars")
    bars = spark.read.parquet(f"file://{tmp_path}/bars")
    out = oscillators.macd(bars, layout=Layout(block_rows=32, split=True))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path) not in plan
    files = out.inputFiles()
    assert all("tickloom-blocks" in f for f in files)
