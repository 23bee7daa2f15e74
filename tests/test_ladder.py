"""Frames of any length against pandas, whole and in blocks."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tickloom.layout import Layout, over_series
from tickloom.operators import bands, ladder, swings
from tickloom.operators.ladder import Frame, add_frames

SPLIT = Layout(block_rows=64, split=True)


def series(n, seed=3, missing=0.0):
    r = random.Random(seed)
    return [None if r.random() < missing else r.choice((1e6 + r.random(), r.gauss(0, 1), 7.0)) for _ in range(n)]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        missing = w is None or math.isnan(w)
        assert (g is None) if missing else g == pytest.approx(w, rel=1e-9, abs=1e-6)


def pandas_frame(x, f):
    s = pd.Series(x, dtype=float)
    if f.ahead:
        s = pd.Series([*s, *[float("nan")] * f.ahead])
    if f.forward:
        s = s[::-1]
    rolled = s.rolling(f.n, min_periods=f.n if f.full else 1)
    out = {
        ladder.MEAN: rolled.mean, ladder.LOW: rolled.min, ladder.HIGH: rolled.max,
        ladder.STD: lambda: rolled.apply(lambda v: v.std(ddof=1)), ladder.STD_POP: lambda: rolled.apply(lambda v: v.std(ddof=0)),
    }[f.kind]()
    if f.forward:
        out = out[::-1]
    return list(out)[f.ahead :]


@pytest.mark.parametrize("layout", [None, SPLIT])
@pytest.mark.parametrize("sizes", [(1, 7, 8), (9, 65), (20, 130)])
def test_frames_equal_pandas(make_bars, layout, sizes):
    x = series(300, missing=0.1)
    frames = {}
    for n in sizes:
        for kind in (ladder.MEAN, ladder.LOW, ladder.HIGH):
            frames[f"{kind}_{n}"] = Frame(kind, "close", n)
            frames[f"{kind}_{n}_full"] = Frame(kind, "close", n, True)
            frames[f"{kind}_{n}_on"] = Frame(kind, "close", n, forward=True)
        if n > 1:
            frames[f"std_{n}"] = ladder.std("close", n)
            frames[f"pop_{n}"] = ladder.std("close", n, True)
    bars = make_bars(A=x, B=x[:3])
    out = over_series(bars, lambda df, w: add_frames(df, w, frames), back=130, ahead=130, layout=layout)
    for pair, y in (("A", x), ("B", x[:3])):
        got = out.filter(F.col("pair") == pair).toPandas().sort_values("date")
        for name, f in frames.items():
            same([None if pd.isna(v) else v for v in got[name]], pandas_frame(y, f))


def test_a_frame_moved_ahead(make_bars):
    x = series(60)
    f = Frame(ladder.LOW, "close", 21, ahead=10)
    got = values(over_series(make_bars(A=x), lambda df, w: add_frames(df, w, {"m": f}), 10, 10), "m")
    assert got[10:50] == [min(x[i - 10 : i + 11]) for i in range(10, 50)]


def test_deviation_after_a_spike_is_exact(make_bars):
    x = [5.0] * 100 + [1e17] + [5.0, 6.0] * 300
    got = values(over_series(make_bars(A=x), lambda df, w: add_frames(df, w, {"s": ladder.std("close", 500), "t": ladder.std("close", 20)}), 500), "s")
    want = pd.Series([5.0, 6.0] * 250).std()
    assert got[-1] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("layout", [None, SPLIT])
@pytest.mark.parametrize("n", [1, 4, 10, 40])
def test_bands_and_swings_on_both_sides(make_bars, layout, n):
    r = random.Random(n)
    x = [float(r.randrange(12)) for _ in range(150)]
    bars = make_bars(A=x, B=x[: n + 1])
    found = swings.swing_points(bars, n, layout)
    assert values(found, "is_support", pair="A") == [n <= i < 150 - n and v == min(x[max(0, i - n) : i + n + 1]) for i, v in enumerate(x)]
    assert set(values(found, "is_resistance", pair="B")) == {False}
    band = bands.price_band(bars, n, layout)
    assert values(band, "support_level", pair="A") == [min(x[max(0, i - n) : i + n + 1]) for i in range(150)]
    assert values(band, "resistance_level", pair="B") == [max(x[max(0, i - n) : min(n + 1, i + n + 1)]) for i in range(n + 1)]


def test_windows_do_not_grow_with_the_frames(make_bars):
    """One window node a rung and one for the frames, however many frames there are."""
    frames = {f"m{n}": ladder.mean("close", n) for n in (3, 20, 50, 200)} | {f"s{n}": ladder.std("close", n) for n in (3, 20, 200)}
    out = over_series(make_bars(A=[1.0]), lambda df, w: add_frames(df, w, frames), back=200)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") + plan.count("Window(") == 3
