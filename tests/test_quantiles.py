"""Exact quantiles by counting, against pandas."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import summary

SERIES = {
    "spread": lambda r: [r.gauss(0, 1) for _ in range(700)],
    "ties": lambda r: [float(r.randrange(4)) for _ in range(700)],
    "outliers": lambda r: [1e-300 * r.random() for _ in range(300)] + [1e300, -1e300, 1.0],
    "widest": lambda r: [-1.7e308, 1.7e308] + [r.random() for _ in range(100)],
    "tiny": lambda r: [5e-324 * r.randrange(40) for _ in range(300)],
    "powers": lambda r: [2.0**-k for k in range(1, 60)],
    "one": lambda r: [7.5],
    "two": lambda r: [1.0, 4.0],
}


@pytest.mark.parametrize("few", [3, 4096])
def test_quantiles_equal_pandas(spark, few):
    r = random.Random(few)
    values = {k: make(r) for k, make in SERIES.items()}
    rows = [(k, v, -v) for k, vs in values.items() for v in vs] + [("spread", None, float("nan")), ("none", None, None)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "pair string, a double, b double").repartition(4)
    asked = (0.0, 0.1, 0.25, 0.5, 0.999, 1.0)
    got = {(x.pair, x.column_name, x.quantile): x.value for x in summary.exact_quantiles(df, ["a", "b"], asked, bins=16, few=few).collect()}
    want = {}
    for k, vs in values.items():
        for name, sign in (("a", 1), ("b", -1)):
            s = pd.Series([sign * v for v in vs])
            want |= {(k, name, q): s.quantile(q) for q in asked}
    assert set(got) == set(want)
    for key, w in want.items():
        if key[0] == "widest" and key[2] not in (0.0, 1.0):
            continue  # pandas' own interpolation leaves double range there
        assert got[key] == pytest.approx(w, rel=1e-12, abs=1e-320), key


def test_no_series_is_gathered(spark):
    df = spark.range(1000).select(F.lit("A").alias("pair"), F.col("id").cast("timestamp").alias("date"), F.col("id").cast("double").alias("v"))
    out = summary.describe_exact(df, ["v"])
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString()
    row = out.first()
    assert (row["count"], row.min, row.p25, row.p50, row.p75, row["max"]) == (1000, 0.0, 249.75, 499.5, 749.25, 999.0)
    assert summary.describe_exact(df.limit(0), ["v"]).count() == 0
