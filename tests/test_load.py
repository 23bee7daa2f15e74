"""Sources, quality rules, maintenance and streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tickloom.operators import quality, select, upkeep
from tickloom.schema import BARS
from tickloom.sources import csv_files, payloads, tables
from tickloom.streaming import jobs


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.fixture
def csv_folder(tmp_path):
    write(tmp_path, "historical_EUR_USD.csv", "date,1. open,2. high,3. low,4. close\n2024-01-02,1,2,0.5,1.5\n")
    write(tmp_path, "historical_USD_EGP.csv", "Close,Date,Open,High,Low\n30,2024-01-03,29,31,28\nbad,2024-01-04,1,1,1\n31,soon,1,1,1\n31,2024-01-05,1\n")
    write(tmp_path, "historical_NO_DATE.csv", '"",Open,High,Low,Close\n2024-01-02,1,2,0.5,1.5\n')
    return str(tmp_path)


def test_csv_variants(spark, csv_folder):
    good, bad = csv_files.read_bars_csv(spark, f"{csv_folder}/historical_*.csv")
    got = {(r.pair, str(r.date), r.open, r.close) for r in good.collect()}
    assert got == {("EUR/USD", "2024-01-02", 1.0, 1.5), ("USD/EGP", "2024-01-03", 29.0, 30.0)}
    reasons = sorted((r.pair, r.reason) for r in bad.collect())
    assert reasons == [
        ("NO/DATE", "missing columns: date"),
        ("USD/EGP", "bad date"),
        ("USD/EGP", "bad number"),
        ("USD/EGP", "wrong number of cells"),
    ]


def test_csv_written_newest_first(spark, make_bars, tmp_path):
    csv_files.write_bars_csv(make_bars(**{"A/B": [1.23456, 2.0]}).coalesce(1), str(tmp_path / "out"))
    folder = tmp_path / "out" / "file=historical_A_B.csv"
    (part,) = [p for p in os.listdir(folder) if p.endswith(".csv")]
    lines = open(folder / part).read().split()
    assert lines[0] == "date,open,high,low,close"
    assert lines[1].startswith("2020-01-02") and lines[2].endswith("1.2346")
    csv_files.export_csv(make_bars(A=[1.0]), str(tmp_path / "export"))
    assert spark.read.option("header", True).csv(str(tmp_path / "export")).count() == 1


def test_headers(spark):
    ok = spark.createDataFrame([("2024-01-01", 1, 2, 3, 4)], ["Date", "1. open", "High", "3. low", "close"])
    assert csv_files.normalize_columns(ok).columns == ["date", "open", "high", "low", "close"]
    with pytest.raises(ValueError):
        csv_files.normalize_columns(ok.drop("Date"))


def test_payloads(spark):
    daily = '{"Time Series FX (Daily)": {"2024-01-02": {"1. open": "1.1", "2. high": "x", "3. low": "1", "4. close": "1.2"}}}'
    bodies = [("A", daily), ("B", '{"Error Message": "no"}'), ("C", '{"Note": "slow down"}'), ("D", "{}"), ("E", "oops")]
    df = spark.createDataFrame(bodies, "pair string, payload string")
    status = {r.pair: r.status for r in payloads.triage_payload(df).collect()}
    assert status == {"A": "accepted", "B": "rejected", "C": "retry", "D": "rejected", "E": "rejected"}
    parts = payloads.by_status(payloads.triage_payload(df))
    bar = payloads.parse_daily_json(parts["accepted"]).collect()
    assert [(str(b.date), b.open, b.high, b.close) for b in bar] == [("2024-01-02", 1.1, None, 1.2)]
    snap = spark.createDataFrame(
        [('{"rates": {"EGP": 30.9, "EUR": 0.92, "USD": 1.0, "XXX": 5.0}}', dt.datetime(2024, 1, 1))], "payload string, ts timestamp"
    )
    quotes = payloads.parse_snapshot_json(snap, "USD", ["EGP", "EUR", "GBP"])
    assert {(q.target, q.rate) for q in quotes.collect()} == {("EGP", 30.9), ("EUR", 0.92)}


def test_clean_and_validate(spark):
    raw = spark.createDataFrame(
        [("A", " 2024-01-02 ", " 1.1 ", "1.2", "1.0", "1.1"), ("A", "", "abc", "", "NaN", "1")],
        "pair string, date string, open string, high string, low string, close string",
    )
    first, second = quality.clean_raw(raw).collect()
    assert (str(first.date), first.open) == ("2024-01-02", 1.1)
    assert (second.date, second.open, second.high, second.low) == (None, None, None, None)
    good, bad = quality.validate_bars(quality.clean_raw(raw), as_of="2024-12-31")
    assert good.count() == 1 and bad.first().reasons[0] == "missing_date"


def test_good_and_rejected_are_everything(spark):
    from tickloom.plans import inputs

    rows = inputs.dirty_bars(spark, "/root/testdata/sf0.001")
    as_of = select.latest_date(inputs.bars(spark, "/root/testdata/sf0.001"))
    good, bad = quality.validate_bars(rows, as_of)
    assert good.count() + bad.count() == rows.count() and bad.count() > 0


def test_quotes(spark):
    q = spark.createDataFrame(
        [("USD", "EUR", 0.9), ("USD", "EUR", 0.0), (None, "EUR", 1.0), ("USD", "EUR", None)],
        "base string, target string, rate double",
    )
    assert quality.valid_quotes(q).count() == 1 and quality.rejected_quotes(q).count() == 3


def test_upsert_is_idempotent(make_bars):
    target = make_bars(A=[1.0, 2.0], B=[5.0])
    updates = make_bars(A=[1.0, 9.0, 3.0])
    once = upkeep.upsert(target, updates)
    twice = upkeep.upsert(once, updates)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert values(once, "close", pair="A") == [1.0, 9.0, 3.0] and values(once, "close", pair="B") == [5.0]


def test_upsert_stamps_updates(make_bars):
    old, run = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    target = upkeep.audited(make_bars(A=[1.0, 2.0]), run_ts=old)
    out = upkeep.upsert(target, make_bars(A=[9.0]), ts_col="updated_at", run_ts=run)
    assert values(out, "updated_at") == [run, old]


def test_upsert_of_many_copies_of_one_key(spark, make_bars):
    """Copies of one row collapse before the shuffle."""
    copies = make_bars(A=[1.0]).crossJoin(spark.range(20_000)).drop("id")
    out = upkeep.upsert(make_bars(A=[0.0]), copies)
    assert [r.close for r in out.collect()] == [1.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_insert_missing(make_bars):
    out = upkeep.insert_missing(make_bars(A=[1.0]), make_bars(A=[9.0, 2.0]))
    assert values(out, "close") == [1.0, 2.0]


def test_incremental_slice(make_bars):
    source = make_bars(A=[1.0] * 100, NEW=[1.0] * 100)
    target = make_bars(A=[1.0] * 90)
    out = upkeep.incremental_slice(source, target, F.lit(dt.date(2020, 4, 9)))
    counts = {r.pair: r.n for r in out.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    assert counts == {"A": 10, "NEW": 30}


def test_month_table(spark, make_bars, tmp_path):
    path = str(tmp_path / "t")
    upkeep.write_by_month(make_bars(A=[1.0] * 60), path)
    before = {p: os.listdir(f"{path}/{p}") for p in os.listdir(path) if p.startswith("month=")}
    for _ in range(2):
        upkeep.upsert_months(spark, path, make_bars(A=[7.0], B=[8.0]))
    after = upkeep.read_months(spark, path, BARS)
    assert after.count() == 61 and values(after, "close", pair="A")[0] == 7.0
    assert os.listdir(f"{path}/month=2020-02") == before["month=2020-02"]


def test_tables_and_views(spark, make_bars, tmp_path):
    upkeep.register_views({"bars_view": make_bars(A=[1.0])})
    assert "bars_view" in {r.name for r in upkeep.list_tables(spark).collect()}
    assert spark.sql("SELECT close FROM bars_view").first().close == 1.0
    upkeep.register_views({"Upper": make_bars(A=[1.0]).withColumnRenamed("close", "CLOSE")})
    assert "close" in tables.read_table(spark, "Upper").columns
    upkeep.drop_views(spark, "bars_view", "Upper")
    upkeep.save_table(make_bars(A=[1.0]), "bars_table", path=str(tmp_path / "t"))
    upkeep.save_table(make_bars(A=[1.0, 2.0]), "bars_table", "ignore", str(tmp_path / "t"))
    assert tables.read_table(spark, "bars_table").count() == 1
    spark.sql("DROP TABLE bars_table")
    assert "bars_view" not in {r.name for r in upkeep.list_tables(spark).collect()}


def test_slices(make_bars):
    bars = make_bars(A=[float(i) for i in range(100)], B=[1.0] * 3)
    assert select.between(bars, "2020-01-02", "2020-01-05", "A").count() == 4
    assert select.trailing(bars, 9).count() == 10
    assert select.default_range(bars, 200).count() == 103
    out = select.slice_or_tail(bars, "2020-01-01", "2020-01-06")
    assert out.filter("pair = 'A'").count() == 6 and out.filter("pair = 'B'").count() == 3
    late = select.slice_or_tail(bars, "2030-01-01", "2030-02-01")
    assert values(late, "close", pair="A") == [float(i) for i in range(70, 100)]
    assert values(select.latest_per_pair(bars), "close", pair="A") == [99.0]
    assert [r.pair for r in select.newest(bars, 2).collect()] == ["A", "A"]


def test_top_rows_are_cut_before_the_shuffle(make_bars):
    plan = select.last_n(make_bars(A=[1.0, 2.0]), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_null_counts(make_bars):
    got = {r.column_name: r.null_count for r in quality.null_counts(make_bars(A=[None, 1.0])).collect()}
    assert got["close"] == 1 and got["pair"] == 0


# --- streams -----------------------------------------------------------------


def stream(spark, df, path):
    df.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def quotes(spark, rows):
    return spark.createDataFrame(rows, "id int, pair string, ts timestamp, price double")


def at(minute, hour=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_stream_bars_drop_late_quotes(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [(1, "A", at(1), 5.0), (2, "A", at(59), 7.0), (3, "A", at(0, 5), 1.0)],
        [(4, "A", at(30), 100.0), (5, "A", at(0, 9), 2.0)],
        [(6, "A", at(0, 14), 2.0)],
    ]
    for batch in batches:
        bars = jobs.stream_ohlc(stream(spark, quotes(spark, batch), source))
        jobs.append_stream(bars, out, state).awaitTermination()
    got = {r.date.hour: (r.open, r.high, r.low, r.close) for r in spark.read.parquet(out).collect()}
    assert got[0] == (5.0, 7.0, 5.0, 7.0) and got[5] == (1.0, 1.0, 1.0, 1.0)


def test_stream_dedup(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for _ in range(2):
        rows = jobs.stream_dedup(stream(spark, quotes(spark, [(1, "A", at(1), 5.0)]), source), ["id"])
        jobs.append_stream(rows, out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_stream_validate_splits(spark, tmp_path):
    source, good, bad, state = (str(tmp_path / n) for n in ("in", "good", "bad", "state"))
    df = spark.createDataFrame([("USD", "EUR", 1.0), ("USD", None, 1.0)], "base string, target string, rate double")
    jobs.stream_validate(stream(spark, df, source), good, bad, state).awaitTermination()
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(bad).count() == 1


def test_stream_upsert(spark, make_bars, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    for closes in ([1.0, 2.0], [9.0]):
        jobs.stream_upsert(stream(spark, make_bars(A=closes), source), table, state).awaitTermination()
    assert values(upkeep.read_months(spark, table, BARS), "close") == [9.0, 2.0]


NULLABLE = "pair string, date date, open double, high double, low double, close double"


def null_keyed(spark, rows):
    return spark.createDataFrame([(p, d and dt.date.fromisoformat(d), v, v, v, v) for p, d, v in rows], NULLABLE)


def folders(spark, label):
    from tickloom.session import scratch_root

    root = scratch_root(spark).removeprefix("file://")
    return [x for x in os.listdir(root) if x.startswith(f"tickloom-{label}")] if os.path.isdir(root) else []


def test_upsert_loses_no_null_keys(spark, tmp_path):
    path = str(tmp_path / "table")
    target = null_keyed(spark, [("A", None, 1.0), ("A", "2020-01-01", 2.0), (None, "2020-01-02", 3.0), ("C", None, 9.0)])
    upkeep.write_by_month(target, path)
    before = {k: folders(spark, k) for k in ("updates", "staged")}
    fresh = null_keyed(spark, [("B", None, 4.0), (None, "2020-01-02", 5.0), ("A", "2020-01-01", 6.0), ("C", None, 7.0), ("C", None, 8.0)])
    upkeep.upsert_months(spark, path, fresh)
    got = sorted((str(r.pair), str(r.date), r.close) for r in upkeep.read_months(spark, path, target.schema).collect())
    assert got == [("A", "2020-01-01", 6.0), ("A", "None", 1.0), ("B", "None", 4.0), ("C", "None", 8.0), ("None", "2020-01-02", 5.0)]
    assert {k: folders(spark, k) for k in before} == before


def test_upsert_sorts_no_target_rows(spark):
    rows = null_keyed(spark, [("A", "2020-01-01", 1.0)])
    plan = upkeep.upsert(rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") <= 2  # of the updates alone


def test_hot_pair_is_spread(spark):
    """Most rows in one pair, no broadcast: salted marks deal them to several tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        rows = spark.range(4000).select(F.when(F.col("id") % 10 < 7, "HOT").otherwise(F.concat(F.lit("P"), F.col("id"))).alias("pair"), F.col("id").cast("double").alias("v"))
        marks = rows.groupBy("pair").agg(F.max("v").alias("top"))
        joined = select.with_marks(rows, marks, "pair")
        spread = joined.filter("pair = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in spread) == 2800 and len(spread) >= 6 and max(r["count"] for r in spread) < 1200
        assert joined.count() == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_quotes_with_equal_times(spark):
    from tickloom.operators import bars as bar_ops

    t = dt.datetime(2024, 1, 1, 10, 5)
    rows = spark.createDataFrame([(3, "A", t, 30.0), (1, "A", t, 10.0), (2, "A", t, 20.0)], "event_id long, pair string, ts timestamp, price double")
    r = bar_ops.ohlc_bars(rows, 3600, tie="event_id").first()
    assert (r.open, r.close, r.high, r.low) == (10.0, 30.0, 30.0, 10.0)
    plan = bar_ops.ohlc_bars(rows, 3600, tie="event_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_quoted_cells(spark, tmp_path):
    write(tmp_path, "historical_EUR_USD.csv", 'date,note,open,high,low,close\n2024-01-02,"a, ""b"" c",1,2,0.5,"1.5"\n')
    good, bad = csv_files.read_bars_csv(spark, f"{tmp_path}/historical_*.csv")
    assert [(r.open, r.close) for r in good.collect()] == [(1.0, 1.5)] and bad.count() == 0


def test_schemas(spark):
    upkeep.use_schema(spark, "tickloom_test")
    try:
        assert spark.catalog.currentDatabase() == "tickloom_test"
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP SCHEMA tickloom_test")
