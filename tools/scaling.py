"""Rows per second of the windowed operators at several core counts.

    [SCALING_JOBS="ema swing_points"] python tools/scaling.py CORES ROWS FOLDER [daily] [long]

Many daily series (window per series) and one long series of one-second bars (cut into
blocks) are generated into FOLDER once and read from there.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tickloom.layout import Layout, layout_of  # noqa: E402
from tickloom.operators import averages, changes, oscillators, swings  # noqa: E402
from tickloom.session import local_session  # noqa: E402


def prices(ids):
    close = 100 + 10 * F.sin(ids / 50) + (F.xxhash64(ids) % 1000) / 1000
    return [
        (close - 0.1).alias("open"), (close + 0.5).alias("high"), (close - 0.5).alias("low"),
        close.alias("close"),
    ]


def make(spark, rows, folder):
    days = 10_000
    if not os.path.exists(f"{folder}/daily"):
        r = spark.range(0, rows, numPartitions=32)
        i = F.col("id")
        r.select(
            F.floor(i / days).cast("string").alias("pair"),
            F.date_add(F.lit("1990-01-01").cast("date"), (i % days).cast("int")).alias("date"),
            *prices(i),
        ).write.parquet(f"{folder}/daily")
        r.select(
            F.lit("ONE").alias("pair"), F.timestamp_seconds(i + 1_600_000_000).alias("date"), *prices(i)
        ).write.parquet(f"{folder}/long")


JOBS = {
    "moving_averages": lambda b, y: averages.moving_averages(b, layout=y),
    "sma_strict": lambda b, y: averages.sma_strict(b, layout=y),
    "ema": lambda b, y: averages.ema(b, layout=y),
    "macd": lambda b, y: oscillators.macd(b, layout=y),
    "technical_rsi": lambda b, y: oscillators.technical_rsi(b, layout=y),
    "swing_points": lambda b, y: swings.swing_points(b, layout=y),
    "forward_fill": lambda b, y: changes.forward_fill(b, ["close"], y),
}


def main(cores, rows, folder):
    spark = local_session(cores, "scaling", partitions=32)
    make(spark, rows, folder)
    for kind in sys.argv[4:] or ("daily", "long"):
        spark.read.parquet(f"{folder}/{kind}").write.format("noop").mode("overwrite").save()
        bars = spark.read.parquet(f"{folder}/{kind}")
        layout = layout_of(bars) if kind == "daily" else Layout(step=1, split=True)
        for name in os.environ.get("SCALING_JOBS", " ".join(JOBS)).split():
            job = JOBS[name]
            for _ in range(2):  # the first run warms up
                start = time.perf_counter()
                job(bars, layout).write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - start
            print(f"cores={cores} {kind:5} {name:16} {rows / took / 1e6:6.2f} M rows/s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
