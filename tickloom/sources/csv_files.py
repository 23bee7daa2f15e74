"""Per-instrument CSV files ``historical_<PAIR>.csv``: tolerant read, sorted write.

Files differ in their headers (``1. open``, ``Open``, ``open``) and in column order, so
columns are found by name per file.  Everything runs on the executors; no file is opened
by the driver.
"""

from pyspark.sql import functions as F

from tickloom.functions import prices
from tickloom.schema import OHLC

REQUIRED = ("date", *OHLC)

# Header spellings, after lower-casing and removing quotes.
NUMBERED_HEADER = {"1. open": "open", "2. high": "high", "3. low": "low", "4. close": "close"}
FILE_NAME = r"historical_([^/]+?)\.csv"


def pair_from_path(path):
    """Instrument named by a file: the part after ``historical_``, with _ read as /."""
    name = F.regexp_extract(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), FILE_NAME, 1)
    return F.replace(name, F.lit("_"), F.lit("/"))


def file_name(pair):
    return F.concat(F.lit("historical_"), F.replace(pair, F.lit("/"), F.lit("_")), F.lit(".csv"))


def normalize_columns(df):
    """Rename known header spellings; fail if a required column is missing."""
    plain = {c: c.strip().strip('"').lower() for c in df.columns}
    renamed = df.withColumnsRenamed({c: NUMBERED_HEADER.get(p, p) for c, p in plain.items()})
    missing = [c for c in REQUIRED if c not in renamed.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return renamed


def _cells(line):
    """Cells of a line; a quoted cell may hold commas and doubled quotes."""
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'(\s*"(?:[^"]|"")*"\s*|[^,]*),'), 1)
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), '^"|"$', ""), '""', '"')
    return F.transform(found, lambda c: F.trim(bare(c)))


def _header_names(line):
    lowered = F.transform(_cells(line), F.lower)
    spellings = F.create_map(*[F.lit(x) for kv in NUMBERED_HEADER.items() for x in kv])
    return F.transform(lowered, lambda c: F.coalesce(F.try_element_at(spellings, c), c))


def _lines(spark, glob):
    """Text lines with their file, cells, and whether they are a header.

    Also reads folders of that name, which is how Spark writes one CSV per instrument.
    """
    text = spark.read.text(glob).filter(F.length(F.trim("value")) > 0)
    lines = text.select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.withColumn("is_header", F.array_contains(_header_names("value"), "open"))


def _located(lines):
    """Rows with one text column per required name, NULL where the file lacks it."""
    headers = lines.filter("is_header").groupBy("path").agg(F.min("value").alias("header"))
    rows = lines.filter(~F.col("is_header")).join(headers, "path", "left")
    names, cells = _header_names("header"), _cells("value")

    def cell(name):
        place = F.array_position(names, name).cast("int")
        return F.when(place > 0, F.try_element_at(cells, F.nullif(place, F.lit(0))))

    lacking = F.filter(
        F.array(*map(F.lit, REQUIRED)),
        lambda n: ~F.coalesce(F.array_contains(names, n), F.lit(False)),
    )
    return rows.select(
        "path",
        pair_from_path(F.col("path")).alias("pair"),
        *[cell(c).alias(c) for c in REQUIRED],
        "value",
        lacking.alias("_lacking"),
        (F.size(cells) != F.size(names)).alias("_ragged"),
    )


def _judged(spark, glob):
    rows = _located(_lines(spark, glob))
    typed = {c: prices.parse_number(c) for c in OHLC}
    blank = [F.coalesce(F.trim(c), F.lit("")) == "" for c in OHLC]
    garbled = [~b & typed[c].isNull() for b, c in zip(blank, OHLC)]
    any_garbled = garbled[0] | garbled[1] | garbled[2] | garbled[3]
    reason = (
        F.when(F.size("_lacking") > 0, F.concat(F.lit("missing columns: "), F.array_join("_lacking", ", ")))
        .when(F.col("_ragged"), "wrong number of cells")
        .when(prices.parse_date("date").isNull(), "bad date")
        .when(any_garbled, "bad number")
    )
    return rows.withColumn("reason", reason)


def read_bars_csv(spark, glob):
    """(bars, quarantine).  A bad file or row never fails the load; it is set aside
    with the reason."""
    judged = _judged(spark, glob)
    good = judged.filter(F.col("reason").isNull()).select(
        "pair",
        prices.parse_date("date").alias("date"),
        *[prices.parse_number(c).alias(c) for c in OHLC],
    )
    bad = judged.filter(F.col("reason").isNotNull()).select("path", "pair", "value", "reason")
    return good, bad


def write_bars_csv(bars, path, places=4):
    """One folder ``file=historical_<PAIR>.csv`` per instrument, newest rows first.

    Rows are rebalanced by instrument at run time: small ones share a task, one with
    very many rows is split over several and becomes several files.
    """
    shown = bars.select(
        "date",
        *[F.round(c, places).cast("decimal(24,4)").alias(c) for c in OHLC],
        file_name(F.col("pair")).alias("file"),
    )
    (
        shown.hint("rebalance", "file")
        .sortWithinPartitions("file", F.col("date").desc())
        .write.partitionBy("file")
        .option("header", True)
        .csv(path)
    )


def export_csv(rows, path):
    """Export of a view as it is shown: newest first inside each file."""
    rows.sortWithinPartitions(F.col("date").desc()).write.option("header", True).csv(path)
