"""Table maintenance: upsert, insert-if-absent, incremental slices, views.

Plain Parquet has no MERGE, so an upsert is a merge of two DataFrames; writing it
back replaces only the month partitions the updates touch.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F, types as T

from tickloom.functions import dates
from tickloom.operators.select import with_marks
from tickloom.session import discard, stored

KEYS = ("date", "pair")


def audited(rows, ts_col="updated_at", run_ts=None):
    """One audit time per run, not per row."""
    return rows.withColumn(ts_col, F.current_timestamp() if run_ts is None else F.lit(run_ts))


def newest_copy(rows, keys=KEYS, rank=()):
    """One row per key: the greatest by the columns ``rank``, then by content.

    An aggregate with a map-side half, so a key with very many copies is reduced
    before it is shuffled.
    """
    order = [*rank, *[c for c in rows.columns if c not in (*keys, *rank)]]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order])


def _without(rows, others, keys):
    """``rows`` whose key is not among the keys of ``others``; a NULL in a key is a value like any other."""
    found = others.select(*[F.col(k).alias(f"_{k}") for k in keys])
    match = reduce(and_, [rows[k].eqNullSafe(found[f"_{k}"]) for k in keys])
    return rows.join(found, match, "left_anti")


def upsert(target, updates, keys=KEYS, ts_col=None, run_ts=None):
    """Updates win over the target; keys only on one side are kept, also those with a NULL.

    Only the updates are reduced to one row per key; target rows are kept as they are.
    """
    newest = newest_copy(updates, keys)
    if ts_col:
        newest = audited(newest, ts_col, run_ts)
    columns = target.columns
    return _without(target, newest, keys).unionByName(newest.select(*columns))


def insert_missing(target, updates, keys=KEYS):
    """Add updates whose key the target lacks; existing rows stay as they are."""
    one_each = newest_copy(updates, keys)
    return target.unionByName(_without(one_each.select(*target.columns), target, keys))


def high_water_marks(target):
    return target.groupBy("pair").agg(F.max("date").alias("high_water_mark"))


def incremental_slice(source, target, as_of, default_days=30):
    """Source rows newer than what the target holds of their instrument.

    Instruments the target lacks start ``default_days`` before ``as_of``.
    """
    default = F.date_sub(as_of, default_days)
    marked = with_marks(source, high_water_marks(target), "pair", "left")
    return marked.filter(F.col("date") > F.coalesce("high_water_mark", default)).drop("high_water_mark")


def append(rows, path):
    rows.write.mode("append").parquet(path)


def write_by_month(rows, path, mode="overwrite"):
    """Bars partitioned by month; dynamic mode replaces only the months in ``rows``.

    Rows are rebalanced by month first: few files per month, and a month too large for
    one task is split at run time.
    """
    (
        rows.withColumn("month", dates.month_key("date"))
        .hint("rebalance", "month")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def read_months(spark, path, schema):
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("month", T.StringType())])).parquet(path)


def upsert_months(spark, path, updates, keys=KEYS, ts_col=None, run_ts=None):
    """Merge ``updates`` into the month-partitioned table at ``path``; nothing is lost, NULL dates neither.

    The updates are stored first, so what made them runs once.  Only touched months are
    read and rewritten: the scan is joined with the distinct months of the updates, which
    prunes its partitions at run time.  The merged rows are staged, as the files being read
    must not be overwritten, and both stored copies are deleted after the write.  A repeat
    after a failure gives the same table.
    """
    if ts_col:
        updates = audited(updates, ts_col, run_ts)
    changes, changes_path = stored(updates, "updates")
    months = changes.select(dates.month_key("date").alias("_month")).distinct()
    table = read_months(spark, path, updates.schema)
    current = table.join(months, F.col("month").eqNullSafe(F.col("_month")), "left_semi")
    merged, merged_path = stored(upsert(current.select(*updates.columns), changes, keys), "staged")
    write_by_month(merged, path)
    discard(changes_path)
    discard(merged_path)


def list_tables(spark, database=None):
    """Name, database and kind of every table and view in the current schema."""
    shown = spark.sql("SHOW TABLES" + (f" IN {database}" if database else ""))
    return shown.select(
        F.col("tableName").alias("name"), F.col("namespace").alias("database"), "isTemporary"
    )


def register_views(tables):
    """Create or replace a temporary view per (name, DataFrame)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def drop_views(spark, *names):
    for name in names:
        spark.catalog.dropTempView(name)


def use_schema(spark, name):
    """Create a schema unless it exists, and make it the current one."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


def save_table(df, name, mode="overwrite", path=None):
    """Create or replace a catalogue table; mode "ignore" creates it only if absent."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def lower_names(df):
    return df.toDF(*[c.lower() for c in df.columns])
