"""Table reads with lower-case column names."""

from tickloom.operators.upkeep import lower_names


def read_table(spark, name):
    return lower_names(spark.table(name))


def read_jdbc(spark, url, table, partition_column=None, bounds=None, partitions=None, **options):
    """A database table; with a numeric or date column and its bounds, read in parallel.

    Filters and column choices made on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return lower_names(reader.load())
