"""Session settings and the scratch folder shared by all executors."""

import atexit
import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

_kept = set()


def local_session(cores="*", app="tickloom", partitions=8, **extra):
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Call sites in error messages cost several JVM round trips per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark):
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, the warehouse folder.

    Both are folders that the driver and all executors of a session share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = re.sub(r"^file:/+", "file:///", configured.rstrip("/"))
    return path if "://" in path else f"file://{path}"


def scratch_path(spark, label):
    """A path below the scratch folder that nothing has used before."""
    return f"{scratch_root(spark)}/tickloom-{label}-{uuid.uuid4().hex}"


def stored(df, label):
    """Write ``df`` to the shared folder and read it back, cutting its lineage; the rows and their path.

    The files outlive a lost executor, so later stages re-read them instead of
    recomputing everything above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _kept.add(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(path):
    """Delete a folder that ``stored`` has written, once nothing reads it any more."""
    store, folder = fs.FileSystem.from_uri(path)
    if store.get_file_info(folder).type == fs.FileType.Directory:
        store.delete_dir(folder)
    _kept.discard(path)


@atexit.register
def _discard_all():
    for path in list(_kept):
        try:
            discard(path)
        except OSError as error:
            print(f"not deleted: {path}: {error}")
