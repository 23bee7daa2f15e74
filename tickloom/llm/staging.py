"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; only where it is unset (tests), the warehouse folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = re.sub(r"^file:/+", "file:///", root.rstrip("/"))
    return root if "://" in root else f"file://{root}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name of its own for one run; what is in it is deleted when Python ends or by `clear`."""
    path = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


#: Spark deletes an execution's shuffle files when it ends; a staged table is never made twice.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: later jobs and lost executors never recompute it."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def made() -> list[str]:
    """Folders that exist now, to be given to `delete` when nothing reads them any more."""
    return list(_MADE)


def delete(paths: list[str]) -> None:
    for uri in paths:
        if uri in _MADE:
            _MADE.remove(uri)
            system, path = open_store(uri)
            if system.get_file_info(path).type == pafs.FileType.Directory:
                system.delete_dir(path)


def clear() -> None:
    """Delete every intermediate folder of this process; results read from them must be consumed first."""
    delete(made())


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@atexit.register
def _at_exit() -> None:
    try:
        clear()
    except Exception as error:  # the process is ending: say it, don't mask the exit
        print(f"intermediate folders were not deleted: {error}")
