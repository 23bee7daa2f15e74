"""Make this package importable in Python workers, also where it is not installed there, and bound their batches."""

from __future__ import annotations

import io
import tempfile
import zipfile
import zlib
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


#: Spark's limit on rows alone lets a batch of very long texts grow without bound.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all workers with `addPyFile`, once for each session and state of the sources.

    Also holds the session's Arrow batches to BATCH_BYTES (or one row).
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        for file in sorted([*PACKAGE.rglob("*.py"), *PACKAGE.rglob("*.json")]):
            out.writestr(zipfile.ZipInfo(str(file.relative_to(PACKAGE.parent))), file.read_bytes())
    name = f"{PACKAGE.name}-{zlib.crc32(buffer.getvalue()):08x}.zip"
    context = spark.sparkContext
    if not any(x.endswith(name) for x in context.listFiles):
        path = Path(tempfile.mkdtemp()) / name  # on the driver; Spark copies it to the executors
        path.write_bytes(buffer.getvalue())
        context.addPyFile(str(path))
