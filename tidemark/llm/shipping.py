"""Prepare a session: the package on the executors, whose path may lack it, and small Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = "8m"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's source to the application, once, and bound the Arrow batches of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.realpath(os.path.join(tempfile.mkdtemp(), f"{package.name}.zip"))
    with zipfile.ZipFile(target, "w") as archive:
        for file in package.rglob("*.py"):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
