"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`.

    Executors must all see it, so a machine-local folder is used only when
    Spark runs in local mode and the setting is absent.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
