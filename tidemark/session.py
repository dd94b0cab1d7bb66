"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings for any deployment; shuffle partitions and memory are the cluster's to choose."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false"))
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
