"""Bronze: lazy projections over the source. Nothing is copied or cached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import parse_stamp, sortable_text
from tidemark.operators.profile import Signal, union_all


def bronze_standard(df: DataFrame, signal: Signal) -> DataFrame:
    """All columns; hash-suffixed names become LOAD_TYPE and RUN_ID, the stamp is parsed for display."""
    renames = {signal.load_type: "LOAD_TYPE", signal.run_id: "RUN_ID"}
    return (df.withColumnsRenamed({old: new for old, new in renames.items() if old})
            .withColumn("CDC_TIMESTAMP_UTC", parse_stamp(signal.timestamp)))


def bronze_custom(df: DataFrame, wm: str) -> DataFrame:
    return df.withColumn("CDC_TIMESTAMP_UTC", F.col(wm).cast("timestamp_ntz"))


def watermark_text(wm: str, track: str) -> Column:
    """The watermark as text whose order is time order: raw, or fixed-width for a typed one."""
    return F.col(wm) if track == "STANDARD" else sortable_text(wm)


def change_mix(bronze: dict[str, DataFrame], wm: str, track: str,
               operation: str | None = None) -> DataFrame:
    """Per object, operation and load type: n_rows, first and last watermark as text.

    The aggregate runs on the watermark itself; only its result becomes text.
    """
    frames = []
    for name, df in bronze.items():
        has_load_type = track == "STANDARD" and "LOAD_TYPE" in df.columns
        op = F.col(operation) if operation else F.lit(None).cast("string")
        load = F.col("LOAD_TYPE") if has_load_type else F.lit(None).cast("string")
        frames.append(
            df.groupBy(op.alias("operation"), load.alias("load_type"))
            .agg(F.count("*").alias("n_rows"), F.min(wm).alias("first"), F.max(wm).alias("last"))
            .select(F.lit(name).alias("object_name"), "operation", "load_type", "n_rows",
                    watermark_text("first", track).alias("first_seen"),
                    watermark_text("last", track).alias("last_seen")))
    return union_all(frames)
