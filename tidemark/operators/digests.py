"""Where two tables differ, told from order-free digests of key ranges before any row is moved.

The rows of both sides are hashed and summed by key range, one side with the
other sign. A range whose sums are all zero holds the same rows on both sides,
repeats included. Each task reduces its rows to one line per range, so equal
tables cost their scan and no shuffle of rows; else only the ranges that differ
are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import bucket_of, fingerprint

#: Key ranges of a comparison: the lines that a task sends on, and the numbers that the driver may hold.
PARTS = 4096


def sided(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both with `__side`, 1 on the left and -1 on the right; columns meet by name."""
    return left.withColumn("__side", F.lit(1)).unionByName(right.withColumn("__side", F.lit(-1)))


def range_digests(both: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  parts: int = PARTS) -> DataFrame:
    """part, rows_apart, sum_a, sum_b: left less right in rows and in two 64-bit hashes of the row.

    Sums are taken as decimals: they can't overflow in a range that holds most
    of the rows, and unlike XOR they see a row that stands twice.
    """
    hashes = [F.col("__side") * fingerprint(both, columns, seed).cast("decimal(20,0)") for seed in (0, 1)]
    lines = both.select(bucket_of(both, keys, parts).alias("part"), "__side",
                        hashes[0].alias("a"), hashes[1].alias("b"))
    return lines.groupBy("part").agg(F.sum("__side").alias("rows_apart"),
                                     F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))


def differing_parts(both: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    parts: int = PARTS) -> DataFrame:
    """The key ranges in which the sides do not hold the same rows."""
    return range_digests(both, keys, columns, parts).where(
        "rows_apart <> 0 OR sum_a <> 0 OR sum_b <> 0")


def where_different(both: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                    parts: int = PARTS) -> DataFrame:
    """The rows of both sides in the key ranges that differ; none for equal sides. Runs one job."""
    columns = columns or [c for c in both.columns if c != "__side"]
    found = sorted(r.part for r in differing_parts(both, keys, columns, parts).collect())
    return both if len(found) == parts else both.where(bucket_of(both, keys, parts).isin(found))
