"""Write a frame to a named sink, in any format the readers know."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.sources.readers import FORMATS


def write_sink(df: DataFrame, ref: str, mode: str = "append", partition_by: Sequence[str] = (),
               **options: str) -> None:
    """`table:<name>`, `<format>:<path>`, or a bare Parquet path."""
    kind, _, rest = ref.partition(":")
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "table":
        writer.saveAsTable(rest)
    else:
        fmt, path = (kind, rest) if kind in FORMATS else ("parquet", ref)
        writer.format(fmt).save(path)
