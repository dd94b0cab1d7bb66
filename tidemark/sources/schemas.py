"""Schemas as `name type, ...` text, and frames from a few rows the driver holds."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

_JSON_NAMES = {"bigint": "long", "int": "integer"}
_ARROW = {
    "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(),
    "double": pa.float64(), "timestamp": pa.timestamp("us", "UTC"),
    "timestamp_ntz": pa.timestamp("us"),
}


def columns(text: str) -> StructType:
    """Usable before a session exists, unlike a DDL string."""
    schema = StructType()
    for part in text.split(","):
        name, kind = part.split()
        data_type: DataType | str = _JSON_NAMES.get(kind, kind)
        schema = schema.add(name, ArrayType(StringType()) if kind == "array<string>" else data_type)
    return schema


def _arrow(kind: DataType) -> pa.DataType:
    if isinstance(kind, ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return _ARROW[kind.simpleString()]


def local_frame(spark: SparkSession, rows: Sequence[dict], schema: StructType) -> DataFrame:
    """Control rows as a frame; they travel as one Arrow batch, without a Python task."""
    arrays = [pa.array([r.get(f.name) for r in rows], _arrow(f.dataType)) for f in schema.fields]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema.names), schema)
