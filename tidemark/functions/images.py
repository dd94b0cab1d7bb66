"""Row images, hashes and bucket numbers that tell NULL from a shifted value."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tidemark.fixed import LINEAGE

_NESTED = (ArrayType, MapType, StructType, VariantType)


def json_of(columns: Sequence[str]) -> Column:
    """The named columns as a JSON object that keeps NULL fields."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def key_json(keys: Sequence[str]) -> Column:
    return json_of(keys)


def business_columns(df: DataFrame, exclude: Iterable[str] = LINEAGE) -> list[str]:
    dropped = set(exclude)
    return [c for c in df.columns if c not in dropped]


def row_image(df: DataFrame, exclude: Iterable[str] = LINEAGE) -> Column:
    """Business columns as JSON; lineage moves on every re-delivery and stays out."""
    return json_of(business_columns(df, exclude))


def row_hash(image: Column) -> Column:
    return F.sha2(image, 256)


def fingerprint(df: DataFrame, columns: Sequence[str], seed: int = 0) -> Column:
    """A 64-bit hash of a row.

    `xxhash64` skips NULLs, so (NULL, 1) and (1, NULL) would collide; each value
    is therefore preceded by its null flag. Nested columns are hashed as JSON,
    because NULLs inside them are skipped as well.
    """
    parts: list[Column] = [F.lit(seed)]
    for name in columns:
        c = F.col(name)
        parts.append(c.isNull())
        nested = isinstance(df.schema[name].dataType, _NESTED)
        parts.append(F.to_json(c, {"ignoreNullFields": "false"}) if nested else c)
    return F.xxhash64(*parts)


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(fingerprint(df, keys), F.lit(buckets)).cast("int")


def same_image(before: str, after: str, columns: Sequence[str]) -> Column:
    """Whether two structs agree, NULL equal to NULL, on every named field."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(before)[c].eqNullSafe(F.col(after)[c])
    return same


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    """Equality of the keys of two frames, NULL equal to NULL."""
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(right[prefix + k])
    return match
