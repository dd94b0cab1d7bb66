"""Documents with their other columns put aside, so that no name of theirs meets one made here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OWN = ("doc_id", "text")


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as the struct `rest`."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in OWN]
    return docs.select(*OWN, (F.struct(*rest) if rest else F.lit(0)).alias("rest"))


def unpacked(frame: DataFrame, docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """The columns that `docs` has; `n_chars` is counted anew in rows whose text changed."""
    def column(name: str) -> Column:
        if name in OWN:
            return F.col(name)
        old = F.col("rest").getField(name)
        if name == "n_chars" and changed is not None:
            kind = docs.schema[name].dataType
            old = F.when(changed, F.char_length("text").cast(kind)).otherwise(old)
        return old.alias(name)
    return frame.select(*map(column, docs.columns))
