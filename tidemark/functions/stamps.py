"""Watermark text and UTC wall-clock arithmetic, independent of the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

_SORTABLE_WIDTH = len("2026-06-15T09:41:59.123456789")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: str | datetime) -> Column:
    """A UTC instant as a zone-less literal; `as_of` arguments go through here."""
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_stamp(c: Column | str) -> Column:
    """Watermark text to a timestamp for display; text that does not parse gives NULL.

    The text has a comma decimal and one digit more than Spark keeps, so the
    parsed value is coarser than the text and must not be used for ordering.
    """
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast("timestamp_ntz")


def sortable_text(c: Column | str) -> Column:
    """A typed watermark as fixed-width text whose order is time order."""
    text = _col(c).cast("timestamp_ntz").cast("string")
    dotted = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".")))
    return F.replace(F.rpad(dotted, _SORTABLE_WIDTH, "0"), F.lit(" "), F.lit("T"))


def _minute_index(c: Column) -> Column:
    elapsed = c.cast("timestamp_ntz") - F.lit("0001-01-01").cast("timestamp_ntz")
    return elapsed.cast("interval minute").cast("bigint")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from start to end (2 seconds over a boundary is 1)."""
    return _minute_index(_col(end)) - _minute_index(_col(start))


def latest_of(master: Column, *others: Column) -> Column:
    """The latest stamp, where a missing child is ignored and a missing master gives NULL."""
    return F.when(master.isNotNull(), F.greatest(master, *others))
