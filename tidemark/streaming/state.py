"""Streams that remember the last row of each key.

Both operators keep one row of state per key, whatever the number of input
partitions, and want a state store that spills to local disk with changes
logged to the checkpoint: see `ROCKSDB`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.fixed import LINEAGE
from tidemark.functions import row_hash, row_image

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_KEY = "__key_"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams started from here on in RocksDB."""
    spark.conf.set(PROVIDER, ROCKSDB)


class _Changes(StatefulProcessor):
    """Passes on the rows of a key whose image differs from the one before, in order of time.

    State is the time and image hash of the last row. Rows at or before it are
    late or delivered again, so they go. A timer ends the state of a key that
    was quiet for the delay.
    """

    def __init__(self, columns: Sequence[str], delay_ms: int):
        self._columns, self._delay = list(columns), delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", StructType([
            StructField("time", LongType()), StructField("image", StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._last.get()
        before = (held[0], held[1]) if held is not None else None
        news: dict[tuple[int, str], Row] = {}
        for r in rows:
            place = r["__us"], r["__image"]
            if (before is None or place > before) and (place not in news or str(r) < str(news[place])):
                news[place] = r
        if not news:
            return
        if held is not None:
            self._handle.deleteTimer(self._end(held[0]))
        image = held[1] if held is not None else None
        for last, image_here in sorted(news):
            if image_here != image:
                image = image_here
                yield Row(**{c: news[last, image][c] for c in self._columns})
        self._last.update((last, image))
        self._handle.registerTimer(self._end(last))

    def _end(self, micros: int) -> int:
        return micros // 1000 + self._delay

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def drop_redelivery(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str,
                    exclude: Iterable[str] = LINEAGE) -> DataFrame:
    """Drop rows that repeat the current row of their key; a return to an older image is a change.

    Rows of a key are compared in the order of `event_time`, equal times in that
    of their image hashes, within a batch and against the last row of earlier
    batches. Rows older than that are late and lose; a key without rows for
    `delay` is forgotten. Rows without a time, or more than `delay` behind the
    newest, do not arrive. NULL keys are a key. A task holds the distinct images
    and times of one key in one batch, so the size of a batch (files or bytes a
    trigger) bounds what a hot key takes.
    """
    schema, columns = stream.schema, stream.columns
    marked = stream.withColumns({
        "__image": row_hash(row_image(stream, {*exclude, event_time})),
        "__time": F.col(event_time).cast("timestamp"),
        **{f"{_KEY}{i}": F.col(k) for i, k in enumerate(keys)}}).withColumn(
        "__us", F.unix_micros("__time")).where("__us IS NOT NULL").withWatermark("__time", delay)
    delay_ms = int(stream.sparkSession.range(1).select(
        F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {delay})")).first()[0])
    return marked.groupBy(*[f"{_KEY}{i}" for i in range(len(keys))]).transformWithState(
        _Changes(columns, delay_ms), schema, "append", "eventTime")


def latest_state(stream: DataFrame, keys: Sequence[str], wm: str) -> DataFrame:
    """The latest row of each key that moved, as a streaming aggregate in update mode.

    Each task folds its rows to one per key before the shuffle, and state is one
    row per key. A row carries the time of the batch that brought it, so a key
    whose rows of this batch all lost to the row held is not passed on. The
    greater watermark wins, NULL least; ties go to the greater row, equal rows
    to the one that came first.
    """
    row, order = F.struct(*stream.columns), F.struct(F.col(wm), F.struct(*stream.columns), -F.col("__arrived"))
    marked = stream.withColumn("__arrived", F.unix_micros(F.current_timestamp()))
    grouped = marked.groupBy(*keys).agg(
        F.max_by(F.struct(row.alias("row"), "__arrived"), order).alias("__latest"), F.max("__arrived").alias("__now"))
    return grouped.where("__latest.__arrived = __now").select("__latest.row.*")
