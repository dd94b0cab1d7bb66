"""Landed files as a stream: upsert to Silver and log changes.

A pure delete never lands as a file; only a snapshot refresh sees it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.fixed import LINEAGE, STALE_DRAIN_DAYS
from tidemark.functions import fingerprint, null_safe, row_hash, row_image
from tidemark.operators.changes import drain_changes
from tidemark.operators.silver import RefreshResult, add_flags, assert_deterministic, merge_rows
from tidemark.sources.control import ControlTables
from tidemark.sources.snapshots import Snapshot, SnapshotStore
from tidemark.spec import ObjectSpec


def merge_batch(store: SnapshotStore, obj: str, batch: DataFrame, keys: Sequence[str], wm: str,
                token: str, nulls: str = "last", tiebreak: Sequence[str] = ()) -> Snapshot | None:
    """Apply one micro-batch once: a batch whose token is committed already is skipped."""
    done = next((s for s in store.history(obj) if s.token == token), None)
    return done or merge_rows(store, obj, batch, keys, wm, nulls, tiebreak, token)


def stream_upsert(stream: DataFrame, store: SnapshotStore, obj: str, keys: Sequence[str], wm: str,
                  checkpoint: str, name: str = "upsert") -> StreamingQuery:
    """Keep a Silver table current from a stream; drains what has landed, then stops."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(store, obj, batch, keys, wm, f"{name}-{batch_id}")
    return _start(stream, merge, checkpoint)


def stream_capture(stream: DataFrame, store: SnapshotStore, control: ControlTables, obj: ObjectSpec,
                   wm: str, checkpoint: str, as_of: str, nulls: str = "last",
                   name: str = "capture") -> StreamingQuery:
    """`stream_upsert` by a spec: its keys, flags and tiebreak hold, and each batch leaves an audit row.

    The batch's token stands in `state_message`. A batch that is delivered again
    leaves one row; one that fails leaves a FAILED row and ends the stream.
    """
    if obj.object_class == "EMPTY":
        raise ValueError(f"{obj.name} is of class EMPTY: it has no Silver table")
    rows, captured_at = add_flags(stream, obj.flags), datetime.fromisoformat(as_of)
    assert_deterministic(rows)

    def merge(batch: DataFrame, batch_id: int) -> None:
        token, started = f"{name}-{batch_id}", datetime.now(timezone.utc)
        try:
            snapshot = merge_batch(store, obj.name, batch, obj.keys, wm, token, nulls, obj.tiebreak)
        except Exception as error:
            control.append_rows("refresh_audit", [{
                "captured_at": captured_at, "target": obj.name, "state": "FAILED",
                "state_message": f"{token}: {error}", "refresh_start": started,
                "refresh_end": datetime.now(timezone.utc)}])
            raise
        recorded = control.read("refresh_audit").filter(
            (F.col("target") == obj.name) & (F.col("state_message") == token))
        if recorded.isEmpty():
            done = _outcome(store, obj.name, snapshot, started).audit_row(captured_at)
            control.append_rows("refresh_audit", [done | {"state_message": token}])
    return _start(rows, merge, checkpoint)


def _outcome(store: SnapshotStore, target: str, snapshot: Snapshot | None,
             started: datetime) -> RefreshResult:
    ended = datetime.now(timezone.utc)
    if snapshot is None:
        return RefreshResult(target, "NO_DATA", None, 0, started, ended)
    before = store.find(target, snapshot.parent_id)
    return RefreshResult(target, snapshot.action, snapshot.snapshot_id,
                         len(store.changed_buckets(before, snapshot)), started, ended)


def stream_change_log(stream: DataFrame, store: SnapshotStore, control: ControlTables, obj: str,
                      keys: Sequence[str], wm: str, checkpoint: str, as_of: Column,
                      name: str = "log", exclude: Iterable[str] = LINEAGE) -> StreamingQuery:
    """As `stream_upsert`, and log each batch's events under a drain id made from its number."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        token = f"{name}-{batch_id}"
        snapshot = merge_batch(store, obj, batch, keys, wm, token)
        if snapshot is not None:
            drain_changes(store, control, obj, snapshot.snapshot_id, token, as_of, exclude, wm)
    return _start(stream, merge, checkpoint)


def stream_changes(stream: DataFrame, store: SnapshotStore, obj: str, keys: Sequence[str], event_time: str,
                   delay: str, sink: Callable[[DataFrame, int], None], checkpoint: str, name: str = "changes",
                   exclude: Iterable[str] = LINEAGE) -> StreamingQuery:
    """`drop_redelivery` for streams of many rows: gives each batch's changes to `sink`, without Python.

    The Silver table `obj` holds keys, time and image hash of the last row of each
    key, and rows are compared in a window that spills. A batch may reach the sink
    twice, with the same rows: it is compared with the snapshot before its own.
    Lateness and quiet keys count from the newest time of earlier batches; a
    quiet key is overlooked, and its row stays until the key returns.
    """
    micros = int(stream.sparkSession.range(1).select(
        F.expr(f"unix_micros(timestamp_millis(0) + INTERVAL {delay})")).first()[0])
    marks = ["__us", "__image", "__order"]
    marked = stream.withColumns({
        "__us": F.unix_micros(F.col(event_time).cast("timestamp")),
        "__image": row_hash(row_image(stream, {*exclude, event_time})),
        "__order": fingerprint(stream, stream.columns)}).where("__us IS NOT NULL")

    def compare(batch: DataFrame, batch_id: int) -> None:
        token = f"{name}-{batch_id}"
        done = next((s for s in store.history(obj) if s.token == token), None)
        before = store.find(obj, done.parent_id) if done else store.head(obj)
        rows, last = batch.withColumn("__held", F.lit(False)), batch.select(*keys, "__us", "__image")
        if before is not None:
            held = store.read(obj, before)
            start = held.agg(F.max("__us")).first()[0] - micros
            rows, last = rows.where(F.col("__us") > start), last.where(F.col("__us") > start)
            arrived = rows.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            held = held.where(F.col("__us") >= start).join(arrived, null_safe(held, arrived, keys, "__"), "left_semi")
            rows = rows.unionByName(held.withColumn("__held", F.lit(True)), allowMissingColumns=True)
        of_key = Window.partitionBy(*keys)
        in_order = of_key.orderBy("__us", "__image", F.desc("__held"), "__order")
        place = F.struct("__us", "__image")
        changed = (rows.withColumns({"__before": F.lag("__image").over(in_order),
                                     "__from": F.max(F.when(F.col("__held"), place)).over(of_key)})
                   .where(~F.col("__held") & (F.col("__from").isNull() | (place > F.col("__from")))
                          & ~F.col("__image").eqNullSafe(F.col("__before"))))
        sink(changed.select(*[c for c in batch.columns if c not in marks]), batch_id)
        if done is None:
            merge_rows(store, obj, last, keys, "__us", "last", ["__image"], token)
    return _start(marked, compare, checkpoint)


def _start(stream: DataFrame, merge, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drain_staleness(drains: DataFrame, as_of: Column, days: int = STALE_DRAIN_DAYS) -> DataFrame:
    """Per object: days since its last committed drain, WARN beyond the limit."""
    return (drains.groupBy("object_name").agg(F.max("logged_at").alias("last_drain"))
            .withColumn("days_unread", F.datediff(as_of, F.col("last_drain")))
            .withColumn("status", F.when(F.col("days_unread") > days, "WARN").otherwise("PASS")))
