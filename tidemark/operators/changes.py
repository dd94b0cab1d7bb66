"""Insert, update and delete events between two images of a keyed table.

A feed is a frame with an `action` column (DELETE carries the row before,
INSERT the row after) and the columns of the table. An update is a DELETE and
an INSERT of one key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.fixed import LINEAGE
from tidemark.functions import bucket_of, key_json, null_safe, row_hash, same_image
from tidemark.operators.silver import latest_per_key
from tidemark.sources.control import ControlTables
from tidemark.sources.readers import read_if_present
from tidemark.sources.schemas import columns
from tidemark.sources.snapshots import Snapshot, SnapshotStore

CHANGE_LOG = columns(
    "logged_at timestamp_ntz, change_type string, key_values string, row_hash_before string, "
    "row_hash_after string, before_image string, after_image string, cdc_timestamp_text string")


def _moved(prev: DataFrame, cur: DataFrame, keys: Sequence[str],
           exclude: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """Rows before and after, as two structs, of every key whose image differs."""
    columns = [*cur.columns, *[c for c in prev.columns if c not in cur.columns]]
    compared = [c for c in columns if c not in {*exclude, *keys}]

    def side(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
        def value(c: str) -> Column:
            return F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType)
        return df.select(F.struct(*[value(c).alias(c) for c in columns]).alias(name),
                         *[F.col(k).alias(f"{name}_{k}") for k in keys])

    before, after = side(prev, cur, "before"), side(cur, prev, "after")
    match = F.lit(True)
    for k in keys:
        match = match & before[f"before_{k}"].eqNullSafe(after[f"after_{k}"])
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    joined = before.join(after, match, "full_outer")
    return (joined.filter(~(both & same_image("before", "after", compared)))
            .select("before", "after"), columns)


def snapshot_diff(prev: DataFrame, cur: DataFrame, keys: Sequence[str],
                  exclude: Iterable[str] = LINEAGE) -> DataFrame:
    """The feed from one image to the next; both are unique on `keys`.

    Rows are compared, not files: a rewritten or re-delivered copy gives no row.
    Columns that only one image has are NULL in the other.
    """
    moved, columns = _moved(prev, cur, keys, exclude)

    def record(action: str, name: str) -> Column:
        fields = [F.col(name)[c].alias(c) for c in columns]
        return F.when(F.col(name).isNotNull(), F.struct(F.lit(action).alias("action"), *fields))

    return moved.select(F.inline(F.array_compact(F.array(
        record("DELETE", "before"), record("INSERT", "after")))))


def image_changes(prev: DataFrame | None, cur: DataFrame, keys: Sequence[str],
                  exclude: Iterable[str] = LINEAGE) -> DataFrame:
    """keys, change_type (I, U, D), before, after between two images unique on `keys`.

    One join; the result equals pairing the feed of `snapshot_diff`. Without an
    earlier image every row is an insert and nothing is shuffled.
    """
    if prev is None:
        row = F.struct(*cur.columns)
        return cur.select(*keys, F.lit("I").alias("change_type"),
                          F.when(F.lit(False), row).alias("before"), row.alias("after"))
    moved, _ = _moved(prev, cur, keys, exclude)
    change = (F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D")
              .otherwise("U"))
    return moved.select(*[F.coalesce(F.col("after"), F.col("before"))[k].alias(k) for k in keys],
                        change.alias("change_type"), "before", "after")


def insert_only(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("action") == "INSERT")


def fold_feed(feed: DataFrame, keys: Sequence[str], wm: str | None = None,
              seq: str | None = None) -> DataFrame:
    """Per key: `before` (row or NULL) and `after` (row or NULL) over the whole feed.

    A key may appear any number of times. With `seq` the first and last record
    in sequence decide; without it the first DELETE and the last INSERT by
    watermark do. Tasks fold their own rows before the shuffle.
    """
    columns = [c for c in feed.columns if c not in {"action", seq}]
    row = F.struct(*columns)
    deleted, inserted = F.col("action") == "DELETE", F.col("action") == "INSERT"
    if seq is not None:
        order = F.struct(F.col(seq), inserted)
        tagged = F.struct(F.col("action").alias("action"), row.alias("row"))
        first, last = F.min_by(tagged, order), F.max_by(tagged, order)
        return (feed.groupBy(*keys).agg(first.alias("first"), last.alias("last"))
                .select(*keys,
                        F.when(F.col("first.action") == "DELETE", F.col("first.row"))
                        .alias("before"),
                        F.when(F.col("last.action") == "INSERT", F.col("last.row"))
                        .alias("after")))
    order = F.struct(F.col(wm), row) if wm else row
    return feed.groupBy(*keys).agg(
        F.min_by(row, F.when(deleted, order)).alias("before"),
        F.max_by(row, F.when(inserted, order)).alias("after"))


def pair_changes(feed: DataFrame, keys: Sequence[str], exclude: Iterable[str] = LINEAGE,
                 wm: str | None = None, seq: str | None = None) -> DataFrame:
    """keys, change_type (I, U, D), before, after; equal images are dropped as re-delivery."""
    columns = [c for c in feed.columns if c not in {"action", seq, *exclude}]
    has_before, has_after = F.col("before").isNotNull(), F.col("after").isNotNull()
    change = (F.when(has_before & has_after,
                     F.when(~same_image("before", "after", columns), "U"))
              .when(has_after, "I").when(has_before, "D"))
    return (fold_feed(feed, keys, wm, seq).withColumn("change_type", change)
            .filter(F.col("change_type").isNotNull())
            .select(*keys, "change_type", "before", "after"))


def as_events(changes: DataFrame, keys: Sequence[str], logged_at: Column,
              exclude: Iterable[str] = LINEAGE, wm: str = "CDC_TIMESTAMP_TEXT") -> DataFrame:
    """Change rows in the form of the log: JSON key and images, SHA-256 of the images."""
    fields = changes.schema["after"].dataType.names
    business = [c for c in fields if c not in set(exclude)]

    def image(side: str) -> Column:
        text = F.to_json(F.struct(*[F.col(side)[c].alias(c) for c in business]),
                         {"ignoreNullFields": "false"})
        return F.when(F.col(side).isNotNull(), text)

    stamp = (F.coalesce(F.col("after")[wm], F.col("before")[wm]).cast("string")
             if wm in fields else F.lit(None).cast("string"))
    return (changes
            .select(logged_at.alias("logged_at"), "change_type",
                    key_json(keys).alias("key_values"), image("before").alias("before_image"),
                    image("after").alias("after_image"), stamp.alias("cdc_timestamp_text"))
            .withColumns({"row_hash_before": row_hash(F.col("before_image")),
                          "row_hash_after": row_hash(F.col("after_image"))})
            .select(*CHANGE_LOG.names))


def change_summary(log: DataFrame) -> DataFrame:
    """Event counts and the first time per drain and object."""
    def of(kind: str) -> Column:
        return F.count_if(F.col("change_type") == kind)
    return log.groupBy("drain_id", "object_name").agg(
        F.min("logged_at").alias("logged_at"), of("I").alias("inserts"),
        of("U").alias("updates"), of("D").alias("deletes"))


# -- applying a feed -----------------------------------------------------------------

def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str],
                  wm: str | None = None, seq: str | None = None) -> DataFrame:
    """The target after the feed: touched keys leave, their last image enters.

    A key with a DELETE and an INSERT converges on the INSERT. AQE broadcasts
    the folded feed when its measured size is small, so that the target is not
    shuffled for a small change. The feed is read twice; write it to a table
    first when it is costly to derive.
    """
    folded = fold_feed(feed.select("action", *([seq] if seq else []), *target.columns),
                       keys, wm, seq)
    touched = folded.select(*[F.col(k).alias(f"__{k}") for k in keys])
    kept = target.join(touched, null_safe(target, touched, keys, "__"), "left_anti")
    entering = folded.filter(F.col("after").isNotNull()).select("after.*")
    return kept.unionByName(entering)


def watermark_feed(source: DataFrame, keys: Sequence[str], wm: str, last: str | None,
                   operation: str | None = None, delete_codes: Sequence[str] = ()) -> DataFrame:
    """Source rows newer than `last`, newest per key, as a feed.

    Deletes are recognised only by codes that were observed and are passed in.
    """
    newer = source if last is None else source.filter(F.col(wm) > F.lit(last))
    latest = latest_per_key(newer, keys, wm)
    if not operation or not delete_codes:
        return latest.withColumn("action", F.lit("INSERT"))
    gone = F.coalesce(F.col(operation).isin(list(delete_codes)), F.lit(False))
    return latest.withColumn("action", F.when(gone, "DELETE").otherwise("INSERT"))


def watermark_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], wm: str,
                    last: str | None, operation: str | None = None,
                    delete_codes: Sequence[str] = ()) -> DataFrame:
    """The exception path: upsert what is newer than the last watermark, by key."""
    return apply_changes(target, watermark_feed(source, keys, wm, last, operation, delete_codes),
                         keys)


def delete_divergence(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: a target larger than its source has missed deletes."""
    return (source.agg(F.count("*").alias("source_rows"))
            .withColumn("target_rows", target.agg(F.count("*")).scalar())
            .withColumn("divergence",
                        F.greatest(F.col("target_rows") - F.col("source_rows"), F.lit(0))))


# -- stored snapshots and the change log -------------------------------------------------

def stored_images(store: SnapshotStore, obj: str, from_id: str | None,
                  to_id: str) -> tuple[DataFrame | None, DataFrame, tuple[str, ...]]:
    """Two stored images, less the buckets that are equal in both, and the keys."""
    before, after = store.find(obj, from_id), store.find(obj, to_id)
    buckets = store.changed_buckets(before, after)
    prev = store.read(obj, before, buckets) if before else None
    return prev, store.read(obj, after, buckets), after.keys


def drain_changes(store: SnapshotStore, control: ControlTables, obj: str, to_id: str,
                  drain_id: str, as_of: Column, exclude: Iterable[str] = LINEAGE,
                  wm: str = "CDC_TIMESTAMP_TEXT") -> int:
    """Log the events since the last committed drain, exactly once. Runs jobs.

    The events of a drain are one folder, written before the drain is
    committed. Readers follow committed drains only; a repeated drain id
    overwrites its folder or, once committed, does nothing.
    """
    done = control.read("drains").filter(F.col("object_name") == obj)
    rows = {r.drain_id: r for r in done.collect()}
    if drain_id in rows:
        return rows[drain_id].events
    from_id = max((r.to_id for r in rows.values()), default=None)
    if from_id == to_id:
        events = 0
    else:
        prev, cur, keys = stored_images(store, obj, from_id, to_id)
        path = f"{control.root}/change_log/object_name={obj}/drain_id={drain_id}"
        as_events(image_changes(prev, cur, keys, exclude), keys, as_of, exclude, wm) \
            .write.mode("overwrite").parquet(path)
        events = store.spark.read.schema(CHANGE_LOG).parquet(path).count()
    record = control.rows("drains", [{"drain_id": drain_id, "object_name": obj,
                                      "from_id": from_id, "to_id": to_id, "events": events}])
    control.append("drains", record.withColumn("logged_at", as_of))
    return events


def change_log(control: ControlTables) -> DataFrame:
    """Events of committed drains, with drain_id and object_name."""
    schema = StructType([*CHANGE_LOG.fields]).add("object_name", "string").add("drain_id", "string")
    log = read_if_present(control.spark, f"{control.root}/change_log", schema)
    committed = control.read("drains").select("object_name", "drain_id")
    return log.join(committed, ["object_name", "drain_id"], "left_semi")


def merge_snapshot(store: SnapshotStore, obj: str, feed: DataFrame, token: str | None = None,
                   wm: str | None = None, seq: str | None = None) -> Snapshot | None:
    """Apply a feed to a stored table, rewriting only the buckets its keys fall in. Runs jobs."""
    head = store.head(obj)
    # Written first, so that the buckets and the rows come of one state of a source that moves.
    # A folder of its own: two merges, or a feed read from an earlier one, do not meet.
    path = f"{store.root}/feeds/{obj}-{uuid.uuid4().hex}"
    feed.write.parquet(path)
    feed = store.spark.read.schema(feed.schema).parquet(path)
    bucket = bucket_of(feed, head.keys, store.buckets)
    touched = {r.bucket for r in feed.select(bucket.alias("bucket")).distinct().collect()}
    if not touched:
        return None
    current = store.read(obj, head, touched)
    return store.write(obj, apply_changes(current, feed, head.keys, wm, seq), head.keys,
                       touched, token)

