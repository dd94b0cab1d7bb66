"""Versioned keyed tables as plain Parquet folders.

A table is a set of key buckets. A snapshot writes only the buckets that
changed. Its commit is one row in one file: it names, for every bucket, the
snapshot that holds it, with the row count and two 64-bit XOR hashes of the
rows. A snapshot becomes visible with that file, so a failed write leaves
nothing behind that a reader sees, and the retry overwrites it.

Sizes on the driver: one row per bucket and one per retained snapshot.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.functions import bucket_of, fingerprint
from tidemark.sources.readers import read_if_present
from tidemark.sources.schemas import columns, local_frame

_ENTRY = columns("bucket int, holder string, n_rows bigint, hash_a bigint, hash_b bigint")
_HEAD = columns(
    "seq bigint, snapshot_id string, parent_id string, action string, token string, "
    "schema_json string, buckets int, keys array<string>")
_COMMIT = StructType([*_HEAD.fields]).add("entries", ArrayType(_ENTRY))


@dataclass(frozen=True)
class Snapshot:
    object_name: str
    seq: int
    snapshot_id: str
    parent_id: str | None
    action: str
    token: str | None
    schema: StructType
    keys: tuple[str, ...]


class SnapshotStore:
    """Snapshots of keyed tables under one root folder; one writer per object."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- reading ---------------------------------------------------------------

    def history(self, obj: str) -> list[Snapshot]:
        """Committed snapshots, oldest first."""
        rows = read_if_present(self.spark, self._commits(obj), _HEAD).collect()
        for r in rows:
            if r.buckets != self.buckets:
                raise ValueError(f"{obj} was written with {r.buckets} buckets")
        return [Snapshot(obj, r.seq, r.snapshot_id, r.parent_id, r.action, r.token,
                         StructType.fromJson(json.loads(r.schema_json)), tuple(r.keys))
                for r in sorted(rows, key=lambda r: r.seq)]

    def head(self, obj: str) -> Snapshot | None:
        snapshots = self.history(obj)
        return snapshots[-1] if snapshots else None

    def find(self, obj: str, snapshot_id: str | None) -> Snapshot | None:
        if snapshot_id is None:
            return None
        for s in self.history(obj):
            if s.snapshot_id == snapshot_id:
                return s
        raise KeyError(f"{obj} has no committed snapshot {snapshot_id}")

    def manifest(self, snapshot: Snapshot) -> DataFrame:
        """bucket, holder, n_rows, hash_a, hash_b."""
        commit = self.spark.read.schema(_COMMIT).parquet(
            f"{self._commits(snapshot.object_name)}/commit={snapshot.seq}")
        return commit.select(F.inline("entries"))

    def read(self, obj: str, snapshot: Snapshot | None = None,
             buckets: set[int] | None = None) -> DataFrame:
        """The image at a snapshot (default the newest), optionally some buckets of it.

        Only the folders of the wanted buckets are listed and scanned.
        """
        snapshot = snapshot or self.head(obj)
        if snapshot is None:
            raise KeyError(f"{obj} has no committed snapshot")
        held = [r for r in self.manifest(snapshot).collect()
                if buckets is None or r.bucket in buckets]
        if not held:
            return self.spark.createDataFrame([], snapshot.schema)
        base = f"{self.root}/data/{obj}"
        paths = [f"{base}/snapshot_id={r.holder}/bucket={r.bucket}" for r in held]
        stored = StructType([*snapshot.schema.fields]).add("snapshot_id", "string") \
                                                     .add("bucket", "integer")
        return (self.spark.read.schema(stored).option("basePath", base).parquet(*paths)
                .drop("snapshot_id", "bucket"))

    def row_count(self, snapshot: Snapshot) -> int:
        return self.manifest(snapshot).agg(F.sum("n_rows").alias("n")).first().n or 0

    def changed_buckets(self, before: Snapshot | None, after: Snapshot) -> set[int]:
        """Buckets whose rows differ between two snapshots of one object."""
        now = self._marks(after)
        then = self._marks(before) if before else {}
        return {b for b in now.keys() | then.keys() if now.get(b) != then.get(b)}

    def _marks(self, snapshot: Snapshot) -> dict[int, tuple]:
        return {r.bucket: (r.n_rows, r.hash_a, r.hash_b)
                for r in self.manifest(snapshot).collect()}

    # -- comparing and writing -------------------------------------------------

    def marks_of(self, hashed: DataFrame) -> DataFrame:
        """Row count and hashes per bucket, from columns bucket, hash_a, hash_b."""
        return hashed.groupBy("bucket").agg(
            F.count("*").alias("n_rows"), F.bit_xor("hash_a").alias("hash_a"),
            F.bit_xor("hash_b").alias("hash_b"))

    def hashed(self, rows: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
        """The rows with their bucket and the two hashes of the whole row."""
        return rows.withColumns({
            "bucket": bucket_of(rows, keys, self.buckets),
            "hash_a": fingerprint(rows, rows.columns),
            "hash_b": fingerprint(rows, rows.columns, 1)})

    def differing(self, snapshot: Snapshot, marks: DataFrame) -> set[int]:
        """Buckets where freshly computed marks disagree with a snapshot."""
        fresh = {r.bucket: (r.n_rows, r.hash_a, r.hash_b) for r in marks.collect()}
        held = self._marks(snapshot)
        return {b for b in fresh.keys() | held.keys() if fresh.get(b) != held.get(b)}

    def write(self, obj: str, rows: DataFrame, keys: tuple[str, ...] | list[str],
              touched: set[int] | None = None, token: str | None = None) -> Snapshot | None:
        """Commit a snapshot; None when the written buckets equal the held ones.

        `rows` is the whole table, or with `touched` all rows of those buckets.
        Marks are computed from the written files, not from `rows`: a live
        source may move between two evaluations of the same frame.
        """
        head = self.head(obj)
        if touched is not None and head is None:
            raise ValueError(f"{obj} has no snapshot to update")
        seq = head.seq + 1 if head else 1
        snapshot_id = f"s{seq:010d}"
        path = f"{self.root}/data/{obj}/snapshot_id={snapshot_id}"
        (rows.withColumn("bucket", bucket_of(rows, keys, self.buckets))
         .hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))

        written = read_if_present(self.spark, path, StructType([*rows.schema.fields])
                                  .add("bucket", "integer"))
        fresh = self.marks_of(self.hashed(written.drop("bucket"), keys))
        entries = {r.bucket: (snapshot_id, r.n_rows, r.hash_a, r.hash_b) for r in fresh.collect()}
        schema = _nullable(rows.schema)
        if touched is not None:
            held = {r.bucket: (r.holder, r.n_rows, r.hash_a, r.hash_b)
                    for r in self.manifest(head).collect()}
            same = all(held.get(b, ())[1:] == entries.get(b, ())[1:] for b in touched)
            if same and head.schema == schema:
                return None
            entries |= {b: e for b, e in held.items() if b not in touched}
        snapshot = Snapshot(obj, seq, snapshot_id, head.snapshot_id if head else None,
                            "FULL" if touched is None else "INCREMENTAL", token, schema,
                            tuple(keys))
        self._commit(snapshot, entries)
        return snapshot

    def _commits(self, obj: str) -> str:
        return f"{self.root}/commits/{obj}"

    def _commit(self, s: Snapshot, entries: dict[int, tuple]) -> None:
        held = [dict(zip(_ENTRY.names, (bucket, *entry))) for bucket, entry in sorted(entries.items())]
        row = {"seq": s.seq, "snapshot_id": s.snapshot_id, "parent_id": s.parent_id,
               "action": s.action, "token": s.token, "schema_json": s.schema.json(),
               "buckets": self.buckets, "keys": list(s.keys), "entries": held}
        (local_frame(self.spark, [row], _COMMIT).coalesce(1)
         .write.mode("overwrite").parquet(f"{self._commits(s.object_name)}/commit={s.seq}"))

    def unreferenced(self, obj: str, keep: int) -> list[str]:
        """Data folders that none of the newest `keep` snapshots refers to."""
        snapshots = self.history(obj)
        used = {r.holder for s in snapshots[-keep:]
                for r in self.manifest(s).select("holder").distinct().collect()}
        return [f"{self.root}/data/{obj}/snapshot_id={s.snapshot_id}"
                for s in snapshots if s.snapshot_id not in used]


def _nullable(schema: StructType) -> StructType:
    """Parquet reads every column back as nullable."""
    text = schema.json().replace('"nullable":false', '"nullable":true')
    return StructType.fromJson(json.loads(text))


def buckets_for(n_rows: int, per_bucket: int = 1_000_000, least: int = 8,
                most: int = 16_384) -> int:
    """A bucket count for a table of this size; a larger bucket is split into several files."""
    return max(least, min(most, -(-n_rows // per_bucket)))
