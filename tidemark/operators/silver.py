"""Silver: the latest row per key, with lineage under stable names and quality flags."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidemark.fixed import OPERATION, TIMESTAMP
from tidemark.functions import bucket_of, fingerprint, null_safe
from tidemark.functions.rules import Rule
from tidemark.operators.digests import sided, where_different
from tidemark.sources.snapshots import Snapshot, SnapshotStore



class SchemaDrift(RuntimeError):
    """A stored column disappeared or changed its type."""


def latest_order(wm: str, nulls: str = "last", tiebreak: Sequence[Column] = ()) -> list[Column]:
    newest = F.col(wm).desc_nulls_first() if nulls == "first" else F.col(wm).desc_nulls_last()
    return [newest, *tiebreak]


def latest_per_key(df: DataFrame, keys: Sequence[str], wm: str, nulls: str = "last",
                   tiebreak: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the greatest watermark, then the tiebreak, then the row's hash.

    Spark limits each task to one row per key before the shuffle (the plan shows
    a partial WindowGroupLimit), so a key with most of the rows costs no more
    than any other. NULL keys form one group. By default a NULL watermark loses.
    """
    order = latest_order(wm, nulls, [*tiebreak, F.desc("__a"), F.desc("__b")])
    hashed = df.withColumns({"__a": fingerprint(df, df.columns),
                             "__b": fingerprint(df, df.columns, 1)})
    return (hashed.withColumn("__rn", F.row_number().over(
                Window.partitionBy(*keys).orderBy(*order)))
            .filter(F.col("__rn") == 1).drop("__rn", "__a", "__b"))


def delta_first(load_type: str = "CDC_LOAD_TYPE") -> Column:
    """Tiebreak: at one stamp a delta replaces an initial-load row."""
    return (F.col(load_type) == "initial").asc_nulls_last()


def lineage(bronze: DataFrame) -> DataFrame:
    """Metadata under the CDC_ names, after the business columns."""
    renames = {OPERATION: "CDC_OPERATION", "LOAD_TYPE": "CDC_LOAD_TYPE", "RUN_ID": "CDC_RUN_ID",
               TIMESTAMP: "CDC_TIMESTAMP_TEXT"}
    moved = {**{k: v for k, v in renames.items() if k in bronze.columns},
             "CDC_TIMESTAMP_UTC": "CDC_TIMESTAMP_UTC"}
    business = [c for c in bronze.columns if c not in moved]
    return bronze.select(*business, *[F.col(k).alias(v) for k, v in moved.items()])


def add_flags(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Flags by name; a rule on the wrong column type raises here, not on the first row."""
    return df.withColumns({name: rule(df.schema) for name, rule in rules.items()}) if rules else df


#: Expressions that Spark takes for constant within a query, and that differ between queries.
_OF_THE_QUERY = {"CurrentDate", "CurrentTime", "CurrentTimestamp", "Now", "LocalTimestamp", "CurrentTimeZone",
                 "CurrentUser", "CurrentDatabase", "CurrentCatalog"}


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _volatile(plan) -> Iterator[str]:
    """Names of the expressions of an analysed plan that give other values in another run."""
    plans, expressions = [plan], []
    while plans:
        node = plans.pop()
        for inner in (node.children(), node.innerChildren(), node.subqueries()):
            plans += [p for p in _each(inner) if hasattr(p, "expressions")]
        expressions += list(_each(node.expressions()))
    while expressions:
        e = expressions.pop()
        name = e.getClass().getSimpleName()
        if name in _OF_THE_QUERY:
            yield e.prettyName()
        below = list(_each(e.children()))
        if not e.deterministic() and all(b.deterministic() for b in below):
            yield e.prettyName()
        expressions += below


def assert_deterministic(df: DataFrame) -> None:
    """Reject a definition that reads the clock, the session or a random source, in a subquery too."""
    found = next(_volatile(df._jdf.queryExecution().analyzed()), None)
    if found:
        raise ValueError(f"not deterministic: {found}; pass the time in as as_of")


@dataclass(frozen=True)
class RefreshResult:
    target: str
    action: str
    snapshot_id: str | None
    buckets_written: int
    started: datetime
    ended: datetime

    def audit_row(self, captured_at: datetime) -> dict:
        return {"captured_at": captured_at, "target": self.target, "refresh_action": self.action,
                "state": "SUCCEEDED", "refresh_start": self.started, "refresh_end": self.ended,
                "duration_ms": int((self.ended - self.started) / timedelta(milliseconds=1)),
                "buckets_written": self.buckets_written}


def refresh_silver(store: SnapshotStore, target: str, rows: DataFrame, keys: Sequence[str],
                   wm: str, nulls: str = "last", tiebreak: Sequence[str] = ()) -> RefreshResult:
    """Bring a Silver table up to date with `rows`, writing only buckets that changed.

    A first pass shuffles keys, watermark and row hashes, never whole rows, and
    finds the buckets whose content differs from the held snapshot. Deletes show
    there, since a missing row changes its bucket. The second pass filters the
    source to those buckets before its shuffle. Runs jobs.
    """
    started = datetime.now(timezone.utc)
    head = store.head(target)
    order = [F.col(c).desc_nulls_last() for c in tiebreak]
    touched: set[int] | None = None
    if head is not None and _same_columns(head.schema, rows.schema):
        narrow = store.hashed(rows, keys).select(
            *dict.fromkeys([*keys, wm, *tiebreak, "bucket", "hash_a", "hash_b"]))
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(
            *latest_order(wm, nulls, [*order, F.desc("hash_a"), F.desc("hash_b")])))
        kept = narrow.withColumn("__rn", ranked).filter(F.col("__rn") == 1)
        touched = store.differing(head, store.marks_of(kept))
        if not touched:
            return RefreshResult(target, "NO_DATA", head.snapshot_id, 0, started,
                                 datetime.now(timezone.utc))
        rows = rows.filter(bucket_of(rows, keys, store.buckets).isin(sorted(touched)))
    snapshot = store.write(target, latest_per_key(rows, keys, wm, nulls, order), keys, touched)
    ended = datetime.now(timezone.utc)
    if snapshot is None:
        return RefreshResult(target, "NO_DATA", head.snapshot_id, 0, started, ended)
    return RefreshResult(target, snapshot.action, snapshot.snapshot_id,
                         store.buckets if touched is None else len(touched), started, ended)


def merge_rows(store: SnapshotStore, target: str, rows: DataFrame, keys: Sequence[str], wm: str,
               nulls: str = "last", tiebreak: Sequence[str] = (),
               token: str | None = None) -> Snapshot | None:
    """Bring added rows into a Silver table; None when they change nothing. Runs jobs.

    The result is what a refresh over all rows would give, as long as rows were
    only added: the latest row of a key wins whatever the order of arrival. Only
    keys that arrived are ranked; AQE broadcasts them when they measure small,
    and then the held rows are not shuffled to be compared.
    """
    order = [F.col(c).desc_nulls_last() for c in tiebreak]
    head = store.head(target)
    if head is None:
        return store.write(target, latest_per_key(rows, keys, wm, nulls, order), keys, None, token)
    fresh = latest_per_key(rows, keys, wm, nulls, order).persist()
    try:
        bucket = bucket_of(fresh, keys, store.buckets).alias("bucket")
        touched = {r.bucket for r in fresh.select(bucket).distinct().collect()}
        if not touched:
            return None
        held = store.read(target, head, touched)
        arrived = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys])
        match = null_safe(held, arrived, keys, "__")
        rivals = held.join(arrived, match, "left_semi")
        won = latest_per_key(rivals.unionByName(fresh), keys, wm, nulls, order)
        kept = held.join(arrived, match, "left_anti")
        return store.write(target, kept.unionByName(won), keys, touched, token)
    finally:
        fresh.unpersist()


def append_silver(store: SnapshotStore, target: str, rows: DataFrame, keys: Sequence[str],
                  wm: str, nulls: str = "last", tiebreak: Sequence[str] = ()) -> RefreshResult:
    """`merge_rows` as a refresh: for a source that only gained the given rows."""
    started = datetime.now(timezone.utc)
    held = store.head(target)
    snapshot = merge_rows(store, target, rows, keys, wm, nulls, tiebreak)
    written = 0 if snapshot is None else len(store.changed_buckets(held, snapshot))
    return RefreshResult(target, "NO_DATA" if snapshot is None else snapshot.action,
                         (snapshot or held).snapshot_id, written, started,
                         datetime.now(timezone.utc))


def _same_columns(held, fresh) -> bool:
    """True when equal; an added column asks for a full write; a lost one raises."""
    now = {f.name: f.dataType for f in fresh.fields}
    for f in held.fields:
        if now.get(f.name) != f.dataType:
            raise SchemaDrift(f"column {f.name} was {f.dataType.simpleString()}, "
                              f"now {now[f.name].simpleString() if f.name in now else 'missing'}")
    return len(now) == len(held.fields)


def refresh_due(last_success: datetime | None, lag_hours: float | None, as_of: datetime) -> bool:
    """Whether the staleness backstop asks for a refresh although the watermark stands still.

    A pure delete does not move the watermark; this is what catches it.
    """
    if lag_hours is None:
        return False
    return last_success is None or last_success + timedelta(hours=lag_hours) <= as_of


def incremental_equals_full(store: SnapshotStore, target: str, rows: DataFrame,
                            keys: Sequence[str], wm: str, nulls: str = "last",
                            tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row: how many rows the held table and a full recomputation do not share.

    Both are compared by key range first, so a table that agrees is not shuffled.
    """
    full = latest_per_key(rows, keys, wm, nulls, [F.col(c).desc_nulls_last() for c in tiebreak])
    held = store.read(target).select(*full.columns)
    return row_differences(full, held, "only_in_full", "only_in_held", keys)


def row_differences(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """One row: rows (with repeats) on one side only; one shuffle, combined per task.

    With `keys` only the key ranges that differ are shuffled, found by a job that runs at once.
    """
    columns, both = left.columns, sided(left, right)
    if keys:
        both = where_different(both, keys, columns)
    surplus = both.groupBy(*columns).agg(F.sum("__side").alias("__n"))
    total = surplus.agg(
        F.coalesce(F.sum(F.when(F.col("__n") > 0, F.col("__n"))), F.lit(0)).alias(left_name),
        F.coalesce(F.sum(F.when(F.col("__n") < 0, -F.col("__n"))), F.lit(0)).alias(right_name))
    return total.withColumn("equal", (F.col(left_name) == 0) & (F.col(right_name) == 0))
