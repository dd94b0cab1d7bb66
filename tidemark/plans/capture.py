"""The capture jobs over one spec. Each call is one run; a workflow tool repeats it."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.fixed import LINEAGE
from tidemark.functions import ntz, parse_stamp
from tidemark.operators import bronze, changes, control as ops, gold as golds, grain, signals, silver
from tidemark.operators.profile import standard_signal, union_all
from tidemark.sources.control import ControlTables
from tidemark.sources.readers import (
    added_files, listing_mark, newest_in, read_files, read_source, record_listing, source_path,
)
from tidemark.sources.snapshots import SnapshotStore
from tidemark.spec import CaptureSpec, ObjectSpec, cdc_objects, silver_objects


class MetadataError(RuntimeError):
    """The change metadata of at least one object can't be trusted; `rows` holds the validations."""

    def __init__(self, rows: list) -> None:
        super().__init__("; ".join(f"{r.object_name}: {r.faults}" for r in rows))
        self.rows = rows


@dataclass
class CycleResult:
    """What one cycle did: status per object, refresh action per table."""

    statuses: dict[str, str] = field(default_factory=dict)
    actions: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def refreshed(self) -> int:
        return sum(s == "REFRESHED" for s in self.statuses.values())


@dataclass(frozen=True)
class _Outcome:
    """What one object's turn in a cycle came to."""

    status: str
    action: str | None = None
    state: dict = field(default_factory=dict)
    audit: dict | None = None
    error: str | None = None


class Capture:
    """A spec bound to a folder that holds its control tables and snapshots."""

    def __init__(self, spark: SparkSession, spec: CaptureSpec, root: str, buckets: int = 256,
                 at_once: int = 8) -> None:
        self.spark = spark
        self.spec = spec
        self.control = ControlTables(spark, root)
        self.store = SnapshotStore(spark, root, buckets)
        self.at_once = at_once

    # -- frames ----------------------------------------------------------------

    def source(self, obj: ObjectSpec) -> DataFrame:
        return read_source(self.spark, obj.source)

    def bronze(self, obj: ObjectSpec, source: DataFrame | None = None) -> DataFrame:
        df = self.source(obj) if source is None else source
        if self.spec.track == "CUSTOM":
            return bronze.bronze_custom(df, self.spec.watermark)
        return bronze.bronze_standard(df, standard_signal(df.schema))

    def silver_rows(self, obj: ObjectSpec, source: DataFrame | None = None) -> DataFrame:
        """Bronze with lineage and flags, still before de-duplication."""
        rows = silver.add_flags(silver.lineage(self.bronze(obj, source)), obj.flags)
        silver.assert_deterministic(rows)
        return rows

    def _silver_watermark(self) -> str:
        return "CDC_TIMESTAMP_TEXT" if self.spec.track == "STANDARD" else self.spec.watermark

    def _not_compared(self) -> tuple[str, ...]:
        """Columns that move on every re-delivery."""
        return LINEAGE if self.spec.track == "STANDARD" else (*LINEAGE, self.spec.watermark)

    def change_mix(self) -> DataFrame:
        frames = {o.name: self.bronze(o) for o in self.spec.objects}
        return bronze.change_mix(frames, self.spec.watermark, self.spec.track, self.spec.operation)

    # -- jobs ------------------------------------------------------------------

    def gate(self, as_of: str, declared: dict[str, tuple[tuple[str, ...], str]] | None = None) -> None:
        """Raise unless every key is the grain of its object and all change metadata can be trusted.

        `declared` is that of `verify_grain`. Keys are counted in one scan of the
        key columns, metadata in one of its own columns, and the validation is
        recorded; nothing else is written.
        """
        grain.assert_grain(self.verify_grain(declared))
        unusable = self.validate(as_of).filter(F.col("verdict") == "UNUSABLE").collect()
        if unusable:
            raise MetadataError(unusable)

    def build(self, as_of: str,
              declared: dict[str, tuple[tuple[str, ...], str]] | None = None) -> CycleResult:
        """The gate, then registration and the first cycle.

        A log that holds several rows of a key by design has no grain to verify:
        it goes by `register` and `cycle`.
        """
        self.gate(as_of, declared)
        self.register(as_of)
        return self.cycle(as_of)

    def register(self, as_of: str) -> None:
        registry = ops.upsert_registry(self.control.read("registry"),
                                       ops.spec_rows(self.spark, self.spec), ntz(as_of))
        self.control.replace("registry", registry)

    def poll(self, obj: ObjectSpec, seen: dict) -> tuple[str, str | None, str | None]:
        """Status, watermark text and listing mark.

        An unchanged file listing costs no scan, a changed one a scan of one
        column over the files that are newer than the last listing.
        """
        path = source_path(obj.source)
        mark = listing_mark(self.spark, path) if path else None
        text = seen["last_watermark_text"]
        if mark is None or mark != seen["listing_mark"]:
            newest = newest_in(seen["listing_mark"]) if mark and text else None
            polled = ops.poll_watermark(self.source(obj), self.spec.watermark, newest)
            found = polled.select(bronze.watermark_text("watermark", self.spec.track)
                                  .alias("text")).first().text
            text = found if newest is None or (found and found > text) else text
        return ops.decide_poll(seen["last_watermark_text"], text), text, mark

    def refresh(self, obj: ObjectSpec, last_mark: str | None = None,
                mark: str | None = None) -> silver.RefreshResult:
        """Bring Silver up to date. Where files were only added since `last_mark`, only they are read.

        The listing is recorded before the source is opened: a file that lands in
        between may be read twice, which changes nothing, but is never skipped.
        """
        added = self._added(obj, last_mark, mark) if mark is not None else None
        if added == []:
            return self._untouched(obj)
        source, head = self.source(obj), self.store.head(obj.name)
        rows, run = self.silver_rows(obj, source), silver.refresh_silver
        if added and head and head.schema.names == rows.columns:
            files = read_files(self.spark, obj.source, added, source.schema)
            rows, run = self.silver_rows(obj, files), silver.append_silver
        return run(self.store, obj.name, rows, obj.keys, self._silver_watermark(),
                   tiebreak=obj.tiebreak)

    def _added(self, obj: ObjectSpec, last_mark: str | None, mark: str) -> list[str] | None:
        """Files added since the last refresh; None where that is unknown or files left."""
        listing = record_listing(self.spark, source_path(obj.source), self._listing(obj, mark))
        if last_mark is None or last_mark == mark:
            return None
        return added_files(self.spark.read.parquet(self._listing(obj, last_mark)), listing)

    def _listing(self, obj: ObjectSpec, mark: str) -> str:
        return f"{self.control.root}/listings/{obj.name}/{hashlib.sha256(mark.encode()).hexdigest()}"

    def _untouched(self, obj: ObjectSpec) -> silver.RefreshResult:
        now = datetime.now(timezone.utc)
        return silver.RefreshResult(obj.name, "NO_DATA", self.store.head(obj.name).snapshot_id, 0,
                                    now, now)

    def _capture_one(self, obj: ObjectSpec, seen: dict, now: datetime) -> _Outcome:
        """Poll one object and refresh it if it moved or fell due; never raises."""
        started = datetime.now(timezone.utc)
        try:
            status, text, mark = self.poll(obj, seen)
        except Exception as error:
            return _Outcome("ERROR", error=str(error))
        due = status == "NO_CHANGE" and silver.refresh_due(
            seen["last_run_started"], obj.lag_hours, now)
        if status != "REFRESHED" and not due:
            return _Outcome(status)
        # The held mark was taken by the last refresh: the same files hold the same rows.
        same_files = due and mark is not None and mark == seen["listing_mark"]
        try:
            done = self._untouched(obj) if same_files else self.refresh(
                obj, seen["listing_mark"], mark)
        except Exception as error:
            failed = {"captured_at": now, "target": obj.name, "state": "FAILED",
                      "state_message": str(error), "refresh_start": started,
                      "refresh_end": datetime.now(timezone.utc)}
            return _Outcome("ERROR", audit=failed, error=str(error))
        if due and done.action != "NO_DATA":
            status = "REFRESHED"
        state = {"last_watermark_text": text, "last_run_started": now, "listing_mark": mark}
        return _Outcome(status, done.action, state, done.audit_row(now))

    def cycle(self, as_of: str) -> CycleResult:
        """Poll every captured object, refresh what moved or fell due, then Gold, then the audit.

        Objects run side by side, so that small ones fill the gaps of large
        ones. One that fails is recorded as ERROR and does not stop the others.
        One whose newest validation is UNUSABLE is recorded as that and keeps
        what it holds until a validation finds its metadata usable again.
        """
        now = datetime.fromisoformat(as_of)
        state = {r.object_name: r.asDict() for r in self.control.read("registry").collect()}
        objects = [o for o in silver_objects(self.spec) if o.name in state]
        stopped = {r.object_name for r in
                   ops.distrusted(self.control.read("metadata_validation")).collect()}

        def turn(obj: ObjectSpec) -> _Outcome:
            if obj.name in stopped:
                return _Outcome("UNUSABLE")
            return self._capture_one(obj, state[obj.name], now)

        with ThreadPoolExecutor(self.at_once) as pool:
            outcomes = list(pool.map(turn, objects))

        result = CycleResult()
        for obj, outcome in zip(objects, outcomes):
            state[obj.name] |= {**outcome.state, "last_run_status": outcome.status,
                                "updated_at": now}
            result.statuses[obj.name] = outcome.status
            if outcome.action:
                result.actions[obj.name] = outcome.action
            if outcome.error:
                result.errors[obj.name] = outcome.error

        registry = self.control.rows("registry", list(state.values())) \
            .withColumn("last_watermark", parse_stamp("last_watermark_text"))
        self.control.replace("registry", registry)
        self._record([o.audit for o in outcomes if o.audit])
        self._record([row for g in self.spec.gold if (row := self._gold_one(g, now, result))])
        return result

    def _gold_one(self, gold: golds.GoldDef, now: datetime, result: CycleResult) -> dict | None:
        """Refresh one Gold table, never raising; its audit row unless its inputs had not moved."""
        if not all(self.store.head(name) for name in gold.inputs):
            return None
        row = {"captured_at": now, "target": gold.name, "refresh_start": datetime.now(timezone.utc)}
        try:
            action = golds.refresh_gold(self.store, gold)
        except Exception as error:
            result.statuses[gold.name] = "ERROR"
            result.errors[gold.name] = str(error)
            return row | {"state": "FAILED", "state_message": str(error),
                          "refresh_end": datetime.now(timezone.utc)}
        result.actions[gold.name] = action
        if action == "NO_DATA":
            return None
        end = datetime.now(timezone.utc)
        return row | {"refresh_action": action, "state": "SUCCEEDED", "refresh_end": end,
                      "duration_ms": int((end - row["refresh_start"]) / timedelta(milliseconds=1))}

    def _record(self, audit: list[dict]) -> None:
        if audit:
            self.control.append("refresh_audit", ops.unrecorded(
                self.control.read("refresh_audit"), self.control.rows("refresh_audit", audit)))

    def drain(self, drain_id: str, as_of: str) -> dict[str, int]:
        """Log the changes of every object with a change log since its last drain."""
        events = {}
        for obj in cdc_objects(self.spec):
            head = self.store.head(obj.name)
            if head is not None:
                events[obj.name] = changes.drain_changes(
                    self.store, self.control, obj.name, head.snapshot_id, drain_id, ntz(as_of),
                    self._not_compared(), self._silver_watermark())
        return events

    def verify_grain(self, declared: dict[str, tuple[tuple[str, ...], str]] | None = None) -> DataFrame:
        """Verdict per object; `declared` maps an object to its declared key and constraint."""
        declared = declared or {}
        return union_all([
            grain.verify_grain(self.source(o), o, *declared.get(o.name, (None, None)))
            for o in self.spec.objects])

    def validate(self, as_of: str) -> DataFrame:
        """Append one validation row per object and return the rows of this run."""
        frames = []
        for o in self.spec.objects:
            df = self.source(o)
            if self.spec.track == "STANDARD":
                signal = standard_signal(df.schema)
                checked = signals.validate_standard(
                    df, signal.operation, signal.timestamp, signal.load_type,
                    hash_suffixed=signal.hash_suffixed)
            else:
                checked = signals.validate_custom(df, self.spec.watermark)
            frames.append(checked.withColumns({
                "object_name": F.lit(o.name), "source": F.lit(o.source),
                "track": F.lit(self.spec.track), "checked_at": ntz(as_of)}))
        self.control.append("metadata_validation", union_all(frames))
        return self.control.read("metadata_validation").filter(F.col("checked_at") == ntz(as_of))

    def record_keys(self, key_rows: DataFrame, as_of: str) -> None:
        """Snapshot declared keys; `key_rows` names tables by their object name."""
        snapshot = ops.snapshot_declared_keys(self.control.read("registry"), key_rows, ntz(as_of))
        self.control.append("declared_key_snapshot", snapshot)
        latest = self.control.read("declared_key_snapshot").filter(
            F.col("checked_at") == ntz(as_of))
        self.control.replace("object_baseline", ops.seed_key_baseline(
            self.control.read("object_baseline"), latest))

    def seed_baseline(self, as_of: str) -> None:
        baseline = self.control.read("object_baseline")
        fresh = signals.seed_reload_baseline(baseline, self.change_mix(), ntz(as_of))
        self.control.replace("object_baseline",
                             baseline.unionByName(fresh, allowMissingColumns=True))

    def reconcile(self, as_of: str) -> DataFrame:
        """Append one row per Silver table that exists and return the rows of this run."""
        frames = [ops.reconcile(self.source(o), self.store.read(o.name), o.name)
                  for o in silver_objects(self.spec) if self.store.head(o.name)]
        if frames:
            self.control.append("reconciliation",
                                union_all(frames).withColumn("checked_at", ntz(as_of)))
        return self.control.read("reconciliation").filter(F.col("checked_at") == ntz(as_of))

    def daily_assurance(self, as_of: str, key_rows: DataFrame | None = None) -> dict[str, int]:
        """Validate metadata, seed baselines, record keys and reconcile; objects found at fault by each."""
        unusable = self.validate(as_of).filter(F.col("verdict") == "UNUSABLE").count()
        self.seed_baseline(as_of)
        drifted = 0
        if key_rows is not None:
            self.record_keys(key_rows, as_of)
            drifted = self.key_drift().filter(
                F.col("verdict").isin("CONFIG_DRIFT", "DECLARED_KEY_CHANGED")).count()
        differing = self.reconcile(as_of).filter(F.col("verdict") == "DIFFERENCE").count()
        return {"metadata_unusable": unusable, "keys_drifted": drifted, "counts_differ": differing}

    # -- monitoring ------------------------------------------------------------

    def key_drift(self) -> DataFrame:
        return ops.key_drift(self.control.read("registry"), self.control.read("object_baseline"),
                             self.control.read("declared_key_snapshot"))

    def freshness(self, as_of: str) -> DataFrame:
        return ops.freshness(self.control.read("registry"), ntz(as_of))

    def reload_detection(self) -> DataFrame:
        return ops.reload_detection(self.change_mix(), self.control.read("object_baseline"),
                                    self.control.read("registry"))

    def orphans(self) -> DataFrame:
        rule = self.spec.referential
        return ops.orphans(self.store.read(rule.master),
                           {c: self.store.read(c) for c in rule.children}, rule.keys)

    def health(self, as_of: str) -> DataFrame:
        return ops.capture_health(
            self.freshness(as_of), self.control.read("metadata_validation"),
            self.reload_detection(), self.key_drift(), self.control.read("reconciliation"))
