"""Control-plane frames: registry, declared keys, poll, and the monitoring views.

Inputs named registry, baseline, snapshots, audit and so on are control tables,
whose rows grow with the number of objects and runs. Sources and Silver tables
are only ever aggregated here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidemark.functions import minutes_between, parse_stamp
from tidemark.operators.digests import sided, where_different
from tidemark.operators.grain import keys_agree
from tidemark.operators.profile import declared_keys, union_all
from tidemark.spec import CaptureSpec

STATE = ("last_watermark_text", "last_watermark", "last_run_started", "last_run_status",
         "listing_mark")


def spec_rows(spark, spec: CaptureSpec) -> DataFrame:
    """The spec as registry rows, without run state."""
    rows = [(o.name, o.source, spec.track, spec.watermark, spec.operation, spec.load_type,
             spec.run_id, list(o.keys), o.key_source, o.key_override, o.object_class)
            for o in spec.objects]
    return spark.createDataFrame(rows, """object_name string, source string, track string,
        watermark_column string, operation_column string, load_type_column string,
        run_id_column string, merge_key_columns array<string>, key_source string,
        key_override boolean, object_class string""")


def upsert_registry(registry: DataFrame, spec: DataFrame, as_of: Column) -> DataFrame:
    """Spec columns take the new value, run state is kept, new objects start REGISTERED.

    The target follows the class, so an object that stops being EMPTY gets one.
    An object that left the spec keeps its row.
    """
    old = registry.select(F.col("object_name").alias("__name"),
                          *[F.col(c).alias(f"__{c}") for c in registry.columns
                            if c != "object_name"])
    joined = spec.join(old, F.col("object_name") == F.col("__name"), "full_outer")
    in_spec = F.col("object_name").isNotNull()
    target = F.when(F.col("object_class") != "EMPTY", F.concat(F.lit("SILVER."), F.col("object_name")))

    def column(name: str) -> Column:
        if name in STATE:
            kept = F.col(f"__{name}")
            return F.coalesce(kept, F.lit("REGISTERED")) if name == "last_run_status" else kept
        fresh = {"target": target, "updated_at": as_of}.get(name)
        if fresh is None:
            fresh = F.col(name)
        previous = F.col("__name" if name == "object_name" else f"__{name}")
        return F.when(in_spec, fresh).otherwise(previous)

    return joined.select(*[column(c).alias(c) for c in registry.columns])


def snapshot_declared_keys(registry: DataFrame, key_rows: DataFrame, as_of: Column) -> DataFrame:
    """Every registered object with its declared key at this time, NULL where none is."""
    keys = declared_keys(key_rows)
    return (registry.select("object_name", F.col("source").alias("source_table"))
            .join(keys.withColumnRenamed("table_name", "object_name"), "object_name", "left")
            .select(as_of.alias("checked_at"), "object_name", "source_table", "key_columns",
                    "constraint_name", "rely"))


def seed_key_baseline(baseline: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The baseline with the key recorded where none was; later sightings leave it alone."""
    seen = snapshot.select("object_name", "key_columns", "constraint_name", "checked_at",
                           F.lit(True).alias("__seen"))
    first = F.col("declared_key_recorded_at").isNull() & F.col("__seen").isNotNull()
    return (baseline.join(seen, "object_name", "left")
            .withColumns({
                "declared_key_columns": F.when(first, F.col("key_columns"))
                .otherwise(F.col("declared_key_columns")),
                "declared_key_constraint": F.when(first, F.col("constraint_name"))
                .otherwise(F.col("declared_key_constraint")),
                "declared_key_recorded_at": F.when(first, F.col("checked_at"))
                .otherwise(F.col("declared_key_recorded_at"))})
            .select(*baseline.columns))


def newest_per_object(history: DataFrame, stamp: str = "checked_at") -> DataFrame:
    newest = Window.partitionBy("object_name").orderBy(F.desc(stamp))
    return (history.withColumn("__rn", F.row_number().over(newest))
            .filter(F.col("__rn") == 1).drop("__rn"))


def key_drift(registry: DataFrame, baseline: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Per object: the newest declared key against its baseline and the configured key."""
    latest = newest_per_object(snapshots).select(
        "object_name", F.col("key_columns").alias("declared_key_columns"),
        F.col("constraint_name").alias("declared_constraint"), "checked_at",
        F.lit(True).alias("__checked"))
    base = baseline.select(
        "object_name", F.col("declared_key_columns").alias("baseline_key_columns"),
        F.col("declared_key_constraint").alias("baseline_constraint"),
        F.col("declared_key_recorded_at").isNotNull().alias("__recorded"))
    config = F.array_join("merge_key_columns", ",")
    recorded = F.coalesce("__recorded", F.lit(False))
    declared = F.col("declared_key_columns")
    verdict = (
        F.when(F.col("__checked").isNull(), "NOT_CHECKED")
        .when(recorded & ~F.col("baseline_key_columns").eqNullSafe(declared),
              "DECLARED_KEY_CHANGED")
        .when(declared.isNull(), "NO_DECLARED_KEY")
        .when(~keys_agree(F.col("config_key_columns"), declared),
              F.when(F.coalesce("key_override", F.lit(False)), "OVERRIDDEN")
              .otherwise("CONFIG_DRIFT"))
        .when(recorded & ~F.col("baseline_constraint").eqNullSafe(F.col("declared_constraint")),
              "CONSTRAINT_REPLACED")
        .otherwise("MATCH"))
    return (registry.select("object_name", config.alias("config_key_columns"), "key_source",
                            "key_override")
            .join(latest, "object_name", "left").join(base, "object_name", "left")
            .withColumn("verdict", verdict).drop("__checked", "__recorded"))


def poll_watermark(df: DataFrame, wm: str, newer_than: int | None = None) -> DataFrame:
    """One row: the greatest watermark. Reads one column and never parses it.

    With `newer_than`, in microseconds since 1970, only files modified since then are opened.
    """
    if newer_than is not None:
        df = df.filter(F.col("_metadata.file_modification_time")
                       >= F.timestamp_micros(F.lit(newer_than)))
    return df.agg(F.max(wm).alias("watermark"))


def decide_poll(seen: str | None, polled: str | None, registered: bool = True) -> str:
    """What a poll means: NOT_REGISTERED, NO_SIGNAL, REFRESHED or NO_CHANGE."""
    if not registered:
        return "NOT_REGISTERED"
    if polled is None:
        return "NO_SIGNAL"
    return "REFRESHED" if seen is None or polled > seen else "NO_CHANGE"


def reconcile(source: DataFrame, silver: DataFrame, name: str) -> DataFrame:
    """One row: source rows against Silver rows."""
    s, t = F.col("source_rows"), F.col("silver_rows")
    return (source.agg(F.count("*").alias("source_rows"))
            .withColumn("silver_rows", silver.agg(F.count("*")).scalar())
            .select(F.lit(name).alias("object_name"), "source_rows", "silver_rows",
                    (s - t).alias("difference"),
                    F.when(s == t, "MATCH").otherwise("DIFFERENCE").alias("verdict")))


def reconcile_keys(source: DataFrame, silver: DataFrame, keys: Sequence[str],
                   parts: int | None = None) -> DataFrame:
    """Keys that one side lacks, with the side they are `missing_in`; NULL keys count.

    Equal counts can hide a swap of rows; this cannot. Each task reduces its
    rows to keys before the one shuffle. With `parts`, digests of so many key
    ranges are compared first, in a job that runs at once, and only keys of
    ranges that differ are shuffled: cheap where the sides hold nearly the same
    keys once each, and right also where they do not.
    """
    both = sided(source.select(*keys), silver.select(*keys))
    if parts is not None:
        both = where_different(both, keys, keys, parts)
    seen = both.groupBy(*keys).agg(F.max("__side").alias("__most"), F.min("__side").alias("__least"))
    return (seen.filter(F.col("__most") == F.col("__least"))
            .select(*keys, F.when(F.col("__most") == 1, "silver").otherwise("source")
                    .alias("missing_in")))


def distrusted(validations: DataFrame) -> DataFrame:
    """object_name of those whose newest validation found their metadata UNUSABLE."""
    return (validations.groupBy("object_name")
            .agg(F.max_by("verdict", "checked_at").alias("verdict"))
            .filter(F.col("verdict") == "UNUSABLE").select("object_name"))


def freshness(registry: DataFrame, as_of: Column) -> DataFrame:
    """Minutes behind, counted in minute boundaries, from a UTC `as_of`."""
    stamp = F.coalesce("last_watermark", parse_stamp("last_watermark_text"))
    return (registry.withColumn("last_watermark_utc", stamp)
            .select("object_name", "object_class", "source", "target", "last_watermark_utc",
                    minutes_between("last_watermark_utc", as_of).alias("minutes_behind"),
                    "last_run_status", "last_run_started", "updated_at"))


def stalled(fresh: DataFrame, minutes: int) -> DataFrame:
    """Objects whose source has written nothing for longer than `minutes`."""
    return (fresh.select("object_name", "minutes_behind", "last_run_status")
            .withColumn("stalled", F.coalesce(F.col("minutes_behind") > minutes, F.lit(True))))


def reload_detection(mix: DataFrame, baseline: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registered object: EMPTY, RELOADED, SNAPSHOT_ONLY or MERGING."""
    def of(load: str) -> Column:
        return F.sum(F.when(F.col("load_type") == load, F.col("n_rows")).otherwise(0))
    now = mix.groupBy("object_name").agg(
        F.sum("n_rows").alias("total_rows"), of("initial").alias("initial_rows"),
        of("delta").alias("delta_rows"), F.min("first_seen").alias("current_min_ts_text"),
        F.max("last_seen").alias("current_max_ts_text"))
    base = baseline.select("object_name", F.col("first_initial_ts_text").alias("baseline_ts_text"))
    joined = (registry.select("object_name", "track").join(now, "object_name", "left")
              .join(base, "object_name", "left")
              .fillna(0, ["total_rows", "initial_rows", "delta_rows"]))
    verdict = (
        F.when(F.col("total_rows") == 0, "EMPTY")
        .when(F.col("current_min_ts_text") > F.col("baseline_ts_text"), "RELOADED")
        .when((F.col("track") == "STANDARD") & (F.col("delta_rows") == 0)
              & (F.col("initial_rows") == F.col("total_rows")), "SNAPSHOT_ONLY")
        .otherwise("MERGING"))
    return joined.withColumn("verdict", verdict).drop("track")


def orphans(master: DataFrame, children: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """object_name, orphan_rows: child rows whose key the master lacks; NULL keys are orphans.

    Children are counted per key first, so the join sees each key once however
    many rows hold it.
    """
    known = master.select(*keys).distinct()
    frames = []
    for name, child in children.items():
        counted = child.groupBy(*keys).agg(F.count("*").alias("n_rows"))
        frames.append(counted.join(known, list(keys), "left_anti")
                      .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphan_rows"))
                      .select(F.lit(name).alias("object_name"), "orphan_rows"))
    return union_all(frames)


def unrecorded(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """Refresh outcomes that the audit does not hold yet, by target and end."""
    return rows.join(audit, ["target", "refresh_end"], "left_anti")


def refresh_history(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("refresh_start"), "target")


def unexpected_full(audit: DataFrame) -> DataFrame:
    """FULL refreshes after the first run of a target: the incremental path was lost."""
    first = audit.groupBy("target").agg(F.min("refresh_start").alias("first_start"))
    return (audit.filter(F.col("refresh_action") == "FULL").join(first, "target")
            .filter(F.col("refresh_start") > F.col("first_start")))


def capture_health(fresh: DataFrame, validation: DataFrame, reload: DataFrame, drift: DataFrame,
                   recon: DataFrame) -> DataFrame:
    """One row per object: freshness, latest validation, reload, key and reconcile verdicts."""
    v = newest_per_object(validation).select(
        "object_name", F.col("verdict").alias("metadata_verdict"), "operation_card",
        "operation_max_len", "hash_suffix_seen")
    r = reload.select("object_name", F.col("verdict").alias("reload_verdict"))
    k = drift.select("object_name", F.col("verdict").alias("key_verdict"))
    c = newest_per_object(recon).select(
        "object_name", "source_rows", "silver_rows", F.col("difference").alias("row_difference"),
        F.col("verdict").alias("reconcile_verdict"))
    health = fresh.select("object_name", "object_class", "minutes_behind", "last_run_status")
    for part in (v, r, k, c):
        health = health.join(part, "object_name", "left")
    return health
