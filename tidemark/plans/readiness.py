"""Assess a set of sources: profile, trust, codes, load mix, merge or reload, costs, a trial, verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import findings, signals, silver
from tidemark.operators.findings import finding
from tidemark.operators.profile import (
    find_watermark, largest, profile_object, share_inventory, standard_signal, union_all,
)
from tidemark.sources.readers import read_source
from tidemark.sources.snapshots import SnapshotStore, buckets_for
from tidemark.sources.workdir import work_dir


@dataclass(frozen=True)
class Trial:
    """An incremental refresh to try: of which object, by which key, from which earlier image.

    Without `before`, the earlier image is all rows but those of the last stamp.
    With `appended`, the second run takes the rows in as added ones, which is how
    a source that only gains rows is read, and wrong for one that loses some.
    """

    object_name: str
    keys: tuple[str, ...]
    before: str | None = None
    appended: bool = False


def assess(spark: SparkSession, sources: dict[str, str], wm_object: str | None = None,
           trial: Trial | None = None) -> DataFrame:
    """One row per check over all readable sources.

    `wm_object` is the object to test for merge and pruning; by default the
    largest custom-track one. A trial writes its object to a working folder
    once and costs what its first load costs; without one, whether the refresh
    is right stays open and the verdict is not READY.
    """
    inventory = share_inventory(spark, sources)
    broken = {r.object_name for r in inventory.filter(F.col("error").isNotNull()).collect()}
    frames = {name: read_source(spark, ref) for name, ref in sources.items() if name not in broken}
    return union_all([findings.share_finding(inventory), *assess_frames(frames, wm_object, trial)])


def assess_frames(frames: dict[str, DataFrame], wm_object: str | None = None,
                  trial: Trial | None = None) -> list[DataFrame]:
    """The findings on frames that could be read."""
    if not frames:
        return []
    profile = union_all([profile_object(name, df, infer=False) for name, df in frames.items()])
    parts = [findings.signal_findings(profile)]
    standard = {n: s for n, df in frames.items() if (s := standard_signal(df.schema))}
    if standard:
        checks = union_all([
            signals.validate_standard(frames[n], s.operation, s.timestamp,
                                      hash_suffixed=s.hash_suffixed, require_hash=True)
            for n, s in standard.items()])
        parts.append(findings.trust_finding(checks))
        codes = union_all([signals.operation_mix({n: frames[n]}, s.operation)
                           for n, s in standard.items()])
        parts.append(findings.operation_finding(signals.operation_summary(codes)))
        parts += _load_finding(frames, standard)
        parts.append(_poll_finding(frames, standard))
        if (name := _largest(profile, "STANDARD")) is not None:
            parts.append(findings.extract_finding(
                signals.pruning_ratio(frames[name], standard[name].timestamp)))
    target = wm_object or _largest(profile, "CUSTOM")
    if target is not None:
        df, wm = frames[target], find_watermark(frames[target].schema)
        merged = signals.merge_or_reload(df, wm)
        parts.append(finding(merged, "signal.merge_or_reload", F.col("status"), F.format_string(
            "%d write day(s)", F.col("write_days"))))
        pruned = signals.pruning_ratio(df, wm)
        parts.append(finding(pruned, "cost.pruning", F.col("status"), F.format_string(
            "%d of %d file(s) touched", F.col("files_touched"), F.col("files_total"))))
    if trial is not None and trial.object_name in frames:
        parts.append(findings.incremental_finding(tried(frames[trial.object_name], trial)))
    return parts


def tried(df: DataFrame, trial: Trial) -> DataFrame:
    """One row: rows that an incremental refresh and a full one do not share. Runs jobs."""
    spark, keys = df.sparkSession, list(trial.keys)
    signal = standard_signal(df.schema)
    wm = signal.timestamp if signal else find_watermark(df.schema)
    if trial.before is None:
        before = df.where(F.col(wm) < df.agg(F.max(wm)).scalar())
    else:
        before = read_source(spark, trial.before)
    store = SnapshotStore(spark, work_dir(spark, "trial"), buckets_for(before.count()))
    silver.refresh_silver(store, trial.object_name, before, keys, wm)
    refresh = silver.append_silver if trial.appended else silver.refresh_silver
    refresh(store, trial.object_name, df, keys, wm)
    return silver.incremental_equals_full(store, trial.object_name, df, keys, wm)


def _largest(profile: DataFrame, track: str) -> str | None:
    row = largest(profile, track).first()
    return row and row.object_name


def _load_finding(frames: dict[str, DataFrame], standard: dict) -> list[DataFrame]:
    mixes = [signals.load_type_mix({n: frames[n]}, s.load_type)
             for n, s in standard.items() if s.load_type]
    if not mixes:
        return []
    mix = union_all(mixes).groupBy("load_type").agg(F.sum("n_rows").alias("n_rows"))
    return [finding(signals.load_type_verdict(mix), "semantics.load_type", F.col("status"),
                    F.format_string("%d row(s)", F.col("n_rows")))]


def _poll_finding(frames: dict[str, DataFrame], standard: dict) -> DataFrame:
    agreed = union_all([signals.text_order_agrees(frames[n], s.timestamp)
                        for n, s in standard.items()])
    rolled = agreed.agg(F.bool_and("orders_agree").alias("agree"))
    return finding(rolled, "cost.poll", F.when(F.col("agree"), "PASS").otherwise("FAIL"),
                   F.lit("greatest text and greatest stamp compared"))
