"""Readiness findings: one row per check, folded into one verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.fixed import PRUNE_PARTIAL

FINDING = "check string, status string, detail string"


def finding(rows: DataFrame, check: str, status: Column, detail: Column) -> DataFrame:
    """A one-row aggregate as a finding."""
    return rows.select(F.lit(check).alias("check"), status.alias("status"),
                       detail.alias("detail"))


def share_finding(inventory: DataFrame) -> DataFrame:
    """Objects that could be read against objects that could not."""
    counted = inventory.agg(
        F.count_distinct("object_name").alias("objects"),
        F.count_distinct(F.when(F.col("error").isNotNull(), F.col("object_name"))).alias("broken"))
    readable = F.col("objects") - F.col("broken")
    status = F.when(readable == 0, "FAIL").otherwise("PASS")
    return finding(counted, "share.present", status, F.format_string(
        "%d readable, %d unreadable", readable, F.col("broken")))


def signal_findings(profile: DataFrame) -> DataFrame:
    """Findings on the change signal: `signal.watermark` and `signal.standard`."""
    per_track = profile.agg(
        F.count_if(F.col("track") == "STANDARD").alias("standard"),
        F.count_if((F.col("track") == "STANDARD") & F.col("flow_hash").isNotNull()).alias("hashed"),
        F.count_if(F.col("track") == "CUSTOM").alias("custom"),
        F.count_if(F.col("track") == "NONE").alias("silent"))
    std, custom, silent = F.col("standard"), F.col("custom"), F.col("silent")
    watermark = finding(
        per_track, "signal.watermark",
        F.when((custom == 0) & (std > 0), "INFO").when(custom == 0, "FAIL")
        .when(silent > 0, "WARN").otherwise("PASS"),
        F.format_string("%d by timestamp, %d by the standard track, %d without a signal",
                        custom, std, silent))
    standard = finding(
        per_track, "signal.standard",
        F.when(std == 0, "INFO").when(F.col("hashed") == std, "PASS").otherwise("WARN"),
        F.format_string("%d standard object(s), %d with a flow hash", std, F.col("hashed")))
    return watermark.unionByName(standard)


def trust_finding(validations: DataFrame) -> DataFrame:
    """FAIL when any standard object has unusable metadata, WARN when none has rows."""
    counted = validations.agg(
        F.count_if(F.col("verdict") != "EMPTY").alias("checked"),
        F.count_if(F.col("verdict") == "UNUSABLE").alias("unusable"))
    status = (F.when(F.col("checked") == 0, "WARN").when(F.col("unusable") > 0, "FAIL")
              .otherwise("PASS"))
    return finding(counted, "semantics.trustworthy", status, F.format_string(
        "%d of %d standard object(s) unusable", F.col("unusable"), F.col("checked")))


def operation_finding(summary: DataFrame) -> DataFrame:
    """Whether deletes can be applied: INFO, for a code that was never seen may still come."""
    deletes = F.when(F.col("delete_code_seen"), "deletes can be applied").otherwise(
        "no delete code seen, deletes have to be found by comparing keys")
    return finding(summary, "semantics.operation", F.lit("INFO"), F.format_string(
        "%d code(s) on %d object(s); %s", F.col("operations"), F.col("objects"), deletes))


def extract_finding(pruned: DataFrame) -> DataFrame:
    """What reading the last batch costs on the standard track: WARN from a third of the bytes, or unmeasured."""
    cheap = (F.col("files_touched") > 0) & (F.col("ratio") < PRUNE_PARTIAL)
    return finding(pruned, "cost.extract", F.when(cheap, "PASS").otherwise("WARN"), F.format_string(
        "%d of %d byte(s) touched", F.col("bytes_touched"), F.col("bytes_total")))


def incremental_finding(compared: DataFrame) -> DataFrame:
    """Whether an incremental refresh gave what a full one gives; `compared` as of `row_differences`."""
    return finding(compared, "refresh.incremental", F.when(F.col("equal"), "PASS").otherwise("FAIL"),
                   F.format_string("%d row(s) missing, %d too many", F.col("only_in_full"),
                                   F.col("only_in_held")))


def readiness_verdict(findings: DataFrame) -> DataFrame:
    """One row: verdict and reasons, from the status of each check.

    Checks used: share.present, signal.watermark, signal.standard,
    semantics.trustworthy, semantics.load_type, signal.merge_or_reload,
    cost.poll, cost.extract, cost.pruning, and refresh.incremental (the
    incremental result equals a full one). A missing check is NULL.
    """
    def status(check: str) -> Column:
        return F.max(F.when(F.col("check") == check, F.col("status")))

    one = findings.agg(*[status(check).alias(name) for name, check in {
        "present": "share.present", "wm": "signal.watermark", "std": "signal.standard",
        "trust": "semantics.trustworthy", "load": "semantics.load_type",
        "merge": "signal.merge_or_reload", "poll": "cost.poll", "extract": "cost.extract",
        "prune": "cost.pruning", "incremental": "refresh.incremental"}.items()])

    def is_(name: str, *values: str) -> Column:
        return F.coalesce(F.col(name).isin(*values), F.lit(False))

    usable = is_("wm", "PASS") | is_("trust", "PASS")
    verdict = (
        F.when(~is_("present", "PASS"), "NOT ASSESSABLE")
        .when(is_("trust", "FAIL") & ~is_("wm", "PASS"), "NOT READY")
        .when(is_("incremental", "PASS"), "READY")
        .when(is_("incremental", "FAIL") & usable & is_("prune", "PASS", "WARN"),
              "READY WITH CAVEATS")
        .when(~usable, "NOT READY")
        .otherwise("READY WITH CAVEATS"))
    reasons = F.concat_ws(
        "; ",
        F.when(is_("incremental", "PASS"), "incremental refresh equals a full one"),
        F.when(is_("trust", "FAIL"), "standard metadata is unusable on some objects"),
        F.when(~usable, "no usable change signal"),
        F.when(is_("std", "PASS") & is_("poll", "PASS"), "the raw watermark text can be polled"),
        F.when(is_("std", "WARN"), "some objects look like copies"),
        F.when(is_("extract", "WARN"), "extracting a change reads most of the object"),
        F.when(is_("load", "PASS"), "a snapshot and deltas have landed"),
        F.when(is_("merge", "WARN") & ~is_("load", "PASS"), "merge or reload is unresolved"))
    return one.select(verdict.alias("verdict"), reasons.alias("reasons"))


def write_findings(findings: DataFrame, path: str, fmt: str = "json") -> None:
    """Write the findings; one row per check, so one file."""
    findings.coalesce(1).write.mode("overwrite").format(fmt).save(path)
