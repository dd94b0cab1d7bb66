import pytest
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators import control as ops
from tidemark.sources.control import conform
from tidemark.spec import CaptureSpec, ObjectSpec



def now():
    return ntz("2024-02-01 00:01:01")


def spec(*objects):
    return CaptureSpec("CUSTOM", objects, watermark_column="wm")


def test_registry_keeps_state_and_follows_the_class(spark, control):
    first = ops.upsert_registry(control.read("registry"), ops.spec_rows(spark, spec(
        ObjectSpec("A", "a", ("k",)), ObjectSpec("E", "e", ("k",), "EMPTY"))), now())
    control.replace("registry", first.withColumn(
        "last_watermark_text", F.when(F.col("object_name") == "A", "w1")))
    again = ops.upsert_registry(control.read("registry"), ops.spec_rows(spark, spec(
        ObjectSpec("E", "e2", ("k", "l")), ObjectSpec("N", "n", ("k",)))), now())
    got = {r.object_name: r for r in again.collect()}
    assert set(got) == {"A", "E", "N"}
    assert (got["A"].last_watermark_text, got["A"].target) == ("w1", "SILVER.A")
    assert (got["E"].source, got["E"].target, got["E"].merge_key_columns) == (
        "e2", "SILVER.E", ["k", "l"])
    assert got["N"].last_run_status == "REGISTERED"


def test_keyed_tables_are_replaced_and_histories_appended(control):
    control.append_rows("reconciliation", [{"object_name": "A"}])
    control.append_rows("reconciliation", [{"object_name": "B"}])
    assert control.read("reconciliation").count() == 2
    for name in "AB":
        control.replace("object_baseline", control.rows("object_baseline", [{"object_name": name}]))
    assert [r.object_name for r in control.read("object_baseline").collect()] == ["B"]
    with pytest.raises(ValueError):
        control.append("registry", control.read("registry"))
    with pytest.raises(ValueError):
        control.replace("drains", control.read("drains"))


@pytest.mark.parametrize("config,override,baseline,declared,verdict", [
    ("a,b", False, None, "absent", "NOT_CHECKED"),
    ("a,b", False, ("a", "C"), ("a,b", "C"), "DECLARED_KEY_CHANGED"),
    ("a,b", False, ("a,b", "C"), (None, None), "DECLARED_KEY_CHANGED"),
    ("a,b", False, (None, None), (None, None), "NO_DECLARED_KEY"),
    ("a", True, ("a,b", "C"), ("a,b", "C"), "OVERRIDDEN"),
    ("a", False, ("a,b", "C"), ("a,b", "C"), "CONFIG_DRIFT"),
    ("b,a", False, ("a,b", "C"), ("a,b", "D"), "CONSTRAINT_REPLACED"),
    ("b,a", False, ("a,b", "C"), ("a,b", "C"), "MATCH"),
    ("b,a", False, None, ("a,b", "C"), "MATCH"),
])
def test_key_drift_ladder(rows, control, config, override, baseline, declared, verdict):
    registry = conform("registry", rows([("T", config.split(","), override)],
                                        "object_name string, merge_key_columns array<string>, "
                                        "key_override boolean"))
    held = rows([("T", *(baseline or (None, None)), "2024-01-01" if baseline else None)],
                "object_name string, declared_key_columns string, declared_key_constraint string, "
                "declared_key_recorded_at string")
    seen = [] if declared == "absent" else [("T", *declared, "2024-01-02"),
                                            ("T", "old", "OLD", "2024-01-01")]
    snapshots = rows(seen, "object_name string, key_columns string, constraint_name string, "
                           "checked_at string")
    drift = ops.key_drift(registry, conform("object_baseline", held),
                          conform("declared_key_snapshot", snapshots))
    assert drift.first().verdict == verdict


def test_poll_decisions():
    assert ops.decide_poll("a", "b", registered=False) == "NOT_REGISTERED"
    assert ops.decide_poll("a", None) == "NO_SIGNAL"
    assert ops.decide_poll(None, "a") == "REFRESHED"
    assert ops.decide_poll("a", "b") == "REFRESHED"
    assert ops.decide_poll("b", "b") == "NO_CHANGE"


def test_text_is_finer_than_the_parsed_stamp():
    assert ops.decide_poll("2026-06-15T09:41:59,6426580Z", "2026-06-15T09:41:59,6426581Z") == "REFRESHED"


def test_swapped_rows_show_by_key_only(rows):
    source, silver = rows([(1,), (None,), (3,)], "k int"), rows([(1,), (2,), (3,)], "k int")
    assert ops.reconcile(source, silver, "T").first().verdict == "MATCH"
    got = {(r.k, r.missing_in) for r in ops.reconcile_keys(source, silver, ["k"]).collect()}
    assert got == {(None, "silver"), (2, "source")}


def test_orphans_count_null_keys_and_hot_keys(spark, rows):
    master = rows([(1,), (2,)], "k int")
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).when(
        F.col("id") % 3 == 1, 1).cast("int").alias("k"))
    assert ops.orphans(master, {"C": child}, ["k"]).first().orphan_rows == 6000


def test_stalled_and_freshness(rows):
    registry = conform("registry", rows(
        [("A", "2024-02-01T00:00:59,0000000Z"), ("B", None)],
        "object_name string, last_watermark_text string"))
    fresh = ops.freshness(registry, now())
    assert {r.object_name: r.minutes_behind for r in fresh.collect()} == {"A": 1, "B": None}
    assert {r.object_name: r.stalled for r in ops.stalled(fresh, 1).collect()} == {"A": False, "B": True}


def test_full_after_the_first_run_is_unexpected(rows):
    audit = conform("refresh_audit", rows(
        [("A", "FULL", 1), ("A", "INCREMENTAL", 2), ("A", "FULL", 3), ("B", "FULL", 1)],
        "target string, refresh_action string, n int").withColumn(
            "refresh_start", F.timestamp_seconds("n")))
    found = ops.unexpected_full(audit).select("target", F.unix_timestamp("refresh_start").alias("n"))
    assert [tuple(r) for r in found.collect()] == [("A", 3)]
    assert ops.refresh_history(audit).first().target == "A"
