import pytest
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators import findings, keys, signals as ops
from tidemark.plans.readiness import assess_frames
from tidemark.queries.data import events_custom, events_standard

STD = "op string, ts string, load string"
GOOD = "2026-06-15T09:41:59,6426580Z"


@pytest.mark.parametrize("data,verdict,fault", [
    ([], "EMPTY", None),
    ([("L", GOOD, "initial"), ("A", GOOD, "delta"), (None, None, None)], "USABLE", None),
    ([("title", GOOD, "initial")], "UNUSABLE", "operation column is not a change code"),
    ([("L", "bad", "initial")], "UNUSABLE", "timestamp column does not parse"),
    ([("X", GOOD, "X")], "UNUSABLE", "metadata columns hold the same value"),
    ([("X", "X", "initial")], "UNUSABLE",
     "timestamp column does not parse; metadata columns hold the same value"),
])
def test_standard_verdicts(rows, data, verdict, fault):
    r = ops.validate_standard(rows(data, STD), "op", "ts", "load").first()
    assert (r.verdict, r.faults) == (verdict, fault)


def test_too_many_codes(rows):
    df = rows([(f"{i:x}", GOOD, "delta") for i in range(13)], STD)
    assert ops.validate_standard(df, "op", "ts").first().verdict == "UNUSABLE"
    assert ops.validate_standard(df, "op", "ts", max_card=13).first().verdict == "USABLE"


def test_trust_needs_the_flow_hash(rows):
    df = rows([("L", GOOD, "L")], STD)
    r = ops.validate_standard(df, "op", "ts", hash_suffixed=False, require_hash=True).first()
    assert r.faults == "load type carries no flow hash"


@pytest.mark.parametrize("data,verdict", [
    ([], "EMPTY"), ([(None,)], "UNUSABLE"), ([(1,), (None,)], "USABLE_WITH_NULLS"), ([(1,)], "USABLE")])
def test_custom_verdicts(rows, data, verdict):
    assert ops.validate_custom(rows(data, "wm int"), "wm").first().verdict == verdict


def test_operation_mix_ranks_per_object(rows):
    df = rows([("A",)] * 3 + [("L",)] * 2 + [("D",)], "op string")
    mix = ops.operation_mix({"T": df, "U": df.filter("op <> 'D'")}, "op", top=2)
    assert {(r.object_name, r.operation, r.rank) for r in mix.collect()} == {
        ("T", "A", 1), ("T", "L", 2), ("U", "A", 1), ("U", "L", 2)}
    whole = ops.operation_mix({"T": df}, "op")
    assert ops.operation_summary(whole).first().delete_code_seen


def test_rare_delete_code_counts(rows):
    df = rows([(f"X{i}",) for i in range(40) for _ in range(2)] + [("D",)], "op string")
    found = ops.operation_summary(ops.operation_mix({"T": df}, "op")).first()
    assert (found.operations, found.n_rows, found.delete_code_seen) == (41, 81, True)


def test_load_types(rows):
    df = rows([("initial",), (None,)], "lt string")
    assert ops.load_type_verdict(ops.load_type_mix({"T": df}, "lt")).first().status == "WARN"
    mixed = df.union(rows([("delta",)], "lt string"))
    assert ops.load_type_verdict(ops.load_type_mix({"T": mixed}, "lt")).first().status == "PASS"


def test_text_order(rows):
    mixed = rows([("2026-06-15T09:41:59,6426580Z",), ("9",)], "ts string")
    assert not ops.text_order_agrees(mixed, "ts").first().orders_agree


@pytest.mark.parametrize("later,status", [(0, "WARN"), (1, "PASS"), (60, "WARN")])
def test_merge_or_reload(spark, later, status):
    df = spark.range(100).select(F.when(F.col("id") < later, ntz("2024-01-02"))
                                 .otherwise(ntz("2024-01-01")).alias("wm"))
    assert ops.merge_or_reload(df, "wm").first().status == status


def test_pruning_counts_files_and_bytes(spark, tmp_path):
    path = str(tmp_path / "clustered")
    for day in range(10):
        spark.range(1000).select("id", F.lit(day).alias("wm")).coalesce(1) \
             .write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    r = ops.pruning_ratio(df, "wm").first()
    assert (r.files_total, r.files_touched, r.status) == (10, 1, "WARN")
    assert ops.pruning_ratio(df, "wm", bound=0).first().ratio == 1.0
    assert ops.pruning_ratio(df, "wm", bound=10).first().files_touched == 0
    zones = {(r.n_rows, r.oldest, r.newest) for r in ops.zone_map(df, "wm").collect()}
    assert zones == {(1000, day, day) for day in range(10)}
    empty = ops.pruning_ratio(df.withColumn("wm", F.lit(None).cast("int")), "wm").first()
    assert (empty.files_touched, empty.ratio, empty.status) == (0, 0.0, "WARN")
    assert ops.file_count_drop(df, 20).first().dropped
    assert not ops.file_count_drop(df, 14).first().dropped


@pytest.mark.parametrize("batches,status", [(10, "PASS"), (1, "WARN")])
def test_extract_is_judged_by_bytes(spark, tmp_path, batches, status):
    path = str(tmp_path / "t")
    for batch in range(batches):
        spark.range(100).select("id", F.lit(f"2026-06-1{batch}T00:00:00,0000000Z").alias("ts")) \
             .coalesce(1).write.mode("append").parquet(path)
    pruned = ops.pruning_ratio(spark.read.parquet(path), "ts")
    assert findings.extract_finding(pruned).first().status == status


def test_delete_codes_are_reported(rows):
    seen = ops.operation_summary(ops.operation_mix({"T": rows([("L",), ("D",)], "op string")}, "op"))
    found = findings.operation_finding(seen).first()
    assert (found.status, found.detail) == ("INFO", "2 code(s) on 1 object(s); deletes can be applied")


@pytest.mark.parametrize("statuses,verdict", [
    ({}, "NOT ASSESSABLE"),
    ({"share.present": "PASS", "semantics.trustworthy": "FAIL"}, "NOT READY"),
    ({"share.present": "PASS", "signal.watermark": "PASS", "refresh.incremental": "PASS"}, "READY"),
    ({"share.present": "PASS", "signal.watermark": "PASS", "refresh.incremental": "FAIL",
      "cost.pruning": "WARN"}, "READY WITH CAVEATS"),
    ({"share.present": "PASS", "signal.watermark": "FAIL"}, "NOT READY"),
    ({"share.present": "PASS", "semantics.trustworthy": "PASS"}, "READY WITH CAVEATS"),
    ({"share.present": "PASS", "semantics.trustworthy": "FAIL", "signal.watermark": "PASS",
      "refresh.incremental": "PASS"}, "READY"),
])
def test_readiness(rows, statuses, verdict):
    found = rows([(c, s, "") for c, s in statuses.items()], findings.FINDING)
    assert findings.readiness_verdict(found).first().verdict == verdict


def test_findings_are_written(rows, spark, tmp_path):
    found = rows([("share.present", "PASS", "1 readable")], findings.FINDING)
    findings.write_findings(found, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 1


def test_verdict_follows_rows_not_splits_of_the_source(spark, sf_dir, tmp_path):
    from compare import compare, connect
    from tidemark.queries.data import TABLES, table
    for t in TABLES:
        if t != "events":
            (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    table(spark, sf_dir, "events").repartitionByRange(8, "ts").write.parquet(str(tmp_path / "events.parquet"))
    con = connect(sf_dir)
    assert compare(spark, con, "readiness_verdict", str(tmp_path)) is None


def test_an_assessment_infers_no_key(spark, sf_dir, monkeypatch):
    """No finding reads the inferred key, so no object is surveyed for it."""
    monkeypatch.setattr(keys, "survey", lambda *a: pytest.fail("surveyed"))
    found = assess_frames({"EVENTS": events_standard(spark, sf_dir), "CHANGES": events_custom(spark, sf_dir)})
    assert {"signal.watermark", "cost.pruning"} <= {p.first().check for p in found}
