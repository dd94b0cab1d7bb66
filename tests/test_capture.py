"""The jobs, on one capture over landed files."""

import pytest
from compare import rows_of, connect
from pyspark.sql import functions as F

from tidemark.operators import control as ops, gold as golds, silver
from tidemark.operators.grain import GrainError
from tidemark.plans.capture import Capture, MetadataError
from tidemark.queries import ORACLES
from tidemark.queries.control import _captured
from tidemark.queries.data import FLOW, KEYS
from tidemark.spec import CaptureSpec, ObjectSpec


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return _captured(spark, sf_dir)


def oracle(sf_dir, name):
    result = connect(sf_dir).execute(ORACLES[name])
    return rows_of([d[0] for d in result.description], result.fetchall())


def test_cycles(run, sf_dir):
    rows = [(i, n, r.statuses.get(n), r.actions.get(n)) for i, r in enumerate(run[1], 1)
            for n in sorted({*r.statuses, *r.actions})]
    assert rows_of(["cycle", "object_name", "status", "action"], rows) == oracle(sf_dir, "capture_cycle")
    assert [r.refreshed for r in run[1]] == [2, 0, 1]
    assert "ABSENT" in run[1][0].errors


def test_gold_equals_a_full_computation(run, sf_dir):
    gold = run[0].store.read("ACTIVITY").withColumn("latest_value", F.col("latest_value").cast("double"))
    assert rows_of(gold.columns, [tuple(r) for r in gold.collect()]) == oracle(sf_dir, "gold_refresh")


def test_audit(run, sf_dir):
    history = ops.refresh_history(run[0].control.read("refresh_audit"))
    got = history.groupBy("target", "refresh_action", "state").agg(F.count("*").alias("n"))
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == oracle(sf_dir, "refresh_history")


def test_assurance_health_and_drain(spark, run):
    held, _ = run
    spec = CaptureSpec("STANDARD", held.spec.objects[:2], flow_hash=FLOW,
                       referential=held.spec.referential)
    capture = Capture(spark, spec, held.control.root, held.store.buckets)
    assert capture.daily_assurance("2024-02-01 06:00:00") == {
        "metadata_unusable": 0, "keys_drifted": 0, "counts_differ": 1}
    health = {r.object_name: r for r in capture.health("2024-02-01 07:00:00").collect()}
    assert health["EVENTS"].metadata_verdict == "USABLE"
    assert health["EVENTS"].reload_verdict == "MERGING"
    assert health["EVENTS"].reconcile_verdict == "DIFFERENCE"
    assert health["EVENTS"].key_verdict == "NOT_CHECKED"
    assert health["ABSENT"].last_run_status == "ERROR"
    assert capture.orphans().first().orphan_rows == 0
    verdicts = {r.object_name: r.verdict for r in capture.verify_grain().collect()}
    assert verdicts == {"EVENTS": "FAIL", "USERS": "PASS"}
    assert capture.drain("d1", "2024-02-01 07:00:00") == {"EVENTS": 75}
    assert capture.drain("d1", "2024-02-01 07:00:00") == {"EVENTS": 75}


@pytest.fixture
def custom(spark, tmp_path):
    """A custom-track object whose deletes do not move the watermark."""
    path = str(tmp_path / "landed")

    def land(n):
        spark.range(n).select(F.col("id").alias("k"), F.lit("2024-01-01").cast("timestamp_ntz")
                              .alias("ZZLASTCHGDATE")).write.mode("overwrite").parquet(path)

    land(20)
    obj = ObjectSpec("T", path, ("k",), "TRANSACTION", cdc_log=True)
    capture = Capture(spark, CaptureSpec("CUSTOM", (obj,), watermark_column="ZZLASTCHGDATE"),
                      str(tmp_path / "root"), 4)
    capture.register("2024-02-01 00:00:00")
    return capture, land


def test_a_pure_delete_waits_for_the_backstop(custom):
    capture, land = custom
    assert capture.cycle("2024-02-01 00:00:00").statuses == {"T": "REFRESHED"}
    land(15)
    assert capture.cycle("2024-02-01 00:30:00").statuses == {"T": "NO_CHANGE"}
    assert capture.store.read("T").count() == 20
    late = capture.cycle("2024-02-01 01:00:00")
    assert late.actions == {"T": "INCREMENTAL"} and capture.store.read("T").count() == 15
    assert capture.drain("d", "2024-02-01 01:00:00") == {"T": 15}


def test_added_files_alone_are_read_and_give_the_full_result(spark, custom, monkeypatch):
    capture, _ = custom
    obj = capture.spec.objects[0]
    capture.cycle("2024-02-01 00:00:00")
    late = spark.range(10, 30).select(
        F.col("id").alias("k"), F.when(F.col("id") < 15, F.lit("2023-12-31"))
        .otherwise(F.lit("2024-01-02")).cast("timestamp_ntz").alias("ZZLASTCHGDATE"))
    late.write.mode("append").parquet(obj.source)
    read = []
    append = silver.append_silver
    monkeypatch.setattr(silver, "append_silver", lambda store, target, rows, *a, **k: (
        read.append(rows.count()), append(store, target, rows, *a, **k))[1])
    assert capture.cycle("2024-02-01 00:15:00").actions == {"T": "INCREMENTAL"}
    assert read == [20]
    full = silver.incremental_equals_full(capture.store, "T", capture.silver_rows(obj), ["k"],
                                          "ZZLASTCHGDATE").first()
    assert full.equal and capture.store.read("T").count() == 30


def test_an_unchanged_listing_is_not_scanned(custom, monkeypatch):
    capture, _ = custom
    capture.cycle("2024-02-01 00:00:00")

    def fail(*_):
        raise AssertionError("scanned")

    monkeypatch.setattr(ops, "poll_watermark", fail)
    state = capture.control.read("registry").first().asDict()
    assert capture.poll(capture.spec.objects[0], state)[0] == "NO_CHANGE"
    assert capture.cycle("2024-02-01 00:10:00").statuses == {"T": "NO_CHANGE"}
    monkeypatch.setattr(Capture, "refresh", fail)
    due = capture.cycle("2024-02-01 05:00:00")
    assert due.statuses == {"T": "NO_CHANGE"} and due.actions == {"T": "NO_DATA"}
    assert str(capture.control.read("registry").first().last_run_started) == "2024-02-01 05:00:00"


def test_a_failed_refresh_is_recorded_and_does_not_stop_others(spark, sf_dir, tmp_path, monkeypatch):
    from tidemark.queries.data import events_standard
    events_standard(spark, sf_dir).write.parquet(str(tmp_path / "e"))
    objects = tuple(ObjectSpec(n, str(tmp_path / "e"), tuple(KEYS), "TRANSACTION") for n in "AB")
    capture = Capture(spark, CaptureSpec("STANDARD", objects, flow_hash=FLOW), str(tmp_path / "r"), 4)
    capture.register("2024-02-01 00:00:00")
    refresh = Capture.refresh
    monkeypatch.setattr(Capture, "refresh",
                        lambda self, o, *m: 1 / 0 if o.name == "A" else refresh(self, o, *m))
    result = capture.cycle("2024-02-01 00:00:00")
    assert result.statuses == {"A": "ERROR", "B": "REFRESHED"}
    states = {r.target: r.state for r in capture.control.read("refresh_audit").collect()}
    assert states == {"A": "FAILED", "B": "SUCCEEDED"}
    monkeypatch.undo()
    assert capture.cycle("2024-02-01 00:15:00").statuses["A"] == "REFRESHED"


def test_the_gate_refuses_a_short_key_before_anything_is_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id AS k, id % 5 AS part, TIMESTAMP_NTZ'2024-01-01' AS ZZLASTCHGDATE FROM range(20)") \
         .write.parquet(path)

    def capture(name, *keys):
        spec = CaptureSpec("CUSTOM", (ObjectSpec("T", path, keys),), watermark_column="ZZLASTCHGDATE")
        return Capture(spark, spec, str(tmp_path / name), 4)

    short = capture("short", "part")
    with pytest.raises(GrainError, match="T by \\(part\\): FAIL, 15 rows discarded"):
        short.build("2024-02-01 00:00:00")
    assert short.control.read("registry").count() == 0 and short.store.head("T") is None
    with pytest.raises(GrainError, match="VIOLATED"):
        capture("declared", "k").build("2024-02-01 00:00:00", {"T": (("part",), "PK")})
    assert capture("right", "k").build("2024-02-01 00:00:00").actions == {"T": "FULL"}


def test_a_cycle_leaves_an_object_whose_metadata_turned_unusable(spark, tmp_path):
    path, key = str(tmp_path / "t"), ("k",)

    def land(stamp):
        spark.sql(f"SELECT id AS k, CAST({stamp} AS TIMESTAMP_NTZ) AS ZZLASTCHGDATE FROM range(20)") \
             .write.mode("overwrite").parquet(path)

    land("'2024-01-01'")
    spec = CaptureSpec("CUSTOM", (ObjectSpec("T", path, key),), watermark_column="ZZLASTCHGDATE")
    capture = Capture(spark, spec, str(tmp_path / "r"), 4)
    capture.build("2024-02-01 00:00:00")
    land("NULL")
    with pytest.raises(MetadataError, match="T: 20 row"):
        capture.gate("2024-02-01 01:00:00")
    assert capture.cycle("2024-02-03 01:00:00").statuses == {"T": "UNUSABLE"}
    assert capture.store.read("T").filter("ZZLASTCHGDATE IS NULL").count() == 0
    land("'2024-01-03'")
    capture.validate("2024-02-03 02:00:00")
    assert capture.cycle("2024-02-03 02:00:00").statuses == {"T": "REFRESHED"}


def test_gold_definitions_must_name_their_keys(run):
    gold = golds.GoldDef("G", ("a", "b"), {"EVENTS": ("user_id",)}, lambda i: i["EVENTS"])
    with pytest.raises(ValueError):
        golds.touched_keys(run[0].store, gold, {}, {"EVENTS": run[0].store.head("EVENTS").snapshot_id})


def test_a_gold_table_that_fails_is_recorded_and_stops_no_other(spark, sf_dir, tmp_path):
    from tidemark.queries.data import events_standard
    events_standard(spark, sf_dir).write.parquet(str(tmp_path / "e"))
    key = KEYS[0]

    def gold(name, build):
        return golds.GoldDef(name, (key,), {"T": (key,)}, lambda i: build(i["T"].groupBy(key)))

    spec = CaptureSpec("STANDARD", (ObjectSpec("T", str(tmp_path / "e"), tuple(KEYS), "TRANSACTION"),),
                       flow_hash=FLOW, gold=(
        gold("BROKEN", lambda g: g.agg(F.raise_error(F.lit("broken")).alias("x"))),
        gold("CLOCK", lambda g: g.agg(F.count("*").alias("n")).withColumn("at", F.current_timestamp())),
        gold("GOOD", lambda g: g.agg(F.count("*").alias("n")))))
    capture = Capture(spark, spec, str(tmp_path / "r"), 4)
    capture.register("2024-02-01 00:00:00")
    result = capture.cycle("2024-02-01 00:00:00")
    assert result.actions == {"T": "FULL", "GOOD": "FULL"}
    assert "not deterministic" in result.errors["CLOCK"]
    states = {r.target: r.state for r in capture.control.read("refresh_audit").collect()}
    assert states == {"T": "SUCCEEDED", "BROKEN": "FAILED", "CLOCK": "FAILED", "GOOD": "SUCCEEDED"}
    assert capture.control.read("registry").first().last_run_status == "REFRESHED"
    assert "GOOD" not in capture.cycle("2024-02-01 00:15:00").errors
