import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import streaming as ops
from tidemark.functions import ntz
from tidemark.functions.rules import sql_rule
from tidemark.operators import changes
from tidemark.operators.silver import latest_per_key, row_differences
from tidemark.spec import ObjectSpec
from tidemark.streaming import upsert
from tidemark.streaming.upsert import merge_batch

T = "k string, v int, CDC_TIMESTAMP_TEXT string"
KEY, WM = ["k"], "CDC_TIMESTAMP_TEXT"


@pytest.fixture
def data(rows):
    return rows([(f"k{i % 6}", i, f"{(i * 7) % 40:02d}") for i in range(40)], T)


def land(df, path, files):
    df.repartition(files).write.parquet(path)


def stream(spark, df, path, per_batch=1):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


@pytest.mark.parametrize("files", [1, 4])
def test_batches_do_not_change_the_result(spark, store, data, tmp_path, files):
    land(data, str(tmp_path / "in"), files)
    ops.stream_upsert(stream(spark, data, str(tmp_path / "in")), store, "T", KEY, WM,
                      str(tmp_path / "cp")).awaitTermination()
    want = latest_per_key(data, KEY, WM)
    assert row_differences(want, store.read("T").select(*want.columns), "a", "b").first().equal


def test_a_replayed_batch_changes_nothing(store, control, rows, data):
    merge_batch(store, "T", data.limit(10), KEY, WM, "s-0")
    merge_batch(store, "T", data, KEY, WM, "s-1")
    before = [s.snapshot_id for s in store.history("T")]
    again = merge_batch(store, "T", data, KEY, WM, "s-1")
    assert again.token == "s-1" and [s.snapshot_id for s in store.history("T")] == before
    stale = rows([("k1", -1, "00")], T)
    assert merge_batch(store, "T", stale, KEY, WM, "s-2") is None
    assert store.read("T").filter("v = -1").count() == 0


def test_a_spec_rules_the_stream_and_batches_are_audited(spark, store, control, rows, tmp_path, monkeypatch):
    df = rows([("a", 1, None), ("a", 2, "05"), ("b", 3, "01"), ("b", 4, "01")], T)
    land(df, str(tmp_path / "in"), 2)
    spec = ObjectSpec("T", "in", ("k",), tiebreak=("v",), flags={"late": sql_rule(f"{WM} > '03'")})

    def run(checkpoint):
        return ops.stream_capture(stream(spark, df, str(tmp_path / "in")), store, control, spec, WM,
                                  str(tmp_path / checkpoint), "2024-01-01", "first")

    run("cp").awaitTermination()
    assert {(r.k, r.v, r.late) for r in store.read("T").collect()} == {("a", 1, None), ("b", 4, False)}
    audit = control.read("refresh_audit")
    assert {(r.state_message, r.state) for r in audit.collect()} == {
        ("capture-0", "SUCCEEDED"), ("capture-1", "SUCCEEDED")}
    run("another").awaitTermination()  # the same batches once more, as after a lost checkpoint
    assert control.read("refresh_audit").count() == audit.count() == 2
    monkeypatch.setattr(upsert, "merge_batch", lambda *_: 1 / 0)
    with pytest.raises(StreamingQueryException):
        run("third").awaitTermination()
    failed = control.read("refresh_audit").filter("state = 'FAILED'").collect()
    assert [r.state_message for r in failed] == ["capture-0: division by zero"]


def test_an_empty_object_is_not_streamed(spark, store, control, data, tmp_path):
    land(data, str(tmp_path / "in"), 1)
    with pytest.raises(ValueError, match="EMPTY"):
        ops.stream_capture(stream(spark, data, str(tmp_path / "in")), store, control,
                           ObjectSpec("T", "in", ("k",), "EMPTY"), WM, str(tmp_path / "cp"), "2024-01-01")


def test_change_log_of_a_stream(spark, store, control, data, tmp_path):
    land(data, str(tmp_path / "in"), 3)
    ops.stream_change_log(stream(spark, data, str(tmp_path / "in")), store, control, "T", KEY, WM,
                          str(tmp_path / "cp"), ntz("2024-01-01"), exclude=(WM,)).awaitTermination()
    log = changes.change_log(control)
    assert log.filter("change_type = 'I'").count() == 6
    assert log.filter("change_type = 'D'").count() == 0
    last = log.groupBy("key_values").agg(F.max_by("after_image", "cdc_timestamp_text").alias("i"))
    got = {r.k: r.v for r in last.select(F.get_json_object("i", "$.k").alias("k"),
                                         F.get_json_object("i", "$.v").alias("v")).collect()}
    assert got == {r.k: str(r.v) for r in latest_per_key(data, KEY, WM).collect()}


def passed_on(stream, tmp_path):
    """Rows that each batch passes on, in the order of the batches."""
    out = []
    (stream.writeStream.outputMode("update").foreachBatch(lambda df, i: out.append(df.collect()))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
     .start().awaitTermination())
    return [b for b in out if b]


D = "k string, v int, ts timestamp_ntz"


def day(n):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(n)


def land_batches(rows, batches, schema, tmp_path):
    for batch in batches:
        rows(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return rows(batches[0], schema)


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_redelivery(spark, rows, tmp_path, partitions, monkeypatch):
    """A to B to A gives three rows; copies of the current row, late rows and rows without a time none."""
    ops.use_rocksdb(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    batches = [
        [("a", 1, day(1)), ("a", 1, day(2)), ("a", 2, day(3)), (None, 7, day(1)), ("b", None, day(1)),
         ("x", 1, None)] + [("hot", 0, day(1))] * 300,
        [("a", 1, day(4)), ("a", 1, day(5)), (None, 7, day(2)), ("b", None, day(3)), ("hot", 0, day(2))],
        [("a", 2, day(4)), ("a", 3, day(5)), ("a", 2, day(6)), ("b", 1, day(4)), ("hot", 0, day(1))]]
    df = land_batches(rows, batches, D, tmp_path)
    out = passed_on(ops.drop_redelivery(stream(spark, df, str(tmp_path / "in")), KEY, "ts", "30 days"), tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    first, second, third = [sorted(((r.k, r.v, r.ts) for r in b), key=repr) for b in out]
    assert first == sorted([("a", 1, day(1)), ("a", 2, day(3)), (None, 7, day(1)), ("b", None, day(1)),
                            ("hot", 0, day(1))], key=repr)
    assert second == [("a", 1, day(4))]
    three = [] if third[0][1] != 3 else [("a", 3, day(5))]  # equal times go by the hash of the image
    assert [r for r in third if r[1] != 3] == [("a", 2, day(6)), ("b", 1, day(4))] and len(third) == 2 + len(three)


def changes_passed(spark, df, store, tmp_path, delay, run):
    """As `passed_on`, of the form that keeps the last rows in a table."""
    out = []
    ops.stream_changes(stream(spark, df, str(tmp_path / "in")), store, "LAST", KEY, "ts", delay,
                       lambda rows, i: out.append(rows.collect()), str(tmp_path / f"cp{run}")).awaitTermination()
    return out


def test_changes_need_no_python_and_come_again_the_same(spark, rows, store, tmp_path):
    """The batches of `test_redelivery`; a second run with the same tokens gives the same rows."""
    batches = [
        [("a", 1, day(1)), ("a", 1, day(2)), ("a", 2, day(3)), (None, 7, day(1)), ("b", None, day(1)),
         ("x", 1, None)] + [("hot", 0, day(1))] * 300,
        [("a", 1, day(4)), ("a", 1, day(5)), (None, 7, day(2)), ("b", None, day(3)), ("hot", 0, day(2))],
        [("a", 2, day(4)), ("a", 2, day(6)), ("b", 1, day(4)), ("hot", 0, day(1))]]
    df = land_batches(rows, batches, D, tmp_path)
    runs = [[sorted((tuple(r) for r in b), key=repr) for b in changes_passed(spark, df, store, tmp_path, "30 days", i)]
            for i in range(2)]
    assert runs[0] == [sorted([("a", 1, day(1)), ("a", 2, day(3)), (None, 7, day(1)), ("b", None, day(1)),
                               ("hot", 0, day(1))], key=repr), [("a", 1, day(4))], [("a", 2, day(6)), ("b", 1, day(4))]]
    assert runs[1] == runs[0] and len(store.history("LAST")) == 3


def test_changes_overlook_a_quiet_key_and_late_rows(spark, rows, store, tmp_path):
    batches = [[("a", 1, day(1)), ("b", 1, day(1))], [("b", 1, day(20))],
               [("a", 1, day(22)), ("b", 1, day(23)), ("c", 1, day(14))]]
    df = land_batches(rows, batches, D, tmp_path)
    out = [sorted(tuple(r) for r in b) for b in changes_passed(spark, df, store, tmp_path, "5 days", 0)]
    # b was quiet for longer than the delay only while nothing newer had come.
    assert out == [[("a", 1, day(1)), ("b", 1, day(1))], [], [("a", 1, day(22))]]


def test_a_quiet_key_is_forgotten(spark, rows, tmp_path):
    ops.use_rocksdb(spark)
    batches = [[("a", 1, day(1)), ("b", 1, day(1))], [("b", 1, day(20))], [("b", 2, day(21))],
               [("a", 1, day(22)), ("b", 2, day(23))]]
    df = land_batches(rows, batches, D, tmp_path)
    out = passed_on(ops.drop_redelivery(stream(spark, df, str(tmp_path / "in")), KEY, "ts", "5 days"), tmp_path)
    seen = sorted((r.k, r.v, r.ts) for b in out for r in b)
    assert ("a", 1, day(22)) in seen and ("b", 2, day(23)) not in seen


def test_latest_state(spark, data, tmp_path):
    ops.use_rocksdb(spark)
    land(data, str(tmp_path / "in"), 3)
    out = passed_on(ops.latest_state(stream(spark, data, str(tmp_path / "in")), KEY, WM), tmp_path)
    held = {}
    for batch in out:
        for r in batch:
            assert r.k not in held or (r.CDC_TIMESTAMP_TEXT, r.v) > (held[r.k].CDC_TIMESTAMP_TEXT, held[r.k].v)
            held[r.k] = r
    assert {tuple(r) for r in held.values()} == {tuple(r) for r in latest_per_key(data, KEY, WM).collect()}


def test_latest_state_passes_on_only_keys_that_moved(spark, rows, tmp_path):
    ops.use_rocksdb(spark)
    batches = [[("a", 1, "10"), ("b", 1, "10"), (None, 1, None)], [("a", 2, "05"), ("a", 1, "10"), ("b", 3, "11")],
               [("a", 0, None), ("a", 0, "12"), (None, 1, None)]]
    df = land_batches(rows, batches, T, tmp_path)
    out = passed_on(ops.latest_state(stream(spark, df, str(tmp_path / "in")), KEY, WM), tmp_path)
    assert [sorted(((r.k, r.v) for r in b), key=repr) for b in out] == [
        sorted([("a", 1), ("b", 1), (None, 1)], key=repr), [("b", 3)], [("a", 0)]]


def test_unread_drains_warn(rows):
    drains = rows([("A", "2024-01-01"), ("A", "2024-01-20"), ("B", "2024-01-01")],
                  "object_name string, logged_at string") \
        .withColumn("logged_at", F.col("logged_at").cast("timestamp_ntz"))
    got = {r.object_name: r.status for r in ops.drain_staleness(drains, ntz("2024-01-30")).collect()}
    assert got == {"A": "PASS", "B": "WARN"}
