from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import silver as ops

T = "k string, wm string, v int"
KEY = ["k"]


def image(df):
    return {r.k: r.v for r in df.collect()}


def test_latest_does_not_depend_on_order_or_partitioning(rows):
    data = [(f"k{i % 7}", f"{i % 5}", i) for i in range(200)]
    forward = image(ops.latest_per_key(rows(data, T), KEY, "wm"))
    backward = image(ops.latest_per_key(rows(data[::-1], T).repartition(7), KEY, "wm"))
    assert forward == backward and len(forward) == 7


def test_null_stamp_loses_by_default_and_wins_on_request(rows):
    df = rows([("a", None, 1), ("a", "1", 2)], T)
    assert image(ops.latest_per_key(df, KEY, "wm")) == {"a": 2}
    assert image(ops.latest_per_key(df, KEY, "wm", nulls="first")) == {"a": 1}


def test_null_keys_form_one_group(rows):
    df = rows([(None, "1", 1), (None, "2", 2), ("~", "1", 3)], T)
    assert image(ops.latest_per_key(df, KEY, "wm")) == {None: 2, "~": 3}


def test_delta_replaces_initial_at_one_stamp(rows):
    df = rows([("a", "1", 1, "initial"), ("a", "1", 2, "delta")], f"{T}, CDC_LOAD_TYPE string")
    for frame in (df, df.orderBy(F.desc("v"))):
        assert image(ops.latest_per_key(frame, KEY, "wm", tiebreak=[ops.delta_first()])) == {"a": 2}


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("wm"))
    latest = ops.latest_per_key(df, KEY, "wm")
    assert latest.filter("k = 0").first().wm == 29_997
    assert latest.count() == 20_001


def test_lineage_moves_metadata_behind_the_business_columns(rows):
    df = rows([(1, "A", "t", "delta", "r", None)],
              "k int, __OPERATION_TYPE string, __TIMESTAMP string, LOAD_TYPE string, "
              "RUN_ID string, CDC_TIMESTAMP_UTC timestamp_ntz")
    assert ops.lineage(df).columns == ["k", "CDC_OPERATION", "CDC_LOAD_TYPE", "CDC_RUN_ID",
                                       "CDC_TIMESTAMP_TEXT", "CDC_TIMESTAMP_UTC"]


@pytest.mark.parametrize("volatile", [F.current_timestamp, F.current_date, F.rand, F.uuid])
def test_volatile_definitions_are_rejected(rows, volatile):
    df = rows([("a", "1", 1)], T)
    ops.assert_deterministic(df.withColumn("now", F.lit(1)).filter("now = 1"))
    with pytest.raises(ValueError, match="not deterministic"):
        ops.assert_deterministic(df.withColumn("x", volatile()))


@pytest.mark.parametrize("expression", [
    "uniform(1, 10)", "rand(5)", "randstr(4)", "current_user()", "now()", "localtimestamp()", "current_database()",
    "current_timezone()", "1 + (SELECT max(id) FROM range(2) WHERE rand() > 0.5)", "shuffle(array(1, 2))",
    "monotonically_increasing_id()", "if(k = 'a', rand(), 0.0D)", "spark_partition_id()", "input_file_name()"])
def test_volatile_expressions_are_told_by_the_plan(rows, expression):
    df = rows([("a", "1", 1)], T)
    one = df.selectExpr(f"CAST({expression} AS string) AS x")
    for bad in (one, one.union(df.selectExpr("k"))):
        with pytest.raises(ValueError, match="not deterministic"):
            ops.assert_deterministic(bad)


def test_names_in_texts_and_columns_are_no_calls(spark, rows, capfd):
    df = rows([("a", "1", 1)], T)
    df.createOrReplaceTempView("held")
    spark.sql("CREATE OR REPLACE TEMP VIEW viewed AS SELECT * FROM held")
    ops.assert_deterministic(df.selectExpr("'call now()' AS x", "'rand(' AS `current_date()`", "hash(1) AS uuid"))
    ops.assert_deterministic(spark.sql("WITH c AS (SELECT * FROM viewed) SELECT *, (SELECT count(*) FROM c) n FROM c"))
    assert "Logical Plan" not in capfd.readouterr().out


def test_backstop():
    noon = datetime(2024, 1, 1, 12)
    assert ops.refresh_due(None, 1, noon)
    assert ops.refresh_due(datetime(2024, 1, 1, 11), 1, noon)
    assert not ops.refresh_due(datetime(2024, 1, 1, 11, 30), 1, noon)
    assert not ops.refresh_due(None, None, noon)


class TestRefresh:
    def run(self, store, df):
        return ops.refresh_silver(store, "T", df, KEY, "wm")

    def agrees(self, store, df):
        return ops.incremental_equals_full(store, "T", df, KEY, "wm").first().equal

    def test_outcomes_and_equality_with_a_full_run(self, store, rows):
        first = rows([(f"k{i}", "1", i) for i in range(40)], T)
        assert self.run(store, first).action == "FULL"
        assert self.run(store, first.repartition(3)).action == "NO_DATA"
        update = first.union(rows([("k1", "2", 100)], T))
        assert self.run(store, update).action == "INCREMENTAL" and self.agrees(store, update)
        deleted = update.filter("k <> 'k5'")
        assert self.run(store, deleted).action == "INCREMENTAL" and self.agrees(store, deleted)
        assert self.run(store, deleted).action == "NO_DATA"

    def test_only_touched_buckets_are_written(self, store, rows):
        df = rows([(f"k{i}", "1", i) for i in range(40)], T)
        self.run(store, df)
        result = self.run(store, df.union(rows([("k1", "2", 100)], T)))
        assert result.buckets_written == 1
        holders = {r.holder for r in store.manifest(store.head("T")).collect()}
        assert holders == {"s0000000001", "s0000000002"}

    def test_ties_are_broken_the_same_way_in_both_passes(self, store, rows):
        df = rows([(f"k{i % 5}", "1", i) for i in range(50)], T)
        self.run(store, df)
        assert self.run(store, df.orderBy(F.desc("v"))).action == "NO_DATA"

    def test_a_table_that_empties(self, store, rows):
        df = rows([("a", "1", 1)], T)
        self.run(store, df)
        assert self.run(store, df.limit(0)).action == "INCREMENTAL"
        assert store.read("T").count() == 0

    def test_an_added_column_writes_in_full_and_a_lost_one_raises(self, store, rows):
        df = rows([("a", "1", 1)], T)
        self.run(store, df)
        assert self.run(store, df.withColumn("w", F.lit(1))).action == "FULL"
        with pytest.raises(ops.SchemaDrift, match="w was int"):
            self.run(store, df)
        with pytest.raises(ops.SchemaDrift, match="now string"):
            self.run(store, df.withColumn("w", F.lit("1")))
