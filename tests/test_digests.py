import contextlib
import io

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import control, digests
from tidemark.operators.silver import row_differences

CELL = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(CELL, st.one_of(st.none(), st.sampled_from("ab"))), max_size=12)
SCHEMA = "k int, v string"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_ranges_give_what_a_group_by_every_column_gives(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    whole = row_differences(a, b, "a", "b").first()
    assert row_differences(a, b, "a", "b", ["k"]).first() == whole
    keys = control.reconcile_keys(a, b, ["k"]).collect()
    assert sorted(map(str, control.reconcile_keys(a, b, ["k"], parts=2).collect())) == sorted(map(str, keys))


def test_a_row_that_stands_twice_on_one_side_is_seen(rows):
    a, b = rows([(1, "a")] * 3, SCHEMA), rows([(1, "a")], SCHEMA)
    both = digests.sided(a, b)
    assert digests.differing_parts(both, ["k"], ["k", "v"]).count() == 1
    assert row_differences(a, b, "a", "b", ["k"]).first().a == 2


def test_columns_meet_by_name_and_type(rows):
    a, b = rows([(1, "a")], "k int, v string"), rows([("a", 1)], "v string, k bigint")
    assert row_differences(a, b, "a", "b", ["k"]).first().equal


def test_equal_sides_are_not_shuffled(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        digests.where_different(digests.sided(df, df), ["k"]).explain()
    assert "LocalTableScan <empty>" in shown.getvalue() and "Exchange" not in shown.getvalue()


def test_only_the_ranges_that_differ_stay(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    left = digests.where_different(digests.sided(df, df.where("k <> 7")), ["k"], parts=500)
    assert left.count() < 20 and left.where("k = 7").count() == 1


def test_empty_sides(rows):
    none = rows([], SCHEMA)
    assert row_differences(none, none, "a", "b", ["k"]).first().equal
    assert row_differences(rows([(None, None)], SCHEMA), none, "a", "b", ["k"]).first().a == 1
