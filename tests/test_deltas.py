import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import deltas as ops
from tidemark.queries import QUERIES
from tidemark.queries.data import table
from tidemark.operators.changes import snapshot_diff

CHILD = "id int, k int, code string, flag boolean, v decimal(10,2)"
MASTER = "k int, name string"
MEASURES = [ops.Measure("n", "rows"), ops.Measure("low", "min", "v"), ops.Measure("high", "max", "code"),
            ops.Measure("codes", "distinct", "code"), ops.Measure("total", "sum", "v"),
            ops.Measure("any_flag", "any", "flag")]
SUMS = [MEASURES[0], MEASURES[4]]


def child_rows(rng, n=40):
    return [(i, rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b", "c"]), rng.choice([None, True, False]),
             rng.choice([None, Decimal(rng.randint(-5, 5))])) for i in rng.sample(range(60), n)]


def images(rows, seed, cycles=3):
    """Images of a child and a master, each far from the one before; the last child holds no row."""
    rng = random.Random(seed)
    children = [rows(child_rows(rng), CHILD) for _ in range(cycles)] + [rows([], CHILD)]
    masters = [rows([(k, f"m{rng.randint(0, 2)}") for k in rng.sample(range(6), 4)] + [(None, "none")], MASTER)
               for _ in range(cycles + 1)]
    return children, masters


def changes(frames, key):
    return [ops.from_feed(snapshot_diff(a, b, [key], exclude=())) for a, b in zip(frames, frames[1:])]


def bag(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


def full(child, measures):
    kinds = {"rows": lambda c: F.count("*"), "sum": F.sum, "min": F.min, "max": F.max, "distinct": F.count_distinct,
             "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False))}
    return child.groupBy("k").agg(*[kinds[m.kind](m.column).alias(m.name) for m in measures])


@pytest.mark.parametrize("measures", [MEASURES, SUMS])
@pytest.mark.parametrize("seed", [1, 2])
def test_groups_under_inserts_updates_and_deletes(spark, rows, tmp_path, measures, seed):
    children, _ = images(rows, seed)
    kept = ops.KeptGroups(spark, str(tmp_path / "g"), ["k"], measures)
    out = ops.WeightedTable(spark, str(tmp_path / "out"))
    assert bag(kept.start(children[0])) == bag(full(children[0], measures))
    out.put(ops.weighted(kept.current(0)), 0)
    for cycle, change in enumerate(changes(children, "id"), 1):
        touched = kept.apply(change, cycle)
        out.put(kept.change(cycle, touched), cycle)
        want = bag(full(children[cycle], measures))
        assert bag(kept.current(cycle)) == want and bag(out.rows(cycle)) == want
    assert want == []


def test_a_repeated_cycle_changes_nothing(spark, rows, tmp_path):
    children, _ = images(rows, 3, 2)
    kept = ops.KeptGroups(spark, str(tmp_path / "g"), ["k"], MEASURES)
    kept.start(children[0])
    change = changes(children, "id")[0]
    kept.apply(change, 1)
    kept.apply(change, 1)
    assert bag(kept.current(1)) == bag(full(children[1], MEASURES))


def test_only_changed_rows_are_written(spark, tmp_path):
    rows = spark.range(10_000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    kept = ops.KeptGroups(spark, str(tmp_path / "g"), ["k"], [ops.Measure("low", "min", "v")])
    kept.start(rows)
    kept.apply(ops.weighted(rows.where("v % 100 = 7"), -1), 1)
    assert spark.read.parquet(str(tmp_path / "g" / "__cycle=1")).count() == 100
    assert bag(kept.current(1)) == bag(rows.where("v % 100 <> 7").groupBy("k").agg(F.min("v").alias("low")))


@pytest.mark.parametrize("seed", [4, 5])
def test_join_under_changes_of_both_sides(spark, rows, tmp_path, seed):
    children, masters = images(rows, seed)
    out = ops.WeightedTable(spark, str(tmp_path / "j"))
    out.put(ops.net(ops.weighted(masters[0].join(children[0], "k"))), 0)
    pairs = zip(changes([m.where("k IS NOT NULL") for m in masters], "k"), changes(children, "id"))
    for cycle, (d_master, d_child) in enumerate(pairs, 1):
        out.put(ops.joined(masters[cycle - 1], d_master, children[cycle], d_child, ["k"]), cycle)
        assert bag(out.rows(cycle)) == bag(masters[cycle].join(children[cycle], "k"))


@pytest.mark.parametrize("seed", [6, 7])
def test_left_join_to_groups_under_changes_of_both(spark, rows, tmp_path, seed):
    children, masters = images(rows, seed)
    groups = ops.KeptGroups(spark, str(tmp_path / "g"), ["k"], MEASURES)
    out = ops.WeightedTable(spark, str(tmp_path / "out"))

    def whole(master, child):
        rolled = full(child, MEASURES).withColumnRenamed("k", "k2")
        return master.join(rolled, F.col("k").eqNullSafe(F.col("k2")), "left").drop("k2").withColumn(
            "n", F.coalesce("n", F.lit(0)))
    groups.start(children[0])
    out.put(ops.weighted(whole(masters[0], children[0])), 0)
    for cycle, (d_master, d_child) in enumerate(zip(changes(masters, "k"), changes(children, "id")), 1):
        touched = groups.apply(d_child, cycle)
        out.put(ops.left_joined(masters[cycle - 1], d_master, groups, cycle, touched, ["n"]), cycle)
        assert bag(out.rows(cycle)) == bag(whole(masters[cycle], children[cycle]))


def test_projection_keeps_equal_rows_apart(spark, rows, tmp_path):
    children, _ = images(rows, 8)
    out = ops.WeightedTable(spark, str(tmp_path / "p"))
    for cycle, change in enumerate([ops.weighted(children[0]), *changes(children, "id")]):
        out.put(ops.projected(change, "k", F.upper("code").alias("code")), cycle)
        assert bag(out.rows(cycle)) == bag(children[cycle].select("k", F.upper("code").alias("code")))
    assert bag(out.compact(2, str(tmp_path / "c")).rows(2)) == bag(out.rows(2))


def test_measures_are_checked():
    for bad in (("n", "rows", "v"), ("n", "mean", "v"), ("n", "sum", None)):
        with pytest.raises(ValueError):
            ops.Measure(*bad)


def test_parts_keep_their_columns(spark, rows, tmp_path):
    table = ops.WeightedTable(spark, str(tmp_path / "t"))
    table.put(ops.weighted(rows([(1, Decimal(1))], "k int, v decimal(10,2)")), 0)
    table.put(ops.weighted(rows([(1, Decimal(2))], "k bigint, v decimal(20,3)")), 1)
    assert [tuple(r) for r in table.rows(1).orderBy("v").collect()] == [(1, Decimal(1)), (1, Decimal(2))]
    with pytest.raises(ValueError):
        table.put(ops.weighted(rows([(1, 2)], "k int, w int")), 2)


def test_only_changes_of_what_is_measured_touch_an_order(spark, sf_dir, monkeypatch):
    """In the last cycle every order has a line with a new flag, and a third get their lines back."""
    touched, whole = [], ops.KeptGroups.apply
    monkeypatch.setattr(ops.KeptGroups, "apply", lambda *a: touched.append(whole(*a)) or touched[-1])
    QUERIES["kept_preagg"](spark, sf_dir)
    back = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 = 0").select("l_orderkey").distinct()
    assert touched[2].count() == back.count()


def test_a_sum_dealt_by_the_key_of_a_join_is_dealt_once(spark, rows):
    before, after = [(i % 7, i % 3) for i in range(60)], [(i % 7, i % 4) for i in range(50)] + [(None, 1)]
    left, sides = rows([(i, "x") for i in range(7)], "k int, v string"), [rows(x, "k int, w int") for x in (before, after)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = [ops.net(ops.weighted(sides[1]), ops.weighted(sides[0], -1), by=by) for by in ((), ["k"])]
        plans = [left.join(s, "k")._jdf.queryExecution().executedPlan().toString() for s in sums]
        assert [p.count("Exchange hashpartitioning") for p in plans] == [3, 2]
        assert sorted(map(repr, sums[0].collect())) == sorted(map(repr, sums[1].collect())) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
