import pytest
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators import gold as ops
from tidemark.operators.silver import row_differences


@pytest.fixture
def master(rows):
    return rows([(1, "a"), (2, "b"), (3, "c")], "k int, name string") \
        .withColumn("CDC_TIMESTAMP_UTC", F.when(F.col("k") != 3, ntz("2024-01-01")))


@pytest.fixture
def child(rows):
    return rows([(1, "x", True, 5), (1, "y", None, 7), (2, "x", False, 1), (9, "x", True, 1)],
                "k int, code string, flag boolean, v int")


def test_rolling_up_first_does_not_fan_out(master, child, rows):
    other = rows([(1, 1), (1, 2), (1, 3)], "k int, w int")
    one = ops.child_rollup(child, ["k"], {"n": ops.rows(), "codes": ops.distinct("code"),
                                          "any": ops.any_true("flag")})
    two = ops.child_rollup(other, ["k"], {"m": ops.rows()})
    dim = {r.k: r for r in ops.customer_360(
        master, ["k"], [ops.Rollup(one, ("n", "codes")), ops.Rollup(two, ("m",))]).collect()}
    assert (dim[1].n, dim[1].codes, dim[1].any, dim[1].m) == (2, 2, True, 3)
    assert (dim[3].n, dim[3].m, dim[3].any) == (0, 0, None)
    joined_first = master.join(child, "k").join(other, "k")
    assert joined_first.filter("k = 1").count() == 6


def test_latest_change_over_master_and_children(master, child):
    stamped = child.withColumn("at", ntz("2024-02-02"))
    one = ops.child_rollup(stamped, ["k"], {"n": ops.rows(), "c": F.max("at")})
    dim = {r.k: str(r.any_changed_utc) for r in ops.customer_360(
        master, ["k"], [ops.Rollup(one, ("n",), "c")]).collect()}
    assert dim == {1: "2024-02-02 00:00:00", 2: "2024-02-02 00:00:00", 3: "None"}


def test_bridge_keeps_its_grain(child, rows):
    lines = rows([(1, "x", 1), (1, "x", 2), (2, "x", 1)], "k int, code string, p int")
    got = {(r.k, r.code): r.n for r in ops.bridge(
        child.select("k", "code"), lines, ["k", "code"], {"n": ops.rows()}).collect()}
    assert got == {(1, "x"): 2, (1, "y"): 0, (2, "x"): 1, (9, "x"): 0}


@pytest.mark.parametrize("gone,blocked,level,unassigned,bucket", [
    (True, True, 9, True, "DELETED"), (False, True, 9, True, "BLOCKED"),
    (False, False, 3, True, "DUNNING_SEVERE"), (False, False, 1, True, "DUNNING"),
    (False, False, None, True, "UNASSIGNED"), (False, False, 0, False, "OK")])
def test_risk_ladder(rows, gone, blocked, level, unassigned, bucket):
    dim = rows([(gone, blocked, level, unassigned)],
               "gone boolean, blocked boolean, level int, unassigned boolean") \
        .withColumns({"any_changed_utc": ntz("2024-01-31 23:59:59"), "dunned": ntz("2024-01-01")})
    r = ops.risk_view(dim, ntz("2024-02-01 00:00:01"), F.col("gone"), F.col("blocked"),
                      F.col("level"), F.col("unassigned"), "dunned").first()
    assert (r.risk_bucket, r.days_since_dunned, r.minutes_since_change) == (bucket, 31, 1)


def test_deletion_codes_add_up(rows):
    df = rows([("", 60.0), ("L", 30.0), ("X", 10.0), (None, 0.0)], "code string, amount double")
    got = {(r.level, r.code): (r.n_rows, r.amount_share) for r in ops.deletion_code_breakdown(
        df, "code", F.col("amount"), F.coalesce(F.col("code"), F.lit("")) == "").collect()}
    assert got[("FLAGGED", None)] == (2, 0.4) and got[("TOTAL", None)] == (4, 1.0)
    assert got[("CODE", "L")] == (1, 0.3) and got[("CODE", None)] == (1, 0.0)


def test_month_to_date_and_active_only(rows):
    df = rows([("2024-02-01", None), ("2024-01-31", True), ("2024-02-09", False)],
              "d string, gone boolean").withColumn("d", F.to_date("d"))
    assert ops.month_to_date(df, "d", ntz("2024-02-20 10:00:00")).count() == 2
    assert ops.active_only(df, ["gone"]).count() == 2


class TestRefresh:
    def definition(self):
        def build(inputs):
            counts = ops.child_rollup(inputs["C"], ["k"], {"n": ops.rows(), "low": F.min("v")})
            return ops.left_rollup(inputs["M"], counts, ["k"], ["n"])
        return ops.GoldDef("G", ("k",), {"M": ("k",), "C": ("k",)}, build)

    def inputs(self, spark, m, c):
        return (spark.range(m).select(F.col("id").alias("k"), F.lit("m").alias("name")),
                spark.range(c).select((F.col("id") % 10).alias("k"), F.col("id").alias("c"),
                                      (100 - F.col("id")).alias("v")))

    def write(self, store, master, child):
        for name, df, keys in (("M", master, ["k"]), ("C", child, ["k", "c"])):
            store.write(name, df, keys, set(range(4)) if store.head(name) else None)

    def test_incremental_equals_full(self, spark, store):
        gold = self.definition()
        self.write(store, *self.inputs(spark, 20, 50))
        assert ops.refresh_gold(store, gold) == "FULL"
        assert ops.refresh_gold(store, gold) == "NO_DATA"
        master, child = self.inputs(spark, 18, 50)
        child = child.filter("c <> 49").union(child.filter("c = 3").withColumn("c", F.lit(77)))
        self.write(store, master, child)
        assert ops.refresh_gold(store, gold) == "INCREMENTAL"
        full = gold.build({"M": store.read("M"), "C": store.read("C")})
        assert row_differences(full, store.read("G").select(*full.columns), "a", "b").first().equal
        assert ops.refresh_gold(store, gold) == "NO_DATA"

    def test_a_run_cut_short_is_caught_up(self, spark, store):
        gold = self.definition()
        self.write(store, *self.inputs(spark, 20, 50))
        ops.refresh_gold(store, gold)
        self.write(store, *self.inputs(spark, 20, 40))
        self.write(store, *self.inputs(spark, 19, 40))
        assert ops.refresh_gold(store, gold) == "INCREMENTAL"
        assert store.read("G").count() == 19 and store.read("G").agg(F.sum("n")).first()[0] == 40
