"""The four shapes and a rollup kept up over two cycles of inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import changes, deltas as ops
from tidemark.queries.data import ORDERS_SQL, at, orders_after, orders_before, table
from tidemark.queries.registry import query
from tidemark.sources import work_dir

_KEY = ["o_orderkey"]


def _order_images(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders before, the orders of 1996 to 1998 alone with a dearer price, and orders after."""
    before, after = (image(spark, sf_dir).drop("CDC_TIMESTAMP_TEXT") for image in (orders_before, orders_after))
    day = F.col("o_orderdate")
    between = table(spark, sf_dir, "orders").where((day >= at("1996-01-01")) & (day < at("1999-01-01"))).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    return [before, between, after]


def _line_images(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Lines without returns, then without those of a third of the orders, then all with a flag changed."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"), F.to_date("l_shipdate").alias("l_shipdate"))
    return [lines.where("l_returnflag <> 'R'"), lines.where("l_orderkey % 3 <> 0"),
            lines.withColumn("l_returnflag", F.when(F.col("l_linenumber") == 1, "X").otherwise(F.col("l_returnflag")))]


_LINES_AFTER = """
lines AS (SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN 'X' ELSE l_returnflag END AS l_returnflag,
                            CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)"""


def _order_feeds(images: list[DataFrame]) -> list[DataFrame]:
    return [ops.from_feed(changes.snapshot_diff(a, b, _KEY, exclude=())) for a, b in zip(images, images[1:])]


def _row_changes(images: list[DataFrame], by: Sequence[str] = ()) -> list[DataFrame]:
    """Lines have no key, so their changes are differences of counted rows, dealt `by` columns if given."""
    return [ops.net(ops.weighted(b), ops.weighted(a, -1), by=by) for a, b in zip(images, images[1:])]


@query(f"""
WITH {ORDERS_SQL}
SELECT o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM cur
""")
def kept_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _order_images(spark, sf_dir)
    kept = ops.WeightedTable(spark, work_dir(spark, "projection"))
    shape = ("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").cast("string").alias("day"))
    for cycle, change in enumerate([ops.weighted(images[0]), *_order_feeds(images)]):
        kept.put(ops.projected(change, *shape), cycle)
    return kept.rows(2)


@query(f"""
WITH {ORDERS_SQL}, {_LINES_AFTER}
SELECT o_orderkey, l_linenumber, l_partkey, l_returnflag, o_custkey, o_orderstatus
FROM cur JOIN lines ON o_orderkey = l_orderkey
""")
def kept_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides change in both cycles."""
    orders = [o.select("o_orderkey", "o_custkey", "o_orderstatus") for o in _order_images(spark, sf_dir)]
    lines = [x.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_returnflag")
             for x in _line_images(spark, sf_dir)]
    kept = ops.WeightedTable(spark, work_dir(spark, "join"))
    kept.put(ops.weighted(orders[0].join(lines[0], _KEY)), 0)
    for cycle, (d_orders, d_lines) in enumerate(zip(_order_feeds(orders), _row_changes(lines, _KEY)), 1):
        kept.put(ops.joined(orders[cycle - 1], d_orders, lines[cycle], d_lines, _KEY), cycle)
    return kept.rows(2)


@query(f"""
WITH {_LINES_AFTER}
SELECT l_returnflag, l_suppkey, count(*) AS n_rows,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
FROM lines GROUP BY 1, 2
""")
def kept_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums alone: one state row per group and cycle."""
    images = _line_images(spark, sf_dir)
    kept = ops.KeptGroups(spark, work_dir(spark, "group"), ["l_returnflag", "l_suppkey"], [
        ops.Measure("n_rows", "rows"), ops.Measure("quantity", "sum", "l_quantity")])
    for cycle, change in enumerate([ops.weighted(images[0]), *_row_changes(images)]):
        kept.apply(change, cycle)
    return kept.current(2).withColumn("quantity", F.col("quantity").cast("double"))


@query(f"""
WITH {ORDERS_SQL}, {_LINES_AFTER}
SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(n, 0) AS n_lines, coalesce(p, 0) AS n_parts, last_ship
FROM cur LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS p, CAST(max(l_shipdate) AS VARCHAR) AS last_ship
  FROM lines GROUP BY 1) ON l_orderkey = o_orderkey
""")
def kept_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines rolled up, kept up under changes of both; lines by what is measured of them."""
    orders = [o.select("o_orderkey", "o_custkey", "o_orderstatus") for o in _order_images(spark, sf_dir)]
    lines = [x.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_shipdate")
             for x in _line_images(spark, sf_dir)]
    feeds = ops.WeightedTable(spark, work_dir(spark, "feeds"))
    groups = ops.KeptGroups(spark, work_dir(spark, "lines"), _KEY, [
        ops.Measure("n_lines", "rows"), ops.Measure("n_parts", "distinct", "l_partkey"),
        ops.Measure("last_ship", "max", "l_shipdate")])
    kept, zero = ops.WeightedTable(spark, work_dir(spark, "preagg")), ["n_lines", "n_parts"]
    first = orders[0].join(groups.start(lines[0]), _KEY, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in zero})
    kept.put(ops.weighted(first), 0)
    for cycle, (d_orders, d_lines) in enumerate(zip(_order_feeds(orders), _row_changes(lines)), 1):
        touched = groups.apply(d_lines, cycle)
        kept.put(ops.left_joined(orders[cycle - 1], feeds.put(d_orders, cycle), groups, cycle, touched, zero), cycle)
    return kept.rows(2).withColumn("last_ship", F.col("last_ship").cast("string"))


@query(f"""
WITH {ORDERS_SQL}
SELECT o_custkey, count(*) AS n_orders, count(DISTINCT o_orderpriority) AS n_priorities,
       bool_or(o_orderstatus = 'O') AS any_open, min(o_orderpriority) AS first_priority,
       CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM cur GROUP BY o_custkey
""")
def kept_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum, maximum and distinct counts under deletes, from the change log alone."""
    images = [o.withColumns({"open": F.col("o_orderstatus") == "O",
                             "price": F.col("o_totalprice").cast("decimal(18,2)")})
              for o in _order_images(spark, sf_dir)]
    kept = ops.KeptGroups(spark, work_dir(spark, "rollup"), ["o_custkey"], [
        ops.Measure("n_orders", "rows"), ops.Measure("n_priorities", "distinct", "o_orderpriority"),
        ops.Measure("any_open", "any", "open"), ops.Measure("first_priority", "min", "o_orderpriority"),
        ops.Measure("last_order", "max", "o_orderdate"), ops.Measure("total", "sum", "price")])
    for cycle, change in enumerate([ops.weighted(images[0]), *_order_feeds(images)]):
        kept.apply(change, cycle)
    return kept.current(2).withColumns({"total": F.col("total").cast("double"),
                                        "last_order": F.to_date("last_order").cast("string")})
