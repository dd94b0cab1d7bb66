"""Rollups, dimensions, bridges and time-relative views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import ntz
from tidemark.operators import gold as ops
from tidemark.operators.silver import latest_per_key
from tidemark.queries.data import AS_OF, SORTABLE_SQL, at, day_text, events_silver, table, \
    EVENTS_SQL, LATEST_SQL
from tidemark.functions import sortable_text
from tidemark.queries.registry import query

_KEY = ["cust"]


@query("""
SELECT o_custkey, count(*) AS n_orders, count(DISTINCT o_orderpriority) AS n_priorities,
       bool_or(o_orderstatus = 'O') AS any_open, min(o_orderpriority) AS first_priority,
       CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order
FROM orders GROUP BY o_custkey
""")
def rollup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("open", F.col("o_orderstatus") == "O")
    rolled = ops.child_rollup(orders, ["o_custkey"], {
        "n_orders": ops.rows(), "n_priorities": ops.distinct("o_orderpriority"),
        "any_open": ops.any_true("open"), "first_priority": F.min("o_orderpriority"),
        "last_order": F.max("o_orderdate")})
    return rolled.withColumn("last_order", day_text("last_order"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their orders, order lines and user events rolled up."""
    master = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust"), "c_name", "c_mktsegment",
        (F.col("c_acctbal") < -900).alias("is_deleted"),
        (F.col("c_acctbal") < -500).alias("is_blocked"),
        F.when(F.col("c_mktsegment") != "MACHINERY", at("1998-01-01")).alias("CDC_TIMESTAMP_UTC"))
    orders = table(spark, sf_dir, "orders")
    per_customer = ops.child_rollup(
        orders.withColumn("open", F.col("o_orderstatus") == "O")
        .withColumnRenamed("o_custkey", "cust"), _KEY,
        {"n_orders": ops.rows(), "n_priorities": ops.distinct("o_orderpriority"),
         "any_open": ops.any_true("open"), "orders_changed": F.max("o_orderdate")})
    # Lines are counted per order first, so the join to orders moves one row per order.
    lines = ops.child_rollup(table(spark, sf_dir, "lineitem"), ["l_orderkey"],
                             {"n": ops.rows(), "shipped": F.max("l_shipdate")})
    per_line = ops.child_rollup(
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .withColumnRenamed("o_custkey", "cust"), _KEY,
        {"n_lines": F.sum("n"), "lines_changed": F.max("shipped")})
    activity = ops.child_rollup(
        table(spark, sf_dir, "events").withColumnRenamed("user_id", "cust"), _KEY,
        {"n_events": ops.rows(), "n_errors": F.count_if(F.col("event_type") == "error"),
         "last_event": F.max("ts")})
    return ops.customer_360(
        master, _KEY,
        [ops.Rollup(per_customer, ("n_orders", "n_priorities"), "orders_changed"),
         ops.Rollup(per_line, ("n_lines",), "lines_changed"),
         ops.Rollup(activity, ("n_events",))],
        {"any_open": F.coalesce("any_open", F.lit(False)),
         "is_unassigned": (F.col("n_orders") == 0) & (F.col("n_events") == 0)})


_DIM_SQL = """
o AS (SELECT o_custkey AS cust, count(*) AS n_orders, count(DISTINCT o_orderpriority) AS n_priorities,
             bool_or(o_orderstatus = 'O') AS any_open, max(o_orderdate) AS changed
      FROM orders GROUP BY 1),
l AS (SELECT o_custkey AS cust, count(*) AS n_lines, max(l_shipdate) AS changed
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
e AS (SELECT user_id AS cust, count(*) AS n_events,
             count(*) FILTER (WHERE event_type = 'error') AS n_errors, max(ts) AS last_event
      FROM events GROUP BY 1),
dim AS (
  SELECT c_custkey AS cust, c_name, c_mktsegment, c_acctbal < -900 AS is_deleted,
         c_acctbal < -500 AS is_blocked, coalesce(n_orders, 0) AS n_orders,
         coalesce(n_priorities, 0) AS n_priorities, coalesce(any_open, false) AS any_open,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_events, 0) AS n_events, n_errors, last_event,
         n_orders IS NULL AND n_events IS NULL AS is_unassigned,
         CASE WHEN c_mktsegment <> 'MACHINERY'
              THEN greatest(TIMESTAMP '1998-01-01', o.changed, l.changed) END AS any_changed
  FROM customer LEFT JOIN o ON o.cust = c_custkey LEFT JOIN l ON l.cust = c_custkey
       LEFT JOIN e ON e.cust = c_custkey)
"""


@query(f"""
WITH {_DIM_SQL}
SELECT cust, c_name, is_deleted, is_blocked, n_orders, n_priorities, any_open, n_lines, n_events,
       is_unassigned, {SORTABLE_SQL.format('any_changed')} AS any_changed
FROM dim
""")
def dim_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dimension(spark, sf_dir)
            .withColumn("any_changed", sortable_text("any_changed_utc"))
            .drop("c_mktsegment", "n_errors", "last_event", "master_changed_utc",
                  "any_changed_utc"))


@query(f"""
WITH {_DIM_SQL}
SELECT cust, date_diff('day', CAST(last_event AS DATE), DATE '2024-02-01') AS days_since_dunned,
       date_diff('minute', any_changed, TIMESTAMP '{AS_OF}') AS minutes_since_change,
       CASE WHEN is_deleted THEN 'DELETED' WHEN is_blocked THEN 'BLOCKED'
            WHEN coalesce(n_errors, 0) >= 3 THEN 'DUNNING_SEVERE'
            WHEN coalesce(n_errors, 0) > 0 THEN 'DUNNING'
            WHEN is_unassigned THEN 'UNASSIGNED' ELSE 'OK' END AS risk_bucket
FROM dim
""")
def risk_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = ops.risk_view(dimension(spark, sf_dir), ntz(AS_OF), F.col("is_deleted"),
                         F.col("is_blocked"), F.col("n_errors"), F.col("is_unassigned"),
                         "last_event")
    return view.select("cust", "days_since_dunned", "minutes_since_change", "risk_bucket")


@query("""
WITH s AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1),
t AS (SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_parts,
             count(DISTINCT l_suppkey) AS n_suppliers
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, coalesce(t.n_rows, 0) AS n_rows,
       coalesce(n_parts, 0) AS n_parts, coalesce(n_suppliers, 0) AS n_suppliers
FROM s LEFT JOIN t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber
""")
def bridge_order_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines at their own grain with counts of their returns."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    child = latest_per_key(lines, keys, "l_shipdate",
                           tiebreak=[F.desc("l_partkey"), F.desc("l_suppkey")])
    return ops.bridge(child.select(*keys, "l_partkey", "l_suppkey"),
                      lines.filter(F.col("l_returnflag") == "R"), keys,
                      {"n_rows": ops.rows(), "n_parts": ops.distinct("l_partkey"),
                       "n_suppliers": ops.distinct("l_suppkey")})


@query("""
WITH p AS (SELECT CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS code,
                  CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders),
g AS (
  SELECT 'CODE' AS level, code, count(*) AS n, sum(amount) AS a FROM p GROUP BY code
  UNION ALL SELECT 'FLAGGED', NULL, count(*), sum(amount) FROM p WHERE code <> ''
  UNION ALL SELECT 'TOTAL', NULL, count(*), sum(amount) FROM p),
t AS (SELECT n AS tn, a AS ta FROM g WHERE level = 'TOTAL')
SELECT level, code, n AS n_rows, CAST(a AS DOUBLE) AS amount, round(n / tn, 6) AS row_share,
       round(CAST(a AS DOUBLE) / CAST(ta AS DOUBLE), 6) AS amount_share
FROM g, t
""")
def deletion_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "code", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")))
    broken_down = ops.deletion_code_breakdown(
        orders, "code", F.col("o_totalprice").cast("decimal(18,2)"), F.col("code") == "")
    return broken_down.withColumn("amount", F.col("amount").cast("double"))


@query("""
SELECT c_custkey FROM customer WHERE NOT (c_acctbal < -900) AND NOT (c_acctbal > 9000)
""")
def active_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").withColumns({
        "gone": F.col("c_acctbal") < -900, "closed": F.col("c_acctbal") > 9000})
    return ops.active_only(df, ["gone", "closed"]).select("c_custkey")


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-01'
""")
def month_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = ops.month_to_date(table(spark, sf_dir, "orders"), "o_orderdate",
                               ntz("2001-07-19 08:00:00"))
    return recent.select("o_orderkey", day_text("o_orderdate").alias("day"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM lineitem
""")
def shape_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = ops.shape_projection(table(spark, sf_dir, "lineitem"),
                                  ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
                                  ["l_shipdate"])
    return shaped.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("""
SELECT l_orderkey, l_partkey, o_custkey, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def shape_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return ops.shape_join(lines, orders, ["l_orderkey"])


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
       count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY 1, 2
""")
def shape_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.shape_group(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "n_rows": ops.rows(),
        "quantity": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"),
        "n_suppliers": ops.distinct("l_suppkey")})


@query("""
SELECT o_orderkey, o_custkey, coalesce(n, 0) AS n_lines, last_ship
FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS last_ship
  FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
""")
def shape_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return ops.shape_preagg(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"],
        {"n_lines": ops.rows(), "last_ship": F.max(F.to_date("l_shipdate")).cast("string")},
        ["n_lines"])


@query(f"""
WITH {LATEST_SQL},
r AS (SELECT user_id, count(*) AS n_types, max(stamp) AS last_changed,
             CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS latest_value
      FROM latest GROUP BY 1)
SELECT c_custkey AS user_id, c_name, coalesce(n_types, 0) AS n_types, last_changed, latest_value
FROM customer LEFT JOIN r ON user_id = c_custkey
""")
def customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source to Gold: parse, keep the latest event per user and kind, roll up, join the master."""
    return ops.shape_preagg(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name"),
        events_silver(spark, sf_dir), ["user_id"],
        {"n_types": ops.rows(), "last_changed": F.max("CDC_TIMESTAMP_TEXT"),
         "latest_value": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")},
        ["n_types"])
