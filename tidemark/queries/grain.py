"""Grain verification."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import grain as ops
from tidemark.operators.profile import union_all
from tidemark.queries.data import KEYS, table
from tidemark.queries.registry import query
from tidemark.spec import ObjectSpec

_COUNTS = ("object_name", "n_rows", "distinct_keys", "null_key_rows", "rows_discarded", "verdict")


def _spec(name: str, *keys: str, **kw) -> ObjectSpec:
    return ObjectSpec(name, name.lower(), keys, **kw)


def _sql(name: str, source: str, keys: str) -> str:
    return f"""
SELECT '{name}' AS object_name, n AS n_rows, d AS distinct_keys, 0 AS null_key_rows,
       n - d AS rows_discarded,
       CASE WHEN n = 0 THEN 'EMPTY' WHEN n <> d THEN 'FAIL' ELSE 'PASS' END AS verdict
FROM (SELECT count(*) AS n, count(DISTINCT ({keys})) AS d FROM {source})"""


@query(_sql("LINEITEM", "lineitem", "l_orderkey, l_linenumber"))
def grain_lineitem_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    obj = _spec("LINEITEM", "l_orderkey", "l_linenumber")
    return ops.verify_grain(table(spark, sf_dir, "lineitem"), obj).select(*_COUNTS)


@query(_sql("ORDERS", "orders", "o_orderkey"))
def grain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.verify_grain(table(spark, sf_dir, "orders"), _spec("ORDERS", "o_orderkey")) \
              .select(*_COUNTS)


@query(_sql("EVENTS", "events", "user_id, event_type"))
def grain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.verify_grain(table(spark, sf_dir, "events"), _spec("EVENTS", *KEYS)) \
              .select(*_COUNTS)


@query("""
WITH o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d,
                  count(DISTINCT o_custkey) AS c FROM orders),
     l AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d FROM lineitem),
     m AS (SELECT count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN '********'
                                      ELSE CAST(o_orderkey AS VARCHAR) END) AS d FROM orders)
SELECT 'BLOCKED_KEY' AS object_name, n AS n_rows, m.d AS distinct_keys, n - m.d AS rows_discarded,
       'BLOCKED' AS verdict FROM o, m
UNION ALL SELECT 'NO_ROWS', 0, 0, 0, 'EMPTY'
UNION ALL SELECT 'FILLED_SINCE', n, d, n - d, 'POPULATED' FROM o
UNION ALL SELECT 'DECLARED_REPEATS', n, d, n - d, 'VIOLATED' FROM l
UNION ALL SELECT 'DRIFTED', n, c, n - c, 'DRIFT' FROM o
UNION ALL SELECT 'OVERRIDDEN', n, d, n - d, 'PASS' FROM o
UNION ALL SELECT 'SHORT', n, c, n - c, 'FAIL' FROM o
UNION ALL SELECT 'DECLARED', n, d, n - d, 'PASS' FROM o
""")
def grain_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    masked = orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", "********")
                               .otherwise(F.col("o_orderkey").cast("string")))
    none = orders.filter(F.col("o_orderkey").isNull())
    wide = ("o_orderkey", "o_custkey")
    cases = [
        (masked, _spec("BLOCKED_KEY", "o_orderkey"), None),
        (none, _spec("NO_ROWS", "o_orderkey"), None),
        (orders, _spec("FILLED_SINCE", "o_orderkey", object_class="EMPTY"), None),
        (lines, _spec("DECLARED_REPEATS", "l_orderkey", "l_linenumber"),
         ("l_orderkey", "l_linenumber")),
        (orders, _spec("DRIFTED", "o_custkey"), ("o_orderkey",)),
        (orders, _spec("OVERRIDDEN", "o_orderkey", key_override=True,
                       key_override_reason="customer is not part of the key"), wide),
        (orders, _spec("SHORT", "o_custkey"), None),
        (orders, _spec("DECLARED", "o_orderkey"), ("o_orderkey",)),
    ]
    return union_all([ops.verify_grain(df, obj, declared, declared and "PK")
                      for df, obj, declared in cases]) \
        .select("object_name", "n_rows", "distinct_keys", "rows_discarded", "verdict")


@query("""
WITH o AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderpriority
           FROM orders),
     keys AS (SELECT DISTINCT o_custkey, o_orderpriority FROM o)
SELECT (SELECT count(*) FROM o) AS n_rows, (SELECT count(*) FROM keys) AS distinct_keys,
       (SELECT count(*) FROM o WHERE o_custkey IS NULL) AS null_key_rows
""")
def grain_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    return ops.grain_counts(orders, ["o_custkey", "o_orderpriority"]).drop("distinct_declared")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def grain_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
""")
def grain_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]) \
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
