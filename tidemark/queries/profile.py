"""Discovery and profiling."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import profile as ops
from tidemark.queries.data import (
    CUSTOMERS_SQL, FLOW, TABLES, customers_flagged, events_custom, events_standard, table,
)
from tidemark.queries.registry import query

_COLUMN_COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}


@query("\nUNION ALL\n".join(
    f"SELECT '{t}' AS object_name, {n} AS n_columns, count(*) AS n_rows FROM {t}"
    for t, n in _COLUMN_COUNTS.items()))
def share_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = ops.share_inventory(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})
    counts = ops.row_counts({t: table(spark, sf_dir, t) for t in TABLES})
    return (inventory.groupBy("object_name").agg(F.count("column_name").alias("n_columns"))
            .join(counts, "object_name"))


def inferred_sql(source: str, columns: list[str]) -> str:
    """The shortest unique leading prefix, NULL parts counted as values."""
    tests = " ".join(
        f"WHEN count(DISTINCT row({', '.join(columns[:i])})) = count(*) "
        f"THEN '{','.join(columns[:i])}'" for i in range(1, len(columns) + 1))
    return f"(SELECT CASE WHEN count(*) = 0 THEN NULL {tests} END FROM {source})"


_LEADING = {
    "ORDERS": ("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"]),
    "LINEITEM": ("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_extendedprice"]),
    "CONVERSATIONS": ("conversations", ["conv_id", "turn", "role", "text"]),
    "EVENTS": ("events", ["event_id", "user_id", "event_type", "value", "props"]),
    "CHANGES": ("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
}


def _profiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"ORDERS": table(spark, sf_dir, "orders"),
            "LINEITEM": table(spark, sf_dir, "lineitem"),
            "CONVERSATIONS": table(spark, sf_dir, "conversations").withColumn(
                "text", F.when(F.col("role") == "user", F.col("text")).otherwise("********")),
            "EVENTS": events_standard(spark, sf_dir), "CHANGES": events_custom(spark, sf_dir)}


def _profile_sql(name: str, track: str, flow: str, wm: str, indicators: str) -> str:
    source, columns = _LEADING[name]
    key = inferred_sql(source, columns)
    masked = "''"
    if name == "CONVERSATIONS":  # what others than the user say is masked
        masked = ("(SELECT CASE WHEN bool_or(role IS DISTINCT FROM 'user') THEN 'text' ELSE '' END "
                  "FROM conversations)")
    if name == "CHANGES":
        key = f"replace({key}, 'ts', 'ZZLASTCHGDATE')"
    return f"""SELECT '{name}' AS object_name, (SELECT count(*) FROM {source}) AS n_rows,
        '{track}' AS track, {flow} AS flow_hash, {wm} AS watermark_column,
        {key} AS inferred_key, {masked} AS masked_columns, '{indicators}' AS indicators"""


PROFILE_SQL = "\nUNION ALL\n".join([
    _profile_sql("ORDERS", "NONE", "NULL", "NULL", ""),
    _profile_sql("LINEITEM", "NONE", "NULL", "NULL", "l_returnflag"),
    _profile_sql("CONVERSATIONS", "NONE", "NULL", "NULL", ""),
    _profile_sql("EVENTS", "STANDARD", f"'{FLOW}'", "'__TIMESTAMP'", ""),
    _profile_sql("CHANGES", "CUSTOM", "NULL", "'ZZLASTCHGDATE'", ""),
])


@query(f"""
SELECT *, CASE WHEN n_rows = 0 THEN 'EMPTY' ELSE 'MASTER' END AS object_class,
       CASE WHEN inferred_key IS NOT NULL THEN 'inferred' END AS key_source
FROM ({PROFILE_SQL})
""")
def object_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.profile_objects(_profiled(spark, sf_dir)).drop("declared_key")


@query(f"""
SELECT count(*) AS objects, count(DISTINCT flow_hash) AS flow_hashes,
       count(*) AS undeclared_keys,
       count(*) FILTER (WHERE track = 'NONE') AS without_signal,
       count(*) FILTER (WHERE masked_columns <> '') AS masked_objects
FROM ({PROFILE_SQL})
""")
def profile_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.profile_notes(ops.profile_objects(_profiled(spark, sf_dir)))


@query(f"""
SELECT object_name, n_rows, track FROM ({PROFILE_SQL})
WHERE n_rows > 0 ORDER BY n_rows DESC, object_name LIMIT 1
""")
def largest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _profiled(spark, sf_dir)
    counted = ops.union_all([ops.profile_object(n, df, infer=False) for n, df in frames.items()])
    return ops.largest(counted).select("object_name", "n_rows", "track")


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT 'DeletionIndicator' AS column_name, 'boolean' AS column_type,
       CAST(deletion_indicator AS VARCHAR) AS value, count(*) AS n_rows
FROM flagged GROUP BY 3
UNION ALL
SELECT 'BillingBlock', 'string', billing_block, count(*) FROM flagged GROUP BY 3
UNION ALL
SELECT 'IsProspect', 'boolean', CAST(is_prospect AS VARCHAR), count(*) FROM flagged GROUP BY 3
""")
def indicator_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.indicator_values(customers_flagged(spark, sf_dir))


@query(f"""
SELECT (SELECT count(*) FROM conversations) AS n_rows,
       {inferred_sql(*_LEADING['CONVERSATIONS'])} AS key_columns
""")
def infer_key_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.infer_key(table(spark, sf_dir, "conversations")).drop("key_parts")


@query(f"""
SELECT (SELECT count(*) FROM lineitem) AS n_rows,
       {inferred_sql(*_LEADING['LINEITEM'])} AS key_columns
""")
def infer_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.infer_key(table(spark, sf_dir, "lineitem")).drop("key_parts")


def inferred_key_rows(spark: SparkSession, sf_dir: str, names: tuple[str, ...],
                      frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """A key catalogue made of the keys the tables really have."""
    frames = frames or {n: table(spark, sf_dir, n.lower()) for n in names}
    return ops.union_all([ops.key_rows(n, ops.infer_key(frames[n]), f"PK_{n}") for n in names])


@query("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, {inferred_sql(*_LEADING[n])} AS key_columns, "
    f"'PK_{n}' AS constraint_name, true AS rely"
    for n in ("ORDERS", "LINEITEM", "CONVERSATIONS")))
def declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.declared_keys(inferred_key_rows(
        spark, sf_dir, ("ORDERS", "LINEITEM", "CONVERSATIONS")))


@query("""
SELECT 'o_custkey' AS column_name,
       count(*) FILTER (WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL) AS masked_rows,
       count(o_custkey) AS filled_rows,
       count(*) FILTER (WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL) > 0 AS masked
FROM orders
UNION ALL
SELECT 'o_orderkey', 0, count(o_orderkey), false FROM orders
""")
def masked_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    hidden = F.when(F.col("o_orderstatus") == "P", F.when(key.isNotNull(), "********"))
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", F.coalesce(hidden, key))
    return ops.masked_columns(orders, ["o_custkey", "o_orderkey"])
