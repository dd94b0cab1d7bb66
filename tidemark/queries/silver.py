"""Bronze and Silver."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.fixed import OPERATION, TIMESTAMP
from tidemark.functions import (
    any_of, bool_true, sortable_text, text_missing, text_present, text_to_number,
)
from tidemark.operators import bronze, silver as ops
from tidemark.operators.profile import union_all
from tidemark.queries.data import (
    AS_OF, CUSTOMERS_SQL, EVENTS_SQL, KEYS, LATEST_SQL, MIDWAY, SORTABLE_SQL, at, customers_flagged,
    events_bronze, events_custom, events_rows, events_silver, new_store, table,
)
from tidemark.queries.registry import query

_WM = "CDC_TIMESTAMP_TEXT"


@query(f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, event_type, op AS "__OPERATION_TYPE", stamp AS "__TIMESTAMP",
       load_type AS "LOAD_TYPE", run_id AS "RUN_ID", {SORTABLE_SQL.format('ts')} AS parsed
FROM std
""")
def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (events_bronze(spark, sf_dir)
            .withColumn("parsed", sortable_text("CDC_TIMESTAMP_UTC"))
            .drop("CDC_TIMESTAMP_UTC", "value", "props"))


@query(f"SELECT event_id, {SORTABLE_SQL.format('ts')} AS watermark_text FROM events")
def bronze_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bronze.bronze_custom(events_custom(spark, sf_dir), "ZZLASTCHGDATE")
    return df.select("event_id", bronze.watermark_text("ZZLASTCHGDATE", "CUSTOM")
                     .alias("watermark_text"))


@query(f"""
WITH {EVENTS_SQL}
SELECT 'EVENTS' AS object_name, op AS operation, load_type, count(*) AS n_rows,
       min(stamp) AS first_seen, max(stamp) AS last_seen
FROM std GROUP BY op, load_type
""")
def change_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.change_mix({"EVENTS": events_bronze(spark, sf_dir)}, TIMESTAMP, "STANDARD",
                             OPERATION)


@query(f"""
SELECT 'CHANGES' AS object_name, CAST(NULL AS VARCHAR) AS operation,
       CAST(NULL AS VARCHAR) AS load_type, count(*) AS n_rows,
       {SORTABLE_SQL.format('min(ts)')} AS first_seen, {SORTABLE_SQL.format('max(ts)')} AS last_seen
FROM events
""")
def change_mix_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.change_mix({"CHANGES": events_custom(spark, sf_dir)}, "ZZLASTCHGDATE", "CUSTOM")


_SILVER_SQL = """
SELECT event_id, user_id, event_type, value, props, op AS "CDC_OPERATION",
       load_type AS "CDC_LOAD_TYPE", run_id AS "CDC_RUN_ID", stamp AS "CDC_TIMESTAMP_TEXT"
FROM latest
"""


@query(f"WITH {LATEST_SQL} {_SILVER_SQL}")
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_silver(spark, sf_dir).drop("CDC_TIMESTAMP_UTC")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
    AS rn FROM orders) WHERE rn = 1
""")
def silver_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate",
                                tiebreak=[F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
WITH o AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey)
           FROM orders)
SELECT o_custkey, o_orderpriority, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM o)
WHERE rn = 1
""")
def silver_nullable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL key parts form one group, so a third of the rows share five keys."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    latest = ops.latest_per_key(orders, ["o_custkey", "o_orderpriority"], "o_orderdate",
                                tiebreak=[F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderpriority", "o_orderkey")


def _null_stamps(nulls: str) -> str:
    return f"""
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type
    ORDER BY CASE WHEN value >= 5 THEN ts END DESC NULLS {nulls}, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def _with_null_stamps(spark: SparkSession, sf_dir: str, nulls: str) -> DataFrame:
    df = events_custom(spark, sf_dir).withColumn(
        "ZZLASTCHGDATE", F.when(F.col("value") >= 5, F.col("ZZLASTCHGDATE")))
    return ops.latest_per_key(df, KEYS, "ZZLASTCHGDATE", nulls, [F.desc("event_id")]) \
              .select("user_id", "event_type", "event_id")


@query(_null_stamps("LAST"))
def silver_null_stamps_lose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_null_stamps(spark, sf_dir, "last")


@query(_null_stamps("FIRST"))
def silver_null_stamps_win(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_null_stamps(spark, sf_dir, "first")


@query(f"""
WITH {CUSTOMERS_SQL}
SELECT c_custkey, coalesce(deletion_indicator, false) AS is_flagged_deleted,
       coalesce(billing_block, '') <> '' OR coalesce(deletion_indicator, false)
         AS is_blocked_any,
       coalesce(billing_block, '') = '' AS dq_block_missing,
       TRY_CAST(dunning_level AS BIGINT) AS dunning_level_num
FROM flagged
""")
def silver_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {
        "is_flagged_deleted": bool_true("DeletionIndicator"),
        "is_blocked_any": any_of(text_present("BillingBlock"), bool_true("DeletionIndicator")),
        "dq_block_missing": text_missing("BillingBlock"),
        "dunning_level_num": text_to_number("DunningLevel"),
    }
    return ops.add_flags(customers_flagged(spark, sf_dir), flags).select("c_custkey", *flags)


def _refreshed(spark: SparkSession, sf_dir: str):
    """A Silver table loaded midway, refreshed to the whole source, then refreshed again."""
    rows = events_rows(spark, sf_dir)
    store = new_store(spark, "silver", rows)
    early = rows.filter(F.col("CDC_TIMESTAMP_UTC") < at(MIDWAY))
    results = [ops.refresh_silver(store, "EVENTS", df, KEYS, _WM, tiebreak=["event_id"])
               for df in (early, rows, rows)]
    return store, rows, results


@query(f"WITH {LATEST_SQL} {_SILVER_SQL}")
def silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, _ = _refreshed(spark, sf_dir)
    return store.read("EVENTS").drop("CDC_TIMESTAMP_UTC")


@query(f"""
WITH {LATEST_SQL},
early AS (SELECT DISTINCT user_id, event_type FROM std WHERE ts < TIMESTAMP '{MIDWAY}')
SELECT 1 AS run, 'FULL' AS action, (SELECT count(*) FROM early) AS n_rows
UNION ALL SELECT 2, 'INCREMENTAL', (SELECT count(*) FROM latest)
UNION ALL SELECT 3, 'NO_DATA', (SELECT count(*) FROM latest)
""")
def silver_refresh_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, results = _refreshed(spark, sf_dir)
    rows = [(i, r.action, store.row_count(store.find("EVENTS", r.snapshot_id)))
            for i, r in enumerate(results, 1)]
    return spark.createDataFrame(rows, "run bigint, action string, n_rows bigint")


@query("SELECT 0 AS only_in_full, 0 AS only_in_held, true AS equal")
def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, rows, _ = _refreshed(spark, sf_dir)
    return ops.incremental_equals_full(store, "EVENTS", rows, KEYS, _WM, tiebreak=["event_id"])


@query("""
SELECT 'spend' AS definition, count(*) AS n_rows, true AS accepted FROM events
UNION ALL SELECT 'names_in_texts', count(*), true FROM events
UNION ALL SELECT 'clock', count(*), false FROM events
UNION ALL SELECT 'chance', count(*), false FROM events
UNION ALL SELECT 'chance_in_a_subquery', count(*), false FROM events
UNION ALL SELECT 'place_of_the_row', count(*), false FROM events
""")
def determinism_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions over the events, and which of them may be built."""
    events = table(spark, sf_dir, "events")
    definitions = {
        "spend": "value * 2", "names_in_texts": "concat(event_type, ' now() rand(')",
        "clock": "datediff(current_date(), ts)", "chance": "uniform(1, 10) + value",
        "chance_in_a_subquery": "value + (SELECT max(id) FROM range(3) WHERE rand() < 2)",
        "place_of_the_row": "monotonically_increasing_id()"}

    def accepted(df: DataFrame) -> bool:
        try:
            ops.assert_deterministic(df)
        except ValueError:
            return False
        return True

    n = F.count("*").alias("n_rows")
    return union_all([
        events.agg(n).select(F.lit(name).alias("definition"), "n_rows", F.lit(
            accepted(events.selectExpr(f"{definition} AS x"))).alias("accepted"))
        for name, definition in definitions.items()])


@query(f"""
WITH runs AS (SELECT upper(event_type) AS object_name, max(ts) AS last_run FROM events
              WHERE event_type <> 'error' OR ts < TIMESTAMP '{MIDWAY}' GROUP BY 1)
SELECT object_name, last_run + INTERVAL 33 HOUR <= TIMESTAMP '{AS_OF}' AS due, true AS due_if_never_run,
       false AS due_without_limit
FROM runs
""")
def refresh_backstop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per event type, last refreshed when its newest event came; errors stood still since midway."""
    recent = (F.col("event_type") != "error") | (F.col("ts") < at(MIDWAY))
    runs = (table(spark, sf_dir, "events").filter(recent).groupBy(F.upper("event_type").alias("object_name"))
            .agg(F.max("ts").alias("last_run")).collect())
    now = datetime.fromisoformat(AS_OF)
    rows = [(r.object_name, ops.refresh_due(r.last_run, 33, now), ops.refresh_due(None, 33, now),
             ops.refresh_due(r.last_run, None, now)) for r in runs]
    return spark.createDataFrame(rows, "object_name string, due boolean, due_if_never_run boolean, "
                                       "due_without_limit boolean")
