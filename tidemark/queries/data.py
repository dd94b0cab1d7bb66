"""The given tables in the shapes the capture operators work on.

`events` plays a standard-track and a custom-track object. Two images of
`orders` a retention window apart give inserts, updates and deletes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import sortable_text
from tidemark.operators import bronze, silver
from tidemark.operators.profile import standard_signal
from tidemark.sources import ControlTables, SnapshotStore, work_dir
from tidemark.sources.snapshots import buckets_for

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FLOW = "8f0c2d4e6a1b3c5d7e9f0a2b4c6d8e1f"
LOAD_TYPE, RUN_ID = f"load_type_{FLOW}", f"run_id_{FLOW}"
FIRST_DELTA = "2024-01-15"
MIDWAY = "2024-01-20"
AS_OF = "2024-02-01 06:30:30"
KEYS = ["user_id", "event_type"]
ROWS_OF_A_FILE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def day_text(c: str) -> Column:
    return F.to_date(c).cast("string")


# -- events -----------------------------------------------------------------------------

def raw_stamp(c: str) -> Column:
    """A stamp as the connector writes it: comma decimal, seven digits."""
    micros = F.substring(sortable_text(c), 1, len("2026-06-15T09:41:59.642658"))
    return F.concat(F.replace(micros, F.lit("."), F.lit(",")), F.lit("0Z"))


def events_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("ts") < at(FIRST_DELTA)
    return (table(spark, sf_dir, "events").withColumns({
        "__OPERATION_TYPE": F.when(first, "L").otherwise("A"),
        "__TIMESTAMP": raw_stamp("ts"),
        LOAD_TYPE: F.when(first, "initial").otherwise("delta"),
        RUN_ID: F.lit("flow-1")}).drop("ts"))


def events_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumnRenamed("ts", "ZZLASTCHGDATE")


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_standard(spark, sf_dir)
    return bronze.bronze_standard(df, standard_signal(df.schema))


def events_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows before de-duplication."""
    return silver.lineage(events_bronze(spark, sf_dir))


def events_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.latest_per_key(events_rows(spark, sf_dir), KEYS, "CDC_TIMESTAMP_TEXT",
                                 tiebreak=[F.desc("event_id")])


EVENTS_SQL = f"""
std AS (
  SELECT event_id, user_id, event_type, value, props, ts,
         CASE WHEN ts < TIMESTAMP '{FIRST_DELTA}' THEN 'L' ELSE 'A' END AS op,
         strftime(ts, '%Y-%m-%dT%H:%M:%S,%f') || '0Z' AS stamp,
         CASE WHEN ts < TIMESTAMP '{FIRST_DELTA}' THEN 'initial' ELSE 'delta' END AS load_type,
         'flow-1' AS run_id
  FROM events)"""
LATEST_SQL = EVENTS_SQL + """,
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                 ORDER BY stamp DESC, event_id DESC) AS rn
    FROM std) WHERE rn = 1)"""
SORTABLE_SQL = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '000'"


# -- two images of orders ---------------------------------------------------------------

def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as of the end of 2000."""
    return (table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < at("2001-01-01"))
            .withColumn("CDC_TIMESTAMP_TEXT", F.lit("2001-01-01T00:00:00,0000000Z")))


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders later: 1995 archived, new ones in, old open ones closed, every row re-stamped."""
    closed = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < at("1999-01-01"))
    return (table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= at("1996-01-01"))
            .withColumn("o_orderstatus", F.when(closed, "F").otherwise(F.col("o_orderstatus")))
            .withColumn("CDC_TIMESTAMP_TEXT", F.lit("2001-09-01T00:00:00,0000000Z")))


ORDERS_SQL = """
prev AS (
  SELECT *, '2001-01-01T00:00:00,0000000Z' AS stamp FROM orders
  WHERE o_orderdate < TIMESTAMP '2001-01-01'),
cur AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1999-01-01'
                         THEN 'F' ELSE o_orderstatus END AS o_orderstatus),
         '2001-09-01T00:00:00,0000000Z' AS stamp
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""
CHANGES_SQL = ORDERS_SQL + """,
changes AS (
  SELECT coalesce(c.o_orderkey, p.o_orderkey) AS o_orderkey,
         CASE WHEN p.o_orderkey IS NULL THEN 'I' WHEN c.o_orderkey IS NULL THEN 'D' ELSE 'U' END
           AS change_type,
         p.o_orderstatus AS status_before, c.o_orderstatus AS status_after,
         coalesce(c.stamp, p.stamp) AS stamp
  FROM prev p FULL OUTER JOIN cur c ON p.o_orderkey = c.o_orderkey
  WHERE p.o_orderkey IS NULL OR c.o_orderkey IS NULL
     OR p.o_orderstatus IS DISTINCT FROM c.o_orderstatus)"""


# -- customers with flags -----------------------------------------------------------------

def customers_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with indicator columns of both types and a number held as text."""
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").withColumns({
        "DeletionIndicator": F.when(balance < -900, True).when(balance < 0, False),
        "BillingBlock": F.when(balance < -500, "X").when(balance < 5000, ""),
        "IsProspect": balance > 9000,
        "DunningLevel": F.when(F.col("c_mktsegment") == "BUILDING", "n/a")
        .otherwise((balance / 1000).cast("int").cast("string"))})


CUSTOMERS_SQL = """
flagged AS (
  SELECT *,
         CASE WHEN c_acctbal < -900 THEN true WHEN c_acctbal < 0 THEN false END AS deletion_indicator,
         CASE WHEN c_acctbal < -500 THEN 'X' WHEN c_acctbal < 5000 THEN '' END AS billing_block,
         c_acctbal > 9000 AS is_prospect,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a'
              ELSE CAST(CAST(trunc(c_acctbal / 1000) AS BIGINT) AS VARCHAR) END AS dunning_level
  FROM customer)"""


# -- landed files -------------------------------------------------------------------------

def land_clustered(spark: SparkSession, df: DataFrame, by: Sequence[Column | str],
                   purpose: str) -> tuple[str, int]:
    """Write as a source clustered by range; the path, and a third of its file count."""
    files = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = work_dir(spark, purpose)
    df.repartitionByRange(files, *by).write.parquet(path)
    return path, -(-files // 3)


def land_unclustered(spark: SparkSession, df: DataFrame, by: str, purpose: str) -> str:
    """Write as a source whose files follow no order of time; their number follows from the rows alone."""
    path = work_dir(spark, purpose)
    df.repartition(-(-df.count() // ROWS_OF_A_FILE) or 1, by).write.parquet(path)
    return path


# -- stores ------------------------------------------------------------------------------

def new_store(spark: SparkSession, purpose: str, rows: DataFrame) -> SnapshotStore:
    return SnapshotStore(spark, work_dir(spark, purpose), buckets_for(rows.count()))


def control_beside(store: SnapshotStore) -> ControlTables:
    return ControlTables(store.spark, store.root)


def stored_orders(spark: SparkSession, sf_dir: str, purpose: str) -> SnapshotStore:
    """A store that holds both images of orders, one snapshot each."""
    images = orders_before(spark, sf_dir), orders_after(spark, sf_dir)
    store = new_store(spark, purpose, images[0])
    for image in images:
        silver.refresh_silver(store, "ORDERS", image, ["o_orderkey"], "CDC_TIMESTAMP_TEXT")
    return store
