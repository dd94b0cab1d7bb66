"""Streams over landed files, run to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.rules import sql_rule
from tidemark.operators import changes
from tidemark.operators.control import refresh_history
from tidemark.queries.data import (
    AS_OF, EVENTS_SQL, KEYS, LATEST_SQL, at, control_beside, events_rows, land_clustered,
    new_store, table,
)
from tidemark.queries.registry import query
from tidemark.sources import ControlTables, SnapshotStore, work_dir
from tidemark.spec import ObjectSpec
from tidemark import streaming as ops

_WM = "CDC_TIMESTAMP_TEXT"
_COLUMNS = [*KEYS, "event_id", "value", _WM]


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as files clustered by time, newest first, read in three batches."""
    rows = events_rows(spark, sf_dir).select(*_COLUMNS)
    path, third = land_clustered(spark, rows, [F.desc(_WM), "event_id"], "landed")
    return (spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxFilesPerTrigger", third).parquet(path))


def _upserted(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    store = new_store(spark, "stream", table(spark, sf_dir, "events"))
    started = ops.stream_upsert(_landed(spark, sf_dir), store, "EVENTS", KEYS, _WM,
                                work_dir(spark, "offsets"))
    started.awaitTermination()
    return store


@query(f"WITH {LATEST_SQL} SELECT user_id, event_type, event_id, value, stamp AS \"{_WM}\" FROM latest")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order does not matter: the newest watermark wins."""
    return _upserted(spark, sf_dir).read("EVENTS")


def _captured(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, ControlTables]:
    """Events by a spec with flags and a tiebreak; cheap ones lost their stamp, which wins here."""
    store = new_store(spark, "stream-spec", table(spark, sf_dir, "events"))
    control = control_beside(store)
    spec = ObjectSpec("EVENTS", "landed", tuple(KEYS), "TRANSACTION", tiebreak=("event_id",),
                      flags={"is_cheap": sql_rule("value < 5"), "dq_no_stamp": sql_rule(f"{_WM} IS NULL")})
    stream = _landed(spark, sf_dir).withColumn(_WM, F.when(F.col("value") >= 5, F.col(_WM)))
    ops.stream_capture(stream, store, control, spec, _WM, work_dir(spark, "offsets"), AS_OF,
                       nulls="first").awaitTermination()
    return store, control


@query("""
SELECT user_id, event_type, event_id, value < 5 AS is_cheap, value < 5 AS dq_no_stamp FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type
    ORDER BY CASE WHEN value >= 5 THEN ts END DESC NULLS FIRST, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def stream_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captured(spark, sf_dir)[0].read("EVENTS").drop("value", _WM)


@query("""
SELECT 'EVENTS' AS target, 3 AS batches, 3 AS succeeded, 1 AS full_loads FROM events HAVING count(*) > 0
""")
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of refreshes shows each batch of a stream once."""
    _, control = _captured(spark, sf_dir)
    return (refresh_history(control.read("refresh_audit")).groupBy("target")
            .agg(F.count_distinct("state_message").alias("batches"),
                 F.count_if(F.col("state") == "SUCCEEDED").alias("succeeded"),
                 F.count_if(F.col("refresh_action") == "FULL").alias("full_loads")))


@query(f"WITH {LATEST_SQL} SELECT user_id, event_type, event_id FROM latest")
def stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest logged image of each key is its latest event, whatever landed first."""
    store = new_store(spark, "stream-log", table(spark, sf_dir, "events"))
    control = control_beside(store)
    started = ops.stream_change_log(_landed(spark, sf_dir), store, control, "EVENTS", KEYS, _WM,
                                    work_dir(spark, "offsets"), at(AS_OF), exclude=(_WM,))
    started.awaitTermination()
    newest = changes.change_log(control).groupBy("key_values").agg(
        F.max_by("after_image", "cdc_timestamp_text").alias("image"))
    kinds = {"user_id": "bigint", "event_type": "string", "event_id": "bigint"}
    return newest.select(*[F.get_json_object("image", f"$.{k}").cast(t).alias(k)
                           for k, t in kinds.items()])


@query(f"WITH {LATEST_SQL} SELECT user_id, event_type, event_id FROM latest")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three batches pass on, newest files first, holds the latest row of each key once."""
    ops.use_rocksdb(spark)
    out = _run(ops.latest_state(_landed(spark, sf_dir), KEYS, _WM), spark, "latest")
    return out.groupBy(*KEYS).agg(F.max_by("event_id", F.struct(_WM, "event_id")).alias("event_id"))


def _run(stream: DataFrame, spark: SparkSession, purpose: str) -> DataFrame:
    """Everything a stream passes on, update or append mode alike, with the batch as `batch`."""
    out = work_dir(spark, purpose)
    (stream.writeStream.outputMode("update").foreachBatch(_keep(out))
     .option("checkpointLocation", work_dir(spark, "offsets"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


def _keep(out: str):
    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return keep


def _in_order(spark: SparkSession, rows: DataFrame, by: str, cuts: list[str]) -> DataFrame:
    """Rows landed period by period, as many files each, and read a period a batch."""
    path, bounds = work_dir(spark, "periods"), [None, *cuts, None]
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for start, end in zip(bounds, bounds[1:]):
        part = rows if start is None else rows.where(F.col(by) >= at(start))
        part = part if end is None else part.where(F.col(by) < at(end))
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


@query("""
WITH d AS (SELECT user_id, event_type, ts FROM events
           UNION ALL SELECT user_id, event_type, ts + INTERVAL 1 MINUTE FROM events),
s AS (SELECT *, lag(event_type) OVER (
        PARTITION BY user_id ORDER BY ts, sha256('{"event_type":"' || event_type || '"}')) AS before
      FROM d)
SELECT user_id, event_type, ts FROM s WHERE event_type IS DISTINCT FROM before
""")
def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user did last, every row delivered again a minute later; users return to old images."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    again = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    stream = _in_order(spark, events.unionByName(again), "ts", ["2024-01-10", "2024-01-20"])
    out = work_dir(spark, "once")
    ops.stream_changes(stream, new_store(spark, "stream-last", events), "LAST", ["user_id"], "ts", "60 days",
                       _keep(out), work_dir(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(f"""
WITH {EVENTS_SQL},
d AS (SELECT upper(event_type) AS object_name, max(CAST(ts AS DATE)) AS last FROM std
      WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-10' GROUP BY 1)
SELECT object_name, date_diff('day', last, DATE '2024-02-01') AS days_unread,
       CASE WHEN date_diff('day', last, DATE '2024-02-01') > 14 THEN 'WARN' ELSE 'PASS' END
         AS status
FROM d
""")
def drain_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One drain per event; views were last drained early in the month."""
    drains = table(spark, sf_dir, "events").filter(
        (F.col("event_type") != "view") | (F.col("ts") < at("2024-01-10"))).select(
        F.upper("event_type").alias("object_name"), F.col("ts").alias("logged_at"))
    return ops.drain_staleness(drains, at(AS_OF)).drop("last_drain")
