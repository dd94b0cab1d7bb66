"""Inserts, updates and deletes between images; feeds and the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import json_of, row_hash, row_image
from tidemark.operators import changes as ops
from tidemark.operators.silver import latest_per_key, refresh_silver, row_differences
from tidemark.queries.data import (
    CHANGES_SQL, EVENTS_SQL, KEYS, LATEST_SQL, MIDWAY, ORDERS_SQL, AS_OF, at, control_beside,
    events_rows, events_silver, new_store, orders_after, orders_before, stored_orders, table,
)
from tidemark.queries.registry import query

_KEY = ["o_orderkey"]
_WM = "CDC_TIMESTAMP_TEXT"


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.snapshot_diff(orders_before(spark, sf_dir), orders_after(spark, sf_dir), _KEY)


_FEED_SQL = f"""
WITH {CHANGES_SQL},
feed AS (
  SELECT 'DELETE' AS action, p.* FROM changes c JOIN prev p USING (o_orderkey)
  WHERE c.change_type IN ('D', 'U')
  UNION ALL
  SELECT 'INSERT', n.* FROM changes c JOIN cur n USING (o_orderkey)
  WHERE c.change_type IN ('I', 'U'))
"""


@query(_FEED_SQL + """
SELECT action, o_orderkey, o_custkey, o_orderstatus, o_totalprice, stamp AS "CDC_TIMESTAMP_TEXT"
FROM feed
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir).drop("o_orderdate", "o_orderpriority")


@query(_FEED_SQL + "SELECT o_orderkey, o_orderstatus FROM feed WHERE action = 'INSERT'")
def insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.insert_only(_feed(spark, sf_dir)).select("o_orderkey", "o_orderstatus")


@query(f"WITH {CHANGES_SQL} SELECT o_orderkey, change_type, status_before, status_after FROM changes")
def image_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = ops.image_changes(orders_before(spark, sf_dir), orders_after(spark, sf_dir), _KEY)
    return changed.select("o_orderkey", "change_type",
                          F.col("before.o_orderstatus").alias("status_before"),
                          F.col("after.o_orderstatus").alias("status_after"))


@query("""
SELECT c_custkey, '{"c_custkey":' || c_custkey || '}' AS key_values,
       '{"c_name":"' || c_name || '","segment":' ||
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'null' ELSE '"' || c_mktsegment || '"' END
       || '}' AS image,
       sha256('{"c_name":"' || c_name || '","segment":' ||
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'null' ELSE '"' || c_mktsegment || '"' END
       || '}') AS image_hash
FROM customer
""")
def row_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images keep NULL fields, so (NULL, x) and (x, NULL) never look alike."""
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        F.lit("A").alias("CDC_OPERATION"))
    image = row_image(df, ("c_custkey", "CDC_OPERATION"))
    return df.select("c_custkey", json_of(["c_custkey"]).alias("key_values"),
                     image.alias("image"), row_hash(image).alias("image_hash"))


@query(f"""
WITH {ORDERS_SQL},
same AS (SELECT o_orderkey FROM prev JOIN cur USING (o_orderkey, o_orderstatus))
SELECT (SELECT count(*) FROM same) AS redelivered, 0 AS logged
""")
def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-stamped but equal rows are a DELETE and an INSERT on the feed, and no event."""
    before, after = orders_before(spark, sf_dir), orders_after(spark, sf_dir)
    feed = ops.snapshot_diff(before, after, _KEY, exclude=())
    events = ops.pair_changes(feed, _KEY)
    paired = feed.groupBy(*_KEY).agg(
        F.count("*").alias("n"), F.count_distinct("o_orderstatus").alias("images"))
    same = paired.filter((F.col("n") == 2) & (F.col("images") == 1)).select(*_KEY)
    return (same.agg(F.count("*").alias("redelivered"))
            .withColumn("logged", events.join(same, _KEY, "left_semi").agg(F.count("*")).scalar()))


@query(f"""
WITH {EVENTS_SQL},
per_key AS (
  SELECT user_id, event_type, arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id,
         count(*) AS n
  FROM std GROUP BY 1, 2)
SELECT user_id, event_type, 'U' AS change_type, first_id, last_id FROM per_key WHERE n > 1
""")
def folded_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with every event of a key: the first image goes out, the last one comes in."""
    rows = events_rows(spark, sf_dir)
    feed = rows.withColumn("action", F.lit("DELETE")).unionByName(
        rows.withColumn("action", F.lit("INSERT")))
    changed = ops.pair_changes(feed, KEYS, wm=_WM)
    return changed.select(*KEYS, "change_type", F.col("before.event_id").alias("first_id"),
                          F.col("after.event_id").alias("last_id"))


@query(f"""
WITH {EVENTS_SQL},
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth_last
  FROM std)
SELECT f.user_id,
       CASE WHEN f.event_type = 'error' AND l.event_type <> 'error' THEN 'U'
            WHEN l.event_type <> 'error' THEN 'I' ELSE 'D' END AS change_type
FROM ordered f JOIN ordered l ON f.user_id = l.user_id AND f.nth = 1 AND l.nth_last = 1
WHERE (f.event_type = 'error' OR l.event_type <> 'error')
""")
def sequenced_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in sequence where an error event deletes: the first and last records decide."""
    feed = events_rows(spark, sf_dir).withColumns({
        "action": F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT"),
        "seq": F.col("event_id")})
    return ops.pair_changes(feed, ["user_id"], seq="seq").select("user_id", "change_type")


@query(f"""
WITH {CHANGES_SQL}
SELECT 'drain-1' AS drain_id, 'ORDERS' AS object_name, count(*) AS inserts, 0 AS updates,
       0 AS deletes FROM prev
UNION ALL
SELECT 'drain-2', 'ORDERS', count(*) FILTER (WHERE change_type = 'I'),
       count(*) FILTER (WHERE change_type = 'U'), count(*) FILTER (WHERE change_type = 'D')
FROM changes
""")
def change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drains of stored snapshots, the second run twice."""
    return ops.change_summary(_drained(spark, sf_dir)).drop("logged_at")


def _drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored_orders(spark, sf_dir, "drain")
    control = control_beside(store)
    first, second = (s.snapshot_id for s in store.history("ORDERS"))
    for drain_id, to_id in (("drain-1", first), ("drain-2", second), ("drain-2", second)):
        ops.drain_changes(store, control, "ORDERS", to_id, drain_id, at(AS_OF))
    return ops.change_log(control)


@query(f"""
WITH {CHANGES_SQL}
SELECT change_type, '{{"o_orderkey":' || o_orderkey || '}}' AS key_values,
       status_before, status_after, stamp AS cdc_timestamp_text
FROM changes
""")
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _drained(spark, sf_dir).filter(F.col("drain_id") == "drain-2")
    return log.select("change_type", "key_values",
                      F.get_json_object("before_image", "$.o_orderstatus").alias("status_before"),
                      F.get_json_object("after_image", "$.o_orderstatus").alias("status_after"),
                      "cdc_timestamp_text")


@query(f"WITH {ORDERS_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM cur")
def apply_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier image with the feed applied is the later image."""
    applied = ops.apply_changes(orders_before(spark, sf_dir), _feed(spark, sf_dir), _KEY)
    return applied.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("SELECT 0 AS only_in_source, 0 AS only_in_target, true AS equal")
def apply_equals_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = orders_before(spark, sf_dir), orders_after(spark, sf_dir)
    applied = ops.apply_changes(before, ops.snapshot_diff(before, after, _KEY, ()), _KEY)
    return row_differences(after, applied, "only_in_source", "only_in_target")


def _merged(spark: SparkSession, sf_dir: str, delete_codes: tuple[str, ...]) -> DataFrame:
    """Silver as of the cut, then everything newer merged in; here views are deletes."""
    rows = events_rows(spark, sf_dir).withColumn(
        "CDC_OPERATION", F.when(F.col("event_type") == "view", "D").otherwise(F.col("CDC_OPERATION")))
    last = f"{MIDWAY}T00:00:00,0000000Z"
    target = latest_per_key(rows.filter(F.col(_WM) <= F.lit(last)), KEYS, _WM)
    return ops.watermark_merge(target, rows, KEYS, _WM, last, "CDC_OPERATION", delete_codes)


@query(f"WITH {LATEST_SQL} SELECT user_id, event_type, event_id FROM latest")
def watermark_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, ()).select(*KEYS, "event_id")


@query(f"""
WITH {LATEST_SQL}
SELECT user_id, event_type, event_id FROM latest
WHERE event_type <> 'view' OR ts <= TIMESTAMP '{MIDWAY}'
""")
def watermark_merge_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, ("D",)).select(*KEYS, "event_id")


@query(f"WITH {LATEST_SQL} SELECT user_id, event_type, event_id FROM latest")
def stored_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a stored table: only the buckets of the newer keys are rewritten."""
    rows = events_rows(spark, sf_dir)
    store = new_store(spark, "merge", rows)
    last = f"{MIDWAY}T00:00:00,0000000Z"
    refresh_silver(store, "EVENTS", rows.filter(F.col(_WM) <= F.lit(last)), KEYS, _WM)
    ops.merge_snapshot(store, "EVENTS", ops.watermark_feed(rows, KEYS, _WM, last))
    return store.read("EVENTS").select(*KEYS, "event_id")


@query(f"""
WITH {ORDERS_SQL}
SELECT s.n AS source_rows, t.n AS target_rows, greatest(t.n - s.n, 0) AS divergence
FROM (SELECT count(*) AS n FROM cur) s, (SELECT count(*) AS n FROM prev) t
""")
def delete_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.delete_divergence(orders_after(spark, sf_dir), orders_before(spark, sf_dir))


@query("SELECT 0 AS events")
def rewrite_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy in other files and another order is no change."""
    orders = orders_after(spark, sf_dir)
    rewritten = orders.repartition("o_orderkey")
    return ops.snapshot_diff(orders, rewritten, _KEY).agg(F.count("*").alias("events"))


@query(f"""
WITH {LATEST_SQL},
early AS (
  SELECT user_id, event_type, max(ts) AS ts FROM std WHERE ts < TIMESTAMP '{MIDWAY}' GROUP BY 1, 2)
SELECT CASE WHEN l.event_type = 'error' THEN 'D' WHEN e.user_id IS NULL THEN 'I' ELSE 'U' END
         AS change_type, count(*) AS n
FROM latest l LEFT JOIN early e USING (user_id, event_type)
WHERE (e.user_id IS NULL AND l.event_type <> 'error')
   OR (e.user_id IS NOT NULL AND (l.event_type = 'error' OR l.ts > e.ts))
GROUP BY 1
""")
def mutation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between two images of Silver every error key vanished and newer events arrived."""
    rows = events_rows(spark, sf_dir)
    then = latest_per_key(rows.filter(F.col("CDC_TIMESTAMP_UTC") < at(MIDWAY)), KEYS, _WM)
    now = events_silver(spark, sf_dir).filter(F.col("event_type") != "error")
    changed = ops.image_changes(then, now, KEYS)
    return changed.groupBy("change_type").agg(F.count("*").alias("n"))
