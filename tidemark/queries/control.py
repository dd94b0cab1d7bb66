"""Registry, keys, poll, capture jobs and monitoring.

Control rows are derived from the tables: each event type is an object, so
watermarks, counts and keys are those of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.fixed import OPERATION, TIMESTAMP
from tidemark.operators import bronze, control as ops, signals
from tidemark.operators.gold import GoldDef
from tidemark.operators.grain import GrainError
from tidemark.operators.profile import union_all
from tidemark.plans.capture import Capture, MetadataError
from tidemark.queries.data import (
    AS_OF, EVENTS_SQL, FIRST_DELTA, FLOW, KEYS, LATEST_SQL, MIDWAY, SORTABLE_SQL, at,
    events_bronze, events_silver, events_standard, orders_after, orders_before, table,
)
from tidemark.queries.profile import _LEADING, inferred_key_rows, inferred_sql
from tidemark.queries.registry import query
from tidemark.sources import ControlTables, work_dir
from tidemark.sources.control import conform
from tidemark.sources.snapshots import buckets_for
from tidemark.spec import CaptureSpec, ObjectSpec, ReferentialRule, cdc_objects, silver_objects

_ASSURED = "2024-02-01 06:00:00"


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry row per event type, polled to its newest watermark."""
    newest = (events_standard(spark, sf_dir).groupBy("event_type")
              .agg(F.max(TIMESTAMP).alias("last_watermark_text")))
    return conform("registry", newest.withColumns({
        "object_name": F.upper("event_type"), "source": F.lit("events"),
        "track": F.lit("STANDARD"), "merge_key_columns": F.array(*[F.lit(k) for k in KEYS]),
        "key_source": F.lit("declared"), "key_override": F.lit(False),
        "target": F.concat(F.lit("SILVER."), F.upper("event_type")),
        "object_class": F.lit("TRANSACTION"), "last_run_status": F.lit("REFRESHED")}))


@query(f"""
WITH {EVENTS_SQL},
held AS (SELECT upper(event_type) AS object_name, max(stamp) AS wm FROM std
         WHERE ts < TIMESTAMP '{MIDWAY}' AND event_type <> 'error' GROUP BY 1),
spec AS (SELECT DISTINCT upper(event_type) AS object_name FROM std WHERE event_type <> 'click')
SELECT coalesce(s.object_name, h.object_name) AS object_name,
       CASE WHEN s.object_name IS NULL AND h.object_name = 'VIEW' THEN 'EMPTY'
            ELSE 'TRANSACTION' END AS object_class,
       CASE WHEN s.object_name IS NULL AND h.object_name = 'VIEW' THEN NULL
            ELSE 'SILVER.' || coalesce(s.object_name, h.object_name) END AS target,
       h.wm AS last_watermark_text,
       CASE WHEN h.object_name IS NULL THEN 'REGISTERED' ELSE 'REFRESHED' END AS last_run_status
FROM spec s FULL OUTER JOIN held h ON s.object_name = h.object_name
""")
def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERROR is new, CLICK left the spec, VIEW was EMPTY and is no longer."""
    early = events_standard(spark, sf_dir).filter(
        (F.col(TIMESTAMP) < F.lit(f"{MIDWAY}T00:00:00,0000000Z"))
        & (F.col("event_type") != "error"))
    name = F.upper("event_type")
    empty = name == "VIEW"
    held = conform("registry", early.groupBy("event_type").agg(
        F.max(TIMESTAMP).alias("last_watermark_text")).withColumns({
            "object_name": name, "last_run_status": F.lit("REFRESHED"),
            "object_class": F.when(empty, "EMPTY").otherwise("TRANSACTION"),
            "target": F.when(~empty, F.concat(F.lit("SILVER."), name))}))
    spec = _objects(spark, sf_dir).filter("object_name <> 'CLICK'").drop("target", *ops.STATE)
    merged = ops.upsert_registry(held, spec, at(AS_OF))
    return merged.select("object_name", "object_class", "target", "last_watermark_text",
                         "last_run_status")


# -- declared keys ------------------------------------------------------------------------

_NAMES = ("ORDERS", "LINEITEM", "CONVERSATIONS", "EVENTS")


def _key_registry(spark: SparkSession) -> DataFrame:
    configured = {"ORDERS": ["o_orderkey"], "LINEITEM": ["l_orderkey", "l_linenumber"],
                  "CONVERSATIONS": ["turn", "conv_id"], "EVENTS": KEYS, "PAGES": ["page_id"]}
    rows = [(n, n.lower(), k, "declared", n == "EVENTS") for n, k in configured.items()]
    return conform("registry", spark.createDataFrame(
        rows, "object_name string, source string, merge_key_columns array<string>, "
              "key_source string, key_override boolean"))


def _key_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry, and declared-key snapshots of an early image and of the whole tables.

    Early on an order was one line of its customer, and the events key was another.
    Tables that did not change in between are surveyed once.
    """
    registry = _key_registry(spark)
    same = inferred_key_rows(spark, sf_dir, tuple(n for n in _NAMES if n != "LINEITEM"))
    late = inferred_key_rows(spark, sf_dir, ("LINEITEM",))
    early = inferred_key_rows(spark, sf_dir, ("LINEITEM",), {"LINEITEM": table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")})
    first = ops.snapshot_declared_keys(registry, same.unionByName(early), at(_ASSURED))
    return registry, first, ops.snapshot_declared_keys(registry, same.unionByName(late), at(AS_OF))


_EARLY_LINEITEM = inferred_sql("lineitem", ["l_partkey", "l_orderkey", "l_suppkey",
                                            "l_linenumber", "l_quantity", "l_extendedprice"])


def _keys_sql(early: bool) -> str:
    parts = []
    for n in _NAMES:
        source, cols = ("events", _LEADING["CHANGES"][1]) if n == "EVENTS" else _LEADING[n]
        key = _EARLY_LINEITEM if early and n == "LINEITEM" else inferred_sql(source, cols)
        parts.append(f"SELECT '{n}' AS object_name, {key} AS key_columns")
    return " UNION ALL ".join(parts) + " UNION ALL SELECT 'PAGES', NULL"


@query(f"""
SELECT object_name, lower(object_name) AS source_table, key_columns,
       CASE WHEN key_columns IS NOT NULL THEN 'PK_' || object_name END AS constraint_name,
       CASE WHEN key_columns IS NOT NULL THEN true END AS rely
FROM ({_keys_sql(False)})
""")
def declared_key_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inferred_key_rows(spark, sf_dir, _NAMES)
    return ops.snapshot_declared_keys(_key_registry(spark), keys, at(AS_OF)).drop("checked_at")


@query(f"""
SELECT object_name, key_columns AS declared_key_columns,
       CASE WHEN key_columns IS NOT NULL THEN 'PK_' || object_name END AS declared_key_constraint
FROM ({_keys_sql(True)})
""")
def key_baseline_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded from the first snapshot; the second leaves it alone."""
    registry, first, second = _key_snapshots(spark, sf_dir)
    baseline = conform("object_baseline", registry.select("object_name"))
    seeded = ops.seed_key_baseline(ops.seed_key_baseline(baseline, first), second)
    return seeded.select("object_name", "declared_key_columns", "declared_key_constraint")


@query(f"""
WITH b AS ({_keys_sql(True)}), d AS ({_keys_sql(False)}),
c(object_name, config_key_columns, override) AS (VALUES
  ('ORDERS', 'o_orderkey', false), ('LINEITEM', 'l_orderkey,l_linenumber', false),
  ('CONVERSATIONS', 'turn,conv_id', false), ('EVENTS', 'user_id,event_type', true),
  ('PAGES', 'page_id', false))
SELECT object_name, config_key_columns, b.key_columns AS baseline_key_columns,
       d.key_columns AS declared_key_columns,
       CASE WHEN b.key_columns IS DISTINCT FROM d.key_columns THEN 'DECLARED_KEY_CHANGED'
            WHEN d.key_columns IS NULL THEN 'NO_DECLARED_KEY'
            WHEN list_sort(string_split(config_key_columns, ','))
              <> list_sort(string_split(d.key_columns, ','))
              THEN CASE WHEN override THEN 'OVERRIDDEN' ELSE 'CONFIG_DRIFT' END
            ELSE 'MATCH' END AS verdict
FROM c JOIN b USING (object_name) JOIN d USING (object_name)
""")
def key_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, first, second = _key_snapshots(spark, sf_dir)
    baseline = ops.seed_key_baseline(
        conform("object_baseline", registry.select("object_name")), first)
    drift = ops.key_drift(registry, baseline, first.unionByName(second))
    return drift.select("object_name", "config_key_columns", "baseline_key_columns",
                        "declared_key_columns", "verdict")


@query("""
WITH counted AS (SELECT upper(event_type) AS object_name, count(*) FILTER (
  WHERE value > (SELECT max(value) FROM events WHERE event_type = 'error')) AS n FROM events GROUP BY 1)
SELECT object_name, n > 0 AS in_silver, n > 1 AS logged FROM counted
""")
def spec_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per event type, EMPTY where none is dearer than all errors; a log asked for by an EMPTY one is not kept."""
    events = table(spark, sf_dir, "events")
    dearest = events.filter("event_type = 'error'").agg(F.max("value")).scalar()
    counted = (events.withColumn("dear", F.col("value") > dearest).groupBy(F.upper("event_type").alias("name"))
               .agg(F.count_if("dear").alias("n")).collect())
    spec = CaptureSpec("STANDARD", flow_hash=FLOW, objects=tuple(
        ObjectSpec(r.name, "events", tuple(KEYS), "TRANSACTION" if r.n else "EMPTY", cdc_log=r.n != 1)
        for r in counted))
    silver, logged = silver_objects(spec), cdc_objects(spec)
    return spark.createDataFrame([(o.name, o in silver, o in logged) for o in spec.objects],
                                 "object_name string, in_silver boolean, logged boolean")


# -- poll and capture -----------------------------------------------------------------------

@query(f"WITH {EVENTS_SQL} SELECT max(stamp) AS watermark FROM std")
def poll_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.poll_watermark(events_standard(spark, sf_dir), TIMESTAMP)


def _customer_activity() -> GoldDef:
    """Per user: how many kinds of event, the newest stamp, and the spend of the latest ones."""
    def build(inputs: dict[str, DataFrame]) -> DataFrame:
        return inputs["EVENTS"].groupBy("user_id").agg(
            F.count("*").alias("n_types"), F.max("CDC_TIMESTAMP_TEXT").alias("last_changed"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("latest_value"))
    return GoldDef("ACTIVITY", ("user_id",), {"EVENTS": ("user_id",)}, build)


def _captured(spark: SparkSession, sf_dir: str) -> tuple[Capture, list]:
    """Three cycles over landed files: first load, no change, then the rest of the events."""
    root = work_dir(spark, "capture")
    events = events_standard(spark, sf_dir)
    users = events.groupBy("user_id").agg(
        *[F.max(c).alias(c) for c in events.columns if c not in ("user_id", "event_id")])
    midway = F.col(TIMESTAMP) < F.lit(f"{MIDWAY}T00:00:00,0000000Z")
    events.filter(midway).write.parquet(f"{root}/landed/events")
    users.write.parquet(f"{root}/landed/users")
    spec = CaptureSpec(
        "STANDARD",
        (ObjectSpec("EVENTS", f"{root}/landed/events", tuple(KEYS), "TRANSACTION",
                    cdc_log=True, tiebreak=("event_id",)),
         ObjectSpec("USERS", f"{root}/landed/users", ("user_id",)),
         ObjectSpec("ABSENT", f"{root}/landed/absent", ("user_id",))),
        flow_hash=FLOW, referential=ReferentialRule("USERS", ("user_id",), ("EVENTS",)),
        gold=(_customer_activity(),))
    capture = Capture(spark, spec, root, buckets_for(events.count()))
    capture.register("2024-02-01 05:00:00")
    results = [capture.cycle("2024-02-01 05:15:00"), capture.cycle("2024-02-01 05:30:00")]
    events.filter(~midway).write.mode("append").parquet(f"{root}/landed/events")
    results.append(capture.cycle("2024-02-01 05:45:00"))
    return capture, results


@query("""
SELECT * FROM (VALUES
  (1, 'ABSENT', 'ERROR', NULL), (1, 'ACTIVITY', NULL, 'FULL'),
  (1, 'EVENTS', 'REFRESHED', 'FULL'), (1, 'USERS', 'REFRESHED', 'FULL'),
  (2, 'ABSENT', 'ERROR', NULL), (2, 'ACTIVITY', NULL, 'NO_DATA'),
  (2, 'EVENTS', 'NO_CHANGE', NULL), (2, 'USERS', 'NO_CHANGE', NULL),
  (3, 'ABSENT', 'ERROR', NULL), (3, 'ACTIVITY', NULL, 'INCREMENTAL'),
  (3, 'EVENTS', 'REFRESHED', 'INCREMENTAL'), (3, 'USERS', 'NO_CHANGE', NULL)
) AS t(cycle, object_name, status, action)
""")
def capture_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, results = _captured(spark, sf_dir)
    rows = [(i, n, r.statuses.get(n), r.actions.get(n)) for i, r in enumerate(results, 1)
            for n in sorted({*r.statuses, *r.actions})]
    return spark.createDataFrame(
        rows, "cycle int, object_name string, status string, action string")


@query(f"""
WITH {LATEST_SQL}
SELECT user_id, count(*) AS n_types, max(stamp) AS last_changed,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS latest_value
FROM latest GROUP BY user_id
""")
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold table after an incremental refresh equals a full computation."""
    capture, _ = _captured(spark, sf_dir)
    gold = capture.store.read("ACTIVITY")
    return gold.withColumn("latest_value", F.col("latest_value").cast("double"))


@query("""
SELECT 'EVENTS' AS target, 'FULL' AS refresh_action, 'SUCCEEDED' AS state, 1 AS n
UNION ALL SELECT 'EVENTS', 'INCREMENTAL', 'SUCCEEDED', 1
UNION ALL SELECT 'ACTIVITY', 'FULL', 'SUCCEEDED', 1
UNION ALL SELECT 'ACTIVITY', 'INCREMENTAL', 'SUCCEEDED', 1
UNION ALL SELECT 'USERS', 'FULL', 'SUCCEEDED', 1
""")
def refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    capture, _ = _captured(spark, sf_dir)
    history = ops.refresh_history(capture.control.read("refresh_audit"))
    return history.groupBy("target", "refresh_action", "state").agg(F.count("*").alias("n"))


@query(f"""
WITH {LATEST_SQL},
w AS (SELECT count(*) AS n, max(stamp) AS wm FROM std),
s AS (SELECT count(*) AS n FROM latest),
k AS (SELECT user_id, max(load_type) AS load_type FROM std GROUP BY 1),
u AS (SELECT count(*) AS n, CASE WHEN bool_and(load_type = 'initial') THEN 'SNAPSHOT_ONLY'
                                 ELSE 'MERGING' END AS reload FROM k)
SELECT 'EVENTS' AS object_name, 'NO_CHANGE' AS last_run_status, 'USABLE' AS metadata_verdict,
       'MERGING' AS reload_verdict, 'MATCH' AS key_verdict, w.n AS source_rows,
       s.n AS silver_rows, w.n - s.n AS row_difference,
       CASE WHEN w.n = s.n THEN 'MATCH' ELSE 'DIFFERENCE' END AS reconcile_verdict
FROM w, s
UNION ALL
SELECT 'USERS', 'NO_CHANGE', 'USABLE', reload, 'NO_DECLARED_KEY', n, n, 0, 'MATCH' FROM u
""")
def capture_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health after assurance. The key catalogue names the configured key of EVENTS only."""
    capture, _ = _captured(spark, sf_dir)
    readable = CaptureSpec("STANDARD", capture.spec.objects[:2], flow_hash=FLOW)
    capture = Capture(spark, readable, capture.control.root, capture.store.buckets)
    capture.cycle("2024-02-01 06:00:00")
    types = events_standard(spark, sf_dir).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.lit(i).alias("key_sequence"))
        for i, k in enumerate(KEYS, 1)])).alias("k")).distinct()
    keys = types.select(F.lit("EVENTS").alias("table_name"), "k.column_name", "k.key_sequence",
                        F.lit("PK_EVENTS").alias("constraint_name"), F.lit(True).alias("rely"))
    capture.daily_assurance(_ASSURED, keys)
    return (capture.health(AS_OF).filter(F.col("object_name") != "ABSENT")
            .drop("object_class", "minutes_behind", "operation_card", "operation_max_len",
                  "hash_suffix_seen"))


@query(f"""
WITH {LATEST_SQL}
SELECT 'metadata_unusable' AS finding,
       CASE WHEN count(DISTINCT op) > 12 OR max(length(op)) > 2 OR count(stamp) = 0 THEN 2 ELSE 0 END AS objects
FROM std
UNION ALL SELECT 'keys_drifted', 0
UNION ALL SELECT 'counts_differ',
  CASE WHEN (SELECT count(*) FROM std) <> (SELECT count(*) FROM latest) THEN 1 ELSE 0 END
""")
def daily_assurance(spark: SparkSession, sf_dir: str) -> DataFrame:
    capture, _ = _captured(spark, sf_dir)
    readable = CaptureSpec("STANDARD", capture.spec.objects[:2], flow_hash=FLOW)
    found = Capture(spark, readable, capture.control.root, capture.store.buckets) \
        .daily_assurance(_ASSURED)
    return spark.createDataFrame(sorted(found.items()), "finding string, objects int")


@query("""
WITH l AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d FROM lineitem),
     o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d, count(DISTINCT o_custkey) AS c FROM orders),
     e AS (SELECT count(DISTINCT event_type) > 12 OR max(length(event_type)) > 2 AS corrupt FROM events),
     attempts AS (
       SELECT 'lines' AS attempt, CASE WHEN n <> d THEN 'FAIL' END AS stopped_by, n - d AS lost, n FROM l
       UNION ALL SELECT 'orders', CASE WHEN n <> d THEN 'FAIL' END, n - d, n FROM o
       UNION ALL SELECT 'orders_by_customer', CASE WHEN n <> c THEN 'FAIL' END, n - c, n FROM o
       UNION ALL SELECT 'events', CASE WHEN corrupt THEN 'UNUSABLE' END, 0, 0 FROM e)
SELECT attempt, stopped_by, lost, CASE WHEN stopped_by IS NULL THEN 1 ELSE 0 END AS registered,
       CASE WHEN stopped_by IS NULL THEN n ELSE 0 END AS silver_rows
FROM attempts
UNION ALL
SELECT 'events_registered', CASE WHEN corrupt THEN 'UNUSABLE' END, 0, 1, 0 FROM e
""")
def build_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds by right and short keys, one over corrupt metadata, and a cycle over the same without the gate."""
    corrupt = f"{work_dir(spark, 'corrupt')}/events"
    events_standard(spark, sf_dir).withColumn(OPERATION, F.col("event_type")).write.parquet(corrupt)
    attempts = {
        "lines": (f"{sf_dir}/lineitem.parquet", ("l_orderkey", "l_linenumber"), "l_shipdate"),
        "orders": (f"{sf_dir}/orders.parquet", ("o_orderkey",), "o_orderdate"),
        "orders_by_customer": (f"{sf_dir}/orders.parquet", ("o_custkey",), "o_orderdate"),
        "events": (corrupt, ("event_id",), None)}
    rows = []
    for attempt, (source, keys, stamp) in attempts.items():
        spec = CaptureSpec("CUSTOM" if stamp else "STANDARD", (ObjectSpec("T", source, keys),),
                           flow_hash=None if stamp else FLOW, watermark_column=stamp)
        capture, stopped_by, lost = Capture(spark, spec, work_dir(spark, attempt), 8), None, 0
        try:
            capture.build(_ASSURED)
        except (GrainError, MetadataError) as refusal:
            stopped_by, = {r.verdict for r in refusal.rows}
            lost = sum(r.asDict().get("rows_discarded", 0) for r in refusal.rows)
        rows.append(_built(attempt, stopped_by, lost, capture))
    capture.register(_ASSURED)
    rows.append(_built("events_registered", capture.cycle(AS_OF).statuses["T"], 0, capture))
    return spark.createDataFrame(rows, "attempt string, stopped_by string, lost bigint, "
                                       "registered bigint, silver_rows bigint")


def _built(attempt: str, stopped_by: str | None, lost: int, capture: Capture) -> tuple:
    head = capture.store.head("T")
    return (attempt, stopped_by, lost, capture.control.read("registry").count(),
            capture.store.row_count(head) if head else 0)


# -- monitoring -----------------------------------------------------------------------------

_ORPHAN_SQL = """
WITH master AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'ORDERS' AS object_name, count(*) AS orphan_rows FROM orders
WHERE o_orderstatus = 'P' OR o_custkey NOT IN (SELECT c_custkey FROM master)
UNION ALL
SELECT 'EVENTS', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM master)
"""


@query(_ORPHAN_SQL)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt are missing from the master; partial orders have no customer."""
    master = (table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
              .select(F.col("c_custkey").alias("cust")))
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("cust"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("cust"))
    return ops.orphans(master, {"ORDERS": orders, "EVENTS": events}, ["cust"])


@query(f"""
WITH {LATEST_SQL}
SELECT 'EVENTS' AS object_name, s.n AS source_rows, t.n AS silver_rows, s.n - t.n AS difference,
       CASE WHEN s.n = t.n THEN 'MATCH' ELSE 'DIFFERENCE' END AS verdict
FROM (SELECT count(*) AS n FROM std) s, (SELECT count(*) AS n FROM latest) t
UNION ALL
SELECT 'SILVER', t.n, t.n, 0, 'MATCH' FROM (SELECT count(*) AS n FROM latest) t
""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, silver = events_standard(spark, sf_dir), events_silver(spark, sf_dir)
    return union_all([ops.reconcile(source, silver, "EVENTS"),
                      ops.reconcile(silver, silver, "SILVER")])


@query("""
SELECT o_orderkey, 'silver' AS missing_in FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
UNION ALL
SELECT o_orderkey, 'source' FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
""")
def reconcile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.reconcile_keys(orders_after(spark, sf_dir), orders_before(spark, sf_dir),
                              ["o_orderkey"])


@query("""
SELECT o_orderkey, 'silver' AS missing_in FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
""")
def reconcile_keys_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few orders are missing; only the key ranges they fall in are shuffled."""
    orders = table(spark, sf_dir, "orders")
    held = orders.filter((F.col("o_orderpriority") != "1-URGENT") | (F.col("o_orderstatus") != "P"))
    return ops.reconcile_keys(orders, held, ["o_orderkey"], parts=4096)


_MINUTES_SQL = f"""
WITH {EVENTS_SQL}
SELECT upper(event_type) AS object_name, {SORTABLE_SQL.format('max(ts)')} AS last_watermark,
       date_diff('minute', max(ts), TIMESTAMP '{AS_OF}') AS minutes_behind
FROM std GROUP BY 1
"""


@query(_MINUTES_SQL)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = ops.freshness(_objects(spark, sf_dir), at(AS_OF))
    return fresh.select("object_name",
                        bronze.watermark_text("last_watermark_utc", "CUSTOM").alias("last_watermark"),
                        "minutes_behind")


@query(f"SELECT object_name, minutes_behind, minutes_behind > 1980 AS stalled FROM ({_MINUTES_SQL})")
def stalled(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = ops.freshness(_objects(spark, sf_dir), at(AS_OF))
    return ops.stalled(fresh, 1980).drop("last_run_status")


@query(f"""
WITH {EVENTS_SQL}
SELECT 'EVENTS' AS object_name, count(*) AS total_rows,
       count(*) FILTER (WHERE load_type = 'initial') AS initial_rows,
       count(*) FILTER (WHERE load_type = 'delta') AS delta_rows, 'MERGING' AS verdict FROM std
UNION ALL
SELECT 'LOADED_ONCE', count(*), count(*), 0, 'SNAPSHOT_ONLY' FROM std WHERE load_type = 'initial'
UNION ALL
SELECT 'REPUBLISHED', count(*), 0, count(*), 'RELOADED' FROM std WHERE load_type = 'delta'
UNION ALL
SELECT 'NOTHING', 0, 0, 0, 'EMPTY'
""")
def reload_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REPUBLISHED lost the rows its baseline was taken from."""
    frame = events_bronze(spark, sf_dir)
    early = F.col("CDC_TIMESTAMP_UTC") < at(FIRST_DELTA)
    now = {"EVENTS": frame, "LOADED_ONCE": frame.filter(early),
           "REPUBLISHED": frame.filter(~early), "NOTHING": frame.filter("event_id IS NULL")}
    mix = bronze.change_mix(now, TIMESTAMP, "STANDARD", OPERATION)
    then = bronze.change_mix({n: frame for n in ("EVENTS", "LOADED_ONCE", "REPUBLISHED")},
                             TIMESTAMP, "STANDARD", OPERATION)
    nothing = conform("object_baseline", mix.select("object_name").limit(0))
    baseline = signals.seed_reload_baseline(nothing, then, at(_ASSURED))
    registry = spark.createDataFrame([(n, "STANDARD") for n in now],
                                     "object_name string, track string")
    found = ops.reload_detection(mix, baseline, registry)
    return found.select("object_name", "total_rows", "initial_rows", "delta_rows", "verdict")


@query("""
WITH loads AS (
  SELECT upper(event_type) AS target, CAST(ts AS DATE) AS day,
         CASE WHEN count(*) > 70 THEN 'FULL' ELSE 'INCREMENTAL' END AS refresh_action
  FROM events GROUP BY 1, 2),
runs AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY day) AS run FROM loads)
SELECT target, CAST(day AS VARCHAR) AS day FROM runs
WHERE refresh_action = 'FULL' AND run > 1
""")
def unexpected_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit of one refresh per event type and day, where busy days were rebuilt in full."""
    day = F.to_date("ts")
    audit = (table(spark, sf_dir, "events").groupBy(F.upper("event_type").alias("target"),
                                                    day.alias("day"))
             .agg(F.when(F.count("*") > 70, "FULL").otherwise("INCREMENTAL")
                  .alias("refresh_action"))
             .withColumn("refresh_start", F.col("day").cast("timestamp")))
    return ops.unexpected_full(audit).select("target", F.col("day").cast("string").alias("day"))


@query("""
WITH a AS (SELECT upper(event_type) AS target, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2)
SELECT target, CAST(day AS VARCHAR) AS day FROM a WHERE day >= DATE '2024-01-20'
""")
def unrecorded_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshes of each event type and day; those before the cut are recorded already."""
    rows = (table(spark, sf_dir, "events")
            .select(F.upper("event_type").alias("target"), F.to_date("ts").alias("refresh_end"))
            .distinct())
    audit = rows.filter(F.col("refresh_end") < F.lit("2024-01-20").cast("date"))
    return ops.unrecorded(audit, rows).select("target", F.col("refresh_end").cast("string")
                                              .alias("day"))
