"""Change-signal semantics, metadata validation, readiness."""

from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from tidemark.fixed import OPERATION, PRUNE_PARTIAL, TIMESTAMP
from tidemark.operators import bronze, findings, signals as ops
from tidemark.operators.profile import profile_object, union_all
from tidemark.plans.readiness import Trial, assess, assess_frames
from tidemark.queries.data import (
    EVENTS_SQL, FIRST_DELTA, FLOW, KEYS, LOAD_TYPE, ORDERS_SQL, SORTABLE_SQL, at, events_bronze, events_custom,
    events_standard, land_clustered, land_unclustered, orders_after, orders_before, table, AS_OF,
)
from tidemark.queries.registry import query
from tidemark.sources import ControlTables, work_dir, write_sink
from tidemark.sources.readers import read_source

_VALIDATION = ("total_rows", "operation_card", "operation_max_len", "timestamps_parsed",
               "degenerate_rows", "hash_suffix_seen", "verdict", "faults")


def _corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operation column holds event types, as on a damaged copy."""
    return events_standard(spark, sf_dir).withColumn(OPERATION, F.col("event_type"))


def _degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metadata column holds the same value on error events."""
    df = events_standard(spark, sf_dir)
    bad = F.col("event_type") == "error"
    return df.withColumns({c: F.when(bad, F.lit("E")).otherwise(F.col(c))
                           for c in (OPERATION, TIMESTAMP, LOAD_TYPE)})


@query(f"""
WITH {EVENTS_SQL}
SELECT count(*) AS total_rows, count(DISTINCT op) AS operation_card,
       max(length(op)) AS operation_max_len, count(stamp) AS timestamps_parsed,
       0 AS degenerate_rows, true AS hash_suffix_seen, 'USABLE' AS verdict,
       CAST(NULL AS VARCHAR) AS faults
FROM std
""")
def validate_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.validate_standard(events_standard(spark, sf_dir), OPERATION, TIMESTAMP, LOAD_TYPE) \
              .select(*_VALIDATION)


@query("""
SELECT count(*) AS total_rows, count(DISTINCT event_type) AS operation_card,
       max(length(event_type)) AS operation_max_len, count(ts) AS timestamps_parsed,
       0 AS degenerate_rows, true AS hash_suffix_seen, 'UNUSABLE' AS verdict,
       'operation column is not a change code' AS faults
FROM events
""")
def validate_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.validate_standard(_corrupt(spark, sf_dir), OPERATION, TIMESTAMP, LOAD_TYPE) \
              .select(*_VALIDATION)


@query("""
SELECT count(*) AS total_rows, 3 AS operation_card, 1 AS operation_max_len,
       count(*) FILTER (WHERE event_type <> 'error') AS timestamps_parsed,
       count(*) FILTER (WHERE event_type = 'error') AS degenerate_rows,
       true AS hash_suffix_seen, 'UNUSABLE' AS verdict,
       'metadata columns hold the same value' AS faults
FROM events
""")
def validate_degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.validate_standard(_degenerate(spark, sf_dir), OPERATION, TIMESTAMP, LOAD_TYPE) \
              .select(*_VALIDATION)


@query("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_type <> 'error') AS timestamps_parsed,
       round(count(*) FILTER (WHERE event_type <> 'error') / count(*), 6) AS parse_rate,
       'USABLE_WITH_NULLS' AS verdict,
       count(*) FILTER (WHERE event_type = 'error') || ' row(s) have no replication timestamp'
         AS faults
FROM events
""")
def validate_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_custom(spark, sf_dir).withColumn(
        "ZZLASTCHGDATE", F.when(F.col("event_type") != "error", F.col("ZZLASTCHGDATE")))
    return ops.validate_custom(df, "ZZLASTCHGDATE")


@query(f"""
WITH {EVENTS_SQL}
SELECT 'CORRUPT' AS object_name, count(*) AS total_rows, 'UNUSABLE' AS verdict,
       'operation column is not a change code; load type carries no flow hash' AS faults FROM std
UNION ALL
SELECT 'EVENTS', count(*), 'USABLE', NULL FROM std
""")
def trust_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"EVENTS": (events_standard(spark, sf_dir), True),
              "CORRUPT": (_corrupt(spark, sf_dir), False)}
    return union_all([
        ops.validate_standard(df, OPERATION, TIMESTAMP, hash_suffixed=hashed, require_hash=True)
        .select(F.lit(name).alias("object_name"), "total_rows", "verdict", "faults")
        for name, (df, hashed) in checks.items()])


_MIX_SQL = f"""
WITH {EVENTS_SQL},
mix AS (
  SELECT 'EVENTS' AS object_name, op AS operation, count(*) AS n_rows FROM std GROUP BY 2
  UNION ALL
  SELECT 'CORRUPT', event_type, count(*) FROM std GROUP BY 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY object_name ORDER BY n_rows DESC, operation) AS rank
  FROM mix)
"""


def _mix(spark: SparkSession, sf_dir: str, top: int | None = None) -> DataFrame:
    frames = {"EVENTS": events_standard(spark, sf_dir), "CORRUPT": _corrupt(spark, sf_dir)}
    return ops.operation_mix(frames, OPERATION, top)


@query(_MIX_SQL + "SELECT object_name, operation, n_rows, rank FROM ranked WHERE rank <= 25")
def operation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir, top=25)


@query(_MIX_SQL + """
SELECT count(DISTINCT object_name) AS objects, count(DISTINCT operation) AS operations,
       CAST(sum(n_rows) AS BIGINT) AS n_rows,
       bool_or(upper(operation) LIKE 'D%') AS delete_code_seen
FROM ranked
""")
def operation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.operation_summary(_mix(spark, sf_dir))


@query(f"WITH {EVENTS_SQL} SELECT load_type, count(*) AS n_rows FROM std GROUP BY 1")
def load_type_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.load_type_mix({"EVENTS": events_standard(spark, sf_dir)}, LOAD_TYPE)


@query(f"""
WITH {EVENTS_SQL}
SELECT count(*) AS n_rows, count(DISTINCT load_type) = 1 AS only_initial,
       CASE WHEN count(DISTINCT load_type) = 1 THEN 'WARN' ELSE 'PASS' END AS status FROM std
""")
def load_type_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.load_type_verdict(load_type_mix(spark, sf_dir))


@query(f"""
WITH {EVENTS_SQL}
SELECT max(stamp) AS raw_max, {SORTABLE_SQL.format('max(ts)')} AS parsed_max, true AS orders_agree
FROM std
""")
def text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    agreed = ops.text_order_agrees(events_standard(spark, sf_dir), TIMESTAMP)
    return agreed.withColumn("parsed_max", bronze.watermark_text("parsed_max", "CUSTOM"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS write_day, count(*) AS n_rows FROM events GROUP BY 1
""")
def write_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ops.write_days(events_custom(spark, sf_dir), "ZZLASTCHGDATE")
    return days.withColumn("write_day", F.col("write_day").cast("string"))


@query("""
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT count(*) AS write_days, CAST(sum(n) AS BIGINT) AS n_rows,
       round(max(n) / sum(n), 6) AS largest_day_share,
       CASE WHEN count(*) <= 1 THEN 'WARN' WHEN max(n) / sum(n) > 0.98 THEN 'PASS' ELSE 'WARN' END
         AS status
FROM d
""")
def merge_or_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_or_reload(events_custom(spark, sf_dir), "ZZLASTCHGDATE")


@query("""
WITH f AS (SELECT min(CAST(ts AS DATE)) AS first FROM events)
SELECT CASE WHEN CAST(ts AS DATE) = first THEN 'initial' ELSE 'delta' END AS load_phase,
       event_type, count(*) AS n_rows
FROM events, f GROUP BY 1, 2
""")
def load_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    phased = ops.infer_load_phase(events_custom(spark, sf_dir), "ZZLASTCHGDATE")
    return phased.groupBy("load_phase", "event_type").agg(F.count("*").alias("n_rows"))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a source whose files are clustered by write time."""
    path, _ = land_clustered(spark, events_custom(spark, sf_dir), ["ZZLASTCHGDATE", "event_id"],
                             "clustered")
    return spark.read.parquet(path)


@query("SELECT 1 AS files_touched, true AS prunes FROM events HAVING count(*) > 0")
def file_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    pruned = ops.pruning_ratio(_clustered(spark, sf_dir), "ZZLASTCHGDATE")
    return pruned.select("files_touched", (F.col("ratio") < PRUNE_PARTIAL).alias("prunes"))


@query("SELECT 1 AS files_total, 1 AS files_touched, CAST(1 AS DOUBLE) AS ratio, 'FAIL' AS status")
def file_pruning_unclustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pruned = ops.pruning_ratio(events_custom(spark, sf_dir), "ZZLASTCHGDATE")
    return pruned.select("files_total", "files_touched", "ratio", "status")


@query(f"""
SELECT count(*) AS n_rows, {SORTABLE_SQL.format('min(ts)')} AS oldest, {SORTABLE_SQL.format('max(ts)')} AS newest,
       true AS apart
FROM events
""")
def zone_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones of files clustered by write time hold all rows and follow one another."""
    zones = ops.zone_map(_clustered(spark, sf_dir), "ZZLASTCHGDATE")
    before = F.lag("newest").over(Window.partitionBy(F.lit(0)).orderBy("oldest", "newest"))
    return (zones.withColumn("before", before)
            .agg(F.sum("n_rows").alias("n_rows"), F.min("oldest").alias("oldest"),
                 F.max("newest").alias("newest"),
                 F.bool_and(F.coalesce(F.col("before") <= F.col("oldest"), F.lit(True))).alias("apart"))
            .withColumns({c: bronze.watermark_text(c, "CUSTOM") for c in ("oldest", "newest")}))


@query("SELECT 1 AS files, true AS dropped FROM events HAVING count(*) > 0")
def file_count_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered copy is the baseline; the given table is the compacted one."""
    baseline = len(_clustered(spark, sf_dir).inputFiles())
    return ops.file_count_drop(events_custom(spark, sf_dir), baseline).drop("baseline_files")


@query(f"""
WITH {EVENTS_SQL}
SELECT 'EVENTS' AS object_name, min(stamp) AS first_initial_ts_text, count(*) AS rows_at_baseline
FROM std
""")
def reload_baseline_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORDERS has a baseline already and an empty object gets none."""
    frame = events_bronze(spark, sf_dir)
    mix = bronze.change_mix({"EVENTS": frame, "NOTHING": frame.filter("event_id IS NULL"),
                             "KNOWN": frame}, TIMESTAMP, "STANDARD", OPERATION)
    control = ControlTables(spark, work_dir(spark, "baseline"))
    held = control.rows("object_baseline", [{"object_name": "KNOWN"}])
    return ops.seed_reload_baseline(held, mix, at(AS_OF)).drop("captured_at")


@query("""
SELECT 'signal.watermark' AS "check", 'WARN' AS status,
       '1 by timestamp, 1 by the standard track, 1 without a signal' AS detail
UNION ALL SELECT 'signal.standard', 'PASS', '1 standard object(s), 1 with a flow hash'
""")
def signal_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"EVENTS": events_standard(spark, sf_dir), "CHANGES": events_custom(spark, sf_dir),
              "ORDERS": table(spark, sf_dir, "orders")}
    profile = union_all([profile_object(n, df, infer=False) for n, df in frames.items()])
    return findings.signal_findings(profile)


@query(f"""
WITH {EVENTS_SQL}
SELECT 'semantics.trustworthy' AS "check", 'FAIL' AS status, '1 of 2 standard object(s) unusable' AS detail
FROM std HAVING count(DISTINCT event_type) > 12 OR max(length(event_type)) > 2
UNION ALL
SELECT 'semantics.operation', 'INFO',
       count(DISTINCT op) + count(DISTINCT event_type) || ' code(s) on 2 object(s); '
       || CASE WHEN bool_or(upper(event_type) LIKE 'D%') THEN 'deletes can be applied'
               ELSE 'no delete code seen, deletes have to be found by comparing keys' END
FROM std
""")
def findings_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings as written for a reader, read back."""
    frames = {"EVENTS": events_standard(spark, sf_dir), "CORRUPT": _corrupt(spark, sf_dir)}
    checks = union_all([ops.validate_standard(df, OPERATION, TIMESTAMP) for df in frames.values()])
    codes = ops.operation_summary(ops.operation_mix(frames, OPERATION))
    path = work_dir(spark, "report")
    findings.write_findings(findings.trust_finding(checks).unionByName(
        findings.operation_finding(codes)), path)
    return spark.read.schema(findings.FINDING).json(path)


@query(f"""
WITH {EVENTS_SQL},
kinds AS (SELECT event_type, count(*) AS n_rows, CAST(sum(user_id) AS BIGINT) AS users, max(stamp) AS newest
          FROM std GROUP BY 1)
SELECT f.sink, k.* FROM kinds k, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) AS f(sink)
""")
def sink_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two appends to each format, partitioned by kind, read back through the readers."""
    events = events_standard(spark, sf_dir).select("event_id", "user_id", "event_type", TIMESTAMP)
    early = F.col(TIMESTAMP) < F.lit(f"{FIRST_DELTA}T00:00:00,0000000Z")
    sums = []
    for sink in ("csv", "json", "orc", "parquet"):
        ref = f"{sink}:{work_dir(spark, sink)}"
        for part in (events.filter(early), events.filter(~early)):
            write_sink(part, ref, partition_by=["event_type"])
        read = read_source(spark, ref, events.schema)
        sums.append(read.groupBy("event_type").agg(
            F.count("*").alias("n_rows"), F.sum("user_id").alias("users"), F.max(TIMESTAMP).alias("newest"))
            .withColumn("sink", F.lit(sink)))
    return union_all(sums)


@query(f"""
WITH {EVENTS_SQL},
days AS (SELECT count(*) AS n FROM std GROUP BY CAST(ts AS DATE))
SELECT 'signal.watermark' AS "check", 'WARN' AS status
UNION ALL SELECT 'signal.standard', 'PASS'
UNION ALL SELECT 'semantics.trustworthy',
  CASE WHEN count(DISTINCT op) <= 12 AND max(length(op)) <= 2 AND count(*) FILTER (WHERE op = stamp) = 0
       THEN 'PASS' ELSE 'FAIL' END FROM std
UNION ALL SELECT 'semantics.operation', 'INFO'
UNION ALL SELECT 'cost.extract', 'WARN'
UNION ALL SELECT 'semantics.load_type',
  CASE WHEN bool_and(load_type = 'initial') THEN 'WARN' ELSE 'PASS' END FROM std
UNION ALL SELECT 'cost.poll',
  CASE WHEN max(stamp) = strftime(max(ts), '%Y-%m-%dT%H:%M:%S,%f') || '0Z'
       THEN 'PASS' ELSE 'FAIL' END FROM std
UNION ALL SELECT 'signal.merge_or_reload',
  CASE WHEN count(*) > 1 AND max(n) / sum(n) > 0.98 THEN 'PASS' ELSE 'WARN' END FROM days
UNION ALL SELECT 'cost.pruning', 'FAIL'
""")
def readiness_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"EVENTS": events_standard(spark, sf_dir), "CHANGES": events_custom(spark, sf_dir),
              "ORDERS": table(spark, sf_dir, "orders")}
    return union_all(assess_frames(frames)).select("check", "status")


@query(f"""
WITH {EVENTS_SQL}
SELECT 'READY WITH CAVEATS' AS verdict,
       concat_ws('; ',
         CASE WHEN max(stamp) = strftime(max(ts), '%Y-%m-%dT%H:%M:%S,%f') || '0Z'
              THEN 'the raw watermark text can be polled' END,
         'extracting a change reads most of the object',
         CASE WHEN count(DISTINCT load_type) > 1 THEN 'a snapshot and deltas have landed' END) AS reasons
FROM std
""")
def readiness_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tracks over landed files, and one source that cannot be read."""
    events = land_unclustered(spark, events_standard(spark, sf_dir), "event_id", "events")
    changes, _ = land_clustered(spark, events_custom(spark, sf_dir), ["ZZLASTCHGDATE"], "changes")
    found = assess(spark, {"EVENTS": events, "CHANGES": changes, "ABSENT": work_dir(spark, "absent")})
    return findings.readiness_verdict(found)


@query(f"""
WITH {EVENTS_SQL}, {ORDERS_SQL}
SELECT 'absent' AS source, 'NOT ASSESSABLE' AS verdict
UNION ALL
SELECT 'corrupt', CASE WHEN count(DISTINCT event_type) > 12 OR max(length(event_type)) > 2
                       THEN 'NOT READY' ELSE 'READY WITH CAVEATS' END FROM std
UNION ALL SELECT 'untried', 'READY WITH CAVEATS' FROM std HAVING count(ts) > 0
UNION ALL SELECT 'tried', 'READY' FROM std HAVING count(ts) > 0
UNION ALL
SELECT 'reloaded', CASE WHEN count(*) > 0 THEN 'READY' END FROM cur
UNION ALL
SELECT 'read_as_appended', CASE WHEN count(*) > 0 THEN 'READY WITH CAVEATS' ELSE 'READY' END
FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM cur)
""")
def readiness_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verdict, from data: two of the cases are tried on a source that lost rows."""
    root = work_dir(spark, "assessed")
    _corrupt(spark, sf_dir).write.parquet(f"{root}/corrupt")
    events, _ = land_clustered(spark, events_custom(spark, sf_dir), ["ZZLASTCHGDATE"], "events")
    before, after = (land_clustered(spark, image(spark, sf_dir).drop("CDC_TIMESTAMP_TEXT").withColumn(
        "ZZLASTCHGDATE", F.col("o_orderdate")), ["ZZLASTCHGDATE"], "image")[0]
        for image in (orders_before, orders_after))
    cases = {
        "absent": (f"{root}/absent", None), "corrupt": (f"{root}/corrupt", None),
        "untried": (events, None), "tried": (events, Trial("T", tuple(KEYS))),
        "reloaded": (after, Trial("T", ("o_orderkey",), before)),
        "read_as_appended": (after, Trial("T", ("o_orderkey",), before, appended=True))}
    return union_all([
        findings.readiness_verdict(assess(spark, {"T": source}, trial=trial))
        .select(F.lit(name).alias("source"), "verdict") for name, (source, trial) in cases.items()])
