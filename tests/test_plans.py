"""Shape of the physical plans: what is pruned, pushed, combined early, and never crossed."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, control, grain
from tidemark.queries import QUERIES
from tidemark.queries.data import orders_after, orders_before, table

# These run jobs while they are built, or answer from rows the driver holds.
_EAGER = {
    "capture_cycle", "gold_refresh", "refresh_history", "capture_health", "daily_assurance",
    "silver_refresh", "silver_refresh_actions", "incremental_equals_full", "change_log",
    "change_summary", "stored_merge", "stream_upsert", "stream_change_log", "stream_latest",
    "stream_redelivery", "file_pruning", "file_count_drop", "readiness_verdict",
    "readiness_findings", "share_inventory", "object_profile", "profile_notes",
    "declared_keys", "declared_key_snapshot", "key_baseline_seed", "key_drift",
    "findings_report", "sink_formats", "refresh_backstop", "spec_objects", "stream_capture", "stream_audit", "build_gate", "readiness_verdicts", "zone_map", "infer_key_lineitem", "infer_key_conversations", "reload_baseline_seed", "grain_verdicts",
}


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - _EAGER))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"PythonUDF|EvalPython|InPandas|InArrow", text)


@pytest.mark.parametrize("name", ["silver_events", "silver_customer_orders", "bridge_order_part",
                                  "operation_mix"])
def test_ranking_is_limited_before_the_shuffle(spark, sf_dir, name):
    assert re.search(r"WindowGroupLimit[^\n]*\n(?:.*\n)*?.*Arguments:.*Partial",
                     plan(QUERIES[name](spark, sf_dir)))


def test_poll_reads_one_column(spark, sf_dir):
    text = plan(control.poll_watermark(table(spark, sf_dir, "events"), "ts"))
    assert re.findall(r"ReadSchema: (.*)", text) == ["struct<ts:timestamp_ntz>"]


def test_watermark_filter_reaches_the_scan(spark, sf_dir):
    feed = changes.watermark_feed(orders_after(spark, sf_dir), ["o_orderkey"], "o_orderdate",
                                  "2001-01-01")
    assert re.search(r"PushedFilters: .*GreaterThan\(o_orderdate", plan(feed))


def test_grain_reads_only_the_key(spark, sf_dir):
    counts = grain.grain_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    assert re.findall(r"ReadSchema: (.*)", plan(counts)) == [
        "struct<l_orderkey:bigint,l_linenumber:int>"]


def test_image_changes_need_one_join_and_nothing_after_it(spark, sf_dir):
    text = plan(changes.image_changes(orders_before(spark, sf_dir), orders_after(spark, sf_dir),
                                      ["o_orderkey"]))
    assert text.count("SortMergeJoin FullOuter") == 1 or len(re.findall(r"Join.*\(\d+\)", text)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2


def test_a_small_feed_does_not_shuffle_the_target(spark):
    target = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    feed = target.limit(3).withColumn("action", F.lit("INSERT"))
    applied = changes.apply_changes(target, feed, ["k"])
    applied.collect()
    assert "BroadcastHashJoin" in plan(applied)
