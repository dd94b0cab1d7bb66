"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores. Each
query runs once to warm up and then BENCH_RUNS times; its best time counts.
Lazy queries are run into a sink that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import changes, gold, silver
from tidemark.operators.gold import GoldDef
from tidemark.plans.capture import Capture
from tidemark.queries import QUERIES
from tidemark.queries.data import (
    FLOW, KEYS, control_beside, events_standard, new_store, orders_after, orders_before, at, AS_OF,
)
from tidemark.sources import work_dir
from tidemark.spec import CaptureSpec, ObjectSpec

HEADLINE = (
    "customer_activity", "silver_events", "bridge_order_part", "grain_lineitem_short",
    "infer_key_lineitem", "grain_duplicate_rows", "validate_standard", "operation_mix",
    "change_mix", "poll_watermark", "merge_or_reload", "snapshot_diff", "image_changes",
    "apply_feed", "watermark_merge", "rewrite_noop", "reconcile_keys", "orphans",
    "dim_customer_360", "risk_view", "deletion_codes", "shape_projection", "shape_join",
    "shape_group", "shape_preagg",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(runs: int, action) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def fastest(runs: list[dict[str, float]]) -> dict[str, float]:
    return {name: min(r[name] for r in runs) for name in runs[0]}


def stored(spark, sf_dir: str) -> dict[str, float]:
    """Refresh of a stored table: first load, a change, no change; its change log; its Gold."""
    before, after = orders_before(spark, sf_dir), orders_after(spark, sf_dir)
    store = new_store(spark, "bench", before)
    control = control_beside(store)
    per_customer = GoldDef("SPEND", ("o_custkey",), {"ORDERS": ("o_custkey",)}, lambda i: i[
        "ORDERS"].groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("d")))

    def refresh(image):
        silver.refresh_silver(store, "ORDERS", image, ["o_orderkey"], "CDC_TIMESTAMP_TEXT")

    times = {"refresh_initial": timed(lambda: refresh(before))}
    gold.refresh_gold(store, per_customer)
    times |= {"refresh_incremental": timed(lambda: refresh(after)),
              "refresh_no_data": timed(lambda: refresh(after)),
              "gold_incremental": timed(lambda: gold.refresh_gold(store, per_customer)),
              "gold_no_data": timed(lambda: gold.refresh_gold(store, per_customer))}
    first, second = (s.snapshot_id for s in store.history("ORDERS"))
    changes.drain_changes(store, control, "ORDERS", first, "d1", at(AS_OF))
    times["drain"] = timed(
        lambda: changes.drain_changes(store, control, "ORDERS", second, "d2", at(AS_OF)))
    return times


def captured(spark, sf_dir: str) -> dict[str, float]:
    """A capture cycle in which nothing moved, and one poll of it."""
    root = work_dir(spark, "bench-cycle")
    events_standard(spark, sf_dir).write.parquet(f"{root}/landed")
    obj = ObjectSpec("EVENTS", f"{root}/landed", tuple(KEYS), "TRANSACTION")
    capture = Capture(spark, CaptureSpec("STANDARD", (obj,), flow_hash=FLOW), root, 8)
    capture.register("2024-02-01 05:00:00")
    capture.cycle("2024-02-01 05:15:00")
    state = capture.control.read("registry").first().asDict()
    return {"poll_unchanged": timed(lambda: capture.poll(obj, state)),
            "poll_scan": timed(lambda: capture.poll(obj, {**state, "listing_mark": None})),
            "cycle_unchanged": timed(lambda: capture.cycle("2024-02-01 05:30:00"))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session.local(cpus)
    times = {name: best_of(runs, lambda n=name: consume(QUERIES[n](spark, sf_dir)))
             for name in HEADLINE}
    for group in (stored, captured):
        times |= fastest([group(spark, sf_dir) for _ in range(runs + 1)][1:])
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
