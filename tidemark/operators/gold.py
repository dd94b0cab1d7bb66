"""Gold: child rollups, dimensions, bridges and time-relative views over Silver."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import bucket_of, latest_of, minutes_between, null_safe
from tidemark.operators.changes import snapshot_diff, stored_images
from tidemark.operators.profile import union_all
from tidemark.operators.silver import assert_deterministic
from tidemark.sources.snapshots import SnapshotStore


# -- measures of a rollup ---------------------------------------------------------------

def rows() -> Column:
    return F.count("*")


def distinct(c: str) -> Column:
    return F.count_distinct(c)


def any_true(c: str) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def child_rollup(child: DataFrame, key: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """One row per master key. Roll up before joining: a row-level join would fan out."""
    return child.groupBy(*key).agg(*[m.alias(name) for name, m in measures.items()])


def left_rollup(master: DataFrame, rollup: DataFrame, key: Sequence[str],
                zero: Sequence[str] = ()) -> DataFrame:
    """The master with a rollup; counts named in `zero` read 0 where no child exists."""
    joined = master.join(rollup, list(key), "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero}) if zero else joined


@dataclass(frozen=True)
class Rollup:
    """A child of a dimension: its rollup, which counts default to 0, and its change stamp."""

    frame: DataFrame
    zero: tuple[str, ...] = ()
    changed: str | None = None


def customer_360(master: DataFrame, key: Sequence[str], rollups: Sequence[Rollup],
                 derived: dict[str, Column] | None = None,
                 master_changed: str = "CDC_TIMESTAMP_UTC") -> DataFrame:
    """One row per master with its rollups, derived states and the latest change anywhere.

    Rollups hold one row per key, so the joins neither fan out nor skew.
    """
    dim = master.withColumnRenamed(master_changed, "master_changed_utc")
    for r in rollups:
        dim = left_rollup(dim, r.frame, key, r.zero)
    stamps = [F.col(r.changed) for r in rollups if r.changed]
    changed = latest_of(F.col("master_changed_utc"), *stamps) if stamps \
        else F.col("master_changed_utc")
    return (dim.withColumns(derived or {}).withColumn("any_changed_utc", changed)
            .drop(*[r.changed for r in rollups if r.changed]))


def bridge(child: DataFrame, grandchild: DataFrame, keys: Sequence[str],
           measures: dict[str, Column]) -> DataFrame:
    """Child rows at their own grain with grandchild counts, 0 where there is none."""
    return left_rollup(child, child_rollup(grandchild, keys, measures), keys, list(measures))


# Order and thresholds of the risk buckets.
SEVERE_DUNNING = 3
RISK_BUCKETS = ("DELETED", "BLOCKED", "DUNNING_SEVERE", "DUNNING", "UNASSIGNED", "OK")


def risk_view(dim: DataFrame, as_of: Column, deleted: Column, blocked: Column, level: Column,
              unassigned: Column, dunned_on: str) -> DataFrame:
    """Ages and a review bucket. Lazy, and a function of `as_of`: it depends on now."""
    names = RISK_BUCKETS
    bucket = (F.when(deleted, names[0]).when(blocked, names[1])
              .when(F.coalesce(level, F.lit(0)) >= SEVERE_DUNNING, names[2])
              .when(F.coalesce(level, F.lit(0)) > 0, names[3])
              .when(unassigned, names[4]).otherwise(names[5]))
    return dim.withColumns({
        "days_since_dunned": F.datediff(F.to_date(as_of), F.to_date(dunned_on)),
        "minutes_since_change": minutes_between("any_changed_utc", as_of),
        "risk_bucket": bucket})


def deletion_code_breakdown(df: DataFrame, code: str, amount: Column, active: Column) -> DataFrame:
    """Rows and amount per business deletion code, plus FLAGGED and TOTAL, with shares.

    `active` says which codes mean a live row. Totals are sums of the few
    per-code rows, not further scans.
    """
    per_code = (df.groupBy(F.col(code).alias("code"), active.alias("__active"))
                .agg(F.count("*").alias("n_rows"), F.sum(amount).alias("amount")))
    levels = F.explode(F.array_compact(F.array(
        F.struct(F.lit("CODE").alias("level"), F.col("code").alias("level_code")),
        F.when(~F.col("__active"),
               F.struct(F.lit("FLAGGED").alias("level"), F.lit(None).cast("string")
                        .alias("level_code"))),
        F.struct(F.lit("TOTAL").alias("level"), F.lit(None).cast("string").alias("level_code")))))
    summed = (per_code.select("n_rows", "amount", levels.alias("l"))
              .groupBy("l.level", F.col("l.level_code").alias("code"))
              .agg(F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount")))
    n_total = per_code.agg(F.sum("n_rows")).scalar()
    amount_total = per_code.agg(F.sum("amount")).scalar()
    return summed.withColumns({
        "row_share": F.round(F.try_divide(F.col("n_rows"), n_total), 6),
        "amount_share": F.round(F.try_divide(F.col("amount").cast("double"),
                                             amount_total.cast("double")), 6)})


def active_only(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows on which no deletion flag is set; the flags stay as columns."""
    for f in flags:
        df = df.filter(~F.coalesce(F.col(f), F.lit(False)))
    return df


def month_to_date(df: DataFrame, date_col: str, as_of: Column) -> DataFrame:
    """From the first day of the month of `as_of`; the time filter stays outside the table."""
    return df.filter(F.col(date_col) >= F.trunc(F.to_date(as_of), "MM"))


# -- the four shapes a refreshed table is built from -------------------------------------

def shape_projection(df: DataFrame, columns: Sequence[str], dates: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.to_date(c).alias(c) if c in dates else F.col(c) for c in columns])


def shape_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, list(on), how)


def shape_group(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    return child_rollup(df, keys, measures)


def shape_preagg(master: DataFrame, child: DataFrame, key: Sequence[str],
                 measures: dict[str, Column], zero: Sequence[str] = ()) -> DataFrame:
    return left_rollup(master, child_rollup(child, key, measures), key, zero)


# -- refreshing Gold ---------------------------------------------------------------------

@dataclass(frozen=True)
class GoldDef:
    """A Gold table: `build` maps input frames to rows, unique on `keys`.

    `inputs` gives, per Silver table, the columns that hold the Gold key there.
    Every Gold row must depend only on input rows that hold its key.
    """

    name: str
    keys: tuple[str, ...]
    inputs: dict[str, tuple[str, ...]]
    build: Callable[[dict[str, DataFrame]], DataFrame]


def touched_keys(store: SnapshotStore, gold: GoldDef, since: dict[str, str],
                 heads: dict[str, str]) -> DataFrame:
    """Gold keys whose input rows changed between two sets of input snapshots."""
    frames = []
    for name, columns in gold.inputs.items():
        if since.get(name) == heads[name]:
            continue
        prev, cur, keys = stored_images(store, name, since.get(name), heads[name])
        feed = cur if prev is None else snapshot_diff(prev, cur, keys, exclude=())
        frames.append(feed.select(*[F.col(c).alias(k)
                                    for c, k in zip(columns, gold.keys, strict=True)]))
    return union_all(frames).distinct()


def refresh_gold(store: SnapshotStore, gold: GoldDef) -> str:
    """Recompute the keys that moved and rewrite their buckets. Runs jobs.

    Counts, minima and distinct counts cannot be updated from a difference, so
    an affected key is rebuilt from all of its rows and every other key is left.
    The Gold snapshot records which input snapshots it was built from, so a run
    that was cut short is caught up by the next. Returns FULL, INCREMENTAL or
    NO_DATA. A definition that reads the clock or a random source is rejected.
    """
    heads = {name: store.head(name).snapshot_id for name in gold.inputs}
    inputs = {name: store.read(name, store.find(name, heads[name])) for name in gold.inputs}
    token = json.dumps(heads, sort_keys=True)
    held = store.head(gold.name)
    if held is None:
        built = gold.build(inputs)
        assert_deterministic(built)
        store.write(gold.name, built, gold.keys, None, token)
        return "FULL"
    if held.token == token:
        return "NO_DATA"
    # Written, not cached: the keys drive three joins, and a table survives a lost executor.
    path = f"{store.root}/touched/{gold.name}"
    moved = touched_keys(store, gold, json.loads(held.token), heads)
    moved.withColumn("bucket", bucket_of(moved, gold.keys, store.buckets)) \
         .write.mode("overwrite").parquet(path)
    keys = store.spark.read.parquet(path)
    buckets = {r.bucket for r in keys.select("bucket").distinct().collect()}
    if not buckets:
        return "NO_DATA"
    rebuilt = gold.build({name: _holding(df, gold.inputs[name], keys, gold.keys)
                          for name, df in inputs.items()})
    assert_deterministic(rebuilt)
    kept = _holding(store.read(gold.name, held, buckets), gold.keys, keys, gold.keys, "left_anti")
    snapshot = store.write(gold.name, kept.unionByName(rebuilt), gold.keys, buckets, token)
    return "NO_DATA" if snapshot is None else snapshot.action


def _holding(df: DataFrame, columns: Sequence[str], keys: DataFrame, names: Sequence[str],
             how: str = "left_semi") -> DataFrame:
    """Rows that hold one of the keys, or with left_anti none of them."""
    wanted = keys.select(*[F.col(k).alias(f"__{c}") for c, k in zip(columns, names, strict=True)])
    return df.join(wanted, null_safe(df, wanted, columns, "__"), how)
