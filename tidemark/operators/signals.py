"""Whether the change metadata can be trusted, and what it says about the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidemark.fixed import (
    FAULT_NO_HASH, FAULT_OPERATION, FAULT_SAME_VALUE, FAULT_TIMESTAMP, FILE_COUNT_RATIO, MAX_OPERATION_LENGTH, MAX_OPERATIONS, MERGE_SHARE, PRUNE_NEAR_COMPLETE,
    PRUNE_PARTIAL,
)
from tidemark.functions import parse_stamp
from tidemark.operators.profile import union_all


def _faults(*pairs: tuple[Column, str]) -> Column:
    """The texts whose condition holds, joined; NULL when none does."""
    return F.nullif(F.concat_ws("; ", *[F.when(cond, text) for cond, text in pairs]), F.lit(""))


def validate_standard(df: DataFrame, op: str, ts: str, load_type: str | None = None,
                      max_card: int = MAX_OPERATIONS, max_len: int = MAX_OPERATION_LENGTH,
                      hash_suffixed: bool = True, require_hash: bool = False) -> DataFrame:
    """One row: is the operation column a change code and do the stamps parse?

    A table without rows is EMPTY, never UNUSABLE. With `require_hash` a missing
    flow hash is a fault as well.
    """
    same = F.col(op) == F.col(ts)
    if load_type is not None:
        same = same | (F.col(op) == F.col(load_type))
    measured = df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(op).alias("operation_card"),
        F.coalesce(F.max(F.length(op)), F.lit(0)).cast("bigint").alias("operation_max_len"),
        F.count(parse_stamp(ts)).alias("timestamps_parsed"),
        F.count_if(same).alias("degenerate_rows"))
    n = F.col("total_rows")
    faults = _faults(
        ((F.col("operation_card") > max_card) | (F.col("operation_max_len") > max_len),
         FAULT_OPERATION),
        ((n > 0) & (F.col("timestamps_parsed") == 0), FAULT_TIMESTAMP),
        (F.col("degenerate_rows") > 0, FAULT_SAME_VALUE),
        (F.lit(require_hash and not hash_suffixed), FAULT_NO_HASH))
    return measured.select(
        "*", F.lit(hash_suffixed).alias("hash_suffix_seen"),
        F.round(F.try_divide("timestamps_parsed", n), 6).alias("parse_rate"),
        F.when(n == 0, "EMPTY").when(faults.isNull(), "USABLE").otherwise("UNUSABLE")
        .alias("verdict"), faults.alias("faults"))


def validate_custom(df: DataFrame, wm: str) -> DataFrame:
    """One row: is the replication timestamp filled?"""
    n, ok = F.col("total_rows"), F.col("timestamps_parsed")
    missing = F.concat((n - ok).cast("string"), F.lit(" row(s) have no replication timestamp"))
    return (df.agg(F.count("*").alias("total_rows"), F.count(wm).alias("timestamps_parsed"))
            .select("*",
                    F.round(F.try_divide("timestamps_parsed", n), 6).alias("parse_rate"),
                    F.when(n == 0, "EMPTY").when(ok == 0, "UNUSABLE")
                    .when(ok < n, "USABLE_WITH_NULLS").otherwise("USABLE").alias("verdict"),
                    F.when(ok < n, missing).alias("faults")))


def operation_mix(dfs: dict[str, DataFrame], op: str, top: int | None = None) -> DataFrame:
    """object_name, operation, n_rows: each object's codes, or for display its `top` most frequent.

    A corrupt column can hold as many codes as rows; with `top`, only so many of
    them per task reach the ranking of an object.
    """
    counted = union_all([
        df.groupBy(F.col(op).alias("operation")).agg(F.count("*").alias("n_rows"))
        .withColumn("object_name", F.lit(name)) for name, df in dfs.items()])
    if top is None:
        return counted.select("object_name", "operation", "n_rows")
    ranked = Window.partitionBy("object_name").orderBy(F.desc("n_rows"), F.asc("operation"))
    return (counted.withColumn("rank", F.row_number().over(ranked))
            .filter(F.col("rank") <= top)
            .select("object_name", "operation", "n_rows", "rank"))


def operation_summary(mix: DataFrame) -> DataFrame:
    """One row over all objects, from all their codes: whether any delete code was ever seen."""
    return mix.agg(
        F.count_distinct("object_name").alias("objects"),
        F.count_distinct("operation").alias("operations"),
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.bool_or(F.upper("operation").startswith("D")), F.lit(False))
        .alias("delete_code_seen"))


def load_type_mix(dfs: dict[str, DataFrame], load_type: str) -> DataFrame:
    """load_type, n_rows over all objects."""
    per_object = union_all([
        df.groupBy(F.col(load_type).alias("load_type")).agg(F.count("*").alias("n_rows"))
        for df in dfs.values()])
    return per_object.groupBy("load_type").agg(F.sum("n_rows").alias("n_rows"))


def load_type_verdict(mix: DataFrame) -> DataFrame:
    """One row: WARN while only an initial load has landed."""
    only_initial = F.bool_and(F.lower(F.coalesce("load_type", F.lit("null")))
                              .isin("initial", "null"))
    return mix.agg(F.sum("n_rows").alias("n_rows"), only_initial.alias("only_initial")) \
              .withColumn("status", F.when(F.col("only_initial"), "WARN").otherwise("PASS"))


def text_order_agrees(df: DataFrame, ts: str) -> DataFrame:
    """One row: does the greatest text parse to the greatest stamp?"""
    return (df.agg(F.max(ts).alias("raw_max"), F.max(parse_stamp(ts)).alias("parsed_max"))
            .withColumn("orders_agree", parse_stamp("raw_max").eqNullSafe(F.col("parsed_max"))))


def write_days(df: DataFrame, wm: str) -> DataFrame:
    """write_day, n_rows of a typed watermark."""
    return (df.groupBy(F.to_date(wm).alias("write_day")).agg(F.count("*").alias("n_rows"))
            .filter(F.col("write_day").isNotNull()))


def merge_or_reload(df: DataFrame, wm: str, threshold: float = MERGE_SHARE) -> DataFrame:
    """One row: old write days with few rows since speak for merging, a single day for nothing."""
    days = write_days(df, wm)
    share = F.round(F.try_divide(F.max("n_rows"), F.sum("n_rows")), 6)
    return (days.agg(F.count("*").alias("write_days"), F.sum("n_rows").alias("n_rows"),
                     share.alias("largest_day_share"))
            .withColumn("status",
                        F.when(F.col("write_days") <= 1, "WARN")
                        .when(F.col("largest_day_share") > threshold, "PASS")
                        .otherwise("WARN")))


def infer_load_phase(df: DataFrame, wm: str) -> DataFrame:
    """The rows with `load_phase`: the first write day is the initial load.

    The first day is a scalar subquery over one column, not a window over the table.
    """
    first = df.agg(F.min(F.to_date(wm))).scalar()
    return df.withColumn("load_phase",
                         F.when(F.to_date(wm) == first, "initial").otherwise("delta"))


def zone_map(df: DataFrame, wm: str) -> DataFrame:
    """file, bytes, n_rows, oldest, newest: the watermarks of each file, from one scan of one column."""
    return (df.groupBy(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_size").alias("bytes"))
            .agg(F.count("*").alias("n_rows"), F.min(wm).alias("oldest"), F.max(wm).alias("newest")))


def pruning_ratio(df: DataFrame, wm: str, bound: str | None = None) -> DataFrame:
    """One row: the share of bytes a "latest batch" filter touches, judged per file.

    A file is touched when its greatest watermark reaches the bound. The bound
    is the data's own maximum, so the batch is never empty; the files that reach
    it are those whose greatest watermark is the greatest of all, so that one
    scan gives both. A watermark that is empty on every row prunes nothing and
    is a WARN.
    """
    zones = zone_map(df, wm)
    reached = (F.col("newest") if bound is None else
               F.when(F.col("newest") >= F.lit(bound), F.lit(1)).otherwise(0))
    by_reach = zones.groupBy(reached.alias("reached")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"),
        F.count("newest").alias("filled"))
    top = F.max_by(F.struct("files", "bytes"), "reached")
    if bound is not None:
        top = F.max(F.when(F.col("reached") == 1, F.struct("files", "bytes")))
    ratio = F.col("bytes_touched") / F.col("bytes_total")
    return (by_reach.agg(F.sum("files").alias("files_total"), F.sum("bytes").alias("bytes_total"),
                         top.alias("top"), (F.sum("filled") > 0).alias("filled"))
            .select(F.coalesce("files_total", F.lit(0)).alias("files_total"),
                    F.coalesce("top.files", F.lit(0)).alias("files_touched"), "bytes_total",
                    F.coalesce("top.bytes", F.lit(0)).alias("bytes_touched"), "filled")
            .withColumn("ratio", F.round(ratio, 6))
            .withColumn("status", F.when(~F.coalesce("filled", F.lit(False)), "WARN")
                        .when(F.col("ratio") < PRUNE_NEAR_COMPLETE, "PASS")
                        .when(F.col("ratio") < PRUNE_PARTIAL, "WARN").otherwise("FAIL"))
            .drop("filled"))


def file_count_drop(df: DataFrame, baseline_files: int, ratio: float = FILE_COUNT_RATIO) -> DataFrame:
    """One row: far fewer files than at the baseline means they were compacted."""
    return (df.agg(F.count_distinct("_metadata.file_path").alias("files"))
            .select("files", F.lit(baseline_files).cast("bigint").alias("baseline_files"),
                    (F.col("files") < F.lit(baseline_files * ratio)).alias("dropped")))


def seed_reload_baseline(baseline: DataFrame, mix: DataFrame, as_of: Column) -> DataFrame:
    """Baseline rows for objects that have none yet: first watermark text and row count.

    `mix` is the change mix of the Bronze frames; an empty object has no row there.
    """
    seen = (mix.groupBy("object_name")
            .agg(F.min("first_seen").alias("first_initial_ts_text"),
                 F.sum("n_rows").alias("rows_at_baseline")))
    return (seen.join(baseline.select("object_name"), "object_name", "left_anti")
            .withColumn("captured_at", as_of))
