"""Control tables: small Parquet tables that hold capture state.

Rows grow with the number of captured objects and runs, never with the data.
History tables are appended to; keyed tables are rewritten as a new version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.sources.readers import read_if_present
from tidemark.sources.schemas import columns, local_frame

SCHEMAS: dict[str, str] = {
    "registry": """object_name string, source string, track string, watermark_column string,
        operation_column string, load_type_column string, run_id_column string,
        merge_key_columns array<string>, key_source string, key_override boolean,
        target string, object_class string, last_watermark_text string,
        last_watermark timestamp_ntz, last_run_started timestamp_ntz, last_run_status string,
        listing_mark string, updated_at timestamp_ntz""",
    "metadata_validation": """checked_at timestamp_ntz, object_name string, source string,
        track string, total_rows bigint, operation_card bigint, operation_max_len bigint,
        timestamps_parsed bigint, degenerate_rows bigint, hash_suffix_seen boolean,
        parse_rate double, verdict string, faults string""",
    "refresh_audit": """captured_at timestamp_ntz, target string, refresh_action string,
        state string, state_message string, refresh_start timestamp, refresh_end timestamp,
        duration_ms bigint, buckets_written bigint""",
    "reconciliation": """checked_at timestamp_ntz, object_name string, source_rows bigint,
        silver_rows bigint, difference bigint, verdict string""",
    "object_baseline": """object_name string, first_initial_ts_text string,
        rows_at_baseline bigint, captured_at timestamp_ntz, declared_key_columns string,
        declared_key_constraint string, declared_key_recorded_at timestamp_ntz""",
    "declared_key_snapshot": """checked_at timestamp_ntz, object_name string,
        source_table string, key_columns string, constraint_name string, rely boolean""",
    "drains": """drain_id string, object_name string, from_id string, to_id string,
        logged_at timestamp_ntz, events bigint""",
}
KEYED = ("registry", "object_baseline")


def schema_of(table: str) -> StructType:
    return columns(SCHEMAS[table])


def conform(table: str, rows: DataFrame) -> DataFrame:
    """The table's columns in order, typed; a column the caller left out is NULL."""
    have = set(rows.columns)
    return rows.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema_of(table).fields])


class ControlTables:
    """The control tables under one root folder; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/control/{table}"

    def read(self, table: str) -> DataFrame:
        schema = schema_of(table)
        if table not in KEYED:
            return read_if_present(self.spark, self._path(table), schema)
        versions = read_if_present(self.spark, self._path(table),
                                   StructType([*schema.fields]).add("version", "integer"))
        newest = versions.agg(F.max("version").alias("version")).first().version
        return versions.filter(F.col("version") == F.lit(newest)).drop("version")

    def append(self, table: str, rows: DataFrame) -> None:
        if table in KEYED:
            raise ValueError(f"{table} is keyed: use replace")
        conform(table, rows).coalesce(1).write.mode("append").parquet(self._path(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Write a new version; a reader sees the old one until the write commits."""
        if table not in KEYED:
            raise ValueError(f"{table} is a history: use append")
        versions = read_if_present(self.spark, self._path(table),
                                   schema_of(table).add("version", "integer"))
        newest = versions.agg(F.max("version").alias("version")).first().version or 0
        (conform(table, rows).coalesce(1)
         .write.mode("overwrite").parquet(f"{self._path(table)}/version={newest + 1}"))

    def append_rows(self, table: str, rows: list[dict]) -> None:
        self.append(table, self.rows(table, rows))

    def rows(self, table: str, rows: list[dict]) -> DataFrame:
        return local_frame(self.spark, rows, schema_of(table))
