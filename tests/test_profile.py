import random

import pytest
from pyspark.sql.types import StructType

from tidemark.operators import keys, profile as ops
from tidemark.queries import QUERIES
from tidemark.sources import file_listing, listing_mark, read_source, write_sink

HASH = "0123456789abcdef0123456789abcdef"
STANDARD = f"__OPERATION_TYPE string, __TIMESTAMP string, load_type_{HASH} string, run_id_{HASH} string"


def schema(text):
    return StructType.fromDDL(text)


def test_standard_signal(spark):
    signal = ops.standard_signal(schema(f"k int, {STANDARD}"))
    assert signal.flow_hash == HASH and signal.hash_suffixed and signal.run_id == f"run_id_{HASH}"
    copied = ops.standard_signal(schema("__operation_type string, __timestamp string, load_type string"))
    assert copied.flow_hash is None and not copied.hash_suffixed
    assert ops.standard_signal(schema("__TIMESTAMP string")) is None


def test_watermark_names_come_before_hints_and_business_dates_never_qualify(spark):
    assert ops.find_watermark(schema("updated_at timestamp, ZZLASTCHGDATE string")) == "ZZLASTCHGDATE"
    assert ops.find_watermark(schema("PostingDate date, ReplicatedAt timestamp_ntz")) == "ReplicatedAt"
    assert ops.find_watermark(schema("PostingDate date, updated string")) is None


def test_standard_wins_over_custom(spark):
    assert ops.track_of(schema(f"{STANDARD}, ZZLASTCHGDATE timestamp")) == "STANDARD"
    assert ops.track_of(schema("ZZLASTCHGDATE timestamp")) == "CUSTOM"
    assert ops.track_of(schema("k int")) == "NONE"


def test_inventory_records_an_unreadable_source(spark, sf_dir):
    got = ops.share_inventory(spark, {"O": f"{sf_dir}/orders.parquet", "X": "/nowhere"})
    broken = got.filter("error is not null").collect()
    assert [r.object_name for r in broken] == ["X"]
    assert got.filter("object_name = 'O'").count() == 6
    counts = {r.object_name: r.n_rows for r in ops.safe_row_counts(
        spark, {"O": f"{sf_dir}/orders.parquet", "X": "/nowhere"}).collect()}
    assert counts == {"O": 1500, "X": None}


def test_indicator_columns(spark):
    found = ops.indicator_columns(schema(
        f"{STANDARD}, isbn string, IsOneTime int, OrderBlock string, flags int, ok boolean"))
    assert found == ["IsOneTime", "OrderBlock", "ok"]


def test_infer_key_is_the_shortest_prefix_and_counts_null_parts(rows):
    df = rows([(1, None, 1), (1, 2, 1), (2, None, 1)], "a int, b int, c int")
    assert ops.infer_key(df).first().key_columns == "a,b"
    assert ops.infer_key(df.union(df)).first().key_columns is None
    assert ops.infer_key(df.limit(0)).first().key_columns is None


def test_declared_keys_follow_key_sequence(rows):
    df = rows([("T", "b", 2, "C", True), ("T", "a", 10, "C", False), ("T", "c", 1, "C", False)],
              "table_name string, column_name string, key_sequence int, constraint_name string, rely boolean")
    r = ops.declared_keys(df).first()
    assert (r.key_columns, r.constraint_name, r.rely) == ("c,b,a", "C", True)


def test_masking_is_judged_from_every_row(rows):
    df = rows([("a", 1), ("***", 2), (None, 3)], "k string, n int")
    got = {r.column_name: (r.masked_rows, r.filled_rows, r.masked)
           for r in ops.masked_columns(df, ["k", "n"]).collect()}
    assert got == {"k": (1, 2, True), "n": (0, 3, False)}


def test_listing_mark_moves_with_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    first = listing_mark(spark, path)
    assert first == listing_mark(spark, path)
    files = file_listing(spark, path).count()
    spark.range(1).write.mode("append").parquet(path)
    assert listing_mark(spark, path) != first
    assert file_listing(spark, path).count() > files


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_sources_and_sinks_share_their_names(spark, tmp_path, fmt):
    df = spark.range(5).selectExpr("id", "id % 2 AS half")
    ref = f"{fmt}:{tmp_path / fmt}"
    write_sink(df, ref)
    write_sink(df, ref)
    got = read_source(spark, ref, StructType.fromDDL("id bigint, half bigint"))
    assert sorted(r.id for r in got.collect()) == sorted([*range(5)] * 2)


def test_catalogue_tables(spark):
    write_sink(spark.range(3), "table:tidemark_sink", "overwrite")
    try:
        assert read_source(spark, "table:tidemark_sink").count() == 3
    finally:
        spark.sql("DROP TABLE tidemark_sink")


def test_key_behind_the_sixth_column(rows):
    df = rows([(1, 1, 1, 1, 1, 1, i) for i in range(9)], ", ".join(f"c{i} int" for i in range(7)))
    assert ops.infer_key(df).first().key_parts == 7


@pytest.mark.parametrize("distinct, want, confirmed", [(1, None, 0), (12, None, 0), (2_000, 100, 1)])
def test_a_wide_table_costs_two_scans_at_most(spark, monkeypatch, distinct, want, confirmed):
    seen, whole = [], keys.shortest_unique
    monkeypatch.setattr(keys, "shortest_unique", lambda *a: seen.append(a) or whole(*a))
    df = spark.range(2_000).selectExpr(*[f"id % {7 + i % 3} AS c{i}" for i in range(99)], f"id % {distinct} AS c99")
    assert ops.infer_key(df).first().key_parts == want and len(seen) == confirmed


@pytest.mark.parametrize("seed", range(8))
def test_shortest_unique_prefix_among_near_ones(spark, rows, seed):
    rng = random.Random(seed)
    data = {tuple(rng.choice([None, 0, 1, 2]) if j else rng.randrange(3000) for j in range(5)) for _ in range(900)}
    data = [*data, *([(7, 1, 1, 1, 1)] * 2 if seed == 7 else [])]
    want = next((i for i in range(1, 6) if len({r[:i] for r in data}) == len(data)), None)
    assert ops.infer_key(rows(data, ", ".join(f"c{i} int" for i in range(5)))).first().key_parts == want


def test_masked_columns_are_in_the_profile(rows):
    df = rows([("a", "x", 1), ("b", "****", 2), ("c", None, 3)], "k string, m string, z int")
    r = ops.profile_objects({"T": df}).first()
    assert (r.inferred_key, r.masked_columns) == ("k", "m")


@pytest.mark.parametrize("name, surveys", [("declared_key_snapshot", 4), ("key_baseline_seed", 5), ("key_drift", 5)])
def test_each_table_is_surveyed_once(spark, sf_dir, monkeypatch, name, surveys):
    seen, whole = [], keys.survey
    monkeypatch.setattr(keys, "survey", lambda *a: seen.append(a) or whole(*a))
    QUERIES[name](spark, sf_dir)
    assert len(seen) == surveys


def test_only_repeated_rows_are_sorted(spark, monkeypatch):
    """Of 2,000 rows, the four that agree in the first column meet in a window; those of a unique column none."""
    frame = type(spark.range(1))
    ordered, whole = [], frame.withColumn

    def spy(df, name, column):
        if name == "before":
            ordered.append(df.count())
        return whole(df, name, column)

    monkeypatch.setattr(frame, "withColumn", spy)
    near = spark.range(2_000).selectExpr("id - id % 2 * CAST(id < 4 AS INT) AS a", "id AS b", "1 AS c")
    assert keys.keyed_survey(near)[1] == ["a", "b"] and ordered == [4]
    assert keys.keyed_survey(spark.range(2_000))[1] == ["id"] and ordered == [4]
