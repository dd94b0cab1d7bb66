from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.sources import SnapshotStore, work_dir
from tidemark.sources.snapshots import buckets_for


def keyed(spark, n, shift=0):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") + shift).alias("v"))


def test_old_snapshots_stay_readable(spark, store):
    store.write("T", keyed(spark, 20), ["k"])
    store.write("T", keyed(spark, 10), ["k"])
    first, second = store.history("T")
    assert store.read("T", first).count() == 20 and store.read("T").count() == 10
    assert second.parent_id == first.snapshot_id
    assert store.row_count(first) == 20


def test_an_uncommitted_write_is_invisible_and_overwritten(spark, store):
    store.write("T", keyed(spark, 20), ["k"])
    keyed(spark, 99).withColumn("bucket", F.lit(0)).write.partitionBy("bucket") \
        .parquet(f"{store.root}/data/T/snapshot_id=s0000000002")
    assert store.read("T").count() == 20
    store.write("T", keyed(spark, 5), ["k"])
    assert store.read("T").count() == 5


def test_changed_buckets_and_pruned_reads(spark, store):
    store.write("T", keyed(spark, 20), ["k"])
    row = keyed(spark, 20).filter("k = 3")
    from tidemark.functions import bucket_of
    bucket = row.select(bucket_of(row, ["k"], store.buckets).alias("b")).first().b
    held = store.read("T", buckets={bucket})
    store.write("T", held.withColumn("v", F.when(F.col("k") == 3, 99).otherwise(F.col("v"))),
                ["k"], {bucket})
    first, second = store.history("T")
    assert store.changed_buckets(first, second) == {bucket}
    assert store.changed_buckets(None, first) == set(range(4))
    assert {r.v for r in store.read("T").filter("k = 3").collect()} == {99}
    assert all("s0000000002" in f for f in store.read("T", second, {bucket}).inputFiles())


def test_an_equal_write_commits_nothing(spark, store):
    store.write("T", keyed(spark, 20), ["k"])
    assert store.write("T", keyed(spark, 20), ["k"], set(range(4))) is None
    assert len(store.history("T")) == 1


def test_unreferenced_folders(spark, store):
    for n in (20, 10, 5):
        store.write("T", keyed(spark, n), ["k"])
    assert [p[-1] for p in store.unreferenced("T", keep=1)] == ["1", "2"]


def test_another_bucket_count_is_refused(spark, store):
    store.write("T", keyed(spark, 3), ["k"])
    with pytest.raises(ValueError, match="4 buckets"):
        SnapshotStore(spark, store.root, 8).head("T")
    with pytest.raises(KeyError):
        store.read("ABSENT")


def test_bucket_count_follows_the_size():
    assert [buckets_for(n) for n in (0, 9_000_000, 10**12)] == [8, 9, 16_384]


def session(shared, master):
    """A stand-in: the setting belongs to the cluster and cannot change in a running session."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared or default),
                           sparkContext=SimpleNamespace(master=master))


def test_work_dir_is_the_shared_folder():
    assert work_dir(session("/shared/", "spark://host"), "x").startswith("/shared/x-")
    assert work_dir(session(None, "local[4]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session(None, "spark://host"), "x")
