import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.operators import changes as ops
from tidemark.operators.silver import refresh_silver, row_differences

T = "k string, v int, CDC_TIMESTAMP_TEXT string"
KEY = ["k"]


def as_of():
    return ntz("2024-02-01 00:00:00")


def kinds(changed):
    return {r.k: r.change_type for r in changed.collect()}


@pytest.fixture
def images(rows):
    return (rows([("1", 1, "a"), ("2", 2, "a"), ("3", 3, "a"), (None, 0, "a")], T),
            rows([("1", 1, "b"), ("3", 9, "b"), ("4", 4, "b"), (None, 0, "b")], T))


def test_mutation_mix(images):
    assert kinds(ops.image_changes(*images, KEY)) == {"2": "D", "3": "U", "4": "I"}


def test_joining_images_equals_pairing_their_feed(images):
    direct = ops.image_changes(*images, KEY)
    paired = ops.pair_changes(ops.snapshot_diff(*images, KEY), KEY)
    assert row_differences(direct, paired.select(*direct.columns), "a", "b").first().equal


def test_redelivery_is_no_change(images):
    before = images[0]
    restamped = before.withColumn("CDC_TIMESTAMP_TEXT", F.lit("z")).repartition(3)
    assert ops.snapshot_diff(before, restamped, KEY).count() == 0
    assert ops.snapshot_diff(before, restamped, KEY, exclude=()).count() == 8
    feed = ops.snapshot_diff(before, restamped, KEY, exclude=())
    assert ops.pair_changes(feed, KEY).count() == 0


def test_null_fields_are_compared(rows):
    before = rows([("1", None, "a")], T)
    assert kinds(ops.image_changes(before, before.withColumn("v", F.lit(0)), KEY)) == {"1": "U"}
    assert kinds(ops.image_changes(before, before, KEY)) == {}


def test_a_column_only_one_image_has(rows, images):
    wider = images[0].withColumn("w", F.lit("new"))
    assert set(kinds(ops.image_changes(images[0], wider, KEY)).values()) == {"U"}


def test_first_image_is_all_inserts(images):
    changed = ops.image_changes(None, images[0], KEY)
    assert set(kinds(changed).values()) == {"I"}
    assert changed.filter("before is not null").count() == 0


def test_repeated_keys_fold(rows):
    feed = rows([("DELETE", "1", 1, "a"), ("INSERT", "1", 2, "b"),
                 ("DELETE", "1", 2, "b"), ("INSERT", "1", 3, "c")], f"action string, {T}")
    r = ops.pair_changes(feed, KEY, wm="CDC_TIMESTAMP_TEXT").first()
    assert (r.change_type, r.before.v, r.after.v) == ("U", 1, 3)


@pytest.mark.parametrize("actions,expected", [
    (["INSERT", "DELETE"], {}), (["INSERT", "DELETE", "INSERT"], {"1": "I"}),
    (["DELETE", "INSERT", "DELETE"], {"1": "D"}), (["DELETE", "INSERT"], {"1": "U"})])
def test_sequence_decides(rows, actions, expected):
    feed = rows([(a, "1", i, "s", i) for i, a in enumerate(actions)], f"action string, {T}, seq int")
    assert kinds(ops.pair_changes(feed, KEY, seq="seq")) == expected


def test_a_hot_key_in_a_feed(spark):
    feed = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, "DELETE").otherwise("INSERT").alias("action"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), F.col("id").alias("wm"))
    hot = ops.fold_feed(feed, KEY, wm="wm").filter("k = 0").first()
    assert (hot.before.v, hot.after.v) == (0, 29_997)


@pytest.mark.parametrize("seed", range(3))
def test_applying_the_difference_gives_the_later_image(rows, seed):
    rnd = random.Random(seed)

    def image(stamp):
        return rows([(str(k), rnd.randrange(3), stamp) for k in range(60) if rnd.random() < 0.7], T)

    before, after = image("a"), image("b")
    applied = ops.apply_changes(before, ops.snapshot_diff(before, after, KEY, ()), KEY)
    assert row_differences(applied, after, "a", "b").first().equal


def test_watermark_merge_and_its_delete_arm(rows):
    target = rows([("1", 1, "a"), ("2", 2, "a")], T)
    source = rows([("1", 9, "b"), ("1", 8, "a"), ("2", 2, "c"), ("3", 3, "b")], T) \
        .withColumn("op", F.when(F.col("k") == "2", "D").otherwise("A"))
    target = target.withColumn("op", F.lit("L"))
    kept = ops.watermark_merge(target, source, KEY, "CDC_TIMESTAMP_TEXT", "a")
    assert {r.k: r.v for r in kept.collect()} == {"1": 9, "2": 2, "3": 3}
    gone = ops.watermark_merge(target, source, KEY, "CDC_TIMESTAMP_TEXT", "a", "op", ["D"])
    assert {r.k: r.v for r in gone.collect()} == {"1": 9, "3": 3}


def test_events_carry_images_and_hashes(images):
    events = {r.change_type: r for r in ops.as_events(
        ops.image_changes(*images, KEY), KEY, as_of()).collect()}
    assert events["I"].before_image is None and events["I"].row_hash_before is None
    assert events["U"].after_image == '{"k":"3","v":9}' and events["U"].key_values == '{"k":"3"}'
    assert events["U"].row_hash_before != events["U"].row_hash_after
    assert (events["U"].cdc_timestamp_text, events["D"].cdc_timestamp_text) == ("b", "a")


class TestDrain:
    def load(self, store, *images):
        for df in images:
            refresh_silver(store, "T", df, KEY, "CDC_TIMESTAMP_TEXT")
        return [s.snapshot_id for s in store.history("T")]

    def test_events_are_logged_once(self, store, control, images):
        first, second = self.load(store, *images)
        assert ops.drain_changes(store, control, "T", first, "d1", as_of()) == 4
        assert ops.drain_changes(store, control, "T", second, "d2", as_of()) == 3
        assert ops.drain_changes(store, control, "T", second, "d2", as_of()) == 3
        assert ops.drain_changes(store, control, "T", second, "d3", as_of()) == 0
        counts = {r.drain_id: (r.inserts, r.updates, r.deletes)
                  for r in ops.change_summary(ops.change_log(control)).collect()}
        assert counts == {"d1": (4, 0, 0), "d2": (1, 1, 1)}

    def test_a_drain_cut_short_leaves_nothing_and_reruns(self, store, control, images):
        first, _ = self.load(store, *images)
        path = f"{control.root}/change_log/object_name=T/drain_id=d1"
        ops.as_events(ops.image_changes(None, images[1], KEY), KEY, as_of()).write.parquet(path)
        assert ops.change_log(control).count() == 0
        ops.drain_changes(store, control, "T", first, "d1", as_of())
        assert ops.change_log(control).count() == 4


def test_merging_into_a_stored_table(store, rows, images):
    refresh_silver(store, "T", images[0], KEY, "CDC_TIMESTAMP_TEXT")
    feed = ops.watermark_feed(images[1], KEY, "CDC_TIMESTAMP_TEXT", "a")
    ops.merge_snapshot(store, "T", feed)
    assert {r.k: r.v for r in store.read("T").collect()} == {"1": 1, "2": 2, "3": 9, "4": 4, None: 0}
    assert ops.merge_snapshot(store, "T", feed.limit(0)) is None


def test_divergence_is_never_negative(images):
    before, after = images
    assert ops.delete_divergence(after.limit(2), before).first().divergence == 2
    assert ops.delete_divergence(before, after.limit(2)).first().divergence == 0
