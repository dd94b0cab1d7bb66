import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn


def one(df, **columns):
    return df.select(*[c.alias(n) for n, c in columns.items()]).first()


def test_parse_stamp_keeps_utc_and_drops_the_seventh_digit(rows):
    df = rows([("2026-06-15T09:41:59,6426580Z",), ("2026-06-15T09:41:59,6426589Z",), ("bad",),
               (None,)], "t string")
    got = [str(r.p) for r in df.select(fn.parse_stamp("t").alias("p")).collect()]
    assert got == ["2026-06-15 09:41:59.642658"] * 2 + ["None", "None"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamps_do_not_depend_on_the_session_zone(spark, zone):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        r = one(spark.range(1),
                text=fn.sortable_text(fn.ntz("2024-03-10 02:30:59.5")),
                whole=fn.sortable_text(fn.ntz("2024-03-10 02:30:59")),
                minutes=fn.minutes_between(fn.ntz("2024-03-10 01:59:59"),
                                           fn.ntz("2024-03-10 03:00:01")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)
    assert r.text == "2024-03-10T02:30:59.500000000"
    assert r.whole == "2024-03-10T02:30:59.000000000"
    assert r.minutes == 61


def test_minutes_count_boundaries(spark):
    r = one(spark.range(1),
            crossed=fn.minutes_between(fn.ntz("2024-01-01 00:00:59"), fn.ntz("2024-01-01 00:01:01")),
            inside=fn.minutes_between(fn.ntz("2024-01-01 00:00:01"), fn.ntz("2024-01-01 00:00:59")),
            back=fn.minutes_between(fn.ntz("2024-01-01 00:01:01"), fn.ntz("2024-01-01 00:00:59")))
    assert (r.crossed, r.inside, r.back) == (1, 0, -1)


def test_latest_of_needs_a_master(rows):
    df = rows([(1, None), (None, 2), (1, 3)], "m int, c int")
    got = [r.x for r in df.select(fn.latest_of(F.col("m"), F.col("c")).alias("x")).collect()]
    assert got == [1, None, 3]


def test_hashes_tell_null_from_a_shifted_value(rows):
    df = rows([(None, 1), (1, None), (None, None)], "a int, b int")
    marked = df.select(fn.fingerprint(df, ["a", "b"]).alias("h"),
                       fn.row_hash(fn.json_of(["a", "b"])).alias("s"))
    got = marked.collect()
    assert len({r.h for r in got}) == 3 and len({r.s for r in got}) == 3


def test_hashes_see_nulls_inside_nested_values(rows):
    df = rows([((None, 1),), ((1, None),)], "s struct<a: int, b: int>")
    assert df.select(fn.fingerprint(df, ["s"]).alias("h")).distinct().count() == 2


def test_image_leaves_lineage_out_and_keeps_nulls(rows):
    df = rows([(1, None, "A")], "k int, v string, CDC_OPERATION string")
    assert df.select(fn.row_image(df).alias("i")).first().i == '{"k":1,"v":null}'


def test_rules_check_the_type_when_built(rows):
    df = rows([(True, "X", " 2.6"), (None, "", "n/a"), (False, None, "")],
              "b boolean, t string, n string")
    got = df.select(*[r(df.schema).alias(n) for n, r in {
        "b": fn.bool_true("b"), "p": fn.text_present("t"), "m": fn.text_missing("t"),
        "n": fn.text_to_number("n"), "a": fn.any_of(fn.bool_true("b"), fn.text_present("t")),
        "s": fn.sql_rule("coalesce(b, true)")}.items()]).collect()
    assert [tuple(r) for r in got] == [
        (True, True, False, 3, True, True), (False, False, True, None, False, True),
        (False, False, True, None, False, False)]
    with pytest.raises(TypeError, match="boolean"):
        fn.text_present("b")(df.schema)
    with pytest.raises(TypeError, match="string"):
        fn.bool_true("t")(df.schema)
