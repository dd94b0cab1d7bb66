import pytest

from tidemark.spec import (
    CaptureSpec, ObjectSpec, ReferentialRule, SpecError, cdc_objects, silver_objects,
)

HASH = "0" * 32
OBJ = ObjectSpec("ORDERS", "orders", ("id",))


@pytest.mark.parametrize("kw", [
    {"name": "orders"}, {"name": "1X"}, {"keys": ()}, {"object_class": "OTHER"},
    {"key_source": "guessed"}, {"key_override": True},
])
def test_object_rules(kw):
    with pytest.raises(SpecError):
        ObjectSpec(**{"name": "ORDERS", "source": "orders", "keys": ("id",), **kw})


@pytest.mark.parametrize("kw", [
    {"track": "OTHER"}, {"track": "STANDARD"}, {"track": "STANDARD", "flow_hash": "xyz"},
    {"track": "CUSTOM"}, {"track": "STANDARD", "flow_hash": HASH, "objects": (OBJ, OBJ)},
    {"track": "STANDARD", "flow_hash": HASH,
     "referential": ReferentialRule("ORDERS", ("id",), ("LINES",))},
])
def test_capture_rules(kw):
    with pytest.raises(SpecError):
        CaptureSpec(**{"objects": (OBJ,), **kw})


def test_all_faults_are_named_at_once():
    with pytest.raises(SpecError, match="name is .*; keys has a column; object_class is one of"):
        ObjectSpec("orders", "orders", (), "OTHER")
    with pytest.raises(SpecError, match="source is given; objects is given"):
        CaptureSpec.from_dict({})
    with pytest.raises(SpecError, match="keys has a column"):
        CaptureSpec.from_dict({"source": {"track": "custom", "watermark_column": "ts"},
                               "objects": [{"name": "a", "table": "a", "keys": None}]})


def test_lag_follows_class():
    assert OBJ.lag_hours == 24
    assert ObjectSpec("T", "t", ("id",), "TRANSACTION").lag_hours == 1
    assert ObjectSpec("E", "e", ("id",), "EMPTY").lag_hours is None


def test_empty_objects_are_neither_silver_nor_logged():
    spec = CaptureSpec("CUSTOM", (OBJ, ObjectSpec("E", "e", ("id",), "EMPTY", cdc_log=True)),
                       watermark_column="ts")
    assert silver_objects(spec) == [OBJ] and cdc_objects(spec) == []


def test_from_dict():
    spec = CaptureSpec.from_dict({
        "source": {"track": "standard", "flow_hash": HASH, "path": "/data/"}, "cdc_log": True,
        "objects": [
            {"name": "a", "table": "a", "keys": ["k"], "key_source": "declared",
             "flags": [{"name": "F", "expr": "coalesce(x, false)"}]},
            {"name": "b", "table": "b", "keys": ["k"], "cdc_log": False}],
        "referential_integrity": {"master": "a", "key_columns": ["k"], "children": ["b"]}})
    assert [o.source for o in spec.objects] == ["/data/a", "/data/b"]
    assert [o.name for o in cdc_objects(spec)] == ["A"]
    assert spec.load_type == f"load_type_{HASH}" and spec.watermark == "__TIMESTAMP"
    assert spec.referential.children == ("B",) and list(spec.object("A").flags) == ["F"]
    with pytest.raises(SpecError):
        CaptureSpec.from_dict({"objects": []})
