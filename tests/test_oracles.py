"""Every registered query against its SQL on the smallest data."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tidemark.queries import ORACLES, QUERIES

# Three full capture cycles each; test_capture.py checks them on one run.
CAPTURED = {"capture_cycle", "gold_refresh", "refresh_history", "capture_health",
            "daily_assurance"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - CAPTURED))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "c_name", "n_types", "last_changed", "latest_value"]
    assert df.count() == 150
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_parses(con, name):
    con.execute("EXPLAIN " + ORACLES[name])


