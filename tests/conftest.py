import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tidemark import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session.local(4, partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows(spark):
    """A frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def store(spark, tmp_path):
    from tidemark.sources import SnapshotStore
    return SnapshotStore(spark, str(tmp_path), 4)


@pytest.fixture
def control(spark, tmp_path):
    from tidemark.sources import ControlTables
    return ControlTables(spark, str(tmp_path))
