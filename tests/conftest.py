import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelspark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = build_session(
        "tests",
        shuffle_partitions=4,
        **{"spark.sql.warehouse.dir": str(warehouse), "spark.checkpoint.dir": str(checkpoints)},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data at {SF_DIR}")
    return SF_DIR


@pytest.fixture
def ratings_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT")

    return make


@pytest.fixture
def movies_of(spark):
    def make(ids):
        rows = [(i, f"Film {i} ({1990 + i % 30})", "Drama") for i in ids]
        return spark.createDataFrame(rows, "movieId INT, title STRING, genres STRING")

    return make


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)
