"""Every registered query runs; those with SQL give the same rows in DuckDB."""

import glob
import os

import duckdb
import pytest
from conftest import sorted_rows

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_sql_only_for_registered_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLE[name])
    columns = [column[0] for column in relation.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted_rows(columns, relation.fetchall())
    actual = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert actual == expected


def test_entry_point_gives_rows(spark):
    assert entry_point.entry(spark).count() == 10


# Model queries are checked for value in test_model and test_recommend.
@pytest.mark.parametrize("name", ["recommend", "sample_predictions", "drift_report", "predict_with_bias"])
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_epoch_does_not_depend_on_session_zone(spark, sf_dir):
    from reelspark.sources import tables

    total = lambda: tables.ratings(spark, sf_dir).selectExpr("sum(timestamp) AS s").first()["s"]
    expected = total()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert total() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
