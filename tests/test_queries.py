"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, canonical
from wayfare.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert QUERIES.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = entry_points.queries()[name](spark, SF)
    result = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    want = canonical(result.fetchall(), columns)
    assert canonical([tuple(r) for r in frame.collect()], frame.columns) == want
    assert want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
