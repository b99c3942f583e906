"""Registered queries next to their SQL, on the smallest given tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry_points
from lavra.plans.queries import QUERIES
from tools.check_sql import table

FOLDER = pathlib.Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_query_without_sql_runs(spark, name):
    assert entry_points.queries()[name](spark, str(FOLDER)).count() > 0


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_agrees_with_sql(spark, db, name):
    df = entry_points.queries()[name](spark, str(FOLDER))
    result = db.execute(entry_points.oracle_sql()[name])
    expected = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_custkey", "c_nationkey", "spend", "place"] and df.count() == 150
