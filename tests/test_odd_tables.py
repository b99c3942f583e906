"""Registered queries next to their SQL on small tables with values that the given ones lack."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lavra.operators import categories
from lavra.operators.joins import skew_join
from tools.check_sql import table


@pytest.fixture
def agrees(spark, tmp_path):
    """Whether a query agrees with its SQL on tables given by name."""

    def run(name, **tables):
        db = duckdb.connect()
        for of, df in tables.items():
            path = f"{tmp_path}/{of}.parquet"
            df.coalesce(1).write.parquet(path)
            db.execute(f"create view {of} as select * from '{path}/*.parquet'")
        result = db.execute(entry_points.oracle_sql()[name])
        expected = table([d[0] for d in result.description], result.fetchall())
        got = entry_points.queries()[name](spark, str(tmp_path))
        return table(got.columns, [tuple(r) for r in got.collect()]) == expected

    return run


def test_key_set_with_keys_longer_than_the_code(spark, agrees):
    orders = spark.createDataFrame([(7,), (100001,), (100002,), (1000012,), (None,)], "o_custkey long")
    lines = spark.createDataFrame([(7,), (10000,), (99999,), (100002,)], "l_suppkey long")
    assert agrees("key_set", orders=orders, lineitem=lines)


def test_ranking_list_with_scores_at_a_half(spark, agrees):
    """Prices that are halves of a ten-thousandth of 600,000: a rank hangs on where their scores are rounded to."""
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") / 5).cast("long").alias("o_custkey"),
        (F.lit(417030.0) + 60 * F.col("id")).alias("o_totalprice"), F.lit("F").alias("o_orderstatus"),
        F.lit(datetime.datetime(2000, 1, 1)).alias("o_orderdate"),
    )
    assert agrees("ranking_list", orders=orders)


def test_many_categories_meets_its_dictionary_once(spark, agrees, monkeypatch):
    joins = []
    monkeypatch.setattr(categories, "skew_join", lambda *a, **k: joins.append(a) or skew_join(*a, **k))
    lines = spark.range(300).select((F.col("id") / 3).cast("long").alias("l_orderkey"), (F.col("id") % 7).alias("l_linenumber"))
    assert agrees("many_categories", lineitem=lines) and len(joins) == 1
