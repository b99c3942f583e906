"""Ranks, positions and running sums against brute force, with ties, nulls, hot values and groups."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lavra.operators import ranking
from lavra.operators.ranking import Ranges


def brute_ranks(values, descending=True):
    known = sorted((v for v in values if v is not None), reverse=descending)
    return [None if v is None else known.index(v) + 1 for v in values]


def messy_values(n, seed):
    rng = random.Random(seed)
    kinds = [lambda: 7.0, lambda: None, lambda: float(rng.randint(0, 20)), lambda: rng.gauss(0, 100)]
    return [rng.choices(kinds, [4, 2, 2, 4])[0]() for _ in range(n)]


@pytest.mark.parametrize("buckets", [2, 3, 16])
@pytest.mark.parametrize("descending", [True, False])
def test_competition_rank_matches_brute_force(spark, buckets, descending):
    values = messy_values(600, buckets)
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double").repartition(5)
    got = ranking.competition_rank(df, "v", "r", descending=descending, buckets=buckets)
    assert got.columns == ["i", "v", "r"]
    assert [r["r"] for r in sorted(got.collect())] == brute_ranks(values, descending)


def test_competition_rank_edges(spark):
    rows = spark.createDataFrame([(0, 9.0), (1, 9.0), (2, 7.0), (3, None)], "i int, v double")
    assert [r["r"] for r in sorted(ranking.competition_rank(rows, "v", "r").collect())] == [1, 1, 3, None]
    empty = ranking.competition_rank(rows.where("i > 9"), "v", "r")
    assert empty.collect() == []
    masked = ranking.competition_rank(rows, "v", "r", where=F.col("i") > 0)
    assert [r["r"] for r in sorted(masked.collect())] == [None, 1, 2, None]
    same = spark.createDataFrame([(i, 1.0) for i in range(9)], "i int, v double")
    assert {r["r"] for r in ranking.competition_rank(same, "v", "r").collect()} == {1}
    nan = spark.createDataFrame([(0, float("nan")), (1, 1.0)], "i int, v double")
    assert [r["r"] for r in sorted(ranking.competition_rank(nan, "v", "r").collect())] == [None, 1]


def test_direct_branch_for_many_missing(spark, monkeypatch):
    monkeypatch.setattr(ranking, "hot_limit", lambda rows, width, floor=0: 3)
    values = messy_values(200, 5)
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = ranking.competition_rank(df, "v", "r", buckets=4).collect()
    assert [r["r"] for r in sorted(got)] == brute_ranks(values)


@pytest.mark.parametrize("floor", [5, 100_000])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_in_group_with_hot_group(spark, floor, descending):
    rng = random.Random(1)
    values = messy_values(900, 2)
    groups = [rng.choices(["hot", "mid", None, *"abcdef"], [30, 10, 5, *[2] * 6])[0] for _ in values]
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(zip(groups, values))], "i int, g string, v double")
    got = ranking.rank_in_group(df, ["g"], "v", "r", descending, floor=floor, buckets=6)
    assert got.columns == ["i", "g", "v", "r"]
    expected = [None] * len(values)
    for g in set(groups) - {None}:
        places = [i for i, x in enumerate(groups) if x == g]
        for i, r in zip(places, brute_ranks([values[i] for i in places], descending)):
            expected[i] = r
    assert [r["r"] for r in sorted(got.collect())] == expected


@pytest.mark.parametrize("buckets", [2, 5, 32])
def test_row_position_with_tied_blocks(spark, buckets):
    rng = random.Random(buckets)
    rows = [(i, rng.choice([1, 1, 1, 2, 5, None, i]), rng.choice([0, 0, 3, i % 7])) for i in range(700)]
    df = spark.createDataFrame(rows, "i int, a int, b int").repartition(7)
    tie = F.md5(F.col("i").cast("string"))
    got = ranking.row_position(df, [(F.col("a"), True), (F.col("b"), False)], tie, "p", buckets)

    def key(row):
        i, a, b = row
        return (a is None, -(a or 0), b, hashlib.md5(str(i).encode()).hexdigest())

    expected = {row[0]: n for n, row in enumerate(sorted(rows, key=key), 1)}
    assert {r["i"]: r["p"] for r in got.collect()} == expected


def test_ranking_list_minimum_and_ties(spark):
    rows = [("a", 0.5, 4), ("b", 0.5, 5), ("c", 0.9, 6), ("d", 0.5, 5), ("e", None, 7)]
    df = spark.createDataFrame(rows, "k string, score double, n int")
    got = ranking.ranking_list(df, "score", ["k"], "place", F.col("n") >= 5).orderBy("place").collect()
    tied = sorted("bd", key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert [r["k"] for r in got] == ["c", *tied, "e"]
    assert [r["place"] for r in got] == [1, 2, 3, 4]


@pytest.mark.parametrize("descending", [True, False])
def test_running_sums(spark, descending):
    rng = random.Random(4)
    rows = sorted({(rng.choice("xyz"), rng.randint(0, 300) / 7.0) for _ in range(500)})
    df = spark.createDataFrame([(g, v, i % 5) for i, (g, v) in enumerate(rows)], "g string, v double, n int")
    got = ranking.running_sums(df, "v", ["n"], ["g"], descending, buckets=7)
    for g in "xyz":
        mine = sorted((r for r in got.collect() if r["g"] == g), key=lambda r: r["v"], reverse=descending)
        total = 0
        for r in mine:
            total += r["n"]
            assert r["cum_n"] == total


def test_ranges_isolate_repeated_quantiles():
    ranges = Ranges([1.0, 3.0, 3.0, 8.0])
    assert ranges.hot_values == [3.0]
    assert len(ranges) == 5
    assert len(Ranges(None)) == 1


def test_no_single_task_window_over_rows(spark):
    """Only the (range, offset) tables are ordered as a whole."""
    df = spark.range(2000).selectExpr("id", "cast(id % 97 as double) as v")
    ranked = ranking.competition_rank(df, "v", "r", buckets=8)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "rank(" in line]
    assert windows and all("[_b#" in line for line in windows)


def test_top_and_best(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9), ("c", None), ("d", 5)], "k string, v int")
    assert [r["k"] for r in ranking.top_k(df, 2, "v").collect()] == ["d", "b"]
    assert [r["k"] for r in ranking.bottom_k(df, 2, "v").collect()] == ["a", "d"]
    assert ranking.best_row(df, "v").first()["k"] == "b"
    assert [r["k"] for r in ranking.sorted_by(df, ("v", True)).collect()] == ["b", "d", "a", "c"]
