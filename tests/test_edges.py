"""Inputs that once gave wrong or lost rows."""

import datetime
import decimal
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lavra.operators import features, profile, ranking, sampling
from lavra.sources import scan
from lavra.sources.payloads import header_row_table
from lavra.sources.sinks import write_layer


def test_rows_without_a_group_keep_a_fold(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"g{i % 13}", i % 2) for i in range(100)], "id int, g string, y int")
    folded = sampling.group_folds(df, "g", "y", 4)
    train, test = sampling.holdout(folded)
    assert train.count() + test.count() == 100
    assert folded.where("g is not null").groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert folded.where("g is null").select("fold").distinct().count() > 1
    again = sampling.group_folds(df.repartition(7), "g", "y", 4)
    assert sorted(map(str, again.collect())) == sorted(map(str, folded.collect()))
    with pytest.raises(Exception, match="no fold"):
        sampling.holdout(folded.withColumn("fold", F.when(F.col("id") > 0, F.col("fold"))))[0].collect()


def test_each_payload_has_its_own_header(spark):
    one = [{"a": "code", "b": "value"}, {"a": "1", "b": "x"}, {"a": "2", "b": "y"}]
    two = [{"a": "value", "b": "code", "c": "note"}, {"a": "z", "b": "3", "c": "n"}]
    out = header_row_table(spark.createDataFrame([(1, one), (2, two)], "id int, p array<map<string,string>>"), "p")
    assert out.columns == ["id", "_ordinal", "code", "value", "note"]
    assert sorted((r["code"], r["value"], r["note"]) for r in out.collect()) == [("1", "x", None), ("2", "y", None), ("3", "z", "n")]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a;b\n1;"x\ny"\n2;z\n3;z;too;many\n4\n')
    read = {r["a"]: r["b"] for r in scan.scan_raw(spark, str(tmp_path / "t.csv"), ";", multi_line=True).collect()}
    assert read["1"] == "x\ny" and read["2"] == "z"
    kept = scan.scan_tolerant(spark, str(tmp_path / "t.csv"), multi_line=True).collect()
    assert sorted((r["a"], r["b"]) for r in kept) == [("1", "x\ny"), ("2", "z"), ("4", None)]


def test_csv_layers_count_what_they_wrote(spark, tmp_path):
    df = spark.createDataFrame([("x\ny", 'q"'), (None, "z"), ("", "")], "a string, b string")
    assert write_layer(df, str(tmp_path / "layer"), "csv") == 3


@pytest.mark.parametrize("buckets", [2, 8])
def test_values_that_share_a_double_keep_their_ranks(spark, buckets):
    big = 2**53
    values = [big + 1] * 20 + [big] * 30 + [big + 3] * 5 + list(range(20))
    df = spark.createDataFrame([(i, v, decimal.Decimal(v * 100 + 1) / 100) for i, v in enumerate(values)], "id int, v long, d decimal(20,2)")
    expected = {i: 1 + sum(x > v for x in values) for i, v in enumerate(values)}
    for column in ("v", "d"):
        found = ranking.competition_rank(df, column, "place", buckets=buckets)
        assert {r["id"]: r["place"] for r in found.collect()} == expected
        inside = ranking.rank_in_group(df.withColumn("g", F.lit(1)), ["g"], column, "place", floor=5, buckets=buckets)
        assert {r["id"]: r["place"] for r in inside.collect()} == expected
        placed = ranking.row_position(df, [(F.col(column), True)], ranking.key_hash(["id"]), "place", buckets=buckets)
        got = [values[r["id"]] for r in placed.orderBy("place").collect()]
        assert got == sorted(values, reverse=True)


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    for approximate in (False, True):
        got = {r["column"]: (r["nulls"], r["null_pct"], r["n_distinct"], r["type"]) for r in profile.column_profile(df, approximate).collect()}
        assert got == {"a": (0, None, 0, "int"), "b": (0, None, 0, "string")}


def test_keys_hash_apart(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), (None, "x"), ("", "x"), ("\\N", "x"), ("a\\", ":b"), ("a", "\\:b")], "a string, b string")
    assert df.select(ranking.key_hash(["a", "b"])).distinct().count() == 7


def test_one_class_weighs_one(spark):
    df = spark.createDataFrame([(1,), (1,)], "y int")
    assert [r[0] for r in df.select(features.balanced_weight("y", *features.class_counts(df, "y"))).collect()] == [1.0, 1.0]


def test_medians_beside_a_flag(spark):
    rng = random.Random(4)
    rows = [(rng.random(), i % 2, rng.choice([1.5, 1.5, 2.5, None]), float(rng.randrange(5)), -rng.expovariate(1) ** 9) for i in range(4001)]
    df = spark.createDataFrame(rows, "x double, flag int, y double, few double, far double")
    for bracket in (10, 100, 100_000):
        got = features.exact_medians(df, ["x", "flag", "y", "few", "far"], bracket)
        for i, c in enumerate(["x", "flag", "y", "few", "far"]):
            assert got[c] == statistics.median([r[i] for r in rows if r[i] is not None]), (c, bracket)


def test_dates_and_nulls_do_not_stop_a_key(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1), None)], "d date, n int")
    assert len(df.select(ranking.key_hash(["d", "n"])).first()[0]) == 32


def test_folder_of_mixed_files(spark, tmp_path):
    from lavra.sources.files import scan_by_profile

    (tmp_path / "a.csv").write_bytes('"x;y;z",name\n1,água\n'.encode())
    (tmp_path / "b.csv").write_bytes('name;more\n"a;b\xe7";2\n'.encode("latin-1"))
    rows = {(r["x;y;z"], r["name"], r["more"]) for r in scan_by_profile(spark, str(tmp_path)).collect()}
    assert rows == {("1", "água", None), (None, "a;bç", "2")}
