"""Joins, reshaping, aggregates, profiles, samples and folds on small tables."""

import pytest
from pyspark.sql import functions as F

from lavra.operators import aggregate, profile, reshape, sampling
from lavra.operators.columns import (
    absent, constant_columns, curate, drop_leakage, drop_prefixed, find_column, numeric_and_categorical,
    rename_existing, require_columns, require_tables, select_existing,
)
from lavra.operators.joins import coverage, enrich, enrich_all, measured, rows_by_id, semi_filter, skew_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key, a tenth have none."""
    left = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 1 when id % 10 = 1 then null else id % 50 end as k"
    )
    right = spark.range(0, 60, 2).selectExpr("id as k", "concat('v', id) as v")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "floor": 10}, {"broadcast_bytes": 0}])
def test_skew_join_equals_plain_join(skewed, how, limits):
    left, right = skewed
    got, plain = skew_join(left, right, ["k"], how, **limits), left.join(right, "k", how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_measured(spark):
    df = spark.createDataFrame([(1, "ab"), (1, None), (None, "x"), (None, "x"), (None, "x")], "k int, s string")
    count, size, most = measured(df, ["k"])
    assert (count, most) == (5, 2) and size >= 5 * 16


def test_enrich(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "c", 7)], "k int, name string, n int")
    right = spark.createDataFrame([(1, "R", 0.5)], "k int, name string, x double")
    out = enrich(left, right, ["k"], "_r")
    assert out.columns == ["k", "name", "n", "name_r", "x"]
    assert rows(out) == sorted([(1, "a", 5, "R", 0.5), (2, "b", 6, None, None), (None, "c", 7, None, None)], key=str)
    twice = right.union(right.withColumn("x", F.lit(0.1)))
    with pytest.raises(ValueError, match="not unique"):
        enrich(left, twice, ["k"])
    first = enrich(left, twice, ["k"], duplicates="first", order=["x"])
    assert first.where("k = 1").first()["x"] == 0.1


def test_enrich_all_with_absent_source(spark):
    base = spark.createDataFrame([("1",), ("2",)], "k string")
    there = spark.createDataFrame([("1", 5)], "k string, n int")
    out = enrich_all(base, {"_a": (there, ""), "_b": (None, "k string, m double")}, ["k"])
    assert rows(out) == [("1", 5, None), ("2", None, None)]


def test_semi_coverage_and_ids(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, None)], "row_id int, k string, s int")
    assert rows(semi_filter(df, spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])) == [("a", 1, None)]
    assert rows_by_id(df, spark.createDataFrame([(3,)], "row_id int")).first()["row_id"] == 3
    assert rows(coverage(df, {"one": "s", "two": "k"})) == [("one", 3, 1, 33.33), ("two", 3, 2, 66.67)]
    assert rows(coverage(df.limit(0), {"one": "s"})) == [("one", 0, 0, None)]


def test_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0, 3)], "a int, `Unnamed: 1` string, c double, d int")
    assert drop_prefixed(df).columns == ["a", "c", "d"]
    assert rename_existing(df, {"a": "b", "zz": "y"}).columns[0] == "b"
    assert select_existing(df, ["d", "zz", "a", "d"]).columns == ["d", "a"]
    assert absent(df, ["a", "zz"]) == ["zz"]
    with pytest.raises(KeyError, match="zz"):
        require_columns(df, ["zz"], "table t")
    with pytest.raises(FileNotFoundError, match="other"):
        require_tables({"t": df, "other": None}, ["t", "other"])
    assert drop_leakage(df, ["d", "zz", "a"])[1] == ["d", "a"]
    assert numeric_and_categorical(df, ["a", "Unnamed: 1", "c"]) == (["a", "c"], ["Unnamed: 1"])
    names = ["Município", "Município (Código)", "Valor"]
    assert find_column(names, ["município", "código"]) == "Município (Código)"
    assert find_column(names, ["município"], exclude=["código"]) == "Município"
    assert find_column(names, ["municipio"], any_of=["codigo"], normalize=True) == "Município (Código)"
    assert find_column(names, ["x"]) is None


def test_constant_and_curated(spark):
    df = spark.createDataFrame([(1, None, 5, 0, "u"), (2, None, 5, 1, "v")], "a int, b int, c int, y int, id string")
    assert constant_columns(df, ["a", "b", "c"]) == ["b", "c"]
    table, kept, constant = curate(df, ["id", "gone"], ["a", "c", "missing"], "y")
    assert (table.columns, kept, constant) == (["id", "a", "y"], ["a"], ["c"])


def test_reshape(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, o int, v string")
    assert rows(reshape.first_per_key(df, ["k"], ["o"])) == [("a", 1, "x"), ("b", 3, None)]
    wide = spark.createDataFrame([("m", 1.0, None)], "id string, pct_2023 double, pct_2024 double")
    long = reshape.melt_years(wide, ["id", "gone"], ["pct_2023", "pct_2024", "pct_2025"], "pct")
    assert rows(long) == [("m", 1.0, 2023), ("m", None, 2024)]
    cells = spark.createDataFrame(
        [("m", "urbana", None, 1), ("m", "urbana", 7.0, 2), ("m", "urbana", 8.0, 3), ("n", "outra", 1.0, 4)],
        "k string, c string, v double, o int",
    )
    out = reshape.pivot_first(cells, ["k"], "c", "v", {"urbana": "u", "rural": "r"}, "o")
    assert rows(out) == [("m", 7.0, None), ("n", None, None)]
    with pytest.raises(ValueError):
        reshape.key_union([df.where("false")], F.col("k"), "k")
    union = reshape.union_all([df.select("k"), df.select("o").limit(1)])
    assert union.columns == ["k", "o"] and union.count() == 4


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    plan = reshape.first_per_key(spark.range(10).selectExpr("id % 3 as k", "id as o"), ["k"], ["o"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_entity_rollup(spark):
    df = spark.createDataFrame(
        [("m", None, 1, 2.0, 2), ("m", "first", None, 4.0, 1), ("m", "next", 0, None, 3), ("n", None, None, None, 4)],
        "k string, name string, flag int, n double, o int",
    )
    out = aggregate.entity_rollup(
        df, ["k"], "rows", {"name": "nome", "gone": "g"}, {"flag": "pct"}, {"n": "avg", "gone2": "g2"}, order="o"
    )
    assert rows(out) == [("m", 3, "first", 50.0, 3.0), ("n", 1, None, None, None)]


def test_group_summaries(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 1), ("a", "x", 3.0, 0), (None, None, None, None)], "g string, k string, v double, f int")
    out = aggregate.group_summary(df, ["g"], {"k": "n"}, {"v": "mean"}, {"f": "pct"})
    assert rows(out) == sorted([("a", 1, 2.0, 50.0), (None, 0, None, None)], key=str)
    names = {x: x for x in ("rows", "mean", "predicted", "actual", "mean_pct", "eligible")}
    rolled = aggregate.score_rollup(df.fillna({"f": 1}), ["g", "gone"], "v", "f", "f", names, minimum=2)
    assert rows(rolled) == sorted([("a", 2, 2.0, 1, 1, 200.0, True), (None, 1, None, 1, 1, None, False)], key=str)
    assert rows(aggregate.rate_by_category(df, "g", "f", minimum=1)) == [("a", 2, 0.5, 50.0)]
    assert rows(aggregate.value_counts(df, "g")) == sorted([("a", 2, 200 / 3), (None, 1, 100 / 3)], key=str)


def test_summaries(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (3, None)], "a int, y int")
    names = {x: x for x in ("rows", "columns", "duplicates", "negatives", "positives", "rate_pct")}
    assert tuple(aggregate.dataset_summary(df, "y", names).first()) == (4, 2, 1, 2, 1, 33.33)
    assert aggregate.duplicate_rows(df).first()[0] == 1
    assert aggregate.duplicate_rows(df.limit(0)).first()[0] == 0
    report = aggregate.key_value_report({"t": df}, {"cutoff": 743})
    assert rows(report) == [("cutoff", "743"), ("t", "4")]
    stats = aggregate.mean_and_std(df, [], ["a"]).first()
    assert stats["a_media"] == 1.75 and stats["a_std"] == pytest.approx(0.82915619)


def test_profile(spark):
    df = spark.createDataFrame([(1, None, 0.0), (2, None, -0.0), (2, None, float("nan"))], "a int, b string, c double")
    exact = {r["column"]: tuple(r)[1:] for r in profile.column_profile(df).collect()}
    assert exact == {
        "a": (0, 0.0, 2, "int"), "b": (3, 100.0, 0, "string"), "c": (1, 33.333333, 1, "double"),
    }
    rough = {r["column"]: r["n_distinct"] for r in profile.column_profile(df, approximate=True).collect()}
    assert rough["a"] == 2 and rough["b"] == 0
    assert [r["column"] for r in profile.high_null(profile.column_profile(df)).orderBy("column").collect()] == ["b", "c"]


def test_correlations(spark):
    data = [(float(i), 1.0, float(-i) if i < 19 else None, i % 2) for i in range(30)]
    df = spark.createDataFrame(data, "x double, same double, few double, y int")
    out = profile.correlation_ranking(df, ["x", "same", "few", "y"], "y")
    got = {r["column"]: r["correlation"] for r in out.collect()}
    assert set(got) == {"x", "y"} and got["y"] == pytest.approx(1.0)
    constant = profile.correlation_ranking(df.withColumn("y", F.lit(1)), ["x"], "y").first()
    assert constant["correlation"] is None


def test_quality(spark):
    df = spark.createDataFrame([(50.0, 0), (-0.1, 1), (100.1, 2), (None, None)], "p double, b int")
    rules = [profile.in_range("p", 0, 100), profile.binary("b"), profile.binary("gone")]
    got = {(r["teste"], r["coluna"]): (r["resultado"], r["status"]) for r in profile.quality_report(df, "t", rules, 6).collect()}
    assert got == {
        ("duplicatas_removidas", ""): (2, "AJUSTADO"),
        ("valores_nulos", "p"): (1, "INFO"), ("valores_nulos", "b"): (1, "INFO"),
        ("faixa_0_100", "p"): (2, "ERRO"), ("validacao_binaria_0_1", "b"): (1, "ERRO"),
        ("validacao_binaria_0_1", "gone"): (0, "OK"),
    }


def test_coerce(spark):
    data = [("1,5" if i else "bad", "2" if i > 1 else "bad", None, str(i)) for i in range(20)]
    df = spark.createDataFrame(data, "good string, poor string, none string, id string")
    out = profile.coerce_numeric(df, protected=["id"])
    assert dict(out.dtypes) == {"good": "double", "poor": "string", "none": "string", "id": "string"}
    assert out.agg(F.count("good"), F.sum("good")).first()[:] == (19, 28.5)
    safe = profile.numeric_when_safe(spark.createDataFrame([("1.234,5", "7")], "valor string, codigo string"))
    assert safe.first()[:] == (1234.5, "7")


def test_sample_is_exact_and_stable(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    picks = [
        rows(sampling.sample_exact(df.repartition(n), 300, ["id"], 42)) for n in (1, 4, 16)
    ]
    assert len(picks[0]) == 300 and picks[0] == picks[1] == picks[2]
    assert rows(sampling.sample_exact(df, 300, ["id"], 7)) != picks[0]
    assert sampling.sample_exact(df, 5000, ["id"]).count() == 5000
    kept, found, n = sampling.sample_with_counts(df, 10)
    assert (kept.count(), found, n) == (10, 5000, 10) and kept.columns == ["id", "v"]


def test_sample_widens_a_limit_that_was_too_tight(spark, monkeypatch):
    df = spark.range(4000)
    whole = rows(sampling.sample_exact(df, 100, ["id"]))
    tight = sampling._hex_limit
    monkeypatch.setattr(sampling, "_hex_limit", lambda chance: tight(chance / 8))
    assert rows(sampling.sample_exact(df, 100, ["id"])) == whole


def test_large_sample_sorts_only_the_surplus(spark, monkeypatch):
    df = spark.range(4000)
    small = rows(sampling.sample_exact(df, 700, ["id"]))
    monkeypatch.setattr(sampling, "SORT_ROWS", 10)
    assert rows(sampling.sample_exact(df, 700, ["id"])) == small
    assert sampling.sample_exact(df, 3999, ["id"]).count() == 3999


def test_folds_keep_groups_together(spark):
    df = spark.range(4000).selectExpr(
        "id", "case when id % 3 = 0 then 'big' when id % 101 = 5 then null else concat('g', id % 400) end as g",
        "cast(id % 7 < 3 as int) as y",
    ).withColumn("grp", sampling.fallback_group(F.col("g"), F.col("id")))
    folds = sampling.group_folds(df, "grp", "y", 4)
    assert folds.count() == 4000
    assert folds.groupBy("grp").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    again = sampling.group_folds(df.repartition(9), "grp", "y", 4)
    assert rows(folds.select("id", "fold")) == rows(again.select("id", "fold"))
    small = folds.where("grp <> 'big'").groupBy("fold").agg(F.count("*").alias("n"), F.avg("y").alias("share")).collect()
    assert len(small) == 4 and max(r["n"] for r in small) < 1.1 * min(r["n"] for r in small)
    assert all(abs(r["share"] - 3 / 7) < 0.05 for r in small)
    train, test = sampling.holdout(folds)
    assert train.count() + test.count() == 4000 and "fold" not in train.columns
