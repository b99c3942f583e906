"""Features, metrics, models and explanations, against hand-worked and brute-force results."""

import hashlib
import itertools
import math
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lavra.operators import evaluate, explain, features, models, sampling, trees
from lavra.operators.categories import slot_names
from lavra.plans.queries import QUERIES
from lavra.session import staged
from lavra.sources.sinks import load_run, save_run

Y = [1, 0, 1, 1, 0, 0, 1, 0]
P = [0.9, 0.8, 0.7, 0.6, 0.5, 0.5, 0.5, 0.1]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("a", y, p, int(p >= 0.6)) for y, p in zip(Y, P)]
    rows += [("one", 1, 0.3, 0), ("one", 1, 0.4, 0)]
    return spark.createDataFrame(rows, "g string, y int, p double, pred int")


def test_metrics_by_hand(scored):
    got = {r["g"]: r for r in evaluate.binary_metrics(scored, "y", "p", "pred", ["g"]).collect()}
    a, one = got["a"], got["one"]
    assert a["roc_auc"] == pytest.approx(0.75) and a["pr_auc"] == pytest.approx(0.7470238, abs=1e-7)
    assert (a["accuracy"], a["precision"], a["recall"], a["f1"]) == (0.75, 0.75, 0.75, 0.75)
    assert one["roc_auc"] is None and one["pr_auc"] is None
    assert (one["accuracy"], one["precision"], one["recall"], one["f1"], one["balanced_accuracy"]) == (0, 0, 0, 0, 0)
    alone = evaluate.binary_metrics(scored.where("g = 'a'"), "y", "p", "pred")
    assert alone.columns == list(evaluate.METRICS) and alone.first()["roc_auc"] == pytest.approx(0.75)


@pytest.mark.parametrize("buckets", [2, 9])
def test_ranking_metrics_brute_force(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice("xy"), int(rng.random() < 0.3), rng.choice([0.5, round(rng.random(), 2), rng.random()])) for _ in range(400)]
    got = evaluate.ranking_metrics(spark.createDataFrame(rows, "g string, y int, p double"), "y", "p", ["g"], buckets)
    for r in got.collect():
        mine = [(p, y) for g, y, p in rows if g == r["g"]]
        pos, neg = [p for p, y in mine if y], [p for p, y in mine if not y]
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
        ap = sum(
            sum(p == s for p in pos) * sum(p >= s for p in pos) / sum(p >= s for p, _ in mine) for s in {p for p, _ in mine}
        ) / len(pos)
        assert r["roc_auc"] == pytest.approx(auc) and r["pr_auc"] == pytest.approx(ap)


def test_curves_and_confusion(scored):
    curve = evaluate.curve_points(scored.where("g = 'a'"), "y", "p").orderBy(F.desc("threshold")).collect()
    assert [(r["threshold"], r["tp"], r["fp"]) for r in curve] == [
        (0.9, 1, 0), (0.8, 1, 1), (0.7, 2, 1), (0.6, 3, 1), (0.5, 4, 3), (0.1, 4, 4)
    ]
    assert curve[4]["fpr"] == 0.75 and curve[4]["precision"] == pytest.approx(4 / 7)
    cells = {(r["y"], r["pred"]): r["n"] for r in evaluate.confusion(scored, "y", "pred", ["g"]).where("g = 'a'").collect()}
    assert cells == {(1, 1): 3, (0, 1): 1, (1, 0): 1, (0, 0): 3}


def metrics_row(spark, values):
    return spark.createDataFrame([tuple(values)], ", ".join(f"{m} double" for m in evaluate.METRICS))


def test_published_comparison(spark):
    """Published metrics with and without one feature, and their differences."""
    base = metrics_row(spark, [0.566, 0.5651719037483315, 0.5448851774530271, 0.5471698113207547, 0.5460251046025104, 0.6112694461480492, 0.5651118863491734])
    less = metrics_row(spark, [0.579, 0.5798128840626766, 0.5544747081712063, 0.5974842767295597, 0.5751765893037336, 0.6026351760324846, 0.5470818882245323])
    table = evaluate.compare_metrics(base, less)
    got = {r["metrica"]: r for r in table.collect()}
    assert got["accuracy"]["delta_absoluto"] == pytest.approx(0.013)
    assert got["accuracy"]["delta_percentual"] == pytest.approx(2.296819787985868)
    assert got["recall"]["delta_percentual"] == pytest.approx(9.195402298850572)
    result = evaluate.verdict(table, {"small": "s", "large": "l"}).first()
    assert result["interpretacao"] == "s" and result["delta_pr_auc"] == pytest.approx(-0.018029998124641122)
    assert evaluate.verdict(table, {"small": "s", "large": "l"}, 0.01).first()["interpretacao"] == "l"
    zero = evaluate.compare_metrics(metrics_row(spark, [0.0] * 7), less).first()
    assert zero["delta_percentual"] is None


@pytest.mark.parametrize("bracket", [3, 50, 100_000])
def test_exact_medians(spark, bracket):
    rng = random.Random(bracket)
    data = [(rng.gauss(0, 1), float(rng.choice([1, 2, 2, 2, 3])), None if i % 2 else float(i), None) for i in range(2001)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = features.exact_medians(df, ["a", "b", "c", "d"], bracket)
    for i, c in enumerate("abc"):
        assert got[c] == pytest.approx(float(np.median([r[i] for r in data if r[i] is not None])), abs=1e-12)
    assert got["d"] is None


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x, z, g = rng.gauss(0, 2), rng.gauss(5, 1), rng.choice(["p", "q", "r's"])
        y = int(x + (g == "q") + rng.gauss(0, 1) > 0.5)
        rows.append((i, x if i % 9 else None, z, None, g if i % 11 else None, y))
    rows.append((400, 0.1, 5.0, None, "once", 1))
    return spark.createDataFrame(rows, "id int, x double, z double, none double, g string, y int")


def test_preparation(spark, labelled):
    fitted = features.fit_preparation(labelled, ["x", "z", "none"], ["g"])
    told = {r["value"]: (r["rare"], r["place"], r["slot"]) for r in fitted.dictionary.table(spark).collect()}
    assert fitted.numeric == ["x", "z"] and fitted.categorical == ["g"]
    assert told == {"once": (True, 0, 3), "p": (False, 1, 0), "q": (False, 2, 1), "r's": (False, 3, 2)}
    onehot, slots = features.assemble(spark, fitted, True, "onehot")
    assert slot_names(slots) == ["num__x", "num__z", "cat__g_p", "cat__g_q", "cat__g_r's", "cat__g___pooled__"]
    probe = spark.createDataFrame(
        [(1, None, 5.0, None, "q"), (2, 1.0, 5.0, None, "new"), (3, 1.0, 5.0, None, "once"), (4, 1.0, 5.0, None, None)],
        "id int, x double, z double, none double, g string",
    )
    rows = [list(r[0]) for r in onehot.transform(probe).orderBy("id").select(vector_to_array("features")).collect()]
    assert rows[0][0] == pytest.approx((fitted.medians["x"] - fitted.means["x"]) / fitted.stds["x"])
    assert [r[2:] for r in rows[:3]] == [[0, 1, 0, 0], [0, 0, 0, 0], [0, 0, 0, 1]]
    assert sum(rows[3][2:5]) == 1
    ordinal, slots = features.assemble(spark, fitted, False, "ordinal")
    codes = [r[0][2] for r in ordinal.transform(probe).orderBy("id").select(vector_to_array("features")).collect()]
    assert slot_names(slots) == ["num__x", "num__z", "cat__g"] and codes[:3] == [2.0, -1.0, 0.0]
    scaled = onehot.transform(labelled).select(vector_to_array("features")[0].alias("v")).agg(F.avg("v"), F.stddev_pop("v")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9) and scaled[1] == pytest.approx(1)


def test_two_hundred_thousand_categories(spark):
    rows = spark.range(0, 500_000).select(F.col("id"), F.concat(F.lit("c"), F.col("id") % 200_000).alias("g"), (F.col("id") % 2).cast("int").alias("y"))
    fitted = features.fit_preparation(rows, [], ["g"], min_frequency=3)
    mode, every, frequent = fitted.dictionary.columns["g"]
    assert (mode, every, frequent) == ("c0", 200_000, 100_000) and fitted.dictionary.width("g") == 100_001
    model, slots = features.assemble(spark, fitted, True, "onehot")
    probe = spark.createDataFrame([(0, "c0"), (1, "c99999"), (2, "c150000"), (3, "new"), (4, None)], "id int, g string")
    got = {r["id"]: r["features"] for r in model.transform(probe).collect()}
    names = sorted(f"c{i}" for i in range(100_000))
    assert all(v.size == 100_001 for v in got.values())
    assert got[0].indices.tolist() == [names.index("c0")] == got[4].indices.tolist()
    assert got[1].indices.tolist() == [names.index("c99999")]
    assert got[2].indices.tolist() == [100_000] and got[3].indices.tolist() == []
    assert slots.count() == 100_001 and slots.where("slot = 100000").first()["name"] == "cat__g___pooled__"


def test_no_features_and_no_values(spark, labelled):
    fitted = features.fit_preparation(labelled.select("none", "y", F.lit(None).cast("string").alias("g")), ["none"], ["g"])
    assert fitted.numeric == [] and fitted.categorical == []
    model, slots = features.assemble(spark, fitted, True, "onehot")
    assert model.transform(labelled).first()["features"].size == 0 and slots.count() == 0


def test_logistic_matches_newton(labelled):
    fitted = models.fit(labelled, "y", ["x", "z"], ["g"], models.LOGISTIC, {"C": 0.3})
    data = fitted.model.transform(labelled).select(vector_to_array("features").alias("f"), "y").collect()
    X = np.array([r["f"] + [1.0] for r in data])
    y = np.array([r["y"] for r in data], float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = np.zeros(X.shape[1])
    penalty = np.r_[np.ones(X.shape[1] - 1), 0.0]
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ beta))
        grad = penalty * beta + 0.3 * X.T @ (w * (p - y))
        beta -= np.linalg.solve(np.diag(penalty) + 0.3 * X.T @ (X * (w * p * (1 - p))[:, None]), grad)
    assert np.allclose(fitted.model.stages[-1].coefficients.toArray(), beta[:-1], atol=1e-3)
    assert fitted.model.stages[-1].intercept == pytest.approx(beta[-1], abs=1e-3)


def test_model_kinds_and_cv(labelled):
    folded = labelled.withColumn("fold", F.col("id") % 2)
    specs = [
        models.LOGISTIC, models.ModelSpec("random_forest", params={"n_estimators": 5, "max_depth": 3}),
        models.ModelSpec("hist_gradient_boosting", encoding="ordinal", weighted=False, params={"max_iter": 2}),
    ]
    table = models.cross_validate(folded, "y", ["x", "z"], ["g"], specs, folds=[0, 1]).collect()
    assert {r["modelo"] for r in table} == {s.name for s in specs}
    assert [r["pr_auc_media"] for r in table] == sorted((r["pr_auc_media"] for r in table), reverse=True)
    assert all(r["roc_auc_media"] > 0.7 for r in table)
    best, draws = models.random_search(folded, "y", ["x", "z"], ["g"], models.LOGISTIC, draws=2, folds=[0, 1])
    top = max(draws.collect(), key=lambda r: r["pr_auc"])
    assert draws.count() == 2 and top["params"] == str(best.params)


def test_draws_are_distinct_and_seeded():
    grid = models.GRIDS["random_forest"]
    draws = models.draw_parameters(grid, 10)
    assert draws == models.draw_parameters(grid, 10) and len({str(d) for d in draws}) == 10
    assert models.GRIDS["logistic_regression"]["C"][8] == pytest.approx(0.18329807108324356)
    assert models.draw_parameters({"C": [1, 2]}, 10) == [{"C": 1}, {"C": 2}]


def test_save_and_load(spark, labelled, tmp_path):
    fitted = models.fit(labelled, "y", ["x", "z"], ["g"], models.LOGISTIC)
    predictions = models.predict(fitted, labelled, "y", ["id"])
    metadata = models.run_metadata(spark, fitted, "y", "g", [], {"roc_auc": 0.5, "none": None}, 10, 5)
    save_run(str(tmp_path / "run"), fitted.model, predictions, metadata)
    model, loaded, facts = load_run(spark, str(tmp_path / "run"))
    assert isinstance(model, PipelineModel)
    again = models.predict(model, labelled, "y", ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, loaded.collect()))
    assert facts.first()["best_model"] == "logistic_regression" and facts.first()["train_rows"] == 10


@pytest.mark.parametrize("partitions", [2, 16])
def test_permuted_keeps_values(spark, labelled, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    copies = staged(explain.permuted(labelled.repartition(partitions), ["x", "g"], "id", 3))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    order = sorted(range(401), key=lambda i: hashlib.md5(f"42:1:{i}".encode()).hexdigest())
    taken = {r["id"]: r["z"] for r in explain.permuted(labelled, ["z"], "id", 1).collect()}
    own = {r["id"]: r["z"] for r in labelled.collect()}
    assert all(taken[a] == own[b] for a, b in zip(order, order[1:] + order[:1]))
    assert copies.count() == labelled.count() * 6
    plain = {r["id"]: r for r in labelled.collect()}
    moved = 0
    for repeat in (1, 2, 3):
        for name, other in (("x", "g"), ("g", "x")):
            got = copies.where((F.col("feature") == name) & (F.col("repeat") == repeat)).collect()
            assert sorted(str(r[name]) for r in got) == sorted(str(r[name]) for r in plain.values())
            assert all(r[other] == plain[r["id"]][other] and r["y"] == plain[r["id"]]["y"] for r in got)
            moved += sum(r["x"] != plain[r["id"]]["x"] for r in got)
    assert moved > 800


def test_importance_and_attribution(labelled):
    fitted = models.fit(labelled, "y", ["x", "z"], ["g"], models.LOGISTIC)
    drops = {r["feature"]: r for r in explain.permutation_importance(fitted, labelled, "y", "id", 4).collect()}
    assert set(drops) == {"x", "z", "g"}
    assert drops["x"]["importance_mean"] > 0.1 > abs(drops["z"]["importance_mean"])
    whole = explain.linear_attribution(fitted, labelled, labelled, "id", None, None)
    got = {r["feature_transformada"]: r["mean_abs_shap"] for r in whole.collect()}
    slots = np.array([r[0] for r in fitted.model.transform(labelled).select(vector_to_array("features")).collect()])
    beta = fitted.model.stages[-1].coefficients.toArray()
    expected = np.abs(beta * (slots - slots.mean(axis=0))).mean(axis=0)
    assert [got[s] for s in slot_names(fitted.slots)] == pytest.approx(list(expected))
    rolled = {r["feature_original"]: r["mean_abs_shap"] for r in explain.importance_rollup(whole).collect()}
    assert rolled["g"] == pytest.approx(sum(v for k, v in got.items() if k.startswith("cat__g_")))
    few = explain.linear_attribution(fitted, labelled, labelled, "id", 20, 10)
    assert few.count() == fitted.slots.count()


def test_sampled_attribution_agrees_with_exact_orders(labelled):
    """Two features have two orders, so the exact values are known."""
    fitted = models.fit(labelled, "y", ["x", "z"], [], models.LOGISTIC)
    row, base = labelled.where("id = 5"), labelled.where("id = 6")
    got = explain.sampled_attribution(fitted, row, base, "id", orders=400)
    found = {r["feature_original"]: r["mean_abs_shap"] for r in got.collect()}

    def p(x_from, z_from):
        x, z = x_from.first()["x"], z_from.first()["z"]
        probe = labelled.sparkSession.createDataFrame([(x, z)], "x double, z double")
        return fitted.model.transform(probe).select(vector_to_array("probability")[1]).first()[0]

    own, none, x_only, z_only = p(row, row), p(base, base), p(row, base), p(base, row)
    assert found["x"] == pytest.approx(abs((x_only - none + own - z_only) / 2), rel=0.1, abs=5e-3)
    assert found["z"] == pytest.approx(abs((z_only - none + own - x_only) / 2), rel=0.1, abs=5e-3)


def test_source_of(spark):
    slots = ["num__pib", "cat__sigla_uf_PE", "cat__sigla_x", "odd"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(slots)], "i int, slot string")
    got = df.orderBy("i").select(explain.source_of("slot", ["pib", "sigla", "sigla_uf"])).collect()
    assert [r[0] for r in got] == ["pib", "sigla_uf", "sigla", "odd"]


def plain_deal(groups, k):
    """One group after the other into the fold that it leaves most even."""
    rows, ones = max(1, sum(s for s, _ in groups)), max(1, sum(p for _, p in groups))
    sizes, positives, out = [0] * k, [0] * k, []
    for s, p in groups:
        f = min(range(k), key=lambda f: (sizes[f] * s * ones**2 + positives[f] * p * rows**2, f))
        sizes[f] += s
        positives[f] += p
        out.append(f)
    return out, sizes, positives


def test_groups_are_dealt_as_one_by_one():
    rng = random.Random(2)
    for _ in range(50):
        groups = sorted(((rng.randrange(1, 9), 0) for _ in range(rng.randrange(1, 60))), reverse=True)
        groups = sorted([(s, rng.randrange(s + 1)) for s, _ in groups] + [(40, 3)] * rng.randrange(3), reverse=True)
        k = rng.randrange(2, 6)
        folds, _, _ = plain_deal(groups, k)
        kinds = sorted(set(groups), reverse=True)
        got = sampling.deal([(s, p, groups.count((s, p))) for s, p in kinds], k)
        want = [[sum(g == kind and f == j for g, f in zip(groups, folds)) for j in range(k)] for kind in kinds]
        assert got == want


def test_a_large_group_leaves_the_other_folds_even(spark):
    rng = random.Random(4)
    rows = [("big", int(rng.random() < 0.3)) for _ in range(3000)]
    rows += [(f"g{rng.randrange(900)}", int(rng.random() < 0.3)) for _ in range(6000)] + [(None, 1)] * 20
    df = spark.createDataFrame([(i, g, y) for i, (g, y) in enumerate(rows)], "id int, g string, y int")
    folded = staged(sampling.stratified_group_folds(df, "g", "y", 4))
    assert folded.count() == len(rows) and folded.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("g is not null and n > 1").count() == 0
    folds = folded.where("g is not null").groupBy("fold").agg(F.count("*").alias("n"), F.avg("y").alias("rate"), F.count_if(F.col("g") == "big").alias("big")).collect()
    assert {r["n"] for r in folds if r["big"]} == {3000}
    others = [r for r in folds if not r["big"]]
    assert max(r["n"] for r in others) - min(r["n"] for r in others) <= 10
    assert max(r["rate"] for r in others) - min(r["rate"] for r in others) < 0.01


def test_size_classes(spark):
    numbers = [0, 1, 2, 127, 128, 129, 255, 256, 10**6, 2**40 + 12345]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in numbers], "n long").select(sampling.size_class(F.col("n"))).collect()]
    assert got == [n if n < 128 else n >> (n.bit_length() - 7) << (n.bit_length() - 7) for n in numbers]


def plain_shapley(leaves, x):
    """Shapley values of all slots by the sum over all sets, of the game that a leaf table describes."""
    slots = sorted({s for leaf in leaves for s in leaf["slots"]})

    def worth(known):
        total = 0.0
        for leaf in leaves:
            part = leaf["value"]
            for s, low, high, share in zip(leaf["slots"], leaf["lows"], leaf["highs"], leaf["shares"]):
                part *= (low < x[s] <= high) if s in known else share
            total += part
        return total

    out = {}
    for s in slots:
        others = [o for o in slots if o != s]
        out[s] = sum(
            math.factorial(k) * math.factorial(len(slots) - 1 - k) / math.factorial(len(slots)) * (worth({*c, s}) - worth(set(c)))
            for k in range(len(slots)) for c in itertools.combinations(others, k)
        )
    return out, worth(set())


@pytest.mark.parametrize("spec", [
    models.ModelSpec("random_forest", params={"n_estimators": 3, "max_depth": 5}),
    models.ModelSpec("hist_gradient_boosting", encoding="ordinal", weighted=False, params={"max_iter": 3, "max_leaf_nodes": 15}),
])
def test_tree_attribution_is_shapley(spark, labelled, spec, monkeypatch):
    fitted = models.fit(labelled, "y", ["x", "z"], ["g"], spec)
    scored = staged(fitted.model.transform(labelled))
    leaves = trees.leaf_paths(fitted.model.stages[-1]).collect()
    gains, base = trees.tree_attribution(fitted.model.stages[-1], scored, "id")
    got = {}
    for r in gains.collect():
        got.setdefault(r["id"], {})[r["slot"]] = r["gain"]
    rows = scored.select("id", vector_to_array("features").alias("f"), "probability", "rawPrediction").collect()
    for r in rows[:25]:
        want, none = plain_shapley(leaves, r["f"])
        assert got[r["id"]] == pytest.approx(want, abs=1e-9) and none == pytest.approx(base)
    for r in rows:
        score = r["probability"][1] if spec.name == "random_forest" else 2 * r["rawPrediction"][1]
        assert sum(got[r["id"]].values()) == pytest.approx(score - base, abs=1e-9)
    # In several passes over the rows, the same.
    monkeypatch.setattr(trees, "LEAVES", 10)
    again, _ = trees.tree_attribution(fitted.model.stages[-1], scored, "id")
    assert {(r["id"], r["slot"]): round(r["gain"], 9) for r in again.collect()} == {
        (i, s): round(v, 9) for i, own in got.items() for s, v in own.items()
    }
    told = {r["feature_transformada"]: r["mean_abs_shap"] for r in trees.mean_attribution(gains, fitted.slots).collect()}
    names = slot_names(fitted.slots)
    assert told == pytest.approx({names[s]: np.mean([abs(g[s]) for g in got.values()]) for s in next(iter(got.values()))})


def test_an_ensemble_without_splits_has_no_gains(spark, labelled):
    fitted = models.fit(labelled.where("y = 1"), "y", ["x"], [], models.ModelSpec("random_forest", params={"n_estimators": 2}))
    gains, base = trees.tree_attribution(fitted.model.stages[-1], fitted.model.transform(labelled), "id")
    assert gains.count() == 0 and base == 1.0


def test_folds_are_measured_once(spark, monkeypatch):
    calls, fit_preparation = [], models.fit_preparation
    monkeypatch.setattr(models, "fit_preparation", lambda *a: calls.append(1) or fit_preparation(*a))
    rows = [(i % 4, i % 3 % 2, float(i % 7), "ab"[i % 2]) for i in range(80)]
    folded = spark.createDataFrame(rows, "fold int, y int, x double, g string")
    specs = [models.LOGISTIC, models.ModelSpec("logistic_regression"), models.ModelSpec("logistic_regression", encoding="ordinal")]
    models.cross_predictions(folded, "y", ["x"], ["g"], [(str(i), s, {"max_iter": 2}) for i, s in enumerate(specs)], folds=[0, 1])
    assert len(calls) == 2


def test_model_cv_compares_the_whole_models(spark, monkeypatch):
    """Every fold gets the library's full ensembles. Only what is asked for is looked at: a short fit stands in for each."""
    asked, own = [], models.Prepared.fit

    def short(self, spec, params=None):
        asked.append(spec.estimator(params or {}, self.rows))
        return own(self, models.LOGISTIC, {"max_iter": 2})

    monkeypatch.setattr(models.Prepared, "fit", short)
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 9 + 1).cast("int")).alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("src"), F.col("id") % 20).alias("source"), (F.col("id") % 9 * 5 + 5).alias("n_chars"),
    )
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 7 % 2).cast("int").alias("quality"))
    table = QUERIES["model_cv"].run(SimpleNamespace(spark=spark, documents=docs, labels=labels))
    assert table.count() == 3 and len(asked) == 3 * 4
    forests = [e for e in asked if e.hasParam("numTrees")]
    boosted = [e for e in asked if e.hasParam("stepSize")]
    assert [(e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode()) for e in forests] == [(400, models.DEEPEST, 1)] * 4
    assert [(e.getMaxIter(), e.getStepSize(), e.getMaxDepth()) for e in boosted] == [(250, 0.08, 5)] * 4
    assert {e.getSubsamplingRate() for e in forests + boosted} == {1.0}


def test_forests_are_fitted_within_their_rows(labelled, monkeypatch):
    """Forests of many rows are fitted one at a time and over several tasks; every row is scored once by each candidate."""
    now, most, tasks, own = set(), [], [], models.Prepared.fit

    def fit(self, spec, params=None):
        if spec.name == "random_forest":
            now.add(id(self))
            most.append(len(now))
            tasks.append(self.vectors.rdd.getNumPartitions())
        out = own(self, spec, params)
        now.discard(id(self))
        return out

    monkeypatch.setattr(models.Prepared, "fit", fit)
    monkeypatch.setattr(models, "FOREST_ROWS", 300)
    monkeypatch.setattr(models, "FOREST_TASK_ROWS", 100)
    folded = labelled.withColumn("fold", F.col("id") % 2)
    small = {"n_estimators": 3, "max_depth": 2}
    candidates = [("a", models.FOREST, small), ("b", models.LOGISTIC, {"max_iter": 2}), ("c", models.FOREST, {**small, "max_features": "log2"})]
    scores = models.cross_predictions(folded, "y", ["x", "z"], ["g"], candidates, folds=[0, 1])
    assert most == [1] * 4 and tasks == [2, 2, 3, 3]
    got = {(r["modelo"], r["fold"]): (r["n"], r["ones"]) for r in scores.groupBy("modelo", "fold").agg(F.count("score").alias("n"), F.sum("y_real").alias("ones")).collect()}
    sides = {r["fold"]: (r["n"], r["ones"]) for r in folded.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).collect()}
    assert got == {(m, k): sides[k] for m in "abc" for k in (0, 1)}
