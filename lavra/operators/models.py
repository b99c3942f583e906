"""Classifiers, cross-validation, random search, predictions and run metadata."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lavra.operators.evaluate import binary_metrics, mean_over_folds
from lavra.operators.features import assemble, balanced_weight, class_counts, fit_preparation
from lavra.session import scratch_path, staged

SEED = 42

# Spark's trees stop at this depth; an unlimited one is asked for as this.
DEEPEST = 30

# Training rows that are worth a task: a pass over them works on all trees of a forest, and else on one tree or the coefficients.
FOREST_TASK_ROWS, TASK_ROWS = 10_000, 100_000

# Training rows of the forests that are fitted at once; each row holds a count and a node for each of the trees.
FOREST_ROWS = 100_000

# Leaf counts of leaf-wise trees and the depth that gives about as many leaves.
DEPTH_FOR_LEAVES = {15: 4, 31: 5, 63: 6}


@dataclass(frozen=True)
class ModelSpec:
    """A kind of classifier with the feature flavour it wants."""

    name: str
    scale: bool = False
    encoding: str = "onehot"
    weighted: bool = True
    params: Mapping[str, object] = field(default_factory=dict)

    def estimator(self, params: Mapping[str, object], rows: int) -> Estimator:
        p = {**self.params, **params}
        common = {"featuresCol": "features", "labelCol": "label"}
        if self.weighted:
            common["weightCol"] = "weight"
        if self.name == "logistic_regression":
            # The penalty is per unit of weight here; balanced weights sum to the row count.
            return LogisticRegression(
                **common, maxIter=p.get("max_iter", 3000), regParam=1.0 / (p.get("C", 1.0) * rows),
                elasticNetParam=0.0, standardization=False, tol=1e-6,
            )
        if self.name == "random_forest":
            return RandomForestClassifier(
                **common, numTrees=p.get("n_estimators", 400), seed=SEED,
                maxDepth=p.get("max_depth") or DEEPEST,
                minInstancesPerNode=p.get("min_samples_leaf", 1),
                featureSubsetStrategy=str(p.get("max_features", "sqrt")),
                # Rows keep the node that they are at in each tree; without, all trees are sent out and walked again for every level.
                cacheNodeIds=True,
            )
        if self.name == "hist_gradient_boosting":
            return GBTClassifier(
                **common, stepSize=p.get("learning_rate", 0.08), maxIter=p.get("max_iter", 250),
                maxDepth=DEPTH_FOR_LEAVES[p.get("max_leaf_nodes", 31)], seed=SEED,
                minInstancesPerNode=p.get("min_samples_leaf", 20),
            )
        raise ValueError(f"unknown model: {self.name}")


LOGISTIC = ModelSpec("logistic_regression", scale=True)
FOREST = ModelSpec("random_forest")
BOOSTING = ModelSpec("hist_gradient_boosting", encoding="ordinal", weighted=False)
MODELS = (LOGISTIC, FOREST, BOOSTING)

# The search grids. Boosting has no L2 term here, so that axis is left out.
GRIDS = {
    "logistic_regression": {"C": [10 ** (-2 + 3 * i / 19) for i in range(20)]},
    "random_forest": {
        "n_estimators": [300, 400, 500, 700],
        "max_depth": [None, 8, 12, 18, 25],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": ["sqrt", "log2", 0.5],
    },
    "hist_gradient_boosting": {
        "learning_rate": [0.03, 0.05, 0.08, 0.10],
        "max_leaf_nodes": [15, 31, 63],
        "max_iter": [150, 250, 350],
    },
}


@dataclass
class Prepared:
    """Fitted preparation and the training vectors, written once: solvers read them many times."""

    stages: PipelineModel
    slots: DataFrame
    vectors: DataFrame
    rows: int
    numeric: list[str]
    categorical: list[str]

    def fit(self, spec: ModelSpec, params: Mapping[str, object] | None = None) -> Fitted:
        params = dict(params or {})
        classifier = spec.estimator(params, self.rows).fit(self.vectors)
        model = PipelineModel([*self.stages.stages, classifier])
        return Fitted(model, self.slots, self.numeric, self.categorical, spec, params)


@dataclass
class Fitted:
    model: PipelineModel
    slots: DataFrame
    numeric: list[str]
    categorical: list[str]
    spec: ModelSpec
    params: dict


def measure(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]) -> tuple:
    """What the preparations of all kinds of models read from the training rows: class counts and fitted values."""
    return class_counts(train, label), fit_preparation(train, numeric, categorical)


def prepare(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], spec: ModelSpec, measured: tuple | None = None
) -> Prepared:
    """Fit the preparation that a kind of model wants on the training rows, or on what was measured of them before."""
    (negatives, positives), fitted = measured or measure(train, label, numeric, categorical)
    stages, slots = assemble(train.sparkSession, fitted, spec.scale, spec.encoding)
    vectors = stages.transform(train).select(
        "features",
        F.col(label).cast("double").alias("label"),
        balanced_weight(label, negatives, positives).alias("weight"),
    )
    rows = negatives + positives
    # Each task sends sums of all nodes of a level, so there are no more of them than cores, however many rows there are.
    worth = FOREST_TASK_ROWS if spec.name == "random_forest" else TASK_ROWS
    tasks = max(1, min(train.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / worth)))
    return Prepared(stages, slots, staged(vectors.repartition(tasks), "vectors"), rows, list(numeric), list(categorical))


def fit(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], spec: ModelSpec,
    params: Mapping[str, object] | None = None,
) -> Fitted:
    return prepare(train, label, numeric, categorical, spec).fit(spec, params)


def predict(
    fitted: Fitted | PipelineModel, rows: DataFrame, label: str, keep: Sequence[str] = (),
    predicted: str = "y_pred", score: str = "score",
) -> DataFrame:
    """Audit columns, actual class, predicted class and probability of the positive class."""
    model = fitted.model if isinstance(fitted, Fitted) else fitted
    scored = model.transform(rows)
    return scored.select(
        *keep,
        F.col(label).cast("int").alias("y_real"),
        F.col("prediction").cast("int").alias(predicted),
        vector_to_array("probability")[1].alias(score),
    )


def cross_predictions(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
    candidates: Sequence[tuple[str, ModelSpec, Mapping[str, object]]], fold: str = "fold",
    folds: Sequence[int] = (0, 1, 2, 3), parallelism: int = 4,
) -> DataFrame:
    """Out-of-fold scores of every candidate (name, kind, parameters), in one long table.

    Candidates that want the same preparation share it within a fold, and all preparations of a fold what they measure. Scores are written as soon as
    a model is fitted, so that the driver does not keep the models. It waits for several folds at a time, and for forests beside them, as many as
    their rows allow; all work on rows is Spark's.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "scores")
    flavours: dict[tuple, list[int]] = {}
    for i, (_, spec, _) in enumerate(candidates):
        flavours.setdefault((spec.scale, spec.encoding), []).append(i)

    def measure_fold(k: int) -> tuple:
        return measure(df.where(F.col(fold) != k), label, numeric, categorical)

    def run(k: int, own: list[int]) -> list[str]:
        parts = []
        ready = prepare(df.where(F.col(fold) != k), label, numeric, categorical, candidates[own[0]][1], measured[k])
        for i in own:
            name, spec, params = candidates[i]
            part = predict(ready.fit(spec, params), df.where(F.col(fold) == k), label)
            parts.append(f"{path}/{k}-{i}")
            part.select(F.lit(name).alias("modelo"), F.lit(k).alias("fold"), "y_real", "y_pred", "score").write.parquet(parts[-1])
        return parts

    threaded, waiting = inheritable_thread_target(spark), max(1, min(parallelism, len(folds)))
    with ThreadPool(waiting) as pool:
        measured = dict(zip(folds, pool.map(threaded(measure_fold), folds)))
        rows = max(sum(counts) for counts, _ in measured.values())
        with ThreadPool(max(1, min(waiting, FOREST_ROWS // max(1, rows)))) as forests:
            begun = []
            for own in flavours.values():
                forest = any(candidates[i][1].name == "random_forest" for i in own)
                begun += [(forests if forest else pool).apply_async(threaded(run), (k, own)) for k in folds]
            scored = [part for parts in begun for part in parts.get()]
    return spark.read.schema("modelo string, fold int, y_real int, y_pred int, score double").parquet(*scored)


def cross_validate(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
    specs: Sequence[ModelSpec] = MODELS, fold: str = "fold", folds: Sequence[int] = (0, 1, 2, 3),
) -> DataFrame:
    """Mean and deviation over folds of all metrics per model, best average precision first."""
    scores = cross_predictions(df, label, numeric, categorical, [(s.name, s, {}) for s in specs], fold, folds)
    rolled = mean_over_folds(scores, "fold", "modelo", "y_real", "score", "y_pred")
    return rolled.orderBy(F.col("pr_auc_media").desc_nulls_last(), "modelo")


def draw_parameters(grid: Mapping[str, Sequence], draws: int = 10, seed: int = SEED) -> list[dict]:
    """Distinct seeded draws from a grid; all of it when it is not larger than that."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in product(*grid.values())]
    return combos if len(combos) <= draws else random.Random(seed).sample(combos, draws)


def random_search(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], spec: ModelSpec,
    draws: int = 10, fold: str = "fold", folds: Sequence[int] = (0, 1, 2, 3), seed: int = SEED,
) -> tuple[Fitted, DataFrame]:
    """Try drawn parameters over the folds, refit the best on all rows.

    Returns the refitted model and the mean average precision per draw.
    """
    drawn = draw_parameters(GRIDS[spec.name], draws, seed)
    candidates = [(str(i), spec, p) for i, p in enumerate(drawn)]
    scores = cross_predictions(df, label, numeric, categorical, candidates, fold, folds)
    per_fold = binary_metrics(scores, "y_real", "score", "y_pred", ["modelo", "fold"])
    results = per_fold.groupBy("modelo").agg(F.avg("pr_auc").alias("pr_auc"))
    best = results.orderBy(F.col("pr_auc").desc_nulls_last(), F.col("modelo").cast("int")).first()
    table = results.select(
        F.col("modelo").cast("int").alias("draw"),
        F.element_at(F.array(*[F.lit(str(p)) for p in drawn]), F.col("modelo").cast("int") + 1).alias("params"),
        "pr_auc",
    )
    return fit(df, label, numeric, categorical, spec, drawn[int(best["modelo"])]), table


def run_metadata(
    spark: SparkSession, fitted: Fitted, target: str, group: str, constant: Sequence[str],
    metrics: Mapping[str, float], train_rows: int, test_rows: int, seed: int = SEED, positive_class: str = "1",
) -> DataFrame:
    """One row that describes a run: model, features by type, parameters, metrics, row counts."""
    schema = (
        "best_model string, target string, group_column string, features array<string>, "
        "numeric_features array<string>, categorical_features array<string>, "
        "constant_features_removed array<string>, best_params map<string,string>, "
        "test_metrics map<string,double>, train_rows long, test_rows long, random_seed int, positive_class string"
    )
    row = (
        fitted.spec.name, target, group, fitted.numeric + fitted.categorical, fitted.numeric,
        fitted.categorical, list(constant), {k: str(v) for k, v in fitted.params.items()},
        {k: v for k, v in metrics.items() if v is not None}, train_rows, test_rows, seed, positive_class,
    )
    return spark.createDataFrame([row], schema)
