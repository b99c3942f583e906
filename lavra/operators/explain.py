"""Permutation importance, additive attribution, and roll-ups to source features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions.text import quoted
from lavra.operators.evaluate import ranking_metrics
from lavra.operators.models import SEED, Fitted, predict
from lavra.operators.ranking import key_hash, row_position
from lavra.operators.sampling import sample_exact
from lavra.session import staged


def permuted(rows: DataFrame, features: Sequence[str], row_id: str, repeats: int = 10, seed: int | str = SEED) -> DataFrame:
    """Copies of the table, one per (feature, repeat), in which that feature is permuted.

    In each repeat the rows stand in one ring, in the order of a hash of their id; a row takes the value of the
    next row and the last that of the first, so no row keeps its own unless it is alone. Places are
    numbered by ranges of the hash and neighbours meet in a join on the place, so the result depends on the ids and the seed
    only. All features of a repeat share this order. Each feature keeps exactly its own set of values.
    """
    tries = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    copies = rows.select(*[quoted(c) for c in rows.columns], tries)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("repeat").cast("string"), F.col(quoted(row_id)).cast("string")))
    placed = staged(row_position(copies, [(F.col("repeat"), False)], order, "_place"), "ring")
    many = F.lit(placed.count() // repeats)
    # Whoever stands before a row takes its values; the first row's go to the last.
    before = F.when((F.col("_place") - 1) % many == 0, F.col("_place") + many - 1).otherwise(F.col("_place") - 1)
    donors = placed.select(before.alias("_place"), F.struct(*[quoted(c) for c in features]).alias("_donor"))
    swapped = placed.join(donors, "_place").withColumn("feature", F.explode(F.array(*[F.lit(c) for c in features])))
    others = [c for c in rows.columns if c not in features]
    return swapped.select(
        *[quoted(c) for c in others],
        *[
            F.when(F.col("feature") == c, F.col(f"_donor.{quoted(c)}")).otherwise(F.col(quoted(c))).alias(c)
            for c in features
        ],
        "feature",
        "repeat",
    )


def permutation_importance(
    fitted: Fitted, rows: DataFrame, label: str, row_id: str, repeats: int = 10, seed: int | str = SEED,
) -> DataFrame:
    """Mean and population deviation of the drop in average precision, per feature."""
    features = fitted.numeric + fitted.categorical
    # Written once: the metrics read the scores for their ranges and again for their sums.
    scored = staged(predict(fitted, permuted(rows, features, row_id, repeats, seed), label, ["feature", "repeat"]), "permuted")
    plain = ranking_metrics(predict(fitted, rows, label), "y_real", "score").first()["pr_auc"]
    drops = ranking_metrics(scored, "y_real", "score", ["feature", "repeat"])
    return drops.groupBy("feature").agg(
        F.avg(F.lit(plain) - F.col("pr_auc")).alias("importance_mean"),
        F.stddev_pop(F.lit(plain) - F.col("pr_auc")).alias("importance_std"),
    )


def source_of(slot: str, features: Sequence[str]) -> Column:
    """Source feature of a slot name: the same name, else the longest ``<feature>_`` prefix, else the name."""
    name = F.regexp_replace(F.col(slot), "^.*?__", "")
    found = name
    # Longer names are asked first.
    for f in sorted(features, key=len):
        found = F.when(F.startswith(name, F.lit(f + "_")), F.lit(f)).otherwise(found)
    return F.when(name.isin(list(features)), name).otherwise(found)


def linear_attribution(
    fitted: Fitted, rows: DataFrame, background: DataFrame, row_id: str,
    explain: int | None = None, against: int | None = None, seed: int = SEED,
) -> DataFrame:
    """Mean absolute contribution (log-odds) of every slot of a linear model.

    A contribution is the coefficient times the distance from the background mean, which is the
    exact additive attribution of a linear model. All rows count, unless ``explain`` and ``against``
    ask for samples of them.
    """
    classifier = fitted.model.stages[-1]
    if not hasattr(classifier, "coefficients"):
        raise TypeError("closed-form attribution needs a linear model")
    some = rows if explain is None else sample_exact(rows, explain, [row_id], seed)
    base = background if against is None else sample_exact(background, against, [row_id], 7)

    def slots_of(df: DataFrame) -> DataFrame:
        array = vector_to_array("features")
        return fitted.model.transform(df).select(F.posexplode(array).alias("slot", "x"))

    # One row per slot of the feature vector: the model's own coefficients.
    weights = rows.sparkSession.createDataFrame(
        list(enumerate(fitted.model.stages[-1].coefficients.toArray().tolist())), "slot int, weight double"
    )
    names = fitted.slots.withColumnsRenamed({"name": "feature_transformada", "source": "feature_original"})
    means = slots_of(base).groupBy("slot").agg(F.avg("x").alias("mean"))
    gains = slots_of(some).join(weights.join(means, "slot"), "slot").groupBy("slot").agg(
        F.avg(F.abs(F.col("weight") * (F.col("x") - F.col("mean")))).alias("mean_abs_shap")
    )
    return gains.join(names, "slot").select("feature_transformada", "feature_original", "mean_abs_shap")


def sampled_attribution(
    fitted: Fitted, rows: DataFrame, background: DataFrame, row_id: str,
    explain: int | None = None, against: int | None = None, orders: int = 10, seed: int = SEED,
) -> DataFrame:
    """Mean absolute contribution of every source feature to the probability, for any model.

    Shapley values by sampled feature orders: a row starts as a background row and takes on its own
    values one feature at a time; the change of the probability at a step goes to that feature. All
    rows are explained, and drawn from as background, unless ``explain`` and ``against`` ask for samples.
    Contributions are averaged over orders, then their absolute values over rows. All steps of all
    rows are scored as one table.
    """
    features = fitted.numeric + fitted.categorical
    values = F.struct(*[quoted(c) for c in features])
    some = rows if explain is None else sample_exact(rows, explain, [row_id], seed)
    base = background if against is None else sample_exact(background, against, [row_id], 7)
    base = staged(base.select(row_id, values.alias("_base")), "background")
    placed = row_position(base, [], key_hash([row_id], "background"), "_place")
    numbered = placed.select((F.col("_place") - 1).alias("_n"), "_base")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string"), F.col("_order").cast("string")))
    drawn = some.select(row_id, values.alias("_own"), F.explode(F.sequence(F.lit(1), F.lit(orders))).alias("_order"))
    drawn = drawn.withColumn("_n", F.pmod(F.conv(F.substring(place, 1, 12), 16, 10).cast("long"), F.lit(base.count())))
    turns = F.sort_array(
        F.array(*[F.struct(F.md5(F.concat(place, F.lit(c))).alias("h"), F.lit(c).alias("name")) for c in features])
    )
    steps = (
        drawn.join(numbered, "_n")
        .withColumn("_turns", turns["name"])
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    )
    mixed = steps.select(
        row_id, "_order", "_step",
        F.when(F.col("_step") > 0, F.try_element_at("_turns", F.greatest("_step", F.lit(1)))).alias("feature_original"),
        *[
            F.when(F.array_position("_turns", F.lit(c)) <= F.col("_step"), F.col(f"_own.{quoted(c)}"))
            .otherwise(F.col(f"_base.{quoted(c)}"))
            .alias(c)
            for c in features
        ],
    )
    path = W.partitionBy(row_id, "_order").orderBy("_step")
    score = vector_to_array("probability")[1]
    gains = fitted.model.transform(mixed).select(row_id, "_order", "_step", "feature_original", score.alias("p"))
    gains = gains.withColumn("gain", F.col("p") - F.lag("p").over(path)).where("_step > 0")
    return (
        gains.groupBy(row_id, "feature_original")
        .agg(F.avg("gain").alias("gain"))
        .groupBy("feature_original")
        .agg(F.avg(F.abs("gain")).alias("mean_abs_shap"))
    )


def importance_rollup(importance: DataFrame, source: str = "feature_original", value: str = "mean_abs_shap") -> DataFrame:
    """Importance of encoded slots summed per source feature."""
    return importance.groupBy(source).agg(F.sum(value).alias(value))


