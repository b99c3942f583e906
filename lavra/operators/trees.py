"""Exact additive attribution of tree ensembles, from their structure.

An ensemble is a table of leaf paths: for each leaf its value and, for every slot that its path asks about, the
interval that leads there and the share of the training rows that pass the slot's conditions. With the rows' own conditions
met for the slots of a set and the shares for all others, a leaf is reached with the product of both; the Shapley value of a slot in that game is

    value * (met - share) * integral over t in [0, 1] of prod over the other slots of ((1 - t) * share + t * met)

A path of ``m`` slots is a polynomial of degree ``m - 1`` in ``t``, so Gauss-Legendre quadrature with ``ceil(m / 2)`` points is
exact. Gains of all slots add up to the row's score minus the base (the value that no slot is known for).

Spark has no such function, so the sums over leaves run in numpy on Arrow batches; rows never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import quoted
from lavra.session import scratch_path, staged

# Leaves whose paths are sent to the tasks at once; a larger ensemble goes in several passes over the rows.
LEAVES = 50_000
PATHS = "tree int, value double, slots array<int>, lows array<double>, highs array<double>, shares array<double>"


def _paths_of(regression: bool):
    """Leaf paths of one tree from its nodes."""

    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        at = {n.id: n for n in nodes.itertuples()}

        def cover(n) -> float:
            return float(n.stats[0] if regression else sum(n.stats))

        rows, todo = [], [(at[0], {})]
        while todo:
            node, path = todo.pop()
            if node.left < 0:
                value = node.prediction if regression else node.stats[1] / sum(node.stats)
                cells = [(s, *c) for s, c in sorted(path.items())]
                rows.append((node.tree, value, *([c[k] for c in cells] for k in range(4))))
                continue
            if node.categories >= 0:
                raise ValueError("attribution needs numeric splits")
            low, high, share = path.get(node.slot, (-np.inf, np.inf, 1.0))
            for child, interval in ((node.left, (low, min(high, node.threshold))), (node.right, (max(low, node.threshold), high))):
                part = cover(at[child]) / cover(node)
                todo.append((at[child], {**path, node.slot: (*interval, share * part)}))
        return pd.DataFrame(rows, columns=["tree", "value", "slots", "lows", "highs", "shares"])

    return run


def leaf_paths(model) -> DataFrame:
    """``tree, value, slots, lows, highs, shares`` of a fitted forest (probabilities) or boosted ensemble (log-odds).

    A row is at a leaf when each slot's value is above ``low`` and at most ``high``. Values are weighted as
    the ensemble weighs its trees. Shares come from the weighted training rows of each node.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    regression = "GBT" in type(model).__name__
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("slot"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), n["split"]["numCategories"].alias("categories"),
    )
    weights = model.treeWeights
    # Boosted margins count twice in the log-odds; a forest's trees are averaged.
    scale = [2.0 * w for w in weights] if regression else [1.0 / len(weights)] * len(weights)
    factor = F.element_at(F.array(*map(F.lit, scale)), F.col("tree") + 1)
    paths = nodes.groupBy("tree").applyInPandas(_paths_of(regression), PATHS)
    return staged(paths.withColumn("value", F.col("value") * factor), "paths")


def _gains(columns: list[int], leaves: list[tuple]):
    """Gains of the given slots for rows of their values."""
    place = {s: k for k, s in enumerate(columns)}
    packed = []
    for value, slots, lows, highs, shares in leaves:
        t, w = np.polynomial.legendre.leggauss(max(1, -(-len(slots) // 2)))
        packed.append((value, [place[s] for s in slots], np.array(lows), np.array(highs), np.array(shares), (t + 1) / 2, w / 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, len(columns))
            out = np.zeros(x.shape)
            for value, own, low, high, share, points, weights in packed:
                met = ((x[:, own] > low) & (x[:, own] <= high)).astype(float)
                rest = np.zeros(met.shape)
                for t, w in zip(points, weights):
                    terms = (1 - t) * share + t * met
                    rest += w * terms.prod(axis=1, keepdims=True) / terms
                out[:, own] += value * (met - share) * rest
            gains = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(columns)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), gains], ["_row", "gains"])

    return run


def tree_attribution(model, rows: DataFrame, row_id: str, features: str = "features") -> tuple[DataFrame, float]:
    """``row_id, slot, gain`` of every slot the ensemble uses, for all rows with a feature vector, and the base.

    Forests are explained in probabilities of class 1, boosted ensembles in log-odds. The ids must be unique. An ensemble without splits has no gains.
    """
    paths = leaf_paths(model)
    # The base and the used slots: one number, and no more slots than the ensemble has splits.
    reach = F.aggregate("shares", F.lit(1.0), lambda a, s: a * s)
    base = paths.agg(F.sum(F.col("value") * reach)).first()[0]
    used = sorted(r[0] for r in paths.select(F.explode("slots")).distinct().collect())
    array = vector_to_array(features)
    picked = F.transform(F.array(*map(F.lit, used)).cast("array<int>"), lambda s: F.get(array, s))
    asked = staged(rows.select(F.col(quoted(row_id)).alias("_row"), picked.alias("_x")), "asked")
    schema = T.StructType([asked.schema["_row"], T.StructField("gains", T.ArrayType(T.DoubleType()))])
    parts, many = None, paths.count()
    numbered = paths.where(F.size("slots") > 0).withColumn("_block", F.pmod(F.xxhash64("tree"), F.lit(-(-many // LEAVES))))
    for block in range(-(-many // LEAVES)):
        leaves = [tuple(r) for r in numbered.where(F.col("_block") == block).select("value", "slots", "lows", "highs", "shares").collect()]
        if leaves:
            gains = asked.mapInArrow(_gains(used, leaves), schema)
            parts = gains if parts is None else parts.unionByName(gains)
    if parts is None:
        return rows.select(row_id, F.lit(0).alias("slot"), F.lit(0.0).alias("gain")).where(F.lit(False)), base
    slots = F.element_at(F.array(*map(F.lit, used)), F.col("pos") + 1)
    told = parts.select("_row", F.posexplode("gains").alias("pos", "gain"))
    if many > LEAVES:
        told = told.groupBy("_row", "pos").agg(F.sum("gain").alias("gain"))
    return told.select(F.col("_row").alias(row_id), slots.alias("slot"), "gain"), base


def mean_attribution(gains: DataFrame, slots: DataFrame) -> DataFrame:
    """Mean absolute gain of every slot the ensemble uses, with the slot's name and source feature."""
    means = gains.groupBy("slot").agg(F.avg(F.abs("gain")).alias("mean_abs_shap"))
    named = slots.withColumnsRenamed({"name": "feature_transformada", "source": "feature_original"})
    return means.join(named, "slot").select("feature_transformada", "feature_original", "mean_abs_shap")
