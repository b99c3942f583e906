"""Binary metrics, curves and comparisons, for one scored table or many at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.operators.aggregate import mean_and_std
from lavra.operators.ranking import running_sums, value_ranges
from lavra.session import shuffle_width, staged

METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


ONE = "_all"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without groups, all rows form one."""
    return (df, list(by)) if by else (df.withColumn(ONE, F.lit(0)), [ONE])


def _ungrouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.drop(ONE)


def score_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), predicted: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score: what the curves need, already summed.

    With ``predicted``, also how many of each were predicted positive.
    """
    y = F.col(label)
    sums = [F.count_if(y == 1).alias("tp"), F.count_if(y == 0).alias("fp")]
    if predicted is not None:
        hit = F.col(predicted) == 1
        sums += [F.count_if((y == 1) & hit).alias("hit_pos"), F.count_if((y == 0) & hit).alias("hit_neg")]
    return df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(*sums)


def _cumulated(
    df: DataFrame, label: str, score: str, by: Sequence[str], buckets: int | None, predicted: str | None = None
) -> DataFrame:
    """Score counts with running totals from the highest score down.

    The ranges are cut on the rows themselves, which needs no shuffle; a range then holds at most
    its share of the distinct scores.
    """
    ranges = value_ranges(df.select(F.col(score).cast("double").alias("_v")), "_v", buckets or shuffle_width(df.sparkSession))
    # Written once: its totals by range and its running sums both start from it.
    counts = staged(score_counts(df, label, score, by, predicted), "scores")
    return running_sums(counts, "score", ["tp", "fp"], by, ranges=ranges)


def curve_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Per distinct score as threshold: counts, true and false positive rates, precision."""
    rows, keys = _grouped(df, by)
    points = staged(_cumulated(rows, label, score, keys, buckets), "curve")
    # The class totals are the last of the running sums.
    sides = points.groupBy(*keys).agg(F.max("cum_tp").alias("_p"), F.max("cum_fp").alias("_n"))
    curve = points.join(sides, keys).select(
        *keys,
        F.col("score").alias("threshold"),
        F.col("cum_tp").alias("tp"),
        F.col("cum_fp").alias("fp"),
        F.try_divide(F.col("cum_tp").cast("double"), "_p").alias("tpr"),
        F.try_divide(F.col("cum_fp").cast("double"), "_n").alias("fpr"),
        F.try_divide(F.col("cum_tp").cast("double"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
    )
    return _ungrouped(curve, by)


def confusion(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label, predicted).agg(F.count("*").alias("n"))


def _curve_sums() -> list[Column]:
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    seen = F.col("cum_tp") + F.col("cum_fp")
    return [
        F.sum(tp).alias("_p"),
        F.sum(fp).alias("_n"),
        F.sum(fp * (F.col("cum_tp") - tp / 2)).alias("_area"),
        F.sum(tp * F.try_divide(F.col("cum_tp").cast("double"), seen)).alias("_steps"),
    ]


def _curve_metrics() -> list[Column]:
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return [
        F.when(both, F.try_divide("_area", F.col("_p") * F.col("_n"))).alias("roc_auc"),
        F.when(both, F.try_divide("_steps", "_p")).alias("pr_auc"),
    ]


def ranking_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step-wise sum), exact.

    Null where only one class is present.
    """
    rows, keys = _grouped(df, by)
    sums = _cumulated(rows, label, score, keys, buckets).groupBy(*keys).agg(*_curve_sums())
    return _ungrouped(sums.select(*keys, *_curve_metrics()), by)


def binary_metrics(
    df: DataFrame, label: str, score: str, predicted: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """All seven metrics per group. Precision, recall and F1 are 0 where they are undefined.

    The rows are summed once per distinct score; every metric comes from those sums.
    """
    rows, keys = _grouped(df, by)
    sums = _cumulated(rows, label, score, keys, buckets, predicted).groupBy(*keys).agg(
        *_curve_sums(),
        F.sum("hit_pos").cast("double").alias("_tp"),
        F.sum("hit_neg").cast("double").alias("_fp"),
    )
    tp, fp, p, n = (F.col(c) for c in ("_tp", "_fp", "_p", "_n"))
    zero = F.lit(0.0)
    recall = F.try_divide(tp, p)
    # With a single true class, the balanced accuracy is the recall of that class.
    specificity = F.try_divide(n - fp, n)
    balanced = F.coalesce((recall + specificity) / 2, recall, specificity)
    metrics = sums.select(
        *keys,
        F.try_divide(tp + n - fp, p + n).alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(recall, zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, tp + fp + p), zero).alias("f1"),
        *_curve_metrics(),
    )
    return _ungrouped(metrics, by)


def metrics_long(metrics: DataFrame, value: str, names: Sequence[str] = METRICS) -> DataFrame:
    return metrics.select(*names).unpivot([], list(names), "metrica", value)


def mean_over_folds(scores: DataFrame, fold: str = "fold", model: str = "modelo", label: str = "y", score: str = "score", predicted: str = "pred") -> DataFrame:
    """Mean and deviation over folds of all metrics, per model."""
    return mean_and_std(binary_metrics(scores, label, score, predicted, [model, fold]), [model], METRICS)


def compare_metrics(
    baseline: DataFrame, variant: DataFrame, base_name: str = "base", variant_name: str = "variant"
) -> DataFrame:
    """Metric by metric: base, variant, difference, and difference in percent (null for base 0)."""
    both = metrics_long(baseline, base_name).join(F.broadcast(metrics_long(variant, variant_name)), "metrica")
    delta = F.col(variant_name) - F.col(base_name)
    return both.select(
        "metrica",
        base_name,
        variant_name,
        delta.alias("delta_absoluto"),
        F.try_divide(100.0 * delta, F.col(base_name)).alias("delta_percentual"),
    )


def verdict(
    comparison: DataFrame, texts: Mapping[str, str], limit: float = 0.02
) -> DataFrame:
    """Differences of the decisive metrics and the verdict: small when both curve metrics moved
    by less than ``limit``. ``texts`` holds the wording for ``small`` and ``large``."""
    def of(metric):
        return F.max(F.when(F.col("metrica") == metric, F.col("delta_absoluto")))

    row = comparison.agg(
        of("pr_auc").alias("delta_pr_auc"),
        of("roc_auc").alias("delta_roc_auc"),
        of("balanced_accuracy").alias("delta_balanced_accuracy"),
    )
    small = (F.abs("delta_pr_auc") < limit) & (F.abs("delta_roc_auc") < limit)
    return row.withColumn("interpretacao", F.when(small, texts["small"]).otherwise(texts["large"]))
