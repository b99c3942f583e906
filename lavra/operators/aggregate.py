"""Group summaries. Each is one aggregate with partial sums before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import quoted


def entity_rollup(
    df: DataFrame,
    key: Sequence[str],
    count: str,
    identity: Mapping[str, str] | None = None,
    percents: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Rows per key, identity fields, percentages of 0/1 fields and means, all in one pass.

    The maps go from source column to output name; columns the table lacks are passed over. The
    identity value is the first non-null one by ``order``, or the smallest when there is no order.
    Nulls do not count in percentages and means.
    """
    def existing(names):
        return [(c, out) for c, out in (names or {}).items() if c in df.columns]

    aggs = [F.count("*").alias(count)]
    for c, out in existing(identity):
        value = F.col(quoted(c))
        pick = F.min(value) if order is None else F.min_by(value, F.when(value.isNotNull(), F.col(order)))
        aggs.append(pick.alias(out))
    aggs += [(F.avg(quoted(c)) * 100).alias(out) for c, out in existing(percents)]
    aggs += [F.avg(quoted(c)).alias(out) for c, out in existing(means)]
    return df.groupBy(*key).agg(*aggs)


def group_summary(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str],
    means: Mapping[str, str],
    percents: Mapping[str, str] | None = None,
) -> DataFrame:
    """Distinct counts and means per group. The null group is kept; nulls do not count."""
    aggs = [F.count_distinct(quoted(c)).alias(out) for c, out in distinct.items()]
    aggs += [F.avg(quoted(c)).alias(out) for c, out in means.items()]
    aggs += [(F.avg(quoted(c)) * 100).alias(out) for c, out in (percents or {}).items()]
    return df.groupBy(*by).agg(*aggs)


def score_rollup(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    predicted: str,
    actual: str,
    names: Mapping[str, str],
    minimum: int = 5,
) -> DataFrame:
    """Per group: rows, mean score (also in percent), predicted and actual positives, eligibility.

    ``names`` gives the output names for ``rows``, ``mean``, ``predicted``, ``actual``,
    ``mean_pct`` and ``eligible``. Group columns the table lacks are passed over except the first.
    """
    groups = [by[0], *[c for c in by[1:] if c in df.columns]]
    rolled = df.groupBy(*groups).agg(
        F.count("*").alias(names["rows"]),
        F.avg(score).alias(names["mean"]),
        F.sum(predicted).alias(names["predicted"]),
        F.sum(actual).alias(names["actual"]),
    )
    return rolled.withColumns(
        {
            names["mean_pct"]: F.col(names["mean"]) * 100,
            names["eligible"]: F.col(names["rows"]) >= minimum,
        }
    )


def rate_by_category(
    df: DataFrame, by: str, target: str, rows: str = "n", rate: str = "rate", pct: str = "rate_pct",
    minimum: int | None = None,
) -> DataFrame:
    """Known targets, their mean and percent per category; with ``minimum``, only larger groups."""
    rated = df.groupBy(by).agg(F.count(target).alias(rows), F.avg(target).alias(rate))
    rated = rated.withColumn(pct, F.col(rate) * 100)
    return rated if minimum is None else rated.where(F.col(rows) >= minimum)


def value_counts(df: DataFrame, column: str, rows: str = "n", pct: str = "pct") -> DataFrame:
    """Rows per value, null included, with percent of all rows.

    The rows are counted once up front (an eager count), so the result needs no join.
    """
    total = df.count()
    counts = df.groupBy(quoted(column)).agg(F.count("*").alias(rows))
    return counts.withColumn(pct, F.try_divide(100.0 * F.col(rows), F.lit(total)))


def duplicate_rows(df: DataFrame, name: str = "duplicates") -> DataFrame:
    """How many rows repeat an earlier one."""
    copies = df.groupBy(*[quoted(c) for c in df.columns]).agg((F.count("*") - 1).alias("_extra"))
    return copies.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias(name))


def dataset_summary(df: DataFrame, target: str, names: Mapping[str, str]) -> DataFrame:
    """Rows, columns, duplicates, class counts and positive rate, in one grouping pass.

    ``names`` gives the output names for ``rows``, ``columns``, ``duplicates``, ``negatives``,
    ``positives`` and ``rate_pct``.
    """
    copies = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    y = F.col(quoted(target))

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    counted = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(names["rows"]),
        F.lit(len(df.columns)).cast("long").alias(names["columns"]),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(names["duplicates"]),
        rows_where(y == 0).alias(names["negatives"]),
        rows_where(y == 1).alias(names["positives"]),
        F.sum(y.cast("double") * F.col("_n")).alias("_sum"),
        rows_where(y.isNotNull()).alias("_known"),
    )
    rate = F.round(F.try_divide(100.0 * F.col("_sum"), F.col("_known")), 2)
    return counted.withColumn(names["rate_pct"], rate).drop("_sum", "_known")


def mean_and_std(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per group, e.g. of metrics over folds."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_media"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.groupBy(*by).agg(*aggs)


def key_value_report(
    df_counts: Mapping[str, DataFrame], constants: Mapping[str, object], key: str = "metrica", value: str = "valor"
) -> DataFrame:
    """Layer summary: a row count per table, then fixed facts, as two text columns."""
    rows = [
        df.agg(F.count("*").cast("string").alias(value)).select(F.lit(name).alias(key), value)
        for name, df in df_counts.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    facts = [(k, str(v)) for k, v in constants.items()]
    if facts:
        out = out.unionByName(out.sparkSession.createDataFrame(facts, f"{key} string, {value} string"))
    return out
