"""Unions, distinct rows, first rows per key, wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions.numbers import year_in
from lavra.functions.text import quoted
from lavra.session import staged


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_union(frames: Sequence[DataFrame], key: Column, name: str) -> DataFrame:
    """Distinct non-null keys of several tables. No key at all is an error.

    The keys are written once: whoever filters by them first measures them and then joins them.
    """
    keys = reduce(lambda a, b: a.unionByName(b), [f.select(key.alias(name)) for f in frames])
    distinct = staged(keys.where(F.col(name).isNotNull()).distinct(), "keys")
    if not distinct.take(1):
        raise ValueError(f"no {name} in any table")
    return distinct


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by ``order`` (all columns break remaining ties).

    Spark limits every task to one row per key before the shuffle, so hot keys are harmless.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    first = W.partitionBy(*key).orderBy(*order, *[quoted(c) for c in rest])
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def melt(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], label: str, value: str
) -> DataFrame:
    """Wide to long over those of the named columns that exist."""
    ids = [c for c in ids if c in df.columns]
    measures = [c for c in measures if c in df.columns]
    return df.unpivot(ids, measures, label, value)


def melt_years(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], value: str, year: str = "ano"
) -> DataFrame:
    """Wide to long, the label replaced by the year found in it."""
    long = melt(df, ids, measures, "_label", value)
    return long.withColumn(year, year_in(F.col("_label"))).drop("_label")


def first_of_category(category: str, value: str, columns: Mapping[str, str], order: str) -> list[Column]:
    """Aggregates: per known category, the first non-null value by ``order``."""
    return [
        F.min_by(
            F.col(value), F.when((F.col(category) == name) & F.col(value).isNotNull(), F.col(order))
        ).alias(out)
        for name, out in columns.items()
    ]


def pivot_first(
    df: DataFrame,
    key: Sequence[str],
    category: str,
    value: str,
    columns: Mapping[str, str],
    order: str,
) -> DataFrame:
    """Long to wide in one aggregate; ``columns`` maps the known categories to output names."""
    return df.groupBy(*key).agg(*first_of_category(category, value, columns, order))
