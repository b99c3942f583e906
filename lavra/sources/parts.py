"""One table out of many parts with differing columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import quoted


def filled_columns(df: DataFrame) -> list[str]:
    """Columns with at least one value, found in one pass."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[f"n{i}"]]


def union_parts(parts: Mapping[str, DataFrame], tag: str = "_part") -> DataFrame:
    """All parts by column name, each row tagged with its part.

    Rows without any value are dropped, then per part the columns without any value, then parts
    that are left empty. Columns a part lacks are null. No readable part at all is an error.
    """
    frames = []
    for name, part in parts.items():
        rows = part.na.drop("all")
        columns = filled_columns(rows)
        if columns:
            frames.append(rows.select(F.lit(name).alias(tag), *[quoted(c) for c in columns]))
    if not frames:
        raise ValueError("no readable part: every part is empty")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
