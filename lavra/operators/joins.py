"""Equi-joins that survive skewed keys and say how big a side they broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import quoted
from lavra.operators.reshape import first_per_key
from lavra.session import BROADCAST_BYTES, HOT_ROWS, hot_limit, shuffle_width, staged


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row in memory: eight bytes a field plus the length of variable fields."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(quoted(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(quoted(f.name)))), F.lit(0))
    return size


def size_of(df: DataFrame) -> int:
    """Bytes of a table in memory, by one aggregate without a shuffle."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def measured(df: DataFrame, on: Sequence[str]) -> tuple[int, int, int]:
    """Rows, bytes and the most rows of one non-null key, by one pass."""
    per_key = df.groupBy(*on).agg(F.count("*").alias("n"), F.sum(row_bytes(df)).alias("b"))
    known = F.lit(True)
    for k in on:
        known = known & F.col(quoted(k)).isNotNull()
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.when(known, F.col("n"))), F.lit(0)).alias("most"),
    ).first()
    return row["rows"], row["bytes"], row["most"]


def key_counts(df: DataFrame, on: Sequence[str], floor: int = HOT_ROWS) -> tuple[DataFrame | None, bool]:
    """Keys that hold more than their share of the rows, or none, and whether the null keys do; one pass."""
    per_key = staged(df.groupBy(*on).agg(F.count("*").alias("_rows")), "keys")
    no_key = reduce(lambda a, b: a | b, [F.col(quoted(k)).isNull() for k in on])
    rows, nulls = per_key.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.sum(F.when(no_key, F.col("_rows"))), F.lit(0))).first()
    limit = hot_limit(rows, shuffle_width(df.sparkSession), floor)
    if rows <= limit:
        return None, False
    keys = per_key.where(~no_key & (F.col("_rows") > limit)).select(*on)
    found = keys.collect()  # at most rows / limit keys: no more than there are shuffle partitions
    return (df.sparkSession.createDataFrame(found, keys.schema) if found else None), nulls > limit


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    floor: int = HOT_ROWS,
    right_bytes: int | None = None,
) -> DataFrame:
    """Left, inner or semi join of a large table to one with unique keys.

    A right side whose measured size is small is broadcast. Otherwise the key column of the left
    side is counted once, in one pass. Rows of hot keys then stay where they are and meet a broadcast of just
    those right rows (at most one key per shuffle partition); a great many null keys skip the
    join; the rest is shuffled. Without such keys it is the plain join.
    """
    on = list(on)
    if right_bytes is None:
        right_bytes = size_of(right)
    if right_bytes <= broadcast_bytes:
        return left.join(F.broadcast(right), on, how)

    hot, many_nulls = key_counts(left, on, floor)
    if hot is None and not many_nulls:
        return left.join(right, on, how)

    # Hot, cold and null keys are read apart: a computed left side is worked out once.
    left = staged(left, "left")
    no_key = reduce(lambda a, b: a | b, [left[k].isNull() for k in on])
    keyed = left.where(~no_key)
    if hot is None:
        parts = [keyed.join(right, on, how)]
    else:
        few = F.broadcast(hot)
        hot_right = right.join(few, on, "left_semi")
        if size_of(hot_right) <= broadcast_bytes:
            hot_right = F.broadcast(hot_right)
        parts = [
            keyed.join(few, on, "left_semi").join(hot_right, on, how),
            keyed.join(few, on, "left_anti").join(right, on, how),
        ]
    if how == "left":
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in on]
        parts.append(left.where(no_key).select(*[quoted(c) for c in left.columns], *empty))
    return reduce(lambda a, b: a.unionByName(b), parts)


def rename_collisions(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """Right columns whose names the left side has too get a suffix."""
    clash = {c: c + suffix for c in right.columns if c in left.columns and c not in on}
    return right.withColumnsRenamed(clash)


def checked_side(right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The right side of a many-to-one join, written once; the pass that writes it raises where a key occurs twice.

    Rows are grouped by key on the way, so the check is part of the plan and needs no pass of its own. Rows
    with a null in the key match nothing and are left out.
    """
    on = list(on)
    known = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in on])
    values = [c for c in right.columns if c not in on]
    held = F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in values])
    one = right.where(known).groupBy(*on).agg(F.any_value(held).alias("_row"), F.count("*").alias("_n"))
    complaint = F.concat(F.lit(f"right side is not unique on {on}: one key occurs "), F.col("_n").cast("string"), F.lit(" times"))
    row = F.when(F.col("_n") > 1, F.raise_error(complaint).cast(one.schema["_row"].dataType)).otherwise(F.col("_row"))
    try:
        return staged(one.select(*on, row.alias("_row")), "right").select(
            *[F.col(quoted(c)) if c in on else F.col(f"_row.{quoted(c)}").alias(c) for c in right.columns]
        )
    except PySparkException as e:
        if "right side is not unique" in str(e):
            raise ValueError(f"right side is not unique on {on}") from e
        raise


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffix: str = "_right",
    duplicates: str = "check",
    order: Sequence[str] = (),
    **limits: int,
) -> DataFrame:
    """Many-to-one left join.

    With ``duplicates='check'`` a right key that occurs twice is an error; with ``'first'`` the
    right row that comes first by ``order`` is kept. Null keys match nothing. Each side is read once: the right
    side is checked, measured and written in one pass, and joined from there.
    """
    on = list(on)
    right = staged(first_per_key(right, on, order), "first") if duplicates == "first" else checked_side(right, on)
    size = size_of(right)
    right = rename_collisions(left, right, on, suffix)
    return skew_join(left, right, on, "left", right_bytes=size, **limits)


def enrich_all(
    base: DataFrame,
    sources: Mapping[str, tuple[DataFrame | None, str]],
    on: Sequence[str],
) -> DataFrame:
    """Chain of left joins on one key.

    ``sources`` maps a suffix to a table and the schema its columns have when it is absent (a
    source that failed to load): then the columns are there, all null.
    """
    out = base
    for suffix, (table, schema) in sources.items():
        if table is None:
            table = base.sparkSession.createDataFrame([], schema)
        out = enrich(out, table, on, suffix)
    return out


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str], **limits: int) -> DataFrame:
    """Rows whose key is in the key set."""
    return skew_join(df, keys.select(*on), on, "left_semi", **limits)


def rows_by_id(df: DataFrame, ids: DataFrame, row_id: str = "row_id", **limits: int) -> DataFrame:
    """Rows saved earlier by their row id."""
    return skew_join(df, ids.select(row_id), [row_id], "left_semi", **limits)


def coverage(df: DataFrame, signals: Mapping[str, str]) -> DataFrame:
    """Per source: rows, rows with data, and percent, judged by one signal column per source."""
    row = df.agg(F.count("*").alias("rows"), F.array(*[F.count(quoted(c)) for c in signals.values()]).alias("hits"))
    names = F.array(*[F.lit(n) for n in signals])
    return row.select("rows", F.explode(F.arrays_zip(names.alias("source"), "hits")).alias("s")).select(
        F.col("s.source").alias("source"),
        F.col("rows").alias("n_rows"),
        F.col("s.hits").alias("n_with_data"),
        F.round(F.try_divide(100.0 * F.col("s.hits"), F.col("rows")), 2).alias("coverage_pct"),
    )

