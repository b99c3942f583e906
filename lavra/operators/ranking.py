"""Global ranks, positions and running sums without sorting a table in one task.

A window without ``partitionBy`` moves every row to one task. Here the ordering value is cut into
ranges of about equal row counts; a window runs inside each range and the rows of the ranges ahead
are added. The cut points are a few numbers read once by the driver and then used as literals, so
every use of them agrees, and equal values always share a range. A value that fills a range of its
own needs no sorting at all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.numbers import missing_if_nan
from lavra.functions.text import quoted
from lavra.session import HOT_ROWS, hot_limit, shuffle_width


class Ranges:
    """Cut points of a numeric column, with the values that hold a range of their own."""

    def __init__(self, quantiles: Sequence[float] | None, rows: int = 0, missing: int = 0) -> None:
        self.rows, self.missing = rows, missing
        values = [q for q in (quantiles or []) if q is not None and math.isfinite(q)]
        repeated = {a for a, b in zip(values, values[1:]) if a == b}
        cuts = set(values) | {math.nextafter(v, math.inf) for v in repeated}
        self.splits = [-math.inf, *sorted(cuts), math.inf]
        self.single = sorted(
            i for i, (a, b) in enumerate(zip(self.splits, self.splits[1:])) if b == math.nextafter(a, math.inf)
        )

    def __len__(self) -> int:
        return len(self.splits) - 1

    @property
    def hot_values(self) -> list[float]:
        return [self.splits[i] for i in self.single]

    def assign(self, df: DataFrame, value: str, out: str) -> DataFrame:
        if len(self) < 2:
            return df.withColumn(out, F.when(F.col(value).isNotNull(), F.lit(0)))
        cut = Bucketizer(splits=self.splits, inputCol=value, outputCol=out, handleInvalid="keep")
        return cut.transform(df).withColumn(out, F.col(out).cast("int"))


def value_ranges(df: DataFrame, value: str, buckets: int) -> Ranges:
    """Ranges with about equal row counts, from approximate quantiles (one pass, one column)."""
    probabilities = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 20 * buckets)
    row = df.agg(
        F.percentile_approx(value, probabilities, accuracy).alias("q"),
        F.count("*").alias("rows"),
        F.count(value).alias("known"),
    ).first()
    return Ranges(row["q"], row["rows"], row["rows"] - row["known"])


def distinct_as_double(df: DataFrame, value: Column, number: str) -> Column:
    """Whether no other value of the column's type has the same double as this one."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.LongType):
        return F.abs(number) < 2.0**53
    if isinstance(kind, T.DecimalType):
        return F.abs(number) < 2.0**49 / 10.0**kind.scale
    return F.lit(True)


def _ordered(column: str, descending: bool) -> Column:
    return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()


def _ahead(counts: DataFrame, group: Sequence[str], bucket: str, total: str, descending: bool) -> DataFrame:
    """Sum of the ranges that come before each range. One row per range goes in."""
    before = W.partitionBy(*group).orderBy(_ordered(bucket, descending)).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("_ahead", F.coalesce(F.sum(total).over(before), F.lit(0)))


def competition_rank(
    df: DataFrame,
    value: str,
    out: str,
    where: Column | None = None,
    descending: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Global rank with ties sharing the best place (1, 1, 3); null and masked rows get null.

    Doubles only choose the range: rows are compared by the value itself. NaN counts as missing.
    """
    columns = df.columns
    masked = F.col(quoted(value)) if where is None else F.when(where, F.col(quoted(value)))
    alone = distinct_as_double(df, masked, "_v")
    base = df.withColumn("_v", missing_if_nan(masked)).withColumn("_o", F.when(F.col("_v").isNotNull(), masked))
    buckets = buckets or shuffle_width(df.sparkSession)
    ranges = value_ranges(base, "_v", buckets)
    base = ranges.assign(base, "_v", "_b")
    counts = base.where("_v is not null").groupBy("_b").agg(F.count("*").alias("_n"))
    # As many rows as there are ranges, whatever the size of the table.
    ahead = F.broadcast(_ahead(counts, [], "_b", "_n", descending).select("_b", "_ahead"))

    inside = F.rank().over(W.partitionBy("_b").orderBy(_ordered("_o", descending)))
    if ranges.hot_values or ranges.missing > hot_limit(ranges.rows, buckets):
        settled = F.col("_v").isNull() | (F.col("_v").isin(ranges.hot_values) & alone)
        spread = base.where(~settled).withColumn("_in", inside)
        direct = base.where(settled).withColumn("_in", F.lit(1))
        placed = spread.unionByName(direct)
    else:
        placed = base.withColumn("_in", inside)
    # A row without a value has no range, so it finds no offset and stays without a rank.
    rank = (F.col("_ahead") + F.col("_in")).cast("long").alias(out)
    return placed.join(ahead, "_b", "left").select(*[quoted(c) for c in columns], rank)


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    out: str,
    descending: bool = True,
    floor: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Rank inside each group; rows with a null value or a null group get null.

    Groups too large for one task are cut into value ranges as in ``competition_rank``.
    """
    columns = df.columns
    group = list(group)
    spark = df.sparkSession
    alone = distinct_as_double(df, F.col(quoted(value)), "_v")
    base = df.withColumn("_v", missing_if_nan(F.col(quoted(value)))).withColumn("_o", F.col(quoted(value)))
    unranked = reduce(lambda a, b: a | b, [F.col(quoted(g)).isNull() for g in group], F.col("_v").isNull())
    order = _ordered("_o", descending)

    rows, skipped = base.agg(F.count("*"), F.count_if(unranked)).first()
    width = shuffle_width(spark)
    limit = hot_limit(rows, width, floor)
    sizes = base.where(~unranked).groupBy(*group).agg(F.count("*").alias("_rows"))
    found = sizes.where(F.col("_rows") > limit).select(*group).collect() if rows > limit else []

    if not found:
        ranked = F.rank().over(W.partitionBy(*group).orderBy(order))
        if skipped <= limit:
            return base.withColumn(out, F.when(~unranked, ranked).cast("long")).drop("_v", "_o")
        some = base.where(~unranked).withColumn(out, ranked.cast("long"))
        none = base.where(unranked).withColumn(out, F.lit(None).cast("long"))
        return some.unionByName(none).select(*[quoted(c) for c in columns], out)

    # Rows of all hot groups share one set of ranges: a range then holds few rows of any group.
    hot = F.broadcast(spark.createDataFrame(found, sizes.select(*group).schema))
    share = max(2, buckets or width)
    hot_rows = base.where(~unranked).join(hot, group, "left_semi")
    ranges = value_ranges(hot_rows, "_v", share)
    counts = ranges.assign(hot_rows, "_v", "_b").groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    ahead = _ahead(counts, group, "_b", "_n", descending).select(*group, "_b", "_ahead")
    cut = ranges.assign(base, "_v", "_b").join(ahead, [*group, "_b"], "left")
    is_hot = F.col("_ahead").isNotNull()
    settled = unranked | (is_hot & F.col("_v").isin(ranges.hot_values) & alone)
    inside = F.rank().over(W.partitionBy(*group, F.when(is_hot, F.col("_b"))).orderBy(order))
    spread = cut.where(~settled).withColumn("_in", inside)
    direct = cut.where(settled).withColumn("_in", F.when(~unranked, F.lit(1)))
    place = (F.coalesce("_ahead", F.lit(0)) + F.col("_in")).cast("long").alias(out)
    return spread.unionByName(direct).select(*[quoted(c) for c in columns], place)


def row_position(
    df: DataFrame,
    order: Sequence[tuple[Column, bool]],
    tie: Column,
    out: str,
    buckets: int | None = None,
) -> DataFrame:
    """Position 1..n of every row by numeric columns (value, descending?), then by ``tie``.

    ``tie`` is a hash text, unique per row: rows equal in all values are split over tasks by as
    many of its first digits as the shuffle width asks for. Nulls come last. Doubles only choose
    the range: rows are ordered by the values themselves.
    """
    columns = df.columns
    buckets = buckets or shuffle_width(df.sparkSession)
    base = df
    keys, paths = [], []
    tied = F.lit(True)
    for i, (value, descending) in enumerate(order):
        number = missing_if_nan(value)
        rising = -number if descending else number
        v, b, o = f"_v{i}", f"_b{i}", f"_o{i}"
        alone = distinct_as_double(df, value, v)
        base = base.withColumn(o, F.when(number.isNotNull(), value))
        base = base.withColumn(v, F.coalesce(rising, F.lit(math.inf)))
        ranges = value_ranges(base.where(tied), v, buckets)
        # The unknown values at the end are one tied block as well.
        if len(ranges) > 1:
            ranges.splits.insert(-1, math.nextafter(math.inf, 0))
        base = ranges.assign(base, v, b).withColumn(b, F.when(tied, F.col(b)).otherwise(F.lit(-1)))
        tied = tied & ((F.col(v).isin(ranges.hot_values) & alone) | (F.col(v) == F.lit(math.inf)))
        keys.append(_ordered(o, descending))
        paths.append(b)
    base = base.withColumn("_t", tie)
    digits = max(2, math.ceil(math.log(4 * buckets, 16)))
    base = base.withColumn("_bt", F.when(tied, F.substring("_t", 1, digits)).otherwise(F.lit("")))
    paths.append("_bt")

    counts = base.groupBy(*paths).agg(F.count("*").alias("_n"))
    before = W.orderBy(*paths).rowsBetween(W.unboundedPreceding, -1)
    # One row per range, not per table row.
    ahead = counts.select(*paths, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(W.partitionBy(*paths).orderBy(*keys, "_t"))
    placed = base.withColumn("_in", inside).join(ahead, paths, "left")
    return placed.select(*[quoted(c) for c in columns], (F.col("_ahead") + F.col("_in")).cast("long").alias(out))


def running_sums(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    group: Sequence[str] = (),
    descending: bool = True,
    buckets: int | None = None,
    ranges: Ranges | None = None,
) -> DataFrame:
    """``cum_<name>`` of every summed column, in value order, inside each group.

    The table holds one row per (group, value): aggregate it first. ``ranges`` spares a pass where
    the caller has cut the value already.
    """
    group = list(group)
    columns = df.columns
    buckets = buckets or shuffle_width(df.sparkSession)
    base = df.withColumn("_v", F.col(quoted(value)).cast("double"))
    base = (ranges or value_ranges(base, "_v", buckets)).assign(base, "_v", "_b")
    own = _ordered(quoted(value), descending)
    inside = W.partitionBy(*group, "_b").orderBy(own).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*group).orderBy(_ordered("_b", descending)).rowsBetween(W.unboundedPreceding, -1)
    totals = base.groupBy(*group, "_b").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    ahead = totals.select(
        *group, "_b", *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_ahead_{s}") for s in sums]
    )
    local = base.withColumns({f"_in_{s}": F.sum(s).over(inside) for s in sums})
    return local.join(ahead, [*group, "_b"], "left").select(
        *[quoted(c) for c in columns],
        *[(F.col(f"_ahead_{s}") + F.col(f"_in_{s}")).alias(f"cum_{s}") for s in sums],
    )


def ranking_list(
    df: DataFrame, score: str, tie: Sequence[str], out: str, eligible: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Eligible rows numbered 1..n by falling score; equal scores in the order of their key's hash."""
    rows = df if eligible is None else df.where(eligible)
    return row_position(rows, [(F.col(score), True)], key_hash(tie), out, buckets)


def key_hash(columns: Sequence[str], seed: str = "") -> Column:
    """md5 of a seed and the key fields: the same number in any partitioning and any engine.

    Fields are joined by colons; colons and backslashes inside them are escaped, and null is ``\\N``,
    so different keys are different texts.
    """
    def field(c: str) -> Column:
        text = F.replace(F.col(quoted(c)).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit(":"), F.lit("\\:")), F.lit("\\N"))

    fields = [field(c) for c in columns]
    return F.md5(F.concat_ws(":", *([F.lit(seed)] if seed else []), *fields))


def top_k(df: DataFrame, k: int, column: str, tie: Sequence[str] = (), ascending: bool = True) -> DataFrame:
    """The k rows with the greatest value, shown from smallest to greatest as in a bar chart."""
    best = df.orderBy(F.col(column).desc_nulls_last(), *tie).limit(k)
    return best.orderBy(F.col(column).asc_nulls_last(), *tie) if ascending else best


def bottom_k(df: DataFrame, k: int, column: str, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last(), *tie).limit(k)


def best_row(df: DataFrame, column: str) -> DataFrame:
    """The row with the greatest value, as a partial aggregate instead of a sort."""
    return df.agg(F.max_by(F.struct(*[quoted(c) for c in df.columns]), column).alias("r")).select("r.*")


def sorted_by(df: DataFrame, *keys: tuple[str, bool]) -> DataFrame:
    """Multi-key sort (column, descending?) with nulls last in either direction."""
    return df.orderBy(
        *[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in keys]
    )
