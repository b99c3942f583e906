"""Exact seeded samples and grouped, stratified folds that do not depend on partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.operators.joins import skew_join
from lavra.operators.ranking import key_hash, row_position
from lavra.session import staged

SAMPLE_ROWS = 5000
SEED = 42

# Samples up to this size are cut off by one sort; larger ones by the hash of their last row.
SORT_ROWS = 100_000


def sample_exact(
    df: DataFrame, n: int, key: Sequence[str], seed: int | str = SEED, rows: int | None = None
) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer) with the smallest hashes of a unique key.

    The rows are counted first. A hash limit that a few more than ``n`` rows pass then leaves only
    those few to be cut off; should fewer than ``n`` pass, the limit is doubled. Samples of any
    size work: for large ones only the surplus rows are sorted, to find the hash to stop at.
    """
    rows = df.count() if rows is None else rows
    if rows <= n:
        return df
    hashed = df.withColumn("_h", key_hash(key, str(seed)))
    chance = min(1.0, (n + 8 * math.sqrt(n) + 64) / rows)
    while True:
        few = hashed if chance >= 1 else hashed.where(F.col("_h") < _hex_limit(chance))
        passed = rows if chance >= 1 else few.count()
        if passed >= n:
            break
        chance *= 2
    if n <= SORT_ROWS:
        return few.orderBy("_h", *key).limit(n).drop("_h")
    if passed > n:
        surplus = few.select("_h").orderBy(F.col("_h").desc()).limit(passed - n)
        few = few.where(F.col("_h") < surplus.agg(F.min("_h")).first()[0])
    return few.drop("_h")


def _hex_limit(chance: float) -> Column:
    return F.lit(format(int(chance * 16**13), "013x"))


def sample_with_counts(
    df: DataFrame, n: int, key: Sequence[str] | None = None, seed: int | str = SEED
) -> tuple[DataFrame, int, int]:
    """The sample, rows in and rows kept, for the lineage manifest.

    A source without a key is numbered as it is read: the sample is as uniform and as exact, but
    holds the same rows again only for the same files and splits.
    """
    rows = df.count()
    if key is None:
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        return sample_exact(numbered, n, ["_row"], seed, rows).drop("_row"), rows, min(n, rows)
    return sample_exact(df, n, key, seed, rows), rows, min(n, rows)


def fallback_group(group: Column, row_id: Column, prefix: str = "SEM_ESCOLA_") -> Column:
    """Rows without a group form a group of their own."""
    return F.coalesce(group.cast("string"), F.concat(F.lit(prefix), row_id.cast("string")))


def serpentine(position: Column, k: int) -> Column:
    """Folds 0..k-1, k-1..0, 0..k-1 ... for positions 1, 2, 3 ..."""
    turn = (position - 1) % (2 * k)
    return F.when(turn < k, turn).otherwise(2 * k - 1 - turn).cast("int")


def group_folds(
    df: DataFrame, group: str, label: str, k: int = 5, seed: int | str = SEED, fold: str = "fold"
) -> DataFrame:
    """Assign every group to one of ``k`` folds of about equal size and class mix.

    Groups are placed by falling size, then positives, then hash, and dealt out in serpentine
    order: neighbours are alike, so every fold gets its share of each kind. Only group totals are
    sorted. The folds are joined back with care for groups that hold much of the table. A row
    without a group is a group of its own, whose fold the hash of its columns decides.
    """
    known = df.where(F.col(group).isNotNull())
    groups = staged(
        known.groupBy(group).agg(F.count("*").alias("_size"), F.sum(label).cast("long").alias("_pos")),
        "groups",
    )
    placed = row_position(
        groups,
        [(F.col("_size"), True), (F.col("_pos"), False)],
        F.concat_ws(":", key_hash([group], str(seed)), F.col(group).cast("string")),
        "_place",
    )
    folds = placed.select(group, serpentine(F.col("_place"), k).alias(fold))
    alone = F.conv(F.substring(key_hash(df.columns, str(seed)), 1, 12), 16, 10).cast("long") % k
    unknown = df.where(F.col(group).isNull()).withColumn(fold, alone.cast("int"))
    return skew_join(known, staged(folds, "folds"), [group]).select(*unknown.columns).unionByName(unknown)


def size_class(n: Column) -> Column:
    """Whole numbers below 128 as they are, larger ones with their seven leading bits: within 1.6 percent."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)))) - 6, F.lit(0))).cast("long")
    return (F.floor(n / step) * step).cast("long")


def deal(classes: Sequence[tuple[int, int, int]], k: int) -> list[list[int]]:
    """Groups of each class (size, positives, groups) that every fold gets.

    Classes come one after the other, and each of their groups goes to the fold where it adds least to
    the sum of squares of both shares, rows and positives; of equal folds to the first. Groups of a class are alike, so
    the cost of a fold rises by the same step with each: how many each fold gets is found at once, from the level that all costs rise to.
    """
    rows = max(1, sum(s * m for s, _, m in classes))
    ones = max(1, sum(p * m for _, p, m in classes))
    sizes, positives, out = [0] * k, [0] * k, []
    for s, p, m in classes:
        base = [sizes[f] * s * ones**2 + positives[f] * p * rows**2 for f in range(k)]
        step = s * s * ones**2 + p * p * rows**2

        def given(level: int) -> list[int]:
            return [max(0, (level - b) // step + 1) for b in base]  # noqa: B023

        low, high = min(base) - 1, max(base) + m * step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if sum(given(middle)) <= m else (low, middle)
        counts = given(low)
        left = m - sum(counts)
        # What is left goes to folds that would all reach the next level.
        for f in range(k):
            if left and given(low + 1)[f] > counts[f]:
                counts[f] += 1
                left -= 1
        for f in range(k):
            sizes[f] += s * counts[f]
            positives[f] += p * counts[f]
        out.append(counts)
    return out


def stratified_group_folds(
    df: DataFrame, group: str, label: str, k: int = 5, seed: int | str = SEED, fold: str = "fold"
) -> DataFrame:
    """Assign every group to one of ``k`` folds, evenly in rows and in positives.

    Groups are packed greedily, the largest first, each into the fold that it leaves most even. The packing works on
    the histogram of groups (how many there are of each size and number of positives, larger ones to seven
    bits), which is small whatever the table; groups of a class are dealt out by their place in hash order. A group that holds much of the
    table fills its fold, and the others share the rest. A row without a group is a group of its own,
    whose fold the hash of its columns decides.
    """
    spark, known = df.sparkSession, df.where(F.col(group).isNotNull())
    groups = known.groupBy(group).agg(F.count("*").alias("_n"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("_p"))
    groups = staged(groups.select(group, size_class(F.col("_n")).alias("_size"), size_class(F.col("_p")).alias("_pos")), "groups")
    # One row for each class of groups.
    found = groups.groupBy("_size", "_pos").count().collect()
    classes = sorted(((r["_size"], r["_pos"], r["count"]) for r in found), reverse=True)
    ends, start, table = deal(classes, k), 0, []
    for i, ((size, positives, many), counts) in enumerate(zip(classes, ends)):
        table.append((size, positives, i, start, [sum(counts[: f + 1]) for f in range(k)]))
        start += many
    plan = spark.createDataFrame(table, "_size long, _pos long, _class int, _start long, _ends array<long>")
    classed = staged(groups.join(plan, ["_size", "_pos"]), "classed")
    tie = F.concat_ws(":", key_hash([group], str(seed)), F.col(group).cast("string"))
    placed = row_position(classed, [(F.col("_class"), False)], tie, "_place")
    own = F.col("_place") - 1 - F.col("_start")
    folds = placed.select(group, F.size(F.filter("_ends", lambda e: e <= own)).alias(fold))
    alone = F.conv(F.substring(key_hash(df.columns, str(seed)), 1, 12), 16, 10).cast("long") % k
    unknown = df.where(F.col(group).isNull()).withColumn(fold, alone.cast("int"))
    return skew_join(known, staged(folds, "folds"), [group]).select(*unknown.columns).unionByName(unknown)


def holdout(df: DataFrame, fold: str = "fold", test: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training rows and test rows; the first fold is the test set. A row without a fold is an error."""
    number = F.coalesce(F.col(fold), F.raise_error(F.lit("a row has no fold")).cast("int"))
    return df.where(number != test).drop(fold), df.where(number == test).drop(fold)
