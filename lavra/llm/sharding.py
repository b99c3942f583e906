"""Shards of near equal bytes as the leaves of a k-d tree over the metadata.

A node is split along the metadata dimension in which it is widest, at the weighted median (or the
fraction that its number of leaves asks for) of the documents' bytes. Medians of all nodes of a level
are found together: bytes are summed into a histogram of each node's value range, the bin that holds
the median becomes the next range, until one value is left. A value is a coordinate followed by a
hash, so documents that share a coordinate, a hot source say, are still split evenly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.text import columns_of
from lavra.session import staged

BINS = 4096
# Bits of a coordinate, and of the hash that follows it.
COORDINATE, TIE = 31, 31
# Leading bits of the hash that deal a shard's rows into runs for numbering.
RUN_BITS = 12
OVERHEAD = 8


def document_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text, null as none, and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


@dataclass
class Tree:
    """Splits by level, node -> (dimension, first value of the right side), and the shard of each leaf."""

    levels: list[dict[int, tuple[int, int]]] = field(default_factory=list)
    leaves: dict[int, int] = field(default_factory=dict)

    def walk(self, df: DataFrame, keys: str = "_keys") -> DataFrame:
        """``_node`` moved down the levels; one broadcast lookup a level, a row a node."""
        spark, walked = df.sparkSession, df
        for splits in self.levels:
            rows = [(n, d, c) for n, (d, c) in splits.items()]
            step = spark.createDataFrame(rows, "_node int, _dim int, _cut long")
            right = (F.get(keys, F.col("_dim")) >= F.col("_cut")).cast("int")
            walked = walked.join(F.broadcast(step), "_node", "left").withColumn(
                "_node", F.when(F.col("_dim").isNull(), F.col("_node")).otherwise(2 * F.col("_node") + right)
            ).drop("_dim", "_cut")
        return walked

    def assign(self, df: DataFrame, keys: str, out: str) -> DataFrame:
        """The leaf's shard of every row."""
        walked = self.walk(df.withColumn("_node", F.lit(1)), keys)
        names = df.sparkSession.createDataFrame(list(self.leaves.items()), f"_node int, `{out}` int")
        return walked.join(F.broadcast(names), "_node", "left").drop("_node")


class Space:
    """The metadata of documents as coordinates in equal ranges.

    Numbers are scaled to the range they have in the table; texts and other types stand at their
    hash, so equal values share a coordinate. Null stands at the start of the range.
    """

    def __init__(self, docs: DataFrame, dimensions: Sequence[str], key: str, text: str):
        self.key, self.text = key, text
        kinds = {f.name: f.dataType for f in docs.schema.fields}
        self.dimensions = [d for d in dimensions if d in kinds]
        self.numbers = [d for d in self.dimensions if isinstance(kinds[d], T.NumericType)]
        ends = [f(F.col(f"`{d}`").cast("double")) for d in self.numbers for f in (F.min, F.max)]
        found = list(docs.agg(F.count("*"), F.sum(document_bytes(F.col(f"`{text}`"))), *ends).first())
        self.rows, self.bytes = found[0], found[1] or 0
        self.ranges = {d: (found[2 + 2 * i], found[3 + 2 * i]) for i, d in enumerate(self.numbers)}

    def _coordinate(self, name: str) -> Column:
        top = (1 << COORDINATE) - 1
        column = F.col(f"`{name}`")
        if name in self.numbers:
            low, high = self.ranges[name]
            if low is None or not high > low or math.isinf(high - low) or math.isnan(high - low):
                return F.lit(0).cast("long")
            place = (column.cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(top)
            return F.coalesce(F.floor(place).cast("long"), F.lit(0))
        return F.when(column.isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(column), 64 - COORDINATE))

    def tie(self) -> Column:
        """Uniform bits: 19 of the text, so that copies stand together, then 12 of key and text."""
        text, key = F.col(f"`{self.text}`"), F.col(f"`{self.key}`")
        front = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - 19)
        back = F.shiftrightunsigned(F.xxhash64(key, text), 64 - (TIE - 19))
        return F.shiftleft(front, TIE - 19).bitwiseOR(back)

    def keys(self) -> Column:
        """One value a dimension: the coordinate, then the hash."""
        tie = self.tie()
        values = [F.shiftleft(self._coordinate(d).cast("long"), TIE).bitwiseOR(tie) for d in self.dimensions]
        return F.array(*(values or [tie]))


def _medians(rows: DataFrame, open_nodes: dict[int, dict]) -> dict[int, int]:
    """First value of the right side for every open node (dim, low, high, goal in bytes)."""
    spark = rows.sparkSession
    left, cuts = {n: dict(v) for n, v in open_nodes.items()}, {}
    while left:
        asked = [(n, v["dim"], v["low"], (v["high"] - v["low"]) // BINS + 1, float(v["goal"])) for n, v in left.items()]
        table = spark.createDataFrame(asked, "_node int, _dim int, _low long, _width long, _goal double")
        valued = rows.join(F.broadcast(table), "_node").withColumn("_value", F.get("_keys", F.col("_dim")))
        binned = valued.withColumn("_bin", F.expr("(_value - _low) div _width")).where(
            (F.col("_value") >= F.col("_low")) & (F.col("_bin") < BINS)
        )
        sums = binned.groupBy("_node", "_bin", "_goal").agg(
            F.sum("_size").alias("_sum"), F.min("_value").alias("_first"), F.max("_value").alias("_last")
        )
        before = W.partitionBy("_node").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
        placed = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        # One row for each open node.
        for r in placed.where("_ahead <= _goal and _ahead + _sum > _goal").collect():
            node = left[r["_node"]]
            if r["_first"] == r["_last"]:
                over, under = r["_ahead"] + r["_sum"] - node["goal"], node["goal"] - r["_ahead"]
                cuts[r["_node"]] = r["_first"] if under < over else r["_first"] + 1
                del left[r["_node"]]
            else:
                node.update(low=r["_first"], high=r["_last"], goal=node["goal"] - r["_ahead"])
    return cuts


def grow(rows: DataFrame, leaves: int, dimensions: int) -> Tree:
    """The tree over rows of ``_keys`` and ``_size``. The driver holds a few numbers a node."""
    tree, counts, first = Tree(), {1: leaves}, {1: 0}
    rows = rows.withColumn("_node", F.lit(1))
    while any(n > 1 for n in counts.values()):
        ends = [f(F.get("_keys", F.lit(d))) for d in range(dimensions) for f in (F.min, F.max)]
        stats = {r[0]: r[1:] for r in rows.groupBy("_node").agg(F.sum("_size"), *ends).collect()}
        asked = {}
        for node, (total, *bounds) in stats.items():
            if counts.get(node, 1) < 2:
                continue
            spans = [bounds[2 * d + 1] - bounds[2 * d] for d in range(dimensions)]
            dim = spans.index(max(spans))
            share = (counts[node] // 2) / counts[node]
            asked[node] = {"dim": dim, "low": bounds[2 * dim], "high": bounds[2 * dim + 1], "goal": total * share}
        if not asked:
            break
        cuts = _medians(rows, asked)
        splits = {n: (asked[n]["dim"], cut) for n, cut in cuts.items()}
        tree.levels.append(splits)
        for n in splits:
            half, start, count = counts[n] // 2, first.pop(n), counts.pop(n)
            counts |= {2 * n: half, 2 * n + 1: count - half}
            first |= {2 * n: start, 2 * n + 1: start + half}
        step = Tree([splits], {})
        rows = staged(step.walk(rows), "level")
    tree.leaves = first
    return tree


def plan(docs: DataFrame, leaves: int | None, target_bytes: int | None, dimensions: Sequence[str], key: str, text: str):
    """The space of the metadata and the tree over it; only sizes and coordinates are written."""
    space = Space(docs, dimensions, key, text)
    leaves = leaves or max(1, math.ceil(space.bytes / target_bytes))
    thin = staged(docs.select(space.keys().alias("_keys"), document_bytes(F.col(f"`{text}`")).alias("_size")), "space")
    return space, grow(thin, leaves, max(1, len(space.dimensions)))


def assign_shards(
    docs: DataFrame,
    leaves: int | None = 24,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = ("source", "lang", "n_chars"),
    key: str = "doc_id",
    text: str = "text",
    out: str = "shard",
) -> DataFrame:
    """``docs`` with their shard, from 0; the texts are not moved.

    Give the number of ``leaves``, or ``target_bytes`` a shard. Shards differ by about the size of
    the documents at their cuts. Dimensions that the table lacks are left out; with none, the hash
    alone is split. Null, empty and very long texts count their bytes and a fixed overhead, and no
    document is cut, so one that is larger than a shard fills it. Rows equal in key, text and
    metadata share a shard. With fewer documents than shards some shards stay empty. An input column
    named like ``out`` is replaced.
    """
    space, tree = plan(docs, leaves, target_bytes, dimensions, key, text)
    own = docs.select(F.struct(*columns_of(docs, (out,))).alias("_doc"), space.keys().alias("_keys"))
    return tree.assign(own, "_keys", out).select("_doc.*", F.col(f"`{out}`"))


def numbered(
    docs: DataFrame, carry: Sequence[str], key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The carried columns with ``size``, ``text_crc32``, ``shard`` and ``slot``, gapless from 0 in a shard.

    The slot follows a hash of key and text; equal rows may swap theirs. A shard is numbered in
    runs of that hash, so no task holds a whole shard, not even of copies of one text. Null keys and texts
    have places like any other; an empty table stays empty.
    """
    space, tree = plan(docs, options.get("leaves", 24), options.get("target_bytes"), options.get("dimensions", ("source", "lang", "n_chars")), key, text)
    value = F.col(f"`{text}`")
    thin = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_doc"), F.col(f"`{key}`").alias("_key"), space.keys().alias("_keys"),
        space.tie().alias("_tie"), document_bytes(value).alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = staged(tree.assign(thin, "_keys", "shard").withColumn("_mix", F.xxhash64("_key", "_tie")).withColumn("_run", F.shiftright("_mix", 64 - RUN_BITS).cast("int")), "shards")
    runs = placed.groupBy("shard", "_run").agg(F.count("*").alias("_n"))
    before = W.partitionBy("shard").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    ahead = runs.select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(W.partitionBy("shard", "_run").orderBy("_mix", "_tie", "_key", "size", "text_crc32")) - 1
    slot = (F.col("_ahead") + F.col("_in")).cast("long").alias("slot")
    joined = placed.withColumn("_in", inside).join(ahead, ["shard", "_run"])
    return joined.select("_doc.*", "size", "text_crc32", "shard", slot)
