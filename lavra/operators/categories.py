"""Category dictionaries as tables, and feature vectors that look their categories up in them.

A dictionary has a row per (column, value) with the value's slot. Values are numbered by ranges: they are dealt out in text order,
counted inside each range, and the counts of the ranges ahead are added. Rows meet the dictionary in a join that
is safe for frequent categories, so neither the driver nor a plan ever holds a list of categories.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import quoted
from lavra.operators.joins import size_of, skew_join
from lavra.session import scratch_path, shuffle_width, staged

POOLED = "__pooled__"


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) of the categorical columns, null included, in one pass."""
    texts = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
    return texts.unpivot([], [quoted(c) for c in columns], "column", "value").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )


def modes(counts: DataFrame) -> DataFrame:
    """The most frequent non-null value per column; of equally frequent ones the smallest."""
    return counts.where("value is not null").groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode")
    )


class Dictionary:
    """Categories of some columns in a folder: ``column, value, n, rare, place, slot``.

    ``place`` numbers all values of a column by text from 0, ``slot`` those that are not rare; rare ones share the slot behind
    them. The driver knows a row per column: mode, number of values, of frequent ones, and the table's size.
    """

    def __init__(self, path: str, columns: Mapping[str, tuple[str, int, int]], size: int):
        self.path, self.columns, self.bytes = path, dict(columns), size

    def table(self, spark) -> DataFrame:
        return spark.read.parquet(self.path)

    def width(self, column: str) -> int:
        """Slots of a one-hot column: frequent values, and one for all rare ones if there are any."""
        _, every, frequent = self.columns[column]
        return frequent + (every > frequent)


def fit_dictionary(train: DataFrame, columns: Sequence[str], min_frequency: int = 2) -> Dictionary:
    """Count and number the categories of the training rows.

    Missing values count as the mode. Values below ``min_frequency`` are rare. Columns without any value are left out.
    """
    spark = train.sparkSession
    counts = staged(category_counts(train, columns), "categories")
    missing = F.max(F.when(F.col("value").isNull(), F.col("n"))).alias("missing")
    # One row per column.
    facts = {r["column"]: r for r in counts.groupBy("column").agg(
        missing, F.min_by("value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), "value"))).alias("mode")
    ).collect() if r["mode"] is not None}
    times = F.col("n")
    for c, r in facts.items():
        filled = (F.col("column") == c) & (F.col("value") == r["mode"])
        times = F.when(filled, times + F.lit(r["missing"] or 0)).otherwise(times)
    known = counts.where("value is not null").withColumn("n", times).withColumn("rare", F.col("n") < min_frequency)
    dealt = known.repartitionByRange(shuffle_width(spark), "column", "value").withColumn("_part", F.spark_partition_id())
    dealt = staged(dealt.withColumn("_one", (~F.col("rare")).cast("long")), "dealt")
    # One row per column and range.
    parts = dealt.groupBy("column", "_part").agg(F.count("*").alias("_n"), F.sum("_one").alias("_k"))
    before = W.partitionBy("column").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ahead = parts.select("column", "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_a{c}") for c in ("_n", "_k")])
    upto = W.partitionBy("column", "_part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    inside = dealt.withColumns({"_i": F.row_number().over(upto) - 1, "_j": F.sum("_one").over(upto) - F.col("_one")})
    totals = parts.groupBy("column").agg(F.sum("_n").alias("_all"), F.sum("_k").alias("_kept"))
    placed = inside.join(ahead, ["column", "_part"]).join(F.broadcast(totals), "column").select(
        "column", "value", "n", "rare", (F.col("_i") + F.col("_a_n")).cast("int").alias("place"),
        F.when(F.col("rare"), F.col("_kept")).otherwise(F.col("_j") + F.col("_a_k")).cast("int").alias("slot"),
    )
    path = scratch_path(spark, "dictionary")
    placed.write.parquet(path)
    table = spark.read.parquet(path)
    sizes = {r["column"]: (r["_all"], r["_kept"]) for r in totals.collect()}
    found = {c: (facts[c]["mode"], *sizes[c]) for c in columns if c in facts}
    return Dictionary(path, found, size_of(table.select("value", "place", "slot")))


def encode(
    df: DataFrame, dictionary: DataFrame, column: str, mode: str, numbers: Mapping[str, str], size: int | None = None
) -> DataFrame:
    """Add numbers (and their new names) of each row's category, by one join; missing ones are the mode, unknown ones get null."""
    own = dictionary.where(F.col("column") == column).select(
        F.col("value").alias("_value"), *[F.col(number).alias(out) for number, out in numbers.items()]
    )
    filled = df.withColumn("_value", F.coalesce(F.col(quoted(column)).cast("string"), F.lit(mode)))
    names = [quoted(c) for c in df.columns]
    return skew_join(filled, own, ["_value"], right_bytes=size).select(*names, *numbers.values())


class CategoryFeatures(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Feature vectors of filled numbers and of categories that are looked up in a dictionary.

    ``onehot`` gives a category a slot of its own (rare ones share one, unknown ones have none), ``ordinal`` a
    number (-1 if unknown). Vectors are sparse and built by Spark's own expressions.
    """

    numbers = Param(Params._dummy(), "numbers", "SQL expressions of the numeric slots", TypeConverters.toListString)
    columns = Param(Params._dummy(), "columns", "categorical columns", TypeConverters.toListString)
    modes = Param(Params._dummy(), "modes", "what missing categories are filled with", TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "slots of each categorical column", TypeConverters.toListInt)
    encoding = Param(Params._dummy(), "encoding", "onehot or ordinal", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the dictionary", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "bytes of the dictionary in memory", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numbers=None, columns=None, modes=None, widths=None, encoding=None, path=None, size=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def at(self, path: str) -> CategoryFeatures:
        """The same with its dictionary in another folder."""
        return self.copy({self.path: path})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers, columns = self.getOrDefault(self.numbers), self.getOrDefault(self.columns)
        onehot, names = self.getOrDefault(self.encoding) == "onehot", [quoted(c) for c in dataset.columns]
        rows, at = dataset, len(numbers)
        cells = [F.struct(F.lit(i).alias("slot"), F.expr(e).alias("value")) for i, e in enumerate(numbers)]
        for k, (c, mode, width) in enumerate(zip(columns, self.getOrDefault(self.modes), self.getOrDefault(self.widths))):
            table = dataset.sparkSession.read.parquet(self.getOrDefault(self.path))
            rows = encode(rows, table, c, mode, {"slot" if onehot else "place": f"_slot{k}"}, self.getOrDefault(self.size))
            found = F.col(f"_slot{k}")
            if onehot:
                cells.append(F.struct((found + at).cast("int").alias("slot"), F.when(found.isNotNull(), F.lit(1.0)).alias("value")))
            else:
                cells.append(F.struct(F.lit(at).alias("slot"), F.coalesce(found, F.lit(-1)).cast("double").alias("value")))
            at += width if onehot else 1
        filled = F.filter(F.array(*cells), lambda c: c["value"].isNotNull()) if cells else F.array()
        vector = F.struct(
            F.lit(0).alias("type"), F.lit(at).alias("size"),
            F.transform(filled, lambda c: c["slot"]).alias("indices") if cells else F.array().cast("array<int>").alias("indices"),
            F.transform(filled, lambda c: c["value"]).alias("values") if cells else F.array().cast("array<double>").alias("values"),
        )
        # A vector's fields, read back under the vector type: no slot list and no Python on the way.
        told = F.from_json(F.to_json(F.struct(vector.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))
        return rows.select(*names, told["v"].alias(self.getOrDefault(self.outputCol)))


def slot_table(spark, numeric: Sequence[str], dictionary: Dictionary | None, encoding: str) -> DataFrame:
    """``slot, name, source`` of every slot of the vector."""
    fixed = [(i, f"num__{c}", c) for i, c in enumerate(numeric)]
    columns = dictionary.columns if dictionary else {}
    if encoding != "onehot":
        fixed += [(len(numeric) + k, f"cat__{c}", c) for k, c in enumerate(columns)]
    slots = spark.createDataFrame(fixed, "slot int, name string, source string")
    if encoding == "onehot" and columns:
        at, offsets = len(numeric), F.lit(None).cast("int")
        for c in columns:
            offsets = F.when(F.col("column") == c, F.lit(at)).otherwise(offsets)
            at += dictionary.width(c)
        every = dictionary.table(spark).where(F.col("column").isin(list(columns)))
        name = F.concat(F.lit("cat__"), "column", F.lit("_"), F.when(F.col("rare"), F.lit(POOLED)).otherwise(F.col("value")))
        kept = every.select((F.col("slot") + offsets).alias("slot"), name.alias("name"), F.col("column").alias("source"))
        # All rare values of a column have the same row.
        slots = slots.unionByName(kept.groupBy("slot").agg(F.first("name").alias("name"), F.first("source").alias("source")))
    return slots


def slot_names(slots: DataFrame) -> list[str]:
    """Names of all slots in order, for vectors of a few."""
    return [r["name"] for r in slots.orderBy("slot").collect()]
