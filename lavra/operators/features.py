"""Feature preparation fitted on training rows and kept as ordinary ML stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.numbers import missing_if_nan
from lavra.functions.text import quoted
from lavra.operators.categories import CategoryFeatures, Dictionary, fit_dictionary, slot_table

# Values between the bracketing quantiles are handed to one exact percentile below this count.
BRACKET_ROWS = 100_000

def exact_medians(df: DataFrame, columns: Sequence[str], bracket_rows: int = BRACKET_ROWS) -> dict[str, float | None]:
    """Exact medians of several columns without holding their values in one task.

    Approximate quantiles bracket the middle of each column; one count per round says how many
    values lie below and inside each bracket; rounds go on until few are inside or the bracket is
    one value. The ends of a bracket are counted apart from what lies between them, so repeated
    values settle at once and every round leaves fewer. Only the few values left in a
    column's own bracket are ordered, whatever the other columns hold.
    """
    values = {c: missing_if_nan(F.col(quoted(c))) for c in columns}
    if not values:
        return {}
    row = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
        *[F.min(v).alias(f"a{i}") for i, v in enumerate(values.values())],
        *[F.max(v).alias(f"b{i}") for i, v in enumerate(values.values())],
    ).first()
    out: dict[str, float | None] = {}
    # Per column: the bracket, the values below it and inside it; and for each middle place its own.
    asked: dict[tuple[str, int], list] = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if not n:
            out[c] = None
            continue
        for place in {(n - 1) // 2, n // 2}:
            asked[c, place] = [row[f"a{i}"], row[f"b{i}"], 0, n]

    while todo := {k: v for k, v in asked.items() if v[3] > bracket_rows and v[0] < v[1]}:
        probes = []
        for i, ((c, place), (low, high, below, inside)) in enumerate(todo.items()):
            share = (place - below) / inside
            edges = [max(0.0, share - 1e-3), min(1.0, share + 1e-3)]
            some = F.when(values[c].between(low, high), values[c])
            probes.append(F.percentile_approx(some, edges, 10_000).alias(f"q{i}"))
        found = df.agg(*probes).first()
        counts, tries = [], {}
        for i, ((c, place), _) in enumerate(todo.items()):
            a, b = tries[c, place] = found[f"q{i}"]
            v = values[c]
            counts += [
                F.count_if(v < a).alias(f"l{i}"), F.count_if(v == a).alias(f"a{i}"),
                F.count_if((v > a) & (v < b)).alias(f"m{i}"), F.count_if(v <= b).alias(f"u{i}"),
                F.max(F.when(v < a, v)).alias(f"w{i}"), F.min(F.when(v > a, v)).alias(f"x{i}"),
                F.max(F.when(v < b, v)).alias(f"y{i}"), F.min(F.when(v > b, v)).alias(f"z{i}"),
            ]
        counted = df.agg(*counts).first()
        for i, ((c, place), (low, high, below, inside)) in enumerate(todo.items()):
            a, b = tries[c, place]
            under, at, between, upto = (counted[f"{k}{i}"] for k in "lamu")
            if place < under:
                new = [low, counted[f"w{i}"], below, under - below]
            elif place < under + at:
                new = [a, a, under, at]
            elif place < under + at + between:
                new = [counted[f"x{i}"], counted[f"y{i}"], under + at, between]
            elif place < upto:
                new = [b, b, under + at + between, upto - under - at - between]
            else:
                new = [counted[f"z{i}"], high, upto, below + inside - upto]
            asked[c, place] = new

    exact, sought = [], {k: v for k, v in asked.items() if v[0] < v[1]}
    for i, ((c, place), (low, high, below, inside)) in enumerate(sought.items()):
        ordered = F.sort_array(F.collect_list(F.when(values[c].between(low, high), values[c])))
        exact.append(F.get(ordered, F.lit(place - below)).alias(f"p{i}"))
    found = df.agg(*exact).first() if exact else {}
    middle: dict[str, list] = {}
    for i, (c, place) in enumerate(sought):
        middle.setdefault(c, []).append(found[f"p{i}"])
    for (c, _), (low, high, *_rest) in asked.items():
        if low == high:
            middle.setdefault(c, []).append(low)
    for c, found_values in middle.items():
        out[c] = sum(float(x) for x in found_values) / len(found_values)
    return {c: out[c] for c in columns}


@dataclass
class Preparation:
    """Fitted numbers of the feature preparation; categories are a table."""

    numeric: list[str]
    medians: dict[str, float]
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    dictionary: Dictionary | None = None

    @property
    def categorical(self) -> list[str]:
        return list(self.dictionary.columns) if self.dictionary else []


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], min_frequency: int = 2
) -> Preparation:
    """Medians, then means and population deviations of the filled columns, and the category dictionary.

    Columns without any value are dropped, as there is nothing to fill them with.
    """
    medians = exact_medians(train, numeric)
    used = [c for c in numeric if medians[c] is not None]
    fitted = Preparation(used, {c: medians[c] for c in used})
    if used:
        filled = [F.coalesce(missing_if_nan(F.col(quoted(c))), F.lit(medians[c])) for c in used]
        row = train.agg(
            *[F.avg(v).alias(f"m{i}") for i, v in enumerate(filled)],
            *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled)],
        ).first()
        for i, c in enumerate(used):
            fitted.means[c] = row[f"m{i}"]
            fitted.stds[c] = row[f"s{i}"] or 1.0
    if categorical:
        fitted.dictionary = fit_dictionary(train, categorical, min_frequency)
    return fitted


def _sql_number(value: float) -> str:
    return f"{value!r}D"


def assemble(
    spark: SparkSession, fitted: Preparation, scale: bool, encoding: str, out: str = "features"
) -> tuple[PipelineModel, DataFrame]:
    """The ML stage that builds the feature vector, and a table ``slot, name, source`` of its slots.

    Numeric columns are filled with the median and, with ``scale``, standardised. Categories are
    filled with the mode, then one-hot encoded (rare ones share a slot, unknown ones are all zero)
    or given their ordinal (unknown ones -1).
    """
    numbers = []
    for c in fitted.numeric:
        filled = f"coalesce(nanvl(cast({quoted(c)} as double), null), {_sql_number(fitted.medians[c])})"
        if scale:
            filled = f"({filled} - {_sql_number(fitted.means[c])}) / {_sql_number(fitted.stds[c])}"
        numbers.append(filled)
    known = fitted.dictionary
    columns = list(known.columns) if known else []
    stage = CategoryFeatures(
        numbers=numbers, columns=columns, modes=[known.columns[c][0] for c in columns],
        widths=[known.width(c) for c in columns], encoding=encoding,
        path=known.path if known else "", size=known.bytes if known else 0, outputCol=out,
    )
    return PipelineModel([stage]), slot_table(spark, fitted.numeric, known, encoding)


def balanced_weight(label: str, negatives: int, positives: int) -> Column:
    """``n / (2 * n_class)`` per row; with a single class there is nothing to balance and all weigh 1."""
    if not positives or not negatives:
        return F.lit(1.0)
    n = negatives + positives
    return F.when(F.col(label) == 1, F.lit(n / (2.0 * positives))).otherwise(F.lit(n / (2.0 * negatives)))


def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def preparation_table(spark, fitted: Preparation) -> DataFrame:
    """The fitted numbers as rows (feature, statistic, value, text)."""
    rows = []
    for c in fitted.numeric:
        rows += [(c, "median", float(fitted.medians[c]), None), (c, "mean", float(fitted.means[c]), None),
                 (c, "std", float(fitted.stds[c]), None)]
    rows += [(c, "mode", None, fitted.dictionary.columns[c][0]) for c in fitted.categorical]
    table = spark.createDataFrame(rows, "feature string, statistic string, value double, text string")
    if fitted.dictionary:
        table = table.unionByName(fitted.dictionary.table(spark).select(
            F.col("column").alias("feature"), F.when(F.col("rare"), "pooled").otherwise("category").alias("statistic"),
            F.when(~F.col("rare"), F.col("slot")).cast("double").alias("value"), F.col("value").alias("text"),
        ))
    return table
