"""Reports about a table: columns, correlations, quality rules, feature choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.numbers import missing_if_nan, parse_plain
from lavra.functions.text import quoted, trim_all


def _long(row: DataFrame, names: Sequence[str], stats: Mapping[str, Sequence[Column | str]]) -> DataFrame:
    """Turn a one-row aggregate with an array per statistic into one row per column."""
    arrays = [F.array(*[F.lit(n) for n in names]).alias("column")]
    arrays += [F.col(s) for s in stats]
    return row.select(F.posexplode(F.arrays_zip(*arrays)).alias("pos", "s")).select(
        F.col("s.column").alias("column"), *[F.col(f"s.{s}").alias(s) for s in stats]
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Nulls, percent null, distinct values and type of every column.

    Exact: every (column, value) pair is counted with partial sums, so one pass and one shuffle
    serve all columns, whatever their number. Approximate: one sketch per column, no shuffle of
    values.
    """
    names = df.columns
    types = F.create_map(*[x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))])
    if approximate:
        row = df.agg(
            F.array(*[F.count(F.when(F.col(quoted(c)).isNull(), 1)) for c in names]).alias("nulls"),
            F.array(*[F.lit(1) * F.count("*") for _ in names]).alias("rows"),
            F.array(*[F.approx_count_distinct(quoted(c)) for c in names]).alias("n_distinct"),
        )
        found = _long(row, names, {"nulls": [], "rows": [], "n_distinct": []})
    else:
        texts = df.select(*[_as_text(f).alias(f.name) for f in df.schema])
        pairs = texts.unpivot([], [quoted(c) for c in names], "column", "value")
        counts = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
        found = counts.groupBy("column").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.sum("n").alias("rows"),
            F.count("value").alias("n_distinct"),
        )
    # An empty table still has a row per column.
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    found = every.join(found, "column", "left").fillna(0, ["nulls", "rows", "n_distinct"])
    return found.select(
        "column",
        "nulls",
        F.round(F.try_divide(100.0 * F.col("nulls"), F.col("rows")), 6).alias("null_pct"),
        "n_distinct",
        F.element_at(types, F.col("column")).alias("type"),
    )


def _as_text(f: T.StructField) -> Column:
    c = F.col(quoted(f.name))
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return (missing_if_nan(c) + F.lit(0.0)).cast("string")
    return c.cast("string")


def high_null(profile: DataFrame, limit_pct: float = 20.0) -> DataFrame:
    return profile.where(F.col("null_pct") > limit_pct)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, mean, sample deviation, smallest and greatest value per numeric column, one pass."""
    known = [missing_if_nan(F.col(quoted(c))) for c in columns]
    row = df.agg(
        F.array(*[F.count(v) for v in known]).alias("n_known"),
        F.array(*[F.avg(v) for v in known]).alias("mean"),
        F.array(*[F.stddev_samp(v) for v in known]).alias("std"),
        F.array(*[F.min(v) for v in known]).alias("min"),
        F.array(*[F.max(v) for v in known]).alias("max"),
    )
    return _long(row, columns, {"n_known": [], "mean": [], "std": [], "min": [], "max": []})


def correlation_ranking(
    df: DataFrame, columns: Sequence[str], target: str, minimum: int = 20
) -> DataFrame:
    """Pearson correlation of each column with the target over rows where both are known.

    Columns with fewer than ``minimum`` such rows or a single value are left out. All columns share
    one aggregate. A constant target gives null (``corr`` itself would raise on a zero variance).
    """
    y = missing_if_nan(F.col(quoted(target)))
    pairs = [(F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)) for x in
             [missing_if_nan(F.col(quoted(c))) for c in columns]]
    row = df.agg(
        F.array(*[F.count(F.when(y.isNotNull(), x)) for x, _ in pairs]).alias("n"),
        F.array(*[F.min(x) != F.max(x) for x, _ in pairs]).alias("varies"),
        F.array(*[F.covar_pop(x, t) for x, t in pairs]).alias("cov"),
        F.array(*[F.stddev_pop(x) * F.stddev_pop(t) for x, t in pairs]).alias("dev"),
    )
    ranked = _long(row, columns, {"n": [], "varies": [], "cov": [], "dev": []})
    corr = F.try_divide("cov", "dev")
    return (
        ranked.where((F.col("n") >= minimum) & F.col("varies"))
        .select("column", corr.alias("correlation"), F.abs(corr).alias("abs_correlation"))
    )


@dataclass(frozen=True)
class Rule:
    """A quality rule: which test on which column, and when a value breaks it."""

    test: str
    column: str
    low: float | None = None
    high: float | None = None
    allowed: Sequence[float] | None = None

    def broken(self) -> Column:
        value = F.col(quoted(self.column)).try_cast("double")
        if self.allowed is not None:
            return ~value.isin(*[float(x) for x in self.allowed])
        return (value < F.lit(self.low)) | (value > F.lit(self.high))


def in_range(column: str, low: float, high: float, test: str = "faixa_0_100") -> Rule:
    return Rule(test, column, low=low, high=high)


def binary(column: str, test: str = "validacao_binaria_0_1") -> Rule:
    return Rule(test, column, allowed=(0, 1))


def distinct_rows(df: DataFrame, copies: str = "_copies") -> DataFrame:
    """Different rows, each with the number of its copies."""
    return df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count("*").alias(copies))


def quality_report(
    df: DataFrame, table: str, rules: Sequence[Rule], rows_before: int | None = None, copies: str | None = None
) -> DataFrame:
    """Long report of duplicates removed, nulls per column and rule violations.

    Nulls break no rule; rules on absent columns report 0. One aggregate covers the whole table.
    ``rows_before`` is the row count before exact duplicates were dropped from ``df``, or ``copies`` names a column with
    how many equal rows each row stands for (``distinct_rows``), so that one pass over the source gives both.
    """
    tests = [("valores_nulos", c, F.count_if(F.col(quoted(c)).isNull())) for c in df.columns if c != copies]
    for r in rules:
        hits = F.count_if(r.broken()) if r.column in df.columns else F.lit(0).cast("long")
        tests.append((r.test, r.column, hits))
    before = F.lit(rows_before).cast("long") if rows_before is not None else F.sum(copies) if copies else F.count("*")
    tests.insert(0, ("duplicatas_removidas", "", before - F.count("*")))

    row = df.agg(F.array(*[F.coalesce(n, F.lit(0)) for _, _, n in tests]).alias("result"))
    names = F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).alias("column")) for t, c, _ in tests])
    long = row.select(F.explode(F.arrays_zip(names.alias("name"), "result")).alias("q"))
    test, result = F.col("q.name.test"), F.col("q.result")
    status = (
        F.when(test == "valores_nulos", "INFO")
        .when(result == 0, "OK")
        .when(test == "duplicatas_removidas", "AJUSTADO")
        .otherwise("ERRO")
    )
    return long.select(
        F.lit(table).alias("tabela"),
        test.alias("teste"),
        F.col("q.name.column").alias("coluna"),
        result.alias("resultado"),
        status.alias("status"),
    )



def numeric_shares(df: DataFrame, columns: Sequence[str], number) -> dict[str, float | None]:
    """Share of the non-null texts that ``number`` can parse, for all columns in one pass."""
    if not columns:
        return {}
    row = df.agg(
        *[F.try_divide(F.count(number(F.col(quoted(c)))), F.count(quoted(c))).alias(f"s{i}")
          for i, c in enumerate(columns)]
    ).first()
    return {c: row[f"s{i}"] for i, c in enumerate(columns)}


def coerce_numeric(
    df: DataFrame, protected: Sequence[str] = (), threshold: float = 0.95, drop_dots: bool = False,
    protected_terms: Sequence[str] = (),
) -> DataFrame:
    """Turn text columns into numbers where at least ``threshold`` of their values parse.

    Decides by one aggregate, then converts by one projection. Protected columns and those whose
    name holds a protected term keep their type, as do columns without any value.
    """
    def number(c: Column) -> Column:
        text = trim_all(c)
        if drop_dots:
            text = F.replace(text, F.lit("."), F.lit(""))
        return parse_plain(F.replace(text, F.lit(","), F.lit(".")))

    texts = [
        f.name for f in df.schema
        if isinstance(f.dataType, T.StringType)
        and f.name not in protected
        and not any(t in f.name for t in protected_terms)
    ]
    shares = numeric_shares(df, texts, number)
    chosen = {c: number(F.col(quoted(c))) for c in texts if shares[c] is not None and shares[c] >= threshold}
    return df.withColumns(chosen) if chosen else df


# Name parts of identifiers that must stay text.
IDENTIFIER_TERMS = ("id_", "codigo", "cod_", "inep", "cpf", "cep")


def numeric_when_safe(df: DataFrame) -> DataFrame:
    return coerce_numeric(df, threshold=0.90, drop_dots=True, protected_terms=IDENTIFIER_TERMS)


def feature_report(
    df: DataFrame,
    target: str,
    audit: Sequence[str],
    kept: Sequence[str],
    constant: Sequence[str],
    reasons: Mapping[str, str],
    texts: Mapping[str, str],
) -> DataFrame:
    """What became of every column and why, next to its profile.

    ``texts`` holds the reasons for ``target``, ``audit``, ``feature``, ``constant`` and ``other``.
    """
    rows = []
    for c in df.columns:
        if c == target:
            rows.append((c, "target", texts["target"]))
        elif c in audit:
            rows.append((c, "auditoria/grupo", reasons.get(c, texts["audit"])))
        elif c in kept:
            rows.append((c, "feature", texts["feature"]))
        elif c in constant:
            rows.append((c, "excluida", texts["constant"]))
        else:
            rows.append((c, "excluida", reasons.get(c, texts["other"])))
    # One row per column of the table: a schema-sized side.
    fate = df.sparkSession.createDataFrame(rows, "column string, status string, reason string")
    return column_profile(df).join(F.broadcast(fate), "column").select(
        F.col("column").alias("coluna"),
        F.col("status"),
        F.col("reason").alias("motivo"),
        F.col("type").alias("dtype_original"),
        F.col("nulls").alias("nulos"),
        F.round("null_pct", 2).alias("nulos_pct"),
        F.col("n_distinct").alias("unicos"),
    )
