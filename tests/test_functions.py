"""Column functions on the edge rows they must get right."""

import math

import pytest
from pyspark.sql import functions as F

from lavra.functions import indicators as ind
from lavra.functions.numbers import missing_if_nan, parse_numeric, to_int, to_number, year_in
from lavra.functions.text import (
    clean_strings, clean_text, file_name_of_url, normalize_code, normalize_columns, normalize_label,
    normalize_names, strip_accents,
)


def values(spark, rows, schema, *columns):
    """Results in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    found = df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).collect()
    out = [tuple(r)[1:] for r in sorted(found, key=lambda r: r["i"])]
    return [r[0] for r in out] if len(columns) == 1 else out


def texts(spark, inputs, *columns):
    return values(spark, [(x,) for x in inputs], "s string", *columns)


def test_clean_text(spark):
    inputs = [" a ", "", " ", "nan", "None", "NULL", "null", "NaN", None, " b ", " nan "]
    assert texts(spark, inputs, clean_text(F.col("s"))) == [
        "a", None, None, None, None, None, "null", "NaN", None, "b", None
    ]


def test_clean_strings_leaves_other_types(spark):
    df = clean_strings(spark.createDataFrame([(" x ", 1.5)], "`a b` string, n double"))
    assert df.columns == ["a b", "n"] and tuple(df.first()) == ("x", 1.5)


def test_normalize_code_keeps_or_drops_empty(spark):
    inputs = ["2927408.0", "12", "123456789", None, "CO_MUNICIPIO", " 12.0 ", "NULL"]
    keep = normalize_code(F.col("s"), 7)
    drop = normalize_code(F.col("s"), 7, empty_to_null=True)
    raw = normalize_code(F.col("s"), 7, clean=False)
    assert texts(spark, inputs, keep, drop, raw) == [
        ("2927408",) * 3,
        ("0000012",) * 3,
        ("123456789",) * 3,
        (None,) * 3,
        ("0000000", None, "0000000"),
        ("0000012",) * 3,
        (None, None, "0000000"),
    ]


def test_to_number(spark):
    inputs = ["1.234,56", "1234.56", "1.234", "abc", None, " 5 ", "1d", "1e3", "-2,5", "."]
    assert texts(spark, inputs, to_number(F.col("s"))) == [
        1234.56, 1234.56, 1.234, None, None, 5.0, None, 1000.0, -2.5, None
    ]


def test_parse_numeric(spark):
    inputs = ["-", "...", "..", "X", "x", "1.234,5", "1.234", "y", None, " 7 "]
    assert texts(spark, inputs, parse_numeric(F.col("s"))) == [
        0.0, None, None, None, None, 1234.5, 1.234, None, None, 7.0
    ]


def test_to_int(spark):
    assert texts(spark, ["3", "4.0", None, "x", ""], to_int(F.col("s"))) == [3, 4, None, None, None]
    assert texts(spark, ["2.5"], to_int(F.col("s"), on_fraction="null")) == [None]
    with pytest.raises(Exception, match="whole number"):
        texts(spark, ["2.5"], to_int(F.col("s")))


def test_year_and_nan(spark):
    assert texts(spark, ["pct_2023", "none"], year_in(F.col("s"))) == [2023, None]
    assert values(spark, [(math.nan,), (1.0,), (None,)], "x double", missing_if_nan(F.col("x"))) == [None, 1.0, None]


def test_labels_and_names(spark):
    inputs = ["São Paulo / SP", "  Ação--2024 ", "é", "Çedilha"]
    assert texts(spark, inputs, normalize_label(F.col("s"))) == ["sao_paulo_sp", "acao_2024", "e", "cedilha"]
    assert texts(spark, ["ÀÉÎõü ß"], strip_accents(F.col("s"))) == ["AEIou ß"]
    assert normalize_names(["Ano", "ano ", "%", "%", "Código UF"]) == ["ano", "ano_2", "coluna", "coluna_2", "codigo_uf"]
    assert normalize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a-b` int")).columns == ["a_b", "a_b_2"]


def test_file_name_of_url(spark):
    inputs = ["https://x.org/a/b.zip?q=1", "https://x.org/", "https://x.org"]
    assert texts(spark, inputs, file_name_of_url(F.col("s"), "spare")) == ["b.zip", "spare", "spare"]


def test_flags_keep_null(spark):
    a, b = F.col("a"), F.col("b")
    rows = [(5.0, 5.0), (4.0, 5.0), (None, 5.0), (5.0, None)]
    assert values(spark, rows, "a double, b double", ind.attained(a, b)) == [1, 0, None, None]
    assert values(spark, rows, "a double, b double", ind.change(a, b)) == [0.0, -1.0, None, None]
    assert values(spark, rows, "a double, b double", ind.diverges(a, b)) == [0, 1, None, None]
    assert values(spark, [(743.0,), (742.99,), (None,)], "a double", ind.reaches(a, 743)) == [1, 0, None]
    assert values(spark, [(1,), (2,), (None,)], "a int", ind.category_flag(a, 1)) == [1.0, 0.0, 0.0]
    assert values(spark, [("1",), ("0",), ("2",), ("x",), (None,)], "a string", ind.inverse_target(a)) == [0, 1, None, None, None]


def test_shares(spark):
    a, b = F.col("a"), F.col("b")
    rows = [(1.0, 3.0), (0.0, 0.0), (None, 1.0)]
    assert values(spark, rows, "a double, b double", ind.share(a, b)) == [25.0, None, None]
    assert values(spark, [(2.0, 4.0), (1.0, 0.0)], "a double, b double", ind.per_capita(a, b)) == [500.0, None]
    assert values(spark, [(1.0, 3.0)], "a double, b double", ind.percent(a, b, 2)) == [33.33]
