"""Text to number, tolerant of decimal commas and of sentinel texts. Failures are null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions.text import clean_text, first_match, trim_all

# What counts as a number. Java's own parser would also take forms such as "1d".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Sentinels of the statistics tables.
ZERO_WORDS = ("-",)
MISSING_WORDS = ("...", "..", "X", "x")


def parse_plain(c: Column) -> Column:
    return F.regexp_extract(c, NUMBER, 0).try_cast("double")


def parse_comma(c: Column) -> Column:
    """``1.234,5`` -> 1234.5: dots group thousands, the comma marks the decimals."""
    return parse_plain(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def to_number(c: Column) -> Column:
    """Comma form for texts that hold a comma, plain form for all others."""
    text = clean_text(c)
    return F.when(F.contains(text, F.lit(",")), parse_comma(text)).otherwise(parse_plain(text))


def to_int(c: Column, on_fraction: str = "error") -> Column:
    """Nullable whole number. A fractional value raises, or is null with ``on_fraction='null'``."""
    value = parse_plain(clean_text(c))
    complaint = F.raise_error(F.concat(F.lit("not a whole number: "), c)).cast("long")
    other = F.lit(None).cast("long") if on_fraction == "null" else complaint
    return F.when(value % 1 != 0, other).otherwise(value.try_cast("long"))


def parse_numeric(
    c: Column,
    zero: Sequence[str] = ZERO_WORDS,
    missing: Sequence[str] = MISSING_WORDS,
) -> Column:
    """Plain form first; the comma form only for texts that the plain form rejects."""
    text = trim_all(c)
    value = F.coalesce(parse_plain(text), parse_comma(text))
    return F.when(text.isin(*missing), None).when(text.isin(*zero), 0.0).otherwise(value)


def missing_if_nan(c: Column) -> Column:
    """Missing is null, never NaN."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def year_in(c: Column, pattern: str = r"(\d{4})") -> Column:
    """Year found in a label; null when there is none."""
    return first_match(c, pattern, 1).try_cast("int")
