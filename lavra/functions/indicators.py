"""Indicators that keep null as null: differences, flags, shares, per-capita values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def change(now: Column, before: Column) -> Column:
    return now - before


def attained(value: Column, goal: Column) -> Column:
    """1 when ``value`` reaches ``goal``, else 0; null unless both are known."""
    return (value >= goal).cast("int")


def reaches(value: Column, cutoff: float) -> Column:
    """1 at or above a fixed cut-off, else 0; null stays null."""
    return (value >= F.lit(cutoff)).cast("int")


def diverges(a: Column, b: Column) -> Column:
    """1 when two flags differ, else 0; null unless both are known."""
    return (a != b).cast("int")


def inverse_target(value: Column) -> Column:
    """``1 - value`` for 0/1 values; anything else is null and is meant to be filtered out."""
    number = value.try_cast("double")
    return F.when(number.isin(0.0, 1.0), (1 - number).cast("int"))


def category_flag(code: Column, k: float) -> Column:
    """1.0 for the category, 0.0 otherwise, also when the code is missing."""
    return F.coalesce((code == F.lit(k)).cast("double"), F.lit(0.0))


def category_flags(code: Column, names: Mapping[str, float]) -> dict[str, Column]:
    return {name: category_flag(code, k) for name, k in names.items()}


def share(a: Column, b: Column, scale: float = 100.0) -> Column:
    """``scale * a / (a + b)``; null when the total is zero or unknown."""
    return F.try_divide(F.lit(scale) * a, a + b)


def per_capita(amount: Column, people: Column, unit: float = 1000.0) -> Column:
    return F.try_divide(amount * F.lit(unit), people)


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = F.try_divide(F.lit(100.0) * part, whole)
    return value if digits is None else F.round(value, digits)
