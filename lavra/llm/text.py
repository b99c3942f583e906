"""Text expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def spaced_words(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.array_remove(F.split(text, SPACE + "+"), ""), F.array().cast("array<string>"))


def columns_of(df, but: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in but]
