"""Text cleaning, code normalisation and label normalisation as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "missing" after trimming (exact, case-sensitive), besides "".
BLANK_WORDS = ("nan", "None", "NULL")

# Trimmed text in group 1; no match for blank texts and blank words.
CLEAN = rf"(?sU)^\s*+(?!(?:{'|'.join(BLANK_WORDS)})?\s*\z)(.*?)\s*\z"

# The functions below name their input once wherever they can: an expression that names its input
# three times, nested three deep, is evaluated 27 times wherever Spark cannot share the parts
# (conditional branches, filters, join keys).


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, null without one."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), 0)


def trim_all(c: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    return first_match(c, CLEAN, 1)


def clean_strings(df: DataFrame) -> DataFrame:
    """``clean_text`` on every string column."""
    return df.select(
        *[
            clean_text(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema
        ]
    )


def zero_pad(c: Column, width: int) -> Column:
    """Pad with zeros on the left; longer texts stay whole (``lpad`` alone would cut them).

    Zeros are put in front, then at most as many are taken off, down to ``width`` characters.
    """
    return F.regexp_replace(F.concat(F.lit("0" * width), c), f"(?s)^0{{0,{width}}}(?=.{{{width}}})", "")


def normalize_code(
    c: Column, width: int | None = None, clean: bool = True, empty_to_null: bool = False
) -> Column:
    """Digits of a code, zero-padded to ``width``.

    A trailing ``.0`` is dropped first. With ``clean`` the blank words become null before that.
    A text without any digit is padded like any other one, or becomes null with ``empty_to_null``.
    Texts that are digits already, as most are, take a short cut past all of this.
    """
    text = clean_text(c) if clean else trim_all(c)
    digits = F.regexp_replace(text, r"\.0$|\D", "")
    if empty_to_null:
        digits = first_match(digits, "^.+$")
    if width is None:
        return digits
    padded = F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))
    return F.when(c.rlike("^[0-9]+$"), padded).otherwise(zero_pad(digits, width))


def _accent_pairs() -> tuple[str, str]:
    accented, plain = [], []
    for point in range(0x00C0, 0x0250):
        char = chr(point)
        base = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
        if base != char and len(base) == 1:
            accented.append(char)
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _accent_pairs()


def strip_accents(c: Column) -> Column:
    """Latin letters without their accents, precomposed or with combining marks."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{Mn}+", "")


def normalize_label(c: Column) -> Column:
    """Lower-case label made of ``a-z0-9`` runs joined by one underscore."""
    joined = F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def normalize_name(name: str) -> str:
    """``normalize_label`` for a column name, on the driver."""
    decomposed = unicodedata.normalize("NFKD", str(name))
    plain = "".join(x for x in decomposed if not unicodedata.combining(x))
    return re.sub("[^a-z0-9]+", "_", plain.lower()).strip("_")


def normalize_names(names: Iterable[str], empty: str = "coluna") -> list[str]:
    """Normalised names; the second and later uses of a name get ``_2``, ``_3`` ..."""
    uses: dict[str, int] = {}
    out = []
    for name in names:
        base = normalize_name(name) or empty
        uses[base] = uses.get(base, 0) + 1
        out.append(base if uses[base] == 1 else f"{base}_{uses[base]}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def file_name_of_url(url: Column, fallback: str) -> Column:
    """Last path element of a URL, or ``fallback`` when the path ends in ``/`` or is empty."""
    path = F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "/+$", "")
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name != "", name).otherwise(F.lit(fallback))


def quoted(name: str) -> str:
    """A column name that is safe to look up even with dots or blanks in it."""
    return "`" + name.replace("`", "``") + "`"
