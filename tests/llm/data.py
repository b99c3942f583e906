"""Rows that every operator has to take: nulls, empty and odd texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, vocabulary: int = 300) -> str:
    out = []
    for i in range(words):
        out.append(f"w{rng.randrange(vocabulary)}" + ("\n" if rng.random() < 0.1 else ""))
    return " ".join(out)


def odd_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    texts = [prose(rng, n) for n in (5, 12, 40, 90, 200)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(20, None, None, None, None), (21, "", "en", "s0", 0), (22, " \t\n\r\x0b\x0c ", "de", "s1", 6)]
    rows += [(None, texts[2], None, "s1", None), (None, prose(rng, 30), "fr", None, 3)]
    rows += [(30, texts[3], "en", "s2", 9), (31, texts[3], "en", "s2", 9), (31, texts[3], "en", "s2", 9)]
    rows += [(32, texts[4] + " tail words here", "en", "s0", 1), (32, prose(rng, 50), "en", "s0", 1)]
    rows += [(40, "ÉÀ ß漢字   x\x1cy É É É É É É", "fr", "s1", 5), (41, "A a A a " * 40, "en", "s2", 5)]
    rows += [(42, "z" * 30000 + " " + prose(rng, 3000), "en", "s2", 5)]
    return rows


def clashing(df):
    """The table with extra columns whose names the operators use inside or return."""
    from pyspark.sql import functions as F

    names = ("size", "shard", "taken", "fingerprint", "_row", "_doc", "_text", "n_words", "kept", "host", "_id", "a b")
    return df.withColumns({n: F.lit(n) for n in names})
