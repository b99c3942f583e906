import hashlib
import random

import numpy as np
import pytest

from lavra.llm import substrings
from lavra.llm.fmindex import FMIndex
from tests.llm.data import SCHEMA, clashing, odd_rows, prose


def plain(rows, window):
    """Kept words of each row: windows compared with all earlier starts."""
    words = [r[1].encode().split() if r[1] else [] for r in rows]
    number = [substrings.LAST if r[0] is None else r[0] for r in rows]
    first = {}
    for n, w in zip(number, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (n, i)), (n, i))
    out = []
    for n, w in zip(number, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (n, i):
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_fm_index_against_all_substrings():
    rng = random.Random(1)
    for _ in range(150):
        text = np.array([rng.choice([0, 1, 1, 2, 2, 3]) for _ in range(rng.randint(2, 70))] + [1, 0])
        length = rng.randint(1, 5)
        longest, start, first = FMIndex(text, length).repeated(length)
        words = {i: tuple(text[i : i + length]) for i in range(len(text) - length + 1)}
        expected = {}
        for i, w in words.items():
            places = [j for j, x in words.items() if x == w]
            if 0 not in w and len(places) > 1:
                expected[i] = places[0]
        assert dict(zip(start.tolist(), first.tolist())) == expected
        for end in range(len(text)):
            best = 0
            for n in range(1, min(length, end + 1) + 1):
                w = tuple(text[end - n + 1 : end + 1])
                if 0 in w or sum(tuple(text[j : j + n]) == w for j in range(len(text) - n + 1)) < 2:
                    break
                best = n
            assert longest[end] == best


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    words = np.array([rng.getrandbits(64) for _ in range(500)], np.uint64)
    words[100:200] = words[0]
    counts = np.array([60, 5, 0, 200, 235])
    text, start, windows, _, _ = substrings.segments(words, counts, 20, 8)
    held = [(t, s + i) for t, s, w in zip(text, start, windows) for i in range(w)]
    assert sorted(held) == [(t, i) for t, c in enumerate(counts) for i in range(max(0, c - 19))]


@pytest.mark.parametrize("hot", [False, True])
def test_removal(spark, hot, monkeypatch):
    rng = random.Random(6)
    shared = [prose(rng, 26, 9) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(0, 30), 400)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng, rng.randrange(0, 15), 400)]
        rows.append((i * 3 % 61, " ".join(parts), "en", "s", 1))
    rows += [(70, "a " * 50, "en", "s", 1), (71, "a " * 30 + "b", "en", "s", 1), rows[5], (200, rows[7][1], "en", "s", 1)]
    if hot:  # All anchors are dealt out window by window.
        monkeypatch.setattr(substrings, "HOT_WORDS", 0)
    for window, gram in ((20, 8), (8, 3)):
        found = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), window=window, gram=gram)
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect())
        assert got == sorted((r[0], *x) for r, x in zip(rows, plain(rows, window)))


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    found = substrings.remove_repeats(docs)
    assert set(found.columns) == set(docs.columns) | {"n_removed"}
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found.collect())
    expected = [(str(r[0]), n, gone, hashlib.sha256(kept.encode()).hexdigest()) for r, (n, gone, kept) in zip(rows, plain(rows, 20))]
    assert got == sorted(expected)
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
