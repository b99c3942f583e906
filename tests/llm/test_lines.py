import random
import tracemalloc
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from lavra.llm import lines
from tests.llm.data import SCHEMA, clashing, odd_rows

LAST = (1 << 63) - 1


def plain(rows):
    every = []
    for n, r in enumerate(rows):
        for i, line in enumerate(r[1].encode().split(b"\n") if r[1] is not None else []):
            every.append((LAST if r[0] is None else r[0], i, n, frozenset(line.split())))
    gone = [[] for _ in rows]
    for key, i, n, words in every:
        if words and any(
            (k, j) < (key, i) and w and Fraction(len(w & words), len(w | words)) >= Fraction(4, 5) for k, j, _, w in every
        ):
            gone[n].append(i)
    return gone


def random_rows(seed):
    rng = random.Random(seed)
    base = [[f"v{rng.randrange(60)}" for _ in range(rng.randrange(1, 25))] for _ in range(25)]
    rows = []
    for i in range(50):
        out = []
        for _ in range(rng.randrange(1, 7)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = f"u{rng.randrange(40)}"
            if rng.random() < 0.2:
                line.append(f"t{rng.randrange(40)}")
            out.append(" ".join(line))
        rows.append((rng.randrange(80), "\n".join(out), "en", "s", 1))
    return rows


@pytest.mark.parametrize("first", [4, 1])
def test_removed_lines(spark, first):
    rows = random_rows(9)
    found = {}
    for r in lines.removed_lines(spark.createDataFrame(rows, SCHEMA), first=first).collect():
        found.setdefault(r["_id"], set()).add(tuple(r["_removed"]))
    expected = {}
    for r, gone in zip(rows, plain(rows)):
        if gone:
            expected.setdefault(r[0], set()).add(tuple(gone))
    assert found == expected


def test_long_lists_give_the_same(spark):
    rng = random.Random(1)
    common = [f"c{i}" for i in range(12)]
    rows = [(i, " ".join([*common, f"x{i}", f"y{rng.randrange(5)}"]), "en", "s", 1) for i in range(80)]
    found = lines.mark_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.removed for r in found} == {r[0]: g for r, g in zip(rows, plain(rows))}


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    found = lines.mark_lines(docs)
    assert set(found.columns) == set(docs.columns) | {"n_lines", "n_removed", "removed"}
    got = sorted((str(r.doc_id), r.n_lines, str(r.removed)) for r in found.collect())
    count = [0 if r[1] is None else r[1].count("\n") + 1 for r in rows]
    assert got == sorted((str(r[0]), c, str(g)) for r, c, g in zip(rows, count, plain(rows)))
    cut = lines.remove_lines(docs)
    assert cut.columns == docs.columns
    kept = ["\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in g) if r[1] is not None else None for r, g in zip(rows, plain(rows))]
    assert sorted(str(r.text) for r in cut.collect()) == sorted(map(str, kept))
    assert lines.mark_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_list_of_template_lines_keeps_only_the_nearest():
    """Thousands of lines in one list: each has thousands of candidates, and keeps four."""
    n = 6000
    rows = {
        "word": np.full(n, 7), "name": np.arange(n), "sketch": np.arange(n) % 3, "doc": np.arange(n), "place": np.zeros(n, np.int64),
        "where": np.full(n, 10 << 32 | 2), "asked": np.ones(n, bool),
    }
    tracemalloc.start()
    out = lines._match(rows, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    doc, _, other, _, more = out
    assert len(doc) == 4 * n - 10 and more.sum() > 3 * n and peak < 300 << 20
    assert (other[doc == 100] % 3 == 1).all() and sorted(other[doc == 100]) == [1, 4, 7, 10]


def test_rows_of_lists_come_sorted_by_word_only():
    """A list's rows are ordered where they are compared, and what is alone under its word takes no part; copies stay."""
    rng = np.random.default_rng(2)
    n = 400
    rows = {
        "word": np.sort(rng.integers(0, 150, n)), "name": rng.integers(0, 30, n), "sketch": np.zeros(n, np.int64), "doc": rng.permutation(n),
        "place": np.zeros(n, np.int64), "where": np.where(rng.random(n) < 0.1, 10 << 32, 10 << 32 | 2), "asked": np.ones(n, bool),
    }
    order = np.lexsort([rows[k] for k in ("place", "doc", "name", "word")])
    whole = lines._match({k: v[order] for k, v in rows.items()}, 4, True)
    assert set(zip(*(x.tolist() for x in lines._match(lines._ordered(rows), 4, True)))) == set(zip(*(x.tolist() for x in whole)))
    number = dict(zip(*np.unique(rows["word"], return_counts=True)))
    left = lines._ordered(rows)
    assert all(number[w] > 1 or at == 10 << 32 for w, at in zip(left["word"], left["where"])) and len(left["word"]) < n


def test_words_that_occur_once_are_not_posted_and_marked_lists_are_posted_alone():
    texts = [" ".join([*(f"c{k}" for k in range(12)), f"only{i}"]) for i in range(3)]
    part = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(3)), pa.array(range(3))], ["_text", "_id", "_hash"])
    levels = np.full(lines.CELLS, 16, np.uint8)
    once = lines._cell(lines.word_hashes(pa.array([f"only{i}" for i in range(3)]))[0])
    levels[once] = lines.ONCE
    every = pa.Table.from_batches(lines._post(SimpleNamespace(value=levels))(iter([part])))
    # Three words of thirteen are a prefix: one is each line's own. A row more is the whole set's.
    assert every.num_rows == 3 * (3 - 1) + 3
    marked = np.zeros(lines.CELLS, np.uint8)
    word = every.column("word").to_numpy()[every.column("where").to_numpy() & 0xFFFFFFFF > 1]
    marked[lines._cell(word[:1])] = 1
    again = pa.Table.from_batches(lines._post(SimpleNamespace(value=levels), SimpleNamespace(value=marked))(iter([part])))
    assert set(again.column("word").to_pylist()) == {int(word[0])}


def test_a_line_with_many_variants_at_its_own_place_meets_earlier_ones(spark):
    """Rows that repeat a key are one document: variants of a line at its own place are no candidates, and leave room for those that are."""
    common = [f"c{i}" for i in range(40)]
    rows = [(7, " ".join([*common, f"x{i}"]), "en", "s", 1) for i in range(12)] + [(3, " ".join([*common[:38], "a", "b", "c"]), "en", "s", 1)]
    found = {tuple(r["_removed"]) for r in lines.removed_lines(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()}
    gone = lines.mark_lines(spark.createDataFrame(rows, SCHEMA)).where("doc_id = 7").collect()
    assert found == {(0,)} and [r.removed for r in gone] == [[0]] * 12
