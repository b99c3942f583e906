import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lavra.llm import setjoin
from lavra.llm.lines import CELLS
from tests.llm.data import SCHEMA, clashing, odd_rows, prose
from tests.llm.test_simhash import classes


def plain(text, k=5):
    """The shingle set of a text."""
    words = text.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split() if text else []
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(rows):
    sets = [plain(t) for _, t in rows]
    places = range(len(rows))
    near = [(i, j) for i in places for j in places if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    same = classes(near, places)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[same[i]] = min(key, least.get(same[i], key))
    return sorted((str(key), len(sets[i]), str(least.get(same[i]))) for i, (key, _) in enumerate(rows))


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in setjoin.jaccard_components(docs, **options).collect())


def ids(rows, spark):
    """First keys of all components."""
    return sorted({int(c) for _, _, c in found(spark, rows)})


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    got = setjoin.jaccard_components(docs)
    assert set(got.columns) == set(docs.columns) | {"n_shingles", "component_id"}
    told = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect())
    assert told == components([(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    assert setjoin.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("heavy_from", [1, 8, 60, 10**6])
def test_any_boundary_gives_the_same(spark, monkeypatch, heavy_from):
    monkeypatch.setattr(setjoin, "boundary", lambda sets, percent: heavy_from)
    rng = random.Random(5)
    rows, line = [], prose(rng, 12, 50)
    for i in range(120):
        base = prose(rng, rng.choice([3, 5, 6, 8, 9, 12, 14, 40, 90]), 400).split() + (line.split() if i % 3 else [])
        rows.append((i, " ".join(base)))
        for k in range(rng.randrange(3)):
            words = list(base)
            words[rng.randrange(len(words))] = f"edit{k}"
            rows.append((1000 + 10 * i + k, " ".join(words if rng.random() < 0.5 else words[: -max(1, len(words) // 12)])))
    assert found(spark, rows) == components(rows)


def test_lists_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "LIST_ROWS", 3)
    rng = random.Random(6)
    base = prose(rng, 60, 5000).split()
    rows = [(i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]])) for i in range(50)]
    assert found(spark, rows) == components(rows)


def test_boundary_is_the_cheaper_way(spark):
    row = "node long, size long, light double, heavy double"
    few = spark.createDataFrame([(1, 8, 3.0, 500.0), (2, 64, 90.0, 20.0)], row)
    assert 8 < setjoin.boundary(few) <= 64
    assert setjoin.boundary(spark.createDataFrame([], row)) == 1


def test_sets_are_ordered_by_rarity():
    levels = np.zeros(1 << 22, np.uint8)
    texts = pa.array(["a b c d e f g", None, "A b c D e", "x"])
    value, doc, size = setjoin.distinct(texts, 5)
    assert size.tolist() == [3, 0, 1, 1] and value[doc == 2][0] in value[doc == 0]
    levels[setjoin._cell(value[doc == 2])] = 9
    value, doc, _ = setjoin.distinct(texts, 5, levels)
    assert value[doc == 0][-1] == value[doc == 2][0]


def test_near_copies_among_texts_of_one_fingerprint(spark):
    rng = random.Random(12)
    # Table rows: every other word is the same and decides all bits of a fingerprint of words.
    table = [" ".join(f"| {w}" for w in prose(rng, 80, 5000).split()) for _ in range(20)]
    near = [t.replace("| ", "| changed ", 1) for t in table[10:]]
    assert ids(list(enumerate(table)) + [(100 + i, t) for i, t in enumerate(near)], spark) == list(range(20))


@pytest.mark.parametrize("turns", [0, 4])
def test_long_lists_pass_over_no_pair(spark, monkeypatch, turns):
    monkeypatch.setattr(setjoin, "TURNS", turns)
    monkeypatch.setattr(setjoin, "BLOCK", 30)
    rng = random.Random(14)
    shared = prose(rng, 300, 5000).split()
    texts = []
    for _ in range(100):
        # Most of a text is common to all, but no two of them are near.
        texts.append(shared + prose(rng, 90, 10**6).split())
    near = [t[:-3] + ["other", "last", "words"] for t in texts[40:60]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(200 + i, " ".join(t)) for i, t in enumerate(near)]
    # A large group: each is near the others of it.
    base = prose(rng, 200, 5000).split()
    rows += [(1000 + i, " ".join([*base[:i], "edit", *base[i + 1 :]])) for i in range(150)]
    assert ids(rows, spark) == [*range(100), 1000]


def test_cut_and_extended_copies_are_found(spark):
    rng = random.Random(15)
    rows = []
    for i in range(120):
        words = prose(rng, rng.randrange(60, 600), 5000).split()
        less = int((len(words) - 4) * (0.81, 0.86, 0.9)[i % 3]) + 5
        rows.append((i, " ".join(words)))
        other = words[:less] if i % 2 else words + prose(rng, (len(words) - less) * 11 // 10, 5000).split()
        rows.append((1000 + i, " ".join(other)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    near = [i for i in range(120) if 5 * len(sets[i] & sets[1000 + i]) >= 4 * len(sets[i] | sets[1000 + i])]
    assert len(near) > 100
    assert ids(rows, spark) == [*range(120), *(1000 + i for i in range(120) if i not in near)]


def test_worker_memory_of_large_batches():
    """Marks of many texts take a few times a megabyte of them, and sets that meet a hub are not copied."""
    texts = pa.array([" ".join(f"w{(i * 7 + k) % 5000}" for k in range(200)) for i in range(4000)])
    packed = pa.array([np.arange(i, i + 3000, dtype=np.uint64).tobytes() for i in range(1000)])
    columns = [pa.array([1] * 1000), pa.array([0] * 1000), pa.array([i > 0 for i in range(1000)]), pa.array(range(1000)), packed]
    met = pa.RecordBatch.from_arrays(columns, ["hub", "part", "first", "node", "set"])
    tracemalloc.start()
    try:
        pairs = [r for found in setjoin._against_first(80)(iter([met])) for r in found.column("a").to_pylist()]
        assert pairs == [i for i in range(1, 1000) if 100 * (3000 - i) >= 80 * (3000 + i)]
        assert tracemalloc.get_traced_memory()[1] < 4 << 20
        assert len(setjoin._marks(texts, np.zeros(CELLS, np.uint8), 5, 80, 2)) == 4000
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


@pytest.fixture
def emitted(monkeypatch):
    """Rows that each comparison of lists gives."""
    rows, compared = [], setjoin._compared

    def counted(*args, **options):
        out = compared(*args, **options)
        rows.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "_compared", counted)
    return rows


def test_a_pair_of_many_lists_is_compared_once(spark, emitted):
    rng = random.Random(16)
    rows = []
    for i in range(12):
        words = prose(rng, 1000, 10**6).split()
        # Similarity of about 0.75: a candidate in each of the many lists that both are in, but no link.
        other = [f"edit{k}" if k % 35 == 17 else w for k, w in enumerate(words)]
        rows += [(i, " ".join(words)), (100 + i, " ".join(other))]
    # Either kind in splits of its own, so that the sketch of counts does not see what they share.
    rows.sort()
    assert found(spark, rows) == components(rows)
    assert 12 <= max(emitted) <= 24


@pytest.mark.parametrize("nearest", [True, False])
def test_nearest_of_each_set(nearest):
    n = 200
    bits = np.zeros((n, 512), np.uint8)
    bits[np.arange(n), np.arange(n)] = 1
    columns = {"list": [7] * n, "low": [0] * n, "high": [0] * n, "block": [0] * n, "node": list(range(n)), "root": list(range(n))}
    columns |= {"size": [300] * n, "at": [0] * n, "sketch": [np.packbits(b).tobytes() for b in bits]}
    batch = pa.RecordBatch.from_pydict(columns)
    got = [(r["a"], r["b"]) for out in setjoin._compare(80, nearest)(iter([batch.slice(0, 90), batch.slice(90)])) for r in out.to_pylist()]
    assert sorted(a for a, _ in got) == list(range(n)) if nearest else len(set(got)) == len(got) == n * (n - 1) // 2


def test_lists_of_the_same_sets(spark):
    rows = [(1, 10, 3), (1, 11, 4), (2, 10, 1), (2, 11, 2), (3, 10, 0), (3, 12, 0), (4, 12, 1)]
    lists = spark.createDataFrame([(a, n, 20, at) for a, n, at in rows], "list long, node long, size long, at long")
    assert sorted(r["list"] for r in setjoin._one_of_same(lists).select("list").distinct().collect()) == [2, 3]
