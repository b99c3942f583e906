import hashlib
from collections import defaultdict

import pytest

from lavra.llm import mixing
from tests.llm.data import SCHEMA, clashing, odd_rows, prose


def plain(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by raising the level until no source is above its limit, then one queue after time."""
    size = [len(r[1].encode().split()) if r[1] else 0 for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size):
        total[r[3]] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped, level = set(), 0.0
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            break
        level = (share * sum(size) - sum(most * total[s] for s in stopped)) / sum(weight[s] for s in free)
        more = {s for s in free if most * total[s] <= level * weight[s]}
        if not more:
            break
        stopped |= more
    target = {s: min(most * total[s], level * weight[s]) for s in order}
    return size, total, target


def test_targets_and_shares(spark):
    import random

    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "é", "z", None]), 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in mixing.schedule(docs).collect()}
    size, total, target = plain(rows)
    taken = defaultdict(int)
    for r, n in zip(rows, size):
        got = found[r[0]]
        assert (got.size, got.source_size) == (n, total[r[3]]) and got.target == pytest.approx(target[r[3]])
        assert 0 <= got.taken <= 2 * n
        taken[r[3]] += got.taken
    assert sum(taken.values()) == int(1.5 * sum(size))
    for s in total:
        assert abs(taken[s] - target[s]) <= 60
    again = {r.doc_id: r.taken for r in mixing.schedule(docs.repartition(7)).collect()}
    assert again == {k: r.taken for k, r in found.items()}


def test_key_is_the_leading_bits_of_an_md5(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("7", None)], "a string, b string")
    key = df.select(mixing.shuffle_key([F.col("a"), F.col("b")], "mix")).first()[0]
    assert key == int(hashlib.md5(b"mix|7|\\N").hexdigest()[:15], 16)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    found = mixing.schedule(docs)
    assert set(found.columns) == set(docs.columns) | {"source_size", "target", "finish"}
    got = found.select("doc_id", "size", "taken").collect()
    size, _, _ = plain(rows)
    assert sorted((str(r[0]), n) for r, n in zip(rows, size)) == sorted((str(r.doc_id), r.size) for r in got)
    assert sum(r.taken for r in got) == int(1.5 * sum(size))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    turns = sum(int(2 * r.taken >= r.size) + int(r.taken >= 1.5 * r.size) for r in got if r.taken)
    assert mixed.count() == turns


def test_empty_and_wordless(spark):
    assert mixing.schedule(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, "a", None), (2, " ", None, None, 1)]
    found = mixing.schedule(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2
    assert mixing.mix(spark.createDataFrame(rows, SCHEMA)).count() == 0
