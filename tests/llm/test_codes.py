import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lavra.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _row int"


def plain(rows, entries=256, rounds=4, parts=4):
    """Codes, errors and codebooks by loops over Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    values = [(r[0], r[2], [math.floor(1024 * x) for x in r[1]]) for r in kept]
    width = len(values[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in values]
    first = [c for _, c in sorted(zip([v[0] for v in values], cut))][:entries]
    books = [[list(c[p]) for c in first] for p in range(parts)]

    def near(p, part):
        far = [(sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p])]
        return min(far)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(near(p, c[p])[1], []).append(c[p])
            for i, m in members.items():
                books[p][i] = [sum(x) // len(m) for x in zip(*m)]
    out = []
    for (key, label, _), c in zip(values, cut):
        best = [near(p, c[p]) for p in range(parts)]
        out.append((key, label, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    sums = {}
    for _, label, _, e in out:
        sums[label] = sums.get(label, 0) + e
    told = ",".join(str(x) for b in books for e in b for x in e)
    return sorted((k, c, e, sums[la]) for k, la, c, e in out), hashlib.sha256(told.encode()).hexdigest()


def vectors(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [float(np.float32(rng.gauss(0, 0.2))) for _ in range(8)]
        rows.append((i, v if rng.random() < 0.8 else [round(x, 1) for x in v], rng.choice([None, 1, 2]), "x", 0))
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_codes_are_those_of_plain_loops(spark, partitions):
    rows = [(i, [float(np.float32(x)) for x in v], *r) for i, v, *r in vectors(120)]
    odd = [(900, None, 1, "x", 0), (901, [float("nan")] * 8, 1, "x", 0), (902, [None] + [0.5] * 7, 2, "x", 0),
           (903, [float("-inf")] + [0.5] * 7, None, "x", 0), rows[3]]
    table = spark.createDataFrame(rows + odd, SCHEMA).repartition(partitions)
    got, books = codes.compress(table, entries=16)
    want, digest = plain(rows + odd, 16)
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want
    assert codes.digest(books) == digest
    assert set(got.columns) == set(table.columns) | {"error", "label_error"}


def test_vectors_that_cannot_be_coded(spark):
    rows = vectors(20) + [(50, [0.1] * 4, 1, "x", 0), (51, [], 1, "x", 0), (52, [1e30] * 8, None, "x", 0), (None, [0.2] * 8, 1, "x", 0)]
    got = {r.vec_id: r for r in codes.compress(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    assert len(got) == 24 and all(got[i].code is None and got[i].error is None for i in (50, 51, 52))
    assert got[None].code is not None and got[50].label_error is not None


def test_empty_and_unfit_tables(spark):
    assert codes.compress(spark.createDataFrame([], SCHEMA))[0].count() == 0
    rows = spark.createDataFrame([(1, [0.1] * 3, 1, "x", 0), (2, None, None, "x", 0)], SCHEMA)
    assert [(r.vec_id, r.code, r.label_error) for r in codes.compress(rows)[0].collect()] == [(1, None, None)]


def test_fewer_vectors_than_entries_are_their_own_codes(spark):
    got, books = codes.compress(spark.createDataFrame(vectors(10), SCHEMA).where(F.col("vec_id") < 5))
    assert books.shape == (4, 5, 2) and [r.error for r in got.collect()] == [0] * 5


def test_wide_values_use_wide_sums():
    values = np.array([[1 << 23, 0], [-(1 << 23), 5], [3, -4]])
    books = np.array([[[1 << 23, 0], [0, 0]]])
    found, errors = codes.nearest(values, books)
    assert found.ravel().tolist() == [0, 1, 1] and errors.ravel().tolist() == [0, (1 << 46) + 25, 25]
