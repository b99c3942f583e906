import random

import numpy as np
import pytest
import xxhash

from lavra.llm import simhash
from lavra.llm.components import components
from tests.llm.data import SCHEMA, clashing, odd_rows, prose


def plain_fingerprint(text, k=3):
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(40)][::-1], "star": [(100, i) for i in range(30)] + [(7, 7), (None, 3)],
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(50)], "empty": [],
    }[shape]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == classes(real, {n for x in real for n in x})


def test_any_five_positions_hold_a_choice():
    for size in (3, 4, 5):
        masks = simhash.masks(size)
        for gone in range(256):
            if bin(gone).count("1") <= 3:
                kept = sum(255 << (8 * p) for p in range(8) if not gone >> p & 1)
                assert any(m & kept == m for m in masks)


@pytest.mark.parametrize("size", [5, 4])
def test_links_keep_all_classes(spark, size):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 40])):
            values.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}))
    values |= {rng.getrandbits(64) for _ in range(100)}
    # A crowded list: values that differ in a few low bits only.
    values |= {0xABCD << 40 | i for i in range(60)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(0, v, v) for v in signed], "table int, fingerprint long, node long")
    near = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    found = [(r.a, r.b) for r in simhash.fingerprint_links(df, size).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in found)
    assert classes(found, signed) == classes(near, signed)


def test_long_lists_look_up_neighbours():
    rng = random.Random(2)
    values = np.array(sorted({(0x77 << 56) | rng.getrandbits(12) for _ in range(300)}), np.uint64)
    by_pairs = simhash._forest(len(values), simhash._pairs(values))
    by_lookup = simhash._forest(len(values), simhash._neighbours(values, (1 << 24) - 1))
    nodes = range(len(values))
    assert classes(list(zip(*by_pairs)), nodes) == classes(list(zip(*by_lookup)), nodes)


def test_near_duplicates_on_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    found = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    same = classes([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 3], prints)
    least = {}
    for (key, *_), p in zip(rows, prints):
        if key is not None:
            least[same[p]] = min(key, least.get(same[p], key))
    expected = sorted((str(r[0]), format(p, "016x"), str(least.get(same[p]))) for r, p in zip(rows, prints))
    got = sorted((str(r.doc_id), format(r.fingerprint & (1 << 64) - 1, "016x"), str(r.component_id)) for r in found)
    assert got == expected
    assert set(found[0].asDict()) == set(docs.columns) | {"component_id"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_one_of_each_class_stays(spark):
    rng = random.Random(8)
    base = [prose(rng, 150, 5000) for _ in range(6)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(base)]
    rows += [(50, base[4], "en", "t", 2), (4, base[4].upper(), "en", "s", 1)]
    rows += [(300, None, None, None, None), (301, "", None, None, None), (5, base[5], "en", "s", 1), (5, base[5], "de", "s", 1)]
    # Three-word shingles of one word each: a few edits of a long text move few bits.
    for i in range(40):
        words = base[0].split(" ")
        words[3 * i] = "changed"
        rows.append((100 + i, " ".join(words), "en", "s", 1))
    prints = [plain_fingerprint(r[1]) for r in rows]
    same = classes([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 3], prints)
    least = {}
    for (key, *_), p in zip(rows, prints):
        least[same[p]] = min(key, least.get(same[p], key))
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert len(least) < 40


def test_null_keys_keep_a_row(spark):
    rows = [(None, "one two three", None, None, 1), (None, "one two three", None, None, 1), (None, "other words here now", None, None, 1)]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in kept) == ["one two three", "other words here now"]
