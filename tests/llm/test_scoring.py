import random
import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash

from lavra.llm import scoring
from lavra.llm.substrings import word_codes
from tests.llm.data import SCHEMA, clashing, odd_rows


def language(rng, words):
    """Words that follow each other by rule most of the time."""
    out = [rng.randrange(200)]
    for _ in range(words - 1):
        out.append((out[-1] * 7 + 3) % 200 if rng.random() < 0.8 else rng.randrange(200))
    return [f"w{x}" for x in out]


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    net = scoring.Network.of_counts(np.ones(scoring.CODES))
    for p in net.parts():
        p += rng.normal(0, 0.3, p.shape).astype(np.float32)
    codes, around = rng.integers(0, scoring.CODES, 50), rng.integers(0, scoring.CODES + 1, (50, 4))
    around[:, 1] = 7
    wide = scoring.Network(*(p.astype(np.float64) for p in net.parts()))
    dense, tables = wide.gradients(codes, around)
    checks = [(p, (0,) * p.ndim, g[(0,) * p.ndim]) for p, g in zip((wide.rows, wide.row_bias, wide.columns), dense)]
    checks += [(t, (r[0], 3), g[0, 3]) for t, r, g in tables]
    for part, at, gradient in checks:
        loss = []
        for step in (1e-4, -2e-4):
            part[at] += step
            loss.append(-wide.log_probability(codes, around).mean())
        part[at] += 1e-4
        assert abs((loss[0] - loss[1]) / 2e-4 - gradient) < 1e-6


def test_untrained_network_is_the_word_frequencies():
    counts = np.arange(scoring.CODES, dtype=float)
    net = scoring.Network.of_counts(counts)
    codes = np.array([0, 5, scoring.CODES - 1])
    got = net.log_probability(codes, np.zeros((3, 4), np.int64))
    assert np.allclose(got, np.log((counts[codes] + 0.5) / (counts + 0.5).sum()), atol=1e-4)


def test_held_out_documents(spark):
    rng = random.Random(5)
    train = [(i, " ".join(language(rng, 300)), "en", "s", 1) for i in range(400)]
    model = scoring.fit(spark.createDataFrame(train, SCHEMA).repartition(3), rounds=2)
    held, mixed = [], []
    for i in range(30):
        words = language(rng, 200)
        held.append((i, " ".join(words), "en", "s", 1))
        rng.shuffle(words)
        mixed.append((i, " ".join(words), "en", "s", 1))
    good = {r.doc_id: r.mean_log_likelihood for r in scoring.score(spark.createDataFrame(held, SCHEMA), model).collect()}
    bad = {r.doc_id: r.mean_log_likelihood for r in scoring.score(spark.createDataFrame(mixed, SCHEMA), model).collect()}
    frequencies = -np.log(200)
    assert np.mean(list(good.values())) > frequencies + 0.3
    assert all(good[i] > bad[i] + 0.3 for i in good)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    found = scoring.score(docs, scoring.fit(docs))
    assert set(found.columns) == set(docs.columns) | {"log_likelihood", "mean_log_likelihood"}
    for r in found.collect():
        words = len(r.text.encode().split()) if r.text else 0
        assert r.n_words == words and (r.mean_log_likelihood is None) == (words == 0) and r.log_likelihood <= 0
    empty = spark.createDataFrame([], SCHEMA)
    assert scoring.score(empty, scoring.fit(empty)).count() == 0


def test_words_of_one_code_have_their_own_probabilities(spark):
    def code(word):
        return xxhash.xxh64_intdigest(word.encode()) % (scoring.CODES - scoring.OWN)

    common = [f"c{i}" for i in range(scoring.OWN)]
    train = [(i, " ".join(common), "en", "s", 1) for i in range(6)] + [(9, "rare rare rare once", "en", "s", 1)]
    junk = next(w for w in (f"x{i}" for i in range(10**6)) if code(w) == code("rare"))
    texts = {1: "rare c1 c2 rare", 2: f"{junk} c1 c2 {junk}", 3: "rare c1 c2 rare", 4: "c1 c2"}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA).repartition(3)
    model = scoring.fit(spark.createDataFrame(train, SCHEMA).repartition(2))
    got = {r.doc_id: r.log_likelihood for r in scoring.score(docs, model).collect()}
    assert abs(got[1] - got[2] - 2 * np.log(3 / scoring.UNSEEN)) < 1e-6
    assert abs(got[1] - got[3]) < 1e-9 and got[4] > got[2]


def test_rows_far_below_the_others_keep_their_scores():
    x = np.array([[100.0, 99.0, 98.0], [-15.0, -16.0, -17.0], [0.0, -200.0, -200.0]], np.float32)
    exact = x - np.log(np.exp(x.astype(float) - x.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - x.max(axis=1, keepdims=True)
    assert np.allclose(scoring._log_softmax(x), exact, atol=1e-5)


def test_a_large_batch_takes_little_memory():
    """Words of many texts are looked at some megabytes at a time; a word takes many times its bytes."""
    texts = pa.array([" ".join(f"w{(i * 7 + k) % 5000}" for k in range(200)) for i in range(6000)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array(range(6000))], ["_text", "_hash"])
    none, kinds = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sent = SimpleNamespace(value=scoring.Coded(np.zeros(0), none, kinds, np.ones(scoring.CODES)))
    tracemalloc.start()
    try:
        rows = sum(found.num_rows for found in scoring._shared_words(sent)(iter([batch])))
        assert rows == 6000 * 200 and tracemalloc.get_traced_memory()[1] < 24 << 20
    finally:
        tracemalloc.stop()


def test_numbers_beside_the_own_maximum_and_shares():
    """Rows that are raised as they are and rows that need a shift give the same as exact sums."""
    rng = np.random.default_rng(3)
    for x in (rng.normal(0, 3, (50, 8)), np.concatenate((rng.normal(0, 3, (50, 8)), np.full((1, 8), -300.0), np.full((1, 8), 300.0)))):
        exact = x - np.log(np.exp(x - x.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - x.max(axis=1, keepdims=True)
        row, column = np.arange(len(x)), rng.integers(0, 8, len(x))
        small = x.astype(np.float32)
        assert np.allclose(scoring._log_softmax_at(small, row, column), exact[row, column], atol=1e-4)
        assert np.allclose(scoring._softmax(small, np.float32(0.5)), np.exp(exact) / 2, atol=1e-5)


def test_words_leave_arrow_in_one_call():
    """A scalar made of every word took several times what hashing them takes."""
    words = [f"w{i}".encode() for i in range(200_000)]
    texts = pa.array([" ".join(w.decode() for w in words)])

    def least(run):
        took = []
        for _ in range(3):
            start = time.process_time()
            run()
            took.append(time.process_time() - start)
        return min(took)

    hashing = least(lambda: np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    assert least(lambda: word_codes(texts)) < 3.5 * hashing
