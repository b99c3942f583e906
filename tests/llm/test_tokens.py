import random

from lavra.llm import tokens
from tests.llm.data import SCHEMA, clashing, odd_rows

PIECES = ["▁a", "a", "b", "ab", "▁", "ba", "aba", "c", "▁ab", "bab"]


def plain(word, scores):
    text, best = tokens.MARK + word, []
    fallback = min(scores.values(), default=0) - 10 * tokens.UNIT

    def go(i, total, n):
        if i == len(text):
            best.append((total, -n))
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in scores:
                go(j, total + scores[text[i:j]], n + 1)
        if i < len(text) and text[i] not in scores:
            size = len(text[i].encode())
            go(i + 1, total + size * fallback, n + size)

    go(0, 0, 0)
    return -max(best)[1]


def test_best_splits():
    rng = random.Random(3)
    for scores in (tokens.zipf_scores(PIECES), {}, tokens.zipf_scores(["b"])):
        trie = tokens.Trie(scores, 30)
        for _ in range(300):
            word = "".join(rng.choice("abcdé漢") for _ in range(rng.randint(1, 9)))
            assert trie[word] == plain(word, scores)


def test_prefixes_are_computed_once(monkeypatch):
    trie = tokens.Trie(tokens.zipf_scores(PIECES))
    calls = []
    forward = trie._forward
    trie._forward = lambda text, end, before: calls.append(text[: end + 1]) or forward(text, end, before)
    for word in ("abab", "aba", "abac", "abab"):
        trie[word]
    assert len(calls) == len(set(calls)) == 6


def test_odd_rows(spark):
    scores = tokens.zipf_scores(PIECES)
    docs = clashing(spark.createDataFrame(odd_rows(), SCHEMA))
    found = tokens.count_tokens(docs, scores)
    assert set(found.columns) == set(docs.columns) | {"n_tokens"}
    trie = tokens.Trie(scores)
    for r in found.collect():
        words = r.text.encode().split() if r.text else []
        assert r.n_words == len(words) and r.n_tokens == sum(trie[w.decode()] for w in words)
    assert tokens.count_tokens(spark.createDataFrame([], SCHEMA), scores).count() == 0
