"""Token counts of a unigram model by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the mark of a word start before it. Its best split into pieces is found
from left to right: the best score of a prefix is the best over the pieces that may end it. Those
scores depend on the prefix alone, so words that begin alike share them: distinct pre-tokens go into a
trie, each node holds the best score and the number of tokens of its prefix, and is computed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.text import columns_of

MARK = "▁"
# Scores are whole millionths, so equal splits have equal scores in any order of summing.
UNIT = 1_000_000
# A trie that has grown to this many nodes, with its terminal counts, is begun anew.
MOST_NODES = 800_000
# Largest vocabulary, in pieces, that is sent to every executor.
MOST_PIECES = 1_000_000


def piece_scores(path: str) -> dict[str, int]:
    """Scores of the pieces of a vocabulary file, best first in it: the Zipf share of their rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return zipf_scores(model.id_to_piece(i) for i in plain)


def zipf_scores(pieces: Iterable[str]) -> dict[str, int]:
    ranked = list(dict.fromkeys(pieces))
    total = math.log(sum(1 / r for r in range(1, len(ranked) + 1))) if ranked else 0.0
    return {p: round(-UNIT * (math.log(r) + total)) for r, p in enumerate(ranked, 1)}


class Trie(dict):
    """Number of tokens of a pre-token; missing ones are inserted into the trie.

    Nodes are numbers, found by their parent and character; each has the best (score, minus tokens)
    of its prefix.
    """

    def __init__(self, scores: dict[str, int], most_nodes: int = MOST_NODES):
        super().__init__()
        self.most_nodes = most_nodes
        # Pieces by their characters from the last to the first; the score stands at None.
        self.ends: dict = {}
        for piece, score in scores.items():
            node = self.ends
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[None] = score
        # A character that no piece covers falls back to its bytes, each worse than any piece.
        self.fallback = min(scores.values(), default=0) - 10 * UNIT
        self._begin()

    def _begin(self) -> None:
        self.clear()
        self.children: dict[int, int] = {}
        self.best: list[tuple[int, int]] = [(0, 0)]

    def __missing__(self, word: str) -> int:
        if len(self.best) > self.most_nodes:
            self._begin()
        text, node, children, best = MARK + word, 0, self.children, self.best
        before = [best[0]]
        for end, character in enumerate(text):
            step = node << 21 | ord(character)
            node = children.get(step, 0)
            if not node:
                node = children[step] = len(best)
                best.append(self._forward(text, end, before))
            before.append(best[node])
        self[word] = count = -before[-1][1]
        return count

    def _forward(self, text: str, end: int, before: list[tuple[int, int]]) -> tuple[int, int]:
        """Best of the pieces that may end at this place."""
        node, found = self.ends, None
        for start in range(end, -1, -1):
            node = node.get(text[start])
            if node is None:
                break
            score = node.get(None)
            if score is not None:
                total, tokens = before[start]
                option = (total + score, tokens - 1)
                if found is None or option > found:
                    found = option
            if start == end and score is None:
                found = self._bytes(text[end], before[end])
        return found or self._bytes(text[end], before[end])

    def _bytes(self, character: str, before: tuple[int, int]) -> tuple[int, int]:
        size = len(character.encode("utf-8", "surrogatepass"))
        return before[0] + size * self.fallback, before[1] - size


def count_tokens(docs: DataFrame, scores: dict[str, int], text: str = "text", most_nodes: int = MOST_NODES) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``.

    Words stand between white space. The split with the highest total score counts, of equal ones the
    one with the fewest tokens. Null and empty texts have none. Input columns named like the new ones
    are replaced; repeated rows count alike; an empty vocabulary counts bytes. Each task keeps its own
    trie, of at most about ``most_nodes`` nodes: starting anew changes no count.
    """
    if len(scores) > MOST_PIECES:
        raise ValueError(f"a vocabulary of more than {MOST_PIECES} pieces is not sent to every executor")
    sent = docs.sparkSession.sparkContext.broadcast(scores)
    tries: list[Trie] = []

    def run(texts: pa.Array) -> pa.Array:
        if not tries:
            tries.append(Trie(sent.value, most_nodes))
        trie, words, tokens = tries[0], [], []
        for value in texts.cast(pa.binary()).to_pylist():
            found = [w.decode() for w in value.split()] if value else []
            words.append(len(found))
            tokens.append(sum(map(trie.__getitem__, found)))
        return pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["n_words", "n_tokens"])

    rest = columns_of(docs, ("n_words", "n_tokens"))
    counted = F.arrow_udf(run, "n_words long, n_tokens long")(F.col(f"`{text}`"))
    return docs.select(*rest, counted.alias("_c")).select(*rest, "_c.n_words", "_c.n_tokens")
