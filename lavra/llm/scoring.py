"""Document scores from masked pseudo-likelihood.

A small network sees up to two words on either side of a place, never the word itself, and predicts
the word. The log-probabilities of all words of a document, each given its neighbours, add up to the
document's score. Words are codes: the most frequent ones of the corpus have one of their own, the
others share the rest by hash. A code is predicted in two steps, its row and then its column in a
square, so a prediction costs twice the side of the square instead of all codes. A word that shares its
code takes its share of the code's probability, by its count: the vocabulary is all counted words. The
counts grow with the corpus, so they stay a table that the words of the scored texts meet in a join.

Training starts from the corpus's word frequencies, which the output biases hold exactly. Every task
then runs gradient descent over its own documents, and the tasks' networks are averaged by the words
they saw. Counts and training cover all documents; what comes back to the driver is of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.substrings import PIECE_BYTES, chunks, word_codes
from lavra.llm.text import columns_of
from lavra.session import staged

SIDE = 64
CODES = SIDE * SIDE
OWN = CODES // 2
REACH, WIDTH = 2, 16
# First row of each offset's embeddings.
OFFSETS = (CODES + 1) * np.arange(2 * REACH)
BATCH, RATE = 1024, 0.08
SCORED = 2048
# Count of a word that the fitted corpus does not hold, inside its code.
UNSEEN = 0.5
# Parameters travel and are averaged in blocks of this many numbers.
BLOCK = 8192


@dataclass
class Network:
    """Embeddings of all offsets in one table (each ends in a row for the edge of a text), and output layers."""

    inputs: np.ndarray
    rows: np.ndarray
    row_bias: np.ndarray
    chosen: np.ndarray
    columns: np.ndarray
    column_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.rows, self.row_bias, self.chosen, self.columns, self.column_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        shapes = [(2 * REACH * (CODES + 1), WIDTH), (WIDTH, SIDE), (SIDE,), (SIDE, WIDTH), (WIDTH, SIDE), (SIDE, SIDE)]
        ends = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
        return cls(*(flat[a:b].reshape(s).astype(np.float32) for a, b, s in zip(ends, ends[1:], shapes)))

    @classmethod
    def of_counts(cls, counts: np.ndarray, seed: int = 7) -> Network:
        """The network that predicts the smoothed frequencies of the codes, whatever the neighbours."""
        rng = np.random.default_rng(seed)
        square = counts.reshape(SIDE, SIDE) + 0.5
        rows = square.sum(axis=1)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(
            small(2 * REACH * (CODES + 1), WIDTH), np.zeros((WIDTH, SIDE), np.float32), np.log(rows / rows.sum()).astype(np.float32),
            small(SIDE, WIDTH), np.zeros((WIDTH, SIDE), np.float32), np.log(square / rows[:, None]).astype(np.float32),
        )

    def _hidden(self, near: np.ndarray) -> np.ndarray:
        """From the rows of ``inputs`` that lie around, offset by offset."""
        return np.tanh(self.inputs.take(near, axis=0).reshape(2 * REACH, -1, WIDTH).sum(axis=0))

    def _outputs(self, hidden: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Not yet normalised."""
        first = hidden @ self.rows
        first += self.row_bias
        shifted = hidden + self.chosen.take(row, axis=0)
        second = shifted @ self.columns
        second += self.column_bias.take(row, axis=0)
        return first, shifted, second

    def log_probability(self, codes: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Log-probability of every code given those around it."""
        out = np.empty(len(codes))
        for at in range(0, len(codes), SCORED):
            some = codes[at : at + SCORED]
            row, column, i = some // SIDE, some % SIDE, np.arange(len(some))
            first, _, second = self._outputs(self._hidden(_near(around[at : at + SCORED])), row)
            out[at : at + SCORED] = _log_softmax_at(first, i, row) + _log_softmax_at(second, i, column)
        return out

    def gradients(self, codes: np.ndarray, around: np.ndarray) -> tuple[list[np.ndarray], list[tuple]]:
        """Of the mean loss: of the output layers, and (table, rows, changes) of the tables in use."""
        # In the order of their rows, so that what belongs to a row lies together.
        order = np.argsort((codes // SIDE).astype(np.uint16), kind="stable")
        codes, around = codes[order], around[order]
        row, column, i = codes // SIDE, codes % SIDE, np.arange(len(codes))
        near = _near(around)
        hidden = self._hidden(near)
        first, shifted, second = self._outputs(hidden, row)
        share = np.float32(1 / len(codes))
        first, second = _softmax(first, share), _softmax(second, share)
        first[i, row] -= share
        second[i, column] -= share
        back = second @ self.columns.T
        down = (first @ self.rows.T + back) * (1 - hidden * hidden)
        dense = [hidden.T @ first, first.sum(axis=0), shifted.T @ second]
        starts = _starts(row)
        chosen, back, second = row[starts], _added(back, starts), _added(second, starts)
        return dense, [(self.chosen, chosen, back), (self.column_bias, chosen, second), (self.inputs, *_by_row(near, down))]


def _near(around: np.ndarray) -> np.ndarray:
    """Rows of the table of inputs, offset by offset."""
    return (around.T + OFFSETS[:, None]).ravel()


class Trainer:
    """Gradient descent whose steps shrink with the squared gradients so far, by number or table row."""

    def __init__(self, network: Network, rate: float):
        self.network, self.rate = network, rate
        self.dense = [np.full_like(p, 1e-6) for p in (network.rows, network.row_bias, network.columns)]
        self.tables = [np.full((len(t), 1), 1e-6, np.float32) for t in (network.chosen, network.column_bias, network.inputs)]

    def step(self, codes: np.ndarray, around: np.ndarray) -> None:
        network = self.network
        dense, tables = network.gradients(codes, around)
        for part, seen, change in zip((network.rows, network.row_bias, network.columns), self.dense, dense):
            seen += change * change
            part -= self.rate * change / np.sqrt(seen)
        for (table, rows, change), seen in zip(tables, self.tables):
            squares = seen.take(rows, axis=0) + np.einsum("ij,ij->i", change, change)[:, None] / np.float32(change.shape[1])
            seen[rows] = squares
            table[rows] = table.take(rows, axis=0) - change * (np.float32(self.rate) / np.sqrt(squares))


# Numbers up to this, either way, need no shift before they are raised.
TAME = 40


def _tame(x: np.ndarray) -> np.ndarray:
    """Rows that can be raised: as they are, or each less its own maximum."""
    if not x.size or max(x.max(), -x.min()) < TAME:
        return x
    return x - x.max(axis=1, keepdims=True)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    """Along the rows, each from its own maximum where it has to be."""
    x = _tame(x)
    return x - np.log(np.exp(x) @ np.ones(x.shape[1], x.dtype))[:, None]


def _log_softmax_at(x: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """One number of each row."""
    x = _tame(x)
    return x[row, column] - np.log(np.exp(x) @ np.ones(x.shape[1], x.dtype))


def _softmax(x: np.ndarray, share: np.floating) -> np.ndarray:
    """Times a share."""
    x = np.exp(_tame(x))
    x *= (share / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
    return x


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.concatenate(([True] * (len(ordered) > 0), ordered[1:] != ordered[:-1])))


def _added(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows; two columns go as one complex number, which halves the number of sums."""
    return np.add.reduceat(x.view(np.result_type(x, np.complex64)), starts, axis=0).view(x.dtype)


def _by_row(rows: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Changes added up by table row; they come round again for each offset."""
    # Row numbers fit 16 bits, which are sorted digit by digit.
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ordered = rows[order]
    new = _starts(ordered)
    which = np.tile(np.arange(len(change)), len(rows) // len(change)).take(order)
    return ordered[new], _added(change.take(which, axis=0), new)


def encode(hashes: np.ndarray, own: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Codes of word hashes: ``own`` is sorted, ``number`` its codes."""
    shared = (OWN + hashes % np.uint64(CODES - OWN)).astype(np.int64)
    if not len(own):
        return shared
    at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
    return np.where(own[at] == hashes, number[at], shared)


def surroundings(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Codes at -2, -1, 1 and 2 of every place of every text; beyond a text's ends the edge code."""
    # Every text stands between edge codes.
    place = np.arange(len(codes)) + REACH * (np.repeat(np.arange(len(counts)), counts) + 1)
    padded = np.full(len(codes) + REACH * (len(counts) + 1), CODES, np.int16)
    padded[place] = codes
    return np.stack([padded[place + o] for o in range(-REACH, REACH + 1) if o], axis=1)


def _parts(batches: Iterator[pa.RecordBatch], own: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of words, and the number of words of each text; each different word is looked up once."""
    for part in (c for batch in batches for c in chunks(batch, "_text", PIECE_BYTES)):
        known, code, counts = word_codes(part.column("_text"))
        yield encode(known, own, number)[code], counts


def _coded(batches: Iterator[pa.RecordBatch], own: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the words of many texts at once, and the number of words of each text."""
    for part in (c for batch in batches for c in chunks(batch, "_text")):
        pieces = [(codes.astype(np.int16), counts) for codes, counts in _parts(iter([part]), own, number)]
        codes, counts = zip(*pieces)
        yield np.concatenate(codes), np.concatenate(counts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (c for batch in batches for c in chunks(batch, "_text", PIECE_BYTES)):
        known, code, _ = word_codes(part.column("_text"))
        times = np.bincount(code, minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(times)], ["word", "n"])


def _train(network: np.ndarray, own: np.ndarray, number: np.ndarray, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Network.of(network), 0
        trainer = Trainer(model, rate)
        rng = np.random.default_rng(seed)
        for codes, counts in _coded(batches, own, number):
            around = surroundings(codes, counts)
            order = rng.permutation(len(codes))
            for at in range(0, len(codes), BATCH):
                some = order[at : at + BATCH]
                trainer.step(codes[some], around[some])
            seen += len(codes)
        if seen:
            flat = model.flat().astype("<f4")
            blocks = [flat[at : at + BLOCK] for at in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks))), pa.array([seen] * len(blocks)), pa.array([b.tobytes() for b in blocks])],
                ["block", "seen", "numbers"],
            )

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means of the rows of each block, weighted by words; the sum is taken row by row."""
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for block, seen, numbers in zip(*(batch.column(c).to_pylist() for c in ("block", "seen", "numbers"))):
            values = np.frombuffer(numbers, "<f4").astype(np.float64) * seen
            before = sums.get(block)
            sums[block] = (seen, values) if before is None else (before[0] + seen, before[1] + values)
    if sums:
        blocks = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks), pa.array([sums[b][0] for b in blocks]),
             pa.array([(sums[b][1] / sums[b][0]).astype("<f4").tobytes() for b in blocks])],
            ["block", "seen", "numbers"],
        )


@dataclass
class Coded:
    """A fitted network, the words that have their own code, and the words counted by code; sent to every task."""

    network: np.ndarray
    own: np.ndarray
    number: np.ndarray
    frequencies: np.ndarray


@dataclass
class Model:
    """What every task holds, of fixed size, and the counts ``word, n`` of all words, a table."""

    coded: Coded
    counts: DataFrame


def fit(docs: DataFrame, text: str = "text", rounds: int = 1, rate: float = RATE) -> Model:
    """Count the words of all documents, then train on all of them, ``rounds`` times."""
    read = docs.select(F.col(f"`{text}`").alias("_text"))
    counts = staged(read.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    most = counts.orderBy(F.desc("n"), "word").limit(OWN).collect()
    frequent = np.array([r["word"] for r in most], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    own, number = frequent[order], order
    # The remainder of an unsigned number by a power of two.
    code = F.col("word").bitwiseAND(F.lit(CODES - OWN - 1)).cast("int") + OWN
    named = F.broadcast(docs.sparkSession.createDataFrame([(r["word"], i) for i, r in enumerate(most)], "word long, own int"))
    by_code = counts.join(named, "word", "left").groupBy(F.coalesce("own", code).alias("code")).agg(F.sum("n").alias("n"))
    frequencies = np.zeros(CODES)
    for r in by_code.collect():
        frequencies[r["code"]] = r["n"]
    network = Network.of_counts(frequencies).flat()
    blocks = "block long, seen long, numbers binary"
    for turn in range(rounds):
        trained = read.mapInArrow(_train(network, own, number, rate / (1 + turn), turn), blocks)
        # Blocks of one place meet in a few tasks first, then in one each; both hold one block at a time.
        some = trained.withColumn("_salt", F.spark_partition_id() % 32).repartition("block", "_salt").drop("_salt")
        mean = some.mapInArrow(_average, blocks).repartition("block").mapInArrow(_average, blocks)
        rows = sorted(mean.collect(), key=lambda r: r["block"])
        if rows:
            network = np.concatenate([np.frombuffer(r["numbers"], "<f4") for r in rows])
    return Model(Coded(network, own, number, frequencies), counts)


def _shared_words(sent):
    """How often each text of a batch, by hash, holds each word that shares its code; copies add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = sent.value
        for part in (c for batch in batches for c in chunks(batch, "_text", PIECE_BYTES)):
            known, code, counts = word_codes(part.column("_text"))
            texts, copy_of = np.unique(part.column("_hash").to_numpy(), return_inverse=True)
            shared = (encode(known, coded.own, coded.number) >= OWN)[code]
            # Text and word as one number, so that they are sorted as numbers.
            both = np.sort((np.repeat(copy_of, counts)[shared] << 32) | code[shared])
            at = _starts(both)
            columns = (texts[both[at] >> 32], known[both[at] & 0xFFFFFFFF].view(np.int64), np.diff(np.append(at, len(both))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_hash", "word", "times"])

    return run


def _seen(docs: DataFrame, model: Model, sent, text: str) -> DataFrame:
    """``_hash, _seen``: by text, what its words with shared codes have above unseen ones (logarithm)."""
    read = docs.select(F.xxhash64(f"`{text}`").alias("_hash"), F.col(f"`{text}`").alias("_text"))
    asked = read.mapInArrow(_shared_words(sent), "_hash long, word long, times long")
    gains = asked.join(model.counts, "word").groupBy("_hash").agg(F.sum(F.col("times") * F.log(F.col("n") / UNSEEN)).alias("_sum"))
    copies = read.groupBy("_hash").agg(F.count("*").alias("_copies"))
    # Written, so that the join with a text of many copies can split its rows over tasks.
    return staged(gains.join(copies, "_hash").select("_hash", (F.col("_sum") / F.col("_copies")).alias("_seen")), "seen")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``log_likelihood`` (sum over all words) and ``mean_log_likelihood``.

    Every word has a probability of its own: that of its code, times its share of the words counted
    under the code, among which unseen words count ``UNSEEN``. Null and empty texts have no words, a sum
    of 0 and no mean. Input columns named like the new ones are replaced; repeated rows score alike.
    Texts are told apart by 64-bit hashes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.coded)
    networks: list[Network] = []

    def run(texts: pa.Array) -> pa.Array:
        fitted = sent.value
        if not networks:
            networks.append(Network.of(fitted.network))
        # Of an unseen word inside its code; words with a code of their own are all of it.
        inside = np.log(UNSEEN / (fitted.frequencies + UNSEEN))
        inside[:OWN] = 0
        words, sums = [], []
        whole = pa.RecordBatch.from_arrays([texts], ["_text"])
        for codes, counts in _parts(iter([whole] if len(texts) else []), fitted.own, fitted.number):
            each = networks[0].log_probability(codes, surroundings(codes, counts)) + inside[codes]
            total = np.concatenate(([0.0], np.cumsum(each)))
            ends = np.concatenate(([0], np.cumsum(counts)))
            words.append(counts)
            sums.append(total[ends[1:]] - total[ends[:-1]])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in (words, sums)]
        return pa.StructArray.from_arrays(
            [pa.array(columns[0].astype(np.int64)), pa.array(columns[1])], ["n_words", "log_likelihood"]
        )

    rest = columns_of(docs, ("n_words", "log_likelihood", "mean_log_likelihood"))
    scored = docs.select(
        F.struct(F.lit(0).alias("_"), *rest).alias("_doc"), F.xxhash64(f"`{text}`").alias("_hash"),
        F.arrow_udf(run, "n_words long, log_likelihood double")(F.col(f"`{text}`")).alias("_s"),
    ).join(_seen(docs, model, sent, text), "_hash", "left")
    both = F.col("_s.log_likelihood") + F.coalesce("_seen", F.lit(0.0))
    names = [c for c in docs.columns if c not in ("n_words", "log_likelihood", "mean_log_likelihood")]
    return scored.select(
        *[F.col(f"_doc.`{c}`") for c in names], "_s.n_words", both.alias("log_likelihood"),
        F.when(F.col("_s.n_words") > 0, both / F.col("_s.n_words")).alias("mean_log_likelihood"),
    )
