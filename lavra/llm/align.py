"""Alignment of two tokenizers' tokens over the bytes of each document.

Both sides' tokens of a batch stand in one table each, keyed by document, with the byte that each token
starts at. ``pandas.merge_asof`` finds, for every start of a token, the token of the other side
that covers this byte; two tokens overlap exactly when one of them starts inside the other, so the union of both
directions are all overlaps. Ends that both sides share cut a document into groups.

How many documents hold a pair of ids linked is counted over the whole corpus: tasks count their own
documents before anything is shuffled. The documents' pairs are written beside them in the first pass, so nothing is tokenized
twice. Counts come back to the documents as one sorted table where it is small, and else by ranges of pairs.

A tokenizer that never joins a character to a space behind it gives each stretch ``" word"`` the same
tokens wherever it stands. Then only the distinct stretches of a batch are tokenized, in one text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.session import scratch_path, shuffle_width, staged

# Pairs of ids in a table of counts that is sent to every task (16 bytes each), and in a range of a longer one.
TABLE_ROWS, RANGE_ROWS = 2_000_000, 1_000_000
# Different pairs a task keeps before it hands their counts on.
KEPT = 2_000_000
# Bytes of text whose distinct stretches are tokenized together; a longer text alone.
CHUNK_BYTES = 4 << 20
# Tokens of both sides that are laid over each other at once; a longer text alone.
TOKENS = 400_000
# A space behind a character that is no white space for any of the tokenizers starts a stretch.
BEFORE = r"([^\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]) "
# A code point that is no character marks the starts; texts that hold it are tokenized as a whole.
MARK = "\ufdd0"
CONTROL = re.compile(r"<0x([0-9A-F]{2})>\Z")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


# The split of byte-level vocabularies: contractions, letters, numbers and others, each with one space in front, white space.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class BytePairs:
    """A byte-level vocabulary of the tokenizers library (a JSON file), without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        slow = Tokenizer.from_str(text)
        slow.encode_special_tokens = True
        letters, told = byte_letters(), json.loads(text)
        entries = slow.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            known = all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        before = told.get("pre_tokenizer") or {}
        # The usual split has a space only before other characters, so none is joined to a space behind it.
        self.local = before.get("type") == "ByteLevel" and bool(before.get("use_regex", True)) and not before.get("add_prefix_space")
        self.local &= not told.get("normalizer") and not told["model"].get("ignore_merges")
        self.fast = self._ranked(told) if self.local else None
        self.slow = None if self.fast else slow

    def _ranked(self, told: dict):
        """The same vocabulary in the faster tiktoken, if its ids stand in the order of its merges."""
        import tiktoken

        words, special = told["model"]["vocab"], {t["content"] for t in told["added_tokens"]}
        merges = (m if isinstance(m, str) else " ".join(m) for m in told["model"]["merges"])
        made = [words["".join(m.split(" "))] for m in merges]
        ranks = {self.bytes[i]: i for t, i in words.items() if t not in special}
        if made != sorted(set(made)) or len(ranks) != len(made) + 256:
            return None
        return tiktoken.Encoding("pairs", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, spaced: str) -> list[int]:
        """Ids of a text that starts with a space."""
        if self.fast:
            return self.fast.encode_ordinary(spaced)
        return self.slow.encode(spaced, add_special_tokens=False).ids


class Pieces:
    """A vocabulary of the sentencepiece library (a model file), which adds the space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.local = [], True
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            found = CONTROL.match(piece) if self.model.is_byte(i) else None
            self.bytes.append(bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode())
            self.local &= " " not in piece.replace("▁", " ").lstrip(" ")

    def encode(self, spaced: str) -> list[int]:
        return self.model.encode(spaced[1:])


@cache
def tokenizer(path: str) -> BytePairs | Pieces:
    """The tokenizer of a file, loaded once in each Python worker."""
    return BytePairs(path) if path.endswith(".json") else Pieces(path)


class Side:
    """Tokens of some texts: ids one after the other, and how many each text has."""

    def __init__(self, coder: BytePairs | Pieces, ids: np.ndarray, many: np.ndarray):
        self.ids, self.many = ids, many
        self.sizes = _lengths(coder)[ids]
        self.doc = np.repeat(np.arange(len(many)), many)

    def between(self, start: int, end: int) -> Side:
        """The tokens of some of the texts."""
        part = object.__new__(Side)
        some = slice(int(self.many[:start].sum()), int(self.many[:end].sum()))
        part.ids, part.sizes, part.doc, part.many = self.ids[some], self.sizes[some], self.doc[some] - start, self.many[start:end]
        return part

    def only(self, kept: np.ndarray) -> None:
        """Drop the tokens of all other texts."""
        here = kept[self.doc]
        self.ids, self.sizes, self.doc = self.ids[here], self.sizes[here], self.doc[here]
        self.many = np.where(kept, self.many, 0)


def _lengths(coder: BytePairs | Pieces) -> np.ndarray:
    if not hasattr(coder, "lengths"):
        coder.lengths = np.fromiter(map(len, coder.bytes), np.int64, len(coder.bytes))
    return coder.lengths


def _whole(coder: BytePairs | Pieces, text: str) -> np.ndarray | None:
    """Ids of a spaced text, none where the tokens' bytes are not the text's."""
    ids = coder.encode(text)
    return np.array(ids, np.int64) if b"".join(map(coder.bytes.__getitem__, ids)) == text.encode() else None


def _by_stretch(coder: BytePairs | Pieces, known: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the distinct stretches, one after the other; how many each has; and which are true to their bytes.

    They are tokenized as one text. A stretch with an end that no token ends at, or other bytes, is not true.
    """
    texts = [k.encode() for k in known]
    # A few hundred kilobytes at a time: a single text of many megabytes would be slow.
    groups, ids, many, true, at = [], [], [], [], 0
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (1 << 18), prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(texts)]):
        groups.append((a, b))
    for a, b in groups:
        got = np.array(coder.encode("".join(known[a:b])), np.int64)
        ends, limits = np.cumsum(_lengths(coder)[got]), np.cumsum(sizes[a:b])
        if b"".join(map(coder.bytes.__getitem__, got.tolist())) == b"".join(texts[a:b]):
            place = np.searchsorted(ends, limits)
            if np.array_equal(ends[place], limits):
                ids.append(got)
                many.append(np.diff(place + 1, prepend=0))
                true.append(np.ones(b - a, bool))
                continue
        for k in range(a, b):
            alone = _whole(coder, known[k])
            ids.append(alone if alone is not None else np.zeros(0, np.int64))
            many.append(np.array([len(ids[-1])]))
            true.append(np.array([alone is not None]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ids]), np.concatenate([none, *many]), np.concatenate([none.astype(bool), *true])


def encoded(texts: pa.Array, coders: Sequence[BytePairs | Pieces]) -> list[Side]:
    """Both sides' tokens of texts with a space in front; none for a text that is null, empty or not kept byte by byte."""
    texts = texts.cast(pa.string())
    some = pc.greater(pc.binary_length(texts).fill_null(0), 0)
    spaced = pc.binary_join_element_wise(" ", texts, "")
    marked = pc.match_substring(spaced, MARK).fill_null(False).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(pc.replace_substring_regex(spaced, BEFORE, rf"\1{MARK} "), MARK)
    counts = pc.list_value_length(split).fill_null(0).to_numpy()
    flat = split.flatten().dictionary_encode()
    code, known = flat.indices.to_numpy(), flat.dictionary.to_pylist()
    owner = np.repeat(np.arange(len(texts)), counts)
    made, whole = [], some.to_numpy(zero_copy_only=False).copy()
    for coder in coders:
        if coder.local:
            ids, many, true = _by_stretch(coder, known)
        else:
            ids, many, true = np.zeros(0, np.int64), np.zeros(len(known), np.int64), np.zeros(len(known), bool)
        # Texts with a stretch that is not true to its bytes are tokenized as a whole.
        bad = marked.copy()
        bad[owner[~true[code]]] = True
        starts, width = np.cumsum(many) - many, many[code]
        at = np.repeat(starts[code], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        got, sizes = ids[at], np.bincount(owner, width, len(texts)).astype(np.int64)
        if bad.any():
            parts = np.split(got, np.cumsum(sizes)[:-1])
            for i in np.flatnonzero(bad).tolist():
                alone = _whole(coder, spaced[i].as_py())
                whole[i] &= alone is not None
                parts[i] = alone if alone is not None else np.zeros(0, np.int64)
            got, sizes = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        made.append(Side(coder, got, sizes))
    for side in made:
        side.only(whole)
    return made


def _among(found: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which bytes are among others."""
    marks = np.zeros(max(found[-1], places[-1]) + 1 if len(found) and len(places) else 0, bool)
    marks[places] = True
    return marks[found]


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of both sides whose bytes overlap."""
    starts = [np.cumsum(s.sizes) - s.sizes for s in (a, b)]
    tables = [
        pd.DataFrame({"doc": s.doc, "start": start, name: np.arange(len(start))}) for s, start, name in zip((a, b), starts, "ab")
    ]
    first = pd.merge_asof(tables[0], tables[1], on="start", by="doc")
    # Tokens that start at the same byte are found by the first direction.
    second = pd.merge_asof(tables[1][~_among(starts[1], starts[0])], tables[0], on="start", by="doc")
    i = np.concatenate((first["a"].to_numpy(np.int64), second["a"].to_numpy(np.int64)))
    j = np.concatenate((first["b"].to_numpy(np.int64), second["b"].to_numpy(np.int64)))
    return i, j


@cache
def _told(size: int) -> np.ndarray:
    """The ids below ``size`` with each mark that may follow one."""
    return np.array([f"{i}{mark}" for mark in ",|;" for i in range(size)], object)


def groups(a: Side, b: Side, size: int) -> tuple[np.ndarray, list[str]]:
    """Groups of each text, and their ids as ``a1,a2|b1;a3|b2,b3``."""
    ends_a, ends_b = np.cumsum(a.sizes), np.cumsum(b.sizes)
    last_a, last_b = _among(ends_a, ends_b), _among(ends_b, ends_a)
    # A's tokens of a group come before B's.
    group = np.concatenate((2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1))
    order = np.argsort(group, kind="stable")
    ids = np.concatenate((a.ids, b.ids))
    mark = np.where(np.concatenate((last_a, last_b)), 1 + (group & 1), 0)
    ends, pieces = np.cumsum(a.many + b.many).tolist(), _told(size)[(mark * size + ids)[order]].tolist()
    told = ["".join(pieces[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends)]
    return np.bincount(a.doc[last_a], minlength=len(a.many)), told


def pack(values: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted distinct numbers and how often each occurs, as byte planes (their number first) that compress well."""
    steps = np.concatenate((np.diff(values, prepend=0), times))
    width = 4 if not len(steps) or int(steps.max()) >> 32 == 0 else 8
    return bytes([width]) + np.ascontiguousarray(steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1).T
    steps = np.ascontiguousarray(planes).view(f"<u{width}").reshape(2, -1).astype(np.int64)
    return np.cumsum(steps[0]), steps[1]


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def _aligned(a: Side, b: Side, coders: Sequence[BytePairs | Pieces], digest: bool) -> tuple[list, ...]:
    """The columns of ``ALIGNED`` for some texts."""
    i, j = overlaps(a, b)
    many, told = groups(a, b, max(len(c.bytes) for c in coders))
    linked = a.doc[i]
    bits = (len(coders[0].bytes) * len(coders[1].bytes)).bit_length()
    pair = np.sort((linked << bits) | (a.ids[i] * len(coders[1].bytes) + b.ids[j]))
    new = np.flatnonzero(np.diff(pair, prepend=-1))
    times = np.diff(np.append(new, len(pair)))
    ends = np.searchsorted(pair[new] >> bits, np.arange(len(a.many)), "right").tolist()
    known = pair[new] & ((1 << bits) - 1)
    return (
        a.many.tolist(), b.many.tolist(), many.tolist(), np.bincount(linked, minlength=len(a.many)).tolist(),
        [hashlib.sha256(t.encode()).hexdigest() if t and digest else t for t in told],
        [pack(known[s:e], times[s:e]) for s, e in zip([0, *ends[:-1]], ends)],
    )


def _align(paths: tuple[str, str], digest: bool):
    """Rows ``_row, _text`` with the columns of ``ALIGNED`` instead of the text; pairs are A's id times the size of B's vocabulary plus B's."""
    fields = [f.split() for f in ALIGNED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [tokenizer(p) for p in paths]
        for batch in batches:
            sizes = pc.binary_length(batch.column("_text")).fill_null(0).to_numpy().astype(np.int64)
            firsts = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK_BYTES, prepend=-1)).tolist()
            for first, last in zip(firsts, [*firsts[1:], batch.num_rows]):
                part = batch.slice(first, last - first)
                sides = encoded(part.column("_text"), coders)
                out: list[list] = [[] for _ in fields]
                # Tokens are shared by many texts; what lies over what is worked out for fewer at a time.
                starts = np.flatnonzero(np.diff(np.cumsum(sides[0].many + sides[1].many) // TOKENS, prepend=-1)).tolist()
                for start, end in zip(starts, [*starts[1:], part.num_rows]):
                    a, b = (s.between(start, end) for s in sides)
                    for column, values in zip(out, _aligned(a, b, coders, digest)):
                        column += values
                columns = [pa.array(v, kinds[k]) for v, (_, k) in zip(out, fields)]
                yield pa.RecordBatch.from_arrays([part.column("_row"), *columns], ["_row", *(n for n, _ in fields)])

    return run


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each pair, added up in the task."""
    kept, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kept), pa.array(times)], ["pair", "n"])

    for batch in batches:
        held = [unpack(p)[0] for p in batch.column("pairs").to_pylist()]
        found, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
        both, place = np.unique(np.concatenate((kept, found)), return_inverse=True)
        kept, times = both, np.bincount(place, np.concatenate((times, n)), len(both)).astype(np.int64)
        if len(kept) > KEPT:
            yield handed()
            kept, times = kept[:0], times[:0]
    yield handed()


def _looked_up(packed: pa.Array, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[list[int], list[int]]:
    """Links of each document with the best count of their A id, and the sum of all counts."""
    known, counts, best = table
    best_of, sums = [], []
    for p in packed.to_pylist():
        values, times = unpack(p)
        at = np.searchsorted(known, values)
        best_of.append(int(times[best[at]].sum()))
        sums.append(int((times * counts[at]).sum()))
    return best_of, sums


def _in_ranges(counts: DataFrame, docs: DataFrame, rows: int, range_rows: int) -> DataFrame:
    """``_doc, n_best, count_sum`` of ``_doc, pairs``, where the counts are too many for one task.

    Ranges of pairs hold about as many counts each. A document's pairs are cut by range; each range's counts
    go to as many tasks as share its documents, and stand before them.
    """
    width = shuffle_width(counts.sparkSession)
    parts = -(-rows // range_rows)
    share = [i / parts for i in range(1, parts)]
    limits = sorted(set(counts.approxQuantile("pair", share, 1e-4))) if share else []
    limits = np.array(limits, np.int64)
    salts = max(1, width // (len(limits) + 1))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ranges, slices = [], [], []
            for doc, p in zip(batch.column("_doc").to_pylist(), batch.column("pairs").to_pylist()):
                values, times = unpack(p)
                cuts = np.searchsorted(values, limits)
                for r, (s, e) in enumerate(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])):
                    if e > s:
                        ids.append(doc)
                        ranges.append(r)
                        slices.append(pack(values[s:e], times[s:e]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ranges, pa.int32()), pa.array(slices, pa.binary())], ["_doc", "range", "pairs"]
            )

    below = F.filter(F.array(*map(F.lit, limits.tolist())).cast("array<long>"), lambda limit: limit <= F.col("pair"))
    bounds = F.size(below)
    # Counts travel in blocks of their range, once for each salt.
    cells = counts.withColumn("range", bounds).select("range", F.struct("pair", "n", "best").alias("c"), (F.hash("pair") % 64).alias("b"))
    blocks = cells.groupBy("range", "b").agg(F.collect_list("c").alias("cells")).select(
        "range", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("long").alias("_doc"),
        F.lit(None).cast("binary").alias("pairs"), "cells",
    )
    kind = blocks.schema["cells"].dataType
    slices = docs.mapInArrow(ranged, "_doc long, range int, pairs binary").select(
        "range", F.pmod(F.xxhash64("_doc"), F.lit(salts)).cast("int").alias("salt"), "_doc", "pairs", F.lit(None).cast(kind).alias("cells"),
    )

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cells, table = None, [], None
        for batch in batches:
            places = list(zip(batch.column("range").to_pylist(), batch.column("salt").to_pylist()))
            ids = batch.column("_doc").to_pylist()
            done: list[tuple[int, int, int]] = []
            for k, place in enumerate(places):
                if place != at:
                    at, cells, table = place, [], None
                if ids[k] < 0:
                    held = batch.column("cells").slice(k, 1).flatten()
                    cells.append(tuple(held.field(i).to_numpy(zero_copy_only=False) for i in range(3)))
                    continue
                if table is None:
                    known, n, best = (np.concatenate(x) for x in zip(*cells))
                    order = np.argsort(known)
                    table, cells = (known[order], n[order], best[order]), []
                best_of, sums = _looked_up(batch.column("pairs").slice(k, 1), table)
                done.append((ids[k], best_of[0], sums[0]))
            columns = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_doc", "n_best", "count_sum"])

    met = blocks.unionByName(slices).repartition("range", "salt").sortWithinPartitions("range", "salt", "_doc")
    found = met.mapInArrow(looked_up, "_doc long, n_best long, count_sum long")
    return found.groupBy("_doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame,
    first: str,
    second: str,
    text: str = "text",
    carry: Sequence[str] | None = None,
    digest: bool = True,
    table_rows: int = TABLE_ROWS,
    range_rows: int = RANGE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """How the tokens of tokenizer files ``first`` (A) and ``second`` (B) lie over each document's bytes.

    The first table has the carried columns of ``docs``, all by default, with ``n_a, n_b`` (tokens), ``n_groups`` (stretches between ends that both
    share), ``n_links`` (overlapping pairs of tokens), ``n_best`` (links whose count is the highest of
    their A id, ties included), ``count_sum`` (over links) and ``groups_sha256``, the hash of
    ``a1,a2|b1;a3|b2,b3`` (the text itself without ``digest``). The second has ``a, b, n``, in how many documents each pair of ids is linked.

    Texts are tokenized with a space in front and without special tokens. Null and empty texts, and those whose tokens' bytes are
    not the text's on either side, have no tokens: zeros and an empty string. Very long texts are taken whole.
    Repeated rows count each time, an empty table gives two. Columns named like a new one are replaced.
    """
    new = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    kept = [c for c in (docs.columns if carry is None else carry) if c not in new]

    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_row")
    read = docs.select(row, F.col(f"`{text}`").cast("string").alias("_text"))
    schema = T.StructType([read.schema["_row"], *T.StructType.fromDDL(ALIGNED).fields])
    marked = read.mapInArrow(_align((first, second), digest), schema).withColumn("_doc", F.monotonically_increasing_id())
    path = scratch_path(docs.sparkSession, "aligned")
    # The pairs are byte planes that only a strong codec makes small.
    marked.write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.schema(marked.schema).parquet(path)

    pairs = rows.select("pairs").mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    vocabulary = len(tokenizer(second).bytes)
    counts = staged(pairs.withColumn("a", F.floor(F.col("pair") / vocabulary)), "pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("_most"))
    ranked = staged(counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "counts")
    many = ranked.count()
    own = [F.col("_row")[c].alias(c) for c in kept]
    if many <= table_rows:
        told = ranked.toArrow().sort_by("pair")
        table = tuple(told.column(c).to_numpy() for c in ("pair", "n", "best"))
        sent = docs.sparkSession.sparkContext.broadcast(table)

        def look(packed: pa.Array) -> pa.Array:
            best_of, sums = _looked_up(packed, sent.value)
            return pa.StructArray.from_arrays([pa.array(best_of, pa.int64()), pa.array(sums, pa.int64())], ["n_best", "count_sum"])

        done = rows.withColumn("_f", F.arrow_udf(look, "n_best long, count_sum long")("pairs")).select("*", "_f.*")
    else:
        done = rows.join(_in_ranges(ranked, rows.select("_doc", "pairs"), many, range_rows), "_doc", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    split = counts.select("a", (F.col("pair") % vocabulary).alias("b"), "n")
    return done.select(*own, "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256"), split
