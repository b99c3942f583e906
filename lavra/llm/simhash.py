"""SimHash near-duplicates through an inverted index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight
bytes, so they share at least five positional bytes: the guaranteed minimum of the count filter.
Posting lists of single bytes would pair a 256th of all fingerprints with each other, so the index is
kept by choices of positions: a list per choice and values of its bytes. The choices are such that any
five shared positions hold one of them. In a list the shared bytes of a pair are tallied over all
eight positions, pairs that reach five are verified by their bits, and the first choice that a pair
shares is the one that reports it. With choices of five positions (the default) nothing below the
minimum meets at all, and a list of distinct fingerprints holds at most 2^24, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.components import components
from lavra.llm.text import columns_of
from lavra.session import staged

BITS, BYTES = 3, 8
SHARED = BYTES - BITS
SEED = 42
# The eight bits of each byte value, and where the values of each byte position are counted.
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(float)
PLACE = 256 * np.arange(BYTES)
# Lists up to this length are compared as pairs, longer ones by looking up all neighbours of a value.
PAIRED = 3000
# Lists up to this length are compared for all lists of a batch at once.
SHORT = 16


@cache
def masks(size: int) -> tuple[int, ...]:
    """Masks of choices of ``size`` byte positions such that any five positions hold one of them."""
    open_sets = {frozenset(c) for c in combinations(range(BYTES), SHARED)}
    chosen = []
    while open_sets:
        best = max(combinations(range(BYTES), size), key=lambda c: sum(o.issuperset(c) for o in open_sets))
        chosen.append(sum(255 << (8 * p) for p in best))
        open_sets = {o for o in open_sets if not o.issuperset(best)}
    return tuple(chosen)


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """64-bit hashes of the word shingles, repeats included; fewer words are one shingle."""
    size = min(size, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if size else ()
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), ">u8").astype("<u8")


def majority(hashes: np.ndarray) -> int:
    """Signed number of the bits that are set in more than half of the hashes; 0 without any."""
    places = hashes.view(np.uint8).reshape(-1, BYTES) + PLACE
    ones = np.bincount(places.ravel(), minlength=BYTES * 256).reshape(BYTES, 256) @ BITS_OF_BYTE
    return int(np.packbits(2 * ones.ravel() > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles of a lower-cased (A-Z) text; 0 without words."""
    return majority(shingle_hashes(text.lower().split() if text else [], words))


def fingerprint_column(text: str = "text", words: int = 3) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return F.arrow_udf(run, "long")(F.col(text))


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _first_choice(different: np.ndarray, size: int) -> np.ndarray:
    """Of the choices of positions that a pair shares, the first: the one list that reports it."""
    first = np.full(len(different), -1)
    for i, mask in reversed(list(enumerate(masks(size)))):
        first[(different & np.uint64(mask)) == 0] = i
    return first


def _tally(different: np.ndarray) -> np.ndarray:
    """Positional bytes that pairs share."""
    return (different.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)


def _forest(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that connect all that the pairs connect; earlier groups of pairs first."""
    root, left, right = np.arange(count), [], []
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            i, j, low, high = i[apart], j[apart], np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            if not len(i):
                break
            # Every root is hooked to the smallest root that one of its pairs leads to.
            order = np.lexsort((low, high))
            chosen = order[np.diff(high[order], prepend=-1) != 0]
            root[high[chosen]] = low[chosen]
            left.append(i[chosen])
            right.append(j[chosen])
            while not np.array_equal(up := root[root], root):
                root = up
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _pairs(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs up to three bits apart, the closest first."""
    left, right, apart = [], [], []
    rows = max(1, 1_000_000 // len(values))
    for at in range(0, len(values), rows):
        bits = np.bitwise_count(values[at : at + rows, None] ^ values[None, :])
        i, j = np.nonzero(bits <= BITS)
        later = i + at < j
        left.append(i[later] + at)
        right.append(j[later])
        apart.append(bits[i[later], j[later]])
    i, j, bits = (np.concatenate(x) for x in (left, right, apart))
    for many in range(BITS + 1):
        yield i[bits == many], j[bits == many]


def _neighbours(values: np.ndarray, free: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of sorted distinct values that differ in bits of the mask ``free``, by looking them up."""
    bits = [1 << p for p in range(64) if free >> p & 1]
    for many in range(1, BITS + 1):
        for flipped in combinations(bits, many):
            other = values ^ np.uint64(sum(flipped))
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = np.flatnonzero((values[at] == other) & (values < other))
            yield hit, at[hit]


def _links_of_list(values: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the links that connect what is linked inside one list: fewer than it has values."""
    order = np.argsort(values)
    values = values[order]
    i, j = _forest(len(values), _pairs(values) if len(values) <= PAIRED else _neighbours(values, free))
    return order[i], order[j]


def _links(
    slots: np.ndarray, shared: np.ndarray, prints: np.ndarray, nodes: np.ndarray, size: int, whole: int
) -> pa.RecordBatch:
    """Links of complete posting lists, which stand one after the other."""
    new = np.flatnonzero(np.concatenate(([True], (slots[1:] != slots[:-1]) | (shared[1:] != shared[:-1]))))
    sizes = np.diff(np.append(new, len(slots)))
    size_of = np.repeat(sizes, sizes)
    place = np.arange(len(slots)) - np.repeat(new, sizes)
    choices = len(masks(size))
    left, right = [], []
    for step in range(1, SHORT):
        i = np.flatnonzero((size_of <= SHORT) & (place + step < size_of))
        different = prints[i] ^ prints[i + step]
        enough = np.flatnonzero(_tally(different) >= SHARED)
        near = enough[np.bitwise_count(different[enough]) <= BITS]
        once = near[_first_choice(different[near], size) == slots[i][near] % choices]
        left.append(i[once])
        right.append(i[once] + step)
    for at, many in zip(new[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist()):
        values = prints[at : at + many]
        if many <= whole:
            a, b = (np.concatenate(x) for x in zip(*_pairs(values)))
            once = _first_choice(values[a] ^ values[b], size) == slots[at] % choices
            a, b = a[once], b[once]
        else:
            a, b = _links_of_list(values, ~masks(size)[slots[at] % choices] & ((1 << 64) - 1))
        left.append(a + at)
        right.append(b + at)
    return pa.RecordBatch.from_arrays([pa.array(nodes[np.concatenate(x)]) for x in (left, right)], ["a", "b"])


def _scan_lists(size: int, whole: int):
    bytes_of = np.array(masks(size), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            slots, prints, nodes = (batch.column(c).to_numpy() for c in ("slot", "fingerprint", "node"))
            now = [slots, bytes_of[slots % len(bytes_of)] & prints.view(np.uint64), prints, nodes]
            if kept:
                now = [np.concatenate(x) for x in zip(kept, now)]
            slots, shared, prints, nodes = now
            # The last list may go on in the next batch.
            other = np.flatnonzero((slots != slots[-1]) | (shared != shared[-1])) if len(slots) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield _links(slots[:cut], shared[:cut], prints[:cut].view(np.uint64), nodes[:cut], size, whole)
            kept = [x[cut:] for x in now]
        if kept and len(kept[0]):
            yield _links(kept[0], kept[1], kept[2].view(np.uint64), kept[3], size, whole)

    return run


def fingerprint_links(prints: DataFrame, size: int = SHARED, whole: int = SHORT) -> DataFrame:
    """Links ``a, b`` between the nodes of ``table, fingerprint, node``, distinct in the first two.

    Linked are fingerprints of one table that differ in at most three bits. Lists of
    up to ``whole`` values give every pair once; a longer one gives a spanning forest of its pairs,
    the closest first, so the classes are complete while it gives fewer links than it has values.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(size)]
    slots = F.sequence(F.col("table") * len(signed), (F.col("table") + 1) * len(signed) - 1)
    postings = prints.select("fingerprint", "node", F.explode(slots.cast("array<int>")).alias("slot"))
    # The bytes of the list follow from slot and fingerprint, so they do not travel.
    mask = F.element_at(F.array(*map(F.lit, signed)), (F.col("slot") % len(signed) + 1).cast("int"))
    shared = F.col("fingerprint").bitwiseAND(mask)
    grouped = postings.repartition(F.col("slot"), shared).sortWithinPartitions(F.col("slot"), shared)
    return grouped.mapInArrow(_scan_lists(size, whole), "a long, b long")


def _classes(docs: DataFrame, text: str, key: str, words: int, carry: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The carried columns with their fingerprint, and per fingerprint the first row of its class.

    That row is named by (null key?, key, hash of the text), smallest first.
    """
    name = F.struct(F.col(f"`{key}`").isNull(), F.col(f"`{key}`"), F.xxhash64(f"`{text}`").alias("hash"))
    marked = staged(
        docs.select(
            F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("_doc"),
            fingerprint_column(f"`{text}`", words).alias("fingerprint"),
            name.alias("_row"),
        ),
        "fingerprints",
    )
    first = staged(marked.groupBy("fingerprint").agg(F.min("_row").alias("_row")), "distinct")
    prints = first.select(F.lit(0).alias("table"), "fingerprint", F.col("fingerprint").alias("node"))
    found = components(fingerprint_links(prints))
    members = first.join(found, F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "_row")
    least = members.groupBy("root").agg(F.min("_row").alias("_least"))
    linked = members.join(least, "root").select(F.col("fingerprint").alias("_linked"), "_least")
    owner = first.join(linked, F.col("fingerprint") == F.col("_linked"), "left").select(
        "fingerprint", F.coalesce("_least", "_row").alias("_owner")
    )
    # Written, so that the join with a fingerprint of many copies can split its rows over tasks.
    return marked, staged(owner, "owners")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, carry: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with ``fingerprint`` (long) and ``component_id``, the smallest key of its class.

    Classes are the connected components of fingerprints that differ in at most three bits. Texts
    that are null, empty or without words have fingerprint 0 and are linked like any other. Shorter
    texts than a shingle are one shingle. Copies share their fingerprint and meet the index once.
    Null keys are passed over when the smallest is taken; a class of null keys has a null id.
    ``carry`` names the columns to return, all by default; columns named like the two new ones are
    replaced. Repeated rows stay.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("fingerprint", "component_id")]
    marked, owner = _classes(docs, text, key, words, kept)
    placed = marked.join(owner, "fingerprint")
    return placed.select(*[F.col(f"_doc.`{c}`") for c in kept], "fingerprint", F.col(f"_owner.{key}").alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3) -> DataFrame:
    """One document of every class of ``near_duplicates`` stays, with the columns of ``docs``.

    The document with the smallest key stays, null keys last, then the one whose text has the
    smallest hash; of rows equal in key and text the one whose columns have the smallest hash. Texts without words, null among
    them, share fingerprint 0 and are copies of each other. Very long texts are read whole, an empty table stays empty, and
    extra columns of any name pass through. Texts are told apart by 64-bit hashes.
    """
    marked, owner = _classes(docs, text, key, words, [])
    again = marked.groupBy("_row").agg(F.count("*").alias("_n")).where("_n > 1")
    chosen = owner.select("_owner").distinct().join(again, F.col("_owner") == F.col("_row"), "left")
    chosen = staged(
        chosen.select(F.col(f"_owner.{key}").alias("_key"), F.col("_owner.hash").alias("_hash"), F.col("_n").isNotNull().alias("_many")),
        "chosen",
    )
    value = F.col(f"`{text}`")
    own = docs.select(F.struct(*columns_of(docs)).alias("_doc"), F.col(f"`{key}`").alias("_k"), F.xxhash64(value).alias("_h"))
    met = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_hash"))
    if not chosen.where("_many").limit(1).count():
        return own.join(chosen, met, "left_semi").select("_doc.*")
    alone = own.join(chosen.where("not _many"), met, "left_semi").select("_doc")
    # Of repeated rows each task keeps one, and then all tasks together.
    several = own.join(chosen.where("_many"), met, "left_semi").groupBy("_k", "_h")
    return alone.unionByName(several.agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc")).select("_doc")).select("_doc.*")
