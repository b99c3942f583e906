"""Join of word-shingle sets by Jaccard similarity, heavy and light sets apart.

Two sets of the wanted similarity share most of their elements, so with all elements in one order of
rarity the first ``k`` that they share are among the first few of both (their prefixes). That gives two kinds of lists:

* small (light) sets are entered under every subset of ``k`` elements of their prefix: few sets meet by
  chance, but the number of subsets grows with the prefix like a power of ``k``;
* large (heavy) sets are entered in the inverted lists of single elements, which are scanned. Small sets
  that are large enough to be similar to a heavy one are entered there too.

The size where one gives way to the other has the least cost: subsets entered below it, list entries
scanned from it on, both added up over all sets by size.

Equal sets are put together first. What is asked for are classes, so a list is not expanded into all its
pairs: each set meets a pivot of its list, these pairs are verified on the whole sets, and only lists that still hold
different classes are compared further, in blocks over tasks, with filters by size, by the place of
the shared element and by sketches: in turns that give each set the nearest one of another class, which joins groups of
near copies with a pair or so for each set, and then all pairs between the classes that are left. Of lists that hold the same sets
one is looked at. Every pair of similar sets either has such a comparison or is joined by verified links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.components import components
from lavra.llm.lines import _cell, rarity
from lavra.llm.substrings import PIECE_BYTES, chunks, mixed, word_hashes
from lavra.session import staged

WORDS, PERCENT, SUBSET = 5, 80, 2
# Rows of a list that one task scans; a list that is expected to be longer is dealt over several.
LIST_ROWS = 4096
# Rows of a block in the comparison of lists with several classes.
BLOCK = 1000
# Partners of a hub in one task.
HUB_ROWS = 4096
# Turns of nearest pairs before the comparison of all that are left, which is the same without them, only longer.
TURNS = 2
# Lists up to this length are compared for all lists of a batch at once.
SHORT = 24
# Bits of a set's parity sketch, as a power of two.
SKETCH_BITS = 9
_ORDER = np.uint64(0x9E3779B97F4A7C15)


def needed(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Elements that a set of this size shares with any set that is similar enough."""
    return -(-percent * size // 100)


def overlap(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Elements that sets of these sizes share at least if they are similar."""
    return -(-percent * (a + b) // (100 + percent))


def sketched(sketches: pa.Array) -> np.ndarray:
    """Parity sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(sketches.to_pylist()), "<u8").reshape(len(sketches), -1)


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits that differ in sketches; each stands for an element of just one of the sets."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def most_apart(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Elements that just one of two similar sets of these sizes has, at most."""
    return a + b - 2 * overlap(a, b, percent)


def similar(both: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return 100 * both >= percent * (a + b - both)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lower-cased texts, repeats included, and the text that each is of."""
    hashes, counts = word_hashes(pc.ascii_lower(texts))
    many = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    doc = np.repeat(np.arange(len(counts)), many)
    at = (np.cumsum(counts) - counts)[doc] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    long = np.minimum(counts, words)[doc]
    value = long.astype(np.uint64)
    for k in range(words):
        # A text of fewer words than a shingle is one of them as a whole.
        value = np.where(k < long, mixed(value + _ORDER) + hashes[np.minimum(at + k, len(hashes) - 1)] if len(at) else value, value)
    return mixed(value), doc


def distinct(texts: pa.Array, words: int, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of the sets, rarest first (by hash without levels), the text of each, and the size of each set."""
    value, doc = shingles(texts, words)
    level = levels[_cell(value)] if levels is not None and len(value) else np.zeros(len(value), np.uint8)
    # Text, rarity and part of the hash in one number; should two elements share it, by all of them.
    number = (doc.astype(np.uint64) << np.uint64(48)) | (level.astype(np.uint64) << np.uint64(40)) | (value >> np.uint64(24))
    order = np.argsort(number)
    value, number, doc = value[order], number[order], doc[order]
    if len(texts) >> 16 or np.any((number[1:] == number[:-1]) & (value[1:] != value[:-1])):
        order = np.lexsort((value, level[order], doc))
        value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, doc, np.bincount(doc, minlength=len(texts))


def _count_repeats(words: int):
    """Counts of the elements that a batch holds more than once, by cell: the frequent ones are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (c for batch in batches for c in chunks(batch, "_text")):
            pieces = chunks(part, "_text", PIECE_BYTES)
            value = np.sort(np.concatenate([shingles(piece.column("_text"), words)[0] for piece in pieces]))
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(value)), bool), value[1:] != value[:-1])))
            times = np.diff(np.append(first, len(value)))
            often = times > 1
            yield pa.RecordBatch.from_arrays([pa.array(_cell(value[first[often]])), pa.array(times[often])], ["cell", "n"])

    return run


MARKS = "node long, size long, light double, heavy double, sketch binary, prefix binary"


def _marks(texts: pa.Array, levels: np.ndarray, words: int, percent: int, subset: int) -> pa.Array:
    """Of each text: hash and size of its set, what it costs either way, and its prefix."""
    out: dict[str, list] = {f.split()[0]: [] for f in MARKS.split(", ")}
    whole = pa.RecordBatch.from_arrays([texts], ["text"])
    for part in chunks(whole, "text", PIECE_BYTES) if len(texts) else ():
        value, doc, size = distinct(part.column("text"), words, levels)
        ends = np.cumsum(size)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(value + _ORDER), dtype=np.uint64)))
        node = mixed(sums[ends] - sums[ends - size] + size.astype(np.uint64)).view(np.int64)
        single = np.minimum(size, size - needed(size, percent) + 1)
        several = np.minimum(size, single + subset - 1)
        place = np.arange(len(value)) - (ends - size)[doc]
        scanned = np.where(place < single[doc], 1 + _expected(value, levels), 0.0)
        out["node"] += node.tolist()
        out["size"] += size.tolist()
        out["light"] += [float(math.comb(p, subset)) for p in several.tolist()]
        out["heavy"] += np.bincount(doc, scanned, len(size)).tolist()
        # Counts of a byte, which may run over: only their last bit is used.
        odd = np.zeros(len(size) << SKETCH_BITS, np.uint8)
        np.add.at(odd, (doc << SKETCH_BITS) + (value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint8(1))
        out["sketch"] += [row.tobytes() for row in np.packbits((odd & 1).reshape(len(size), -1), axis=1)]
        out["prefix"] += [value[s : s + p].astype("<u8").tobytes() for s, p in zip((ends - size).tolist(), several.tolist())]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
    return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _expected(value: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sets that hold each element, as the sketch of counts has it."""
    return np.exp2(levels[_cell(value)] / 8.0) if len(value) else np.zeros(0)


def boundary(sets: DataFrame, percent: int = PERCENT) -> int:
    """Size from which sets count as heavy: where subsets below and scanned lists from it on cost least.

    Sizes go by half powers of two, so there are few rows to look at. The class below the
    boundary that may be similar to heavy sets is counted on both sides.
    """
    step = F.floor(2 * F.log2(F.col("size").cast("double"))).cast("int")
    costs = {r["step"]: (r["light"], r["heavy"]) for r in sets.where("size > 0").groupBy(step.alias("step")).agg(
        F.sum("light").alias("light"), F.sum("heavy").alias("heavy")).collect()}
    if not costs:
        return 1

    def total(at: int) -> float:
        return sum(c[0] for s, c in costs.items() if s < at) + sum(c[1] for s, c in costs.items() if s >= at - 1)

    best = min(range(min(costs), max(costs) + 2), key=total)
    return math.ceil(2 ** (best / 2))


# A list's part in a task and its number of parts, and a set's size and the place of an element, share a number each.
_HALF = 32


def _post(heavy_from: int, levels, percent: int, subset: int):
    """Entries of sets in their lists: list, part (and parts) of it, set, size and place of the element."""

    def entry(lists, level, node, size, at) -> pa.RecordBatch:
        blocks = 1 + (np.exp2(level / 8.0) // LIST_ROWS).astype(np.int64)
        salt = (mixed(node) % blocks.astype(np.uint64)).astype(np.int64)
        cells = (lists.view(np.int64), (salt << _HALF) | blocks, node, (size << _HALF) | at)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["list", "part", "node", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size = batch.column("node").to_numpy(), batch.column("size").to_numpy()
            prefixes = batch.column("prefix").to_pylist()
            many = np.array([len(p) // 8 for p in prefixes], np.int64)
            value = np.frombuffer(b"".join(prefixes), "<u8")
            start = np.cumsum(many) - many
            level = levels.value[_cell(value)] if len(value) else np.zeros(0, np.uint8)
            single = np.where(100 * size >= percent * heavy_from, np.minimum(size, size - needed(size, percent) + 1), 0)
            at = np.arange(single.sum()) - np.repeat(np.cumsum(single) - single, single)
            rows = np.repeat(start, single) + at
            yield entry(value[rows], level[rows], np.repeat(node, single), np.repeat(size, single), at)
            for p in np.unique(many[size < heavy_from]).tolist():
                chosen = np.array(list(combinations(range(p), subset)), np.int64).reshape(-1, subset)
                own = np.flatnonzero((many == p) & (size < heavy_from))
                # A few hundred thousand subsets at a time.
                turn = max(1, 500_000 // max(1, len(chosen)))
                for some in (own[i : i + turn] for i in range(0, len(own), turn)):
                    rows = start[some][:, None, None] + chosen[None]
                    key = np.full(rows.shape[:2], subset, np.uint64)
                    for k in range(subset):
                        key = mixed(key * _ORDER + value[rows[:, :, k]])
                    times = len(chosen)
                    yield entry(
                        key.ravel(), level[rows].min(axis=2).ravel(), np.repeat(node[some], times),
                        np.repeat(size[some], times), np.tile(chosen[:, 0], len(some)) if times else np.zeros(0, np.int64),
                    )

    return run


def _pivots(percent: int):
    """Entries of lists with more than one set (or with parts in other tasks), each with the pivot that it meets.

    Entries of a list come by size; the pivot is the first whose size is near enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held: tuple[int, int, int, int] | None = None  # list, part, pivot, its size

        def told(cells: list[np.ndarray], last: bool) -> pa.RecordBatch:
            """Whole rows; ``last`` says whether the list of the final row ends with it."""
            nonlocal held
            lists, part, node, place = cells
            size = place >> _HALF
            first = np.ones(len(lists), bool)
            first[1:] = (lists[1:] != lists[:-1]) | (part[1:] != part[:-1])
            goes_on = held is not None and (lists[0], part[0]) == held[:2]
            first[0] = not goes_on
            alone = first & np.append(first[1:], last)
            pivot = np.where(alone, node, 0)
            starts = np.flatnonzero(first & ~alone)
            ends = np.flatnonzero(np.append(first[1:], True))
            if goes_on:
                starts = np.append(0, starts)
            for s in starts.tolist():
                near, own = (held[2], held[3]) if s == 0 and goes_on else (node[s], size[s])
                e, k = int(ends[np.searchsorted(ends, s)]) + 1, s
                while k < e:
                    if 100 * own < percent * size[k]:
                        near, own = node[k], size[k]
                    stop = max(k + 1, k + int(np.searchsorted(size[k:e], 100 * own // percent, "right")))
                    pivot[k:stop] = near
                    k = stop
                held = (lists[s], part[s], near, own)
            if alone[-1]:
                held = (lists[-1], part[-1], node[-1], size[-1])
            blocks = part & ((1 << _HALF) - 1)
            some = ~alone | (blocks > 1)
            columns = (lists, blocks, node, size, place & ((1 << _HALF) - 1), pivot)
            return pa.RecordBatch.from_arrays([pa.array(c[some]) for c in columns], ["list", "blocks", "node", "size", "at", "pivot"])

        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("list", "part", "node", "place")]
            if kept:
                now = [np.concatenate(x) for x in zip(kept, now)]
            if len(now[0]) < 2:
                kept = now
                continue
            # The last row waits for the next one, to know whether its list goes on.
            yield told([x[:-1] for x in now], bool(now[0][-1] != now[0][-2] or now[1][-1] != now[1][-2]))
            kept = [x[-1:] for x in now]
        if kept and len(kept[0]):
            yield told(kept, True)

    return run


def _compare(percent: int, nearest: bool):
    """Pairs of a list that can be similar and are in different classes: of one block all, of two those across.

    With ``nearest`` each set of a list has just the one whose sketch is nearest: no more pairs than sets.
    """
    names = ("list", "low", "high", "block", "node", "root", "size", "at")

    def fitting(rows: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        lists, low, high, block, node, root, size, at, sketch = rows
        some = (root[i] != root[j]) & ((block[i] != block[j]) | (low[i] == high[i]))
        i, j = i[some], j[some]
        # The first element that two sets share has all that they share at or behind it.
        most = np.minimum(size[i] - at[i], size[j] - at[j])
        fits = similar(np.minimum(most, np.minimum(size[i], size[j])), size[i], size[j], percent)
        i, j = i[fits], j[fits]
        apart = differing(sketch[i], sketch[j])
        fits = apart <= most_apart(size[i], size[j], percent)
        i, j, apart = i[fits], j[fits], apart[fits]
        if nearest:
            order = np.lexsort((node[j], apart, i))
            order = order[np.diff(i[order], prepend=-1) > 0]
            i, j, apart = i[order], j[order], apart[order]
        found = (lists[i], node[i], size[i], at[i], node[j], apart)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["list", "a", "size", "at", "b", "apart"])

    def pairs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Of whole lists: the short ones at once, pairs of the same distance by pairs of the same distance."""
        new = np.concatenate(([True], np.any([x[1:] != x[:-1] for x in rows[:3]], axis=0)))
        start = np.flatnonzero(new)
        many = np.diff(np.append(start, len(new)))
        inside = np.arange(len(new)) - np.repeat(start, many)
        short = np.repeat(many, many) <= SHORT
        later = [np.flatnonzero(short & (inside >= step)) for step in range(1, SHORT)]
        i, j = np.concatenate([x - step for step, x in enumerate(later, 1)]), np.concatenate(later)
        yield fitting(rows, *((np.append(i, j), np.append(j, i)) if nearest else (i, j)))
        for s, n in zip(start[many > SHORT].tolist(), many[many > SHORT].tolist()):
            turn = max(1, 500_000 // n)
            for first in range(s, s + n, turn):
                i, j = (x.ravel() for x in np.meshgrid(np.arange(first, min(first + turn, s + n)), np.arange(s, s + n), indexing="ij"))
                yield fitting(rows, *((i, j) if nearest else (i[i < j], j[i < j])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [*(batch.column(c).to_numpy() for c in names), sketched(batch.column("sketch"))]
            if kept:
                now = [np.concatenate(x) for x in zip(kept, now)]
            # The last list may go on in the next batch.
            open_from = np.flatnonzero(np.any([x != x[-1] for x in now[:3]], axis=0))
            cut = int(open_from[-1]) + 1 if len(open_from) else 0
            if cut:
                yield from pairs([x[:cut] for x in now])
            kept = [x[cut:] for x in now]
        if kept:
            yield from pairs(kept)

    return run


def _compared(lists: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Candidates ``a, b`` of whole lists ``list, node, root, size, at, sketch, n``, with the row of ``a`` and how far they are apart.

    A long list meets block by block in many tasks.
    """
    dealt = lists.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    both = dealt.select("list", "node", "root", "size", "at", "sketch", "block", other)
    both = both.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    met = both.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high", "block")
    return met.mapInArrow(_compare(percent, nearest), "list long, a long, size long, at long, b long, apart long")


def _one_of_same(lists: DataFrame) -> DataFrame:
    """One list of those that hold the same sets, which have the same pairs: the one whose element comes first in all of them."""
    held = lists.groupBy("list").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.sum("at").alias("at")
    )
    one = held.where("n > 1").groupBy("n", "x", "y").agg(F.min_by("list", F.struct("at", "list")).alias("list"))
    return lists.join(one.select("list"), "list", "left_semi")


def _against_first(percent: int):
    """Pairs ``a, b`` of rows ``hub, part, first, node, set``: members that are similar to the hub, which stands before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            left, right = [], []
            columns = (batch.column(c).to_pylist() for c in ("hub", "part", "first", "node"))
            # Sets are looked at where the batch holds them; only the hub's stays behind.
            for hub, part, first, node, packed in zip(*columns, batch.column("set")):
                elements = np.frombuffer(packed.as_buffer(), "<u8")
                if not first:
                    if place != (hub, part):
                        place, own = (hub, part), elements.copy()
                    continue
                at = np.searchsorted(own, elements)
                both = int((own[np.minimum(at, len(own) - 1)] == elements).sum())
                if similar(both, len(own), len(elements), percent):
                    left.append(node)
                    right.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _hash_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = _cell(batch.column("_hash").to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.ones(len(cells), np.int64))], ["cell", "n"])


class Verifier:
    """Looks pairs of sets up in the documents again and keeps those that are similar."""

    def __init__(self, docs: DataFrame, texts: DataFrame, text: str, key: str, words: int, percent: int):
        value = F.col(f"`{text}`")
        self.docs = docs.select(F.col(f"`{key}`").alias("_k"), F.xxhash64(value).alias("_h"), value.alias("_text"))
        self.names = texts.select("node", F.col("_row.key").alias("_key"), F.col("_row.hash").alias("_hash"))
        self.sketches = texts.select("node", "size", "sketch")
        self.words, self.percent = words, percent

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """Different pairs that sizes and sketches do not rule out."""
        percent = self.percent

        def fits(left: pa.Array, right: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
            a, b = a.to_numpy(), b.to_numpy()
            return pa.array(differing(sketched(left), sketched(right)) <= most_apart(a, b, percent) if len(a) else np.zeros(0, bool))

        near = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")
        pairs = pairs.where("a <> b").distinct()
        known = pairs.join(self.sketches.toDF("a", "_na", "_sa"), "a").join(self.sketches.toDF("b", "_nb", "_sb"), "b").where(near)
        return known.where(F.arrow_udf(fits, "boolean")("_sa", "_sb", "_na", "_nb")).select("a", "b")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The similar ones of ``a, b``; ``b`` is the hub that its partners are sent to.

        A hub of many partners is sent to several tasks with a part of them each. Only the documents of
        pairs are read for their words again, and a set travels once for each of its pairs. Other documents are left out
        before they are shuffled, by a sketch of fixed size of the hashes that are asked for.
        """
        words, percent = self.words, self.percent

        def told(values: pa.Array) -> pa.Array:
            whole = pa.RecordBatch.from_arrays([values], ["text"])
            out = []
            for part in chunks(whole, "text", PIECE_BYTES) if len(values) else ():
                value, _, size = distinct(part.column("text"), words)
                ends = np.cumsum(size).tolist()
                out += [value[s:e].astype("<u8").tobytes() for s, e in zip([0, *ends[:-1]], ends)]
            return pa.array(out, pa.binary())

        pairs = staged(self._possible(pairs), "pairs")
        hubs = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / HUB_ROWS).alias("parts"))
        dealt = pairs.withColumnRenamed("b", "hub").join(hubs, "hub")
        members = dealt.select(
            F.col("a").alias("node"), "hub", F.pmod(F.xxhash64("a"), "parts").alias("part"), F.lit(True).alias("first")
        )
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
        heads = hubs.select(F.col("hub").alias("node"), "hub", every, F.lit(False).alias("first"))
        places = members.unionByName(heads).groupBy("node").agg(F.collect_list(F.struct("hub", "part", "first")).alias("places"))
        asked = staged(places.join(self.names, "node"), "asked")
        wanted = self.docs.sparkSession.sparkContext.broadcast(rarity(asked.select("_hash"), _hash_cells))

        def may_be(hashes: pa.Array) -> pa.Array:
            return pa.array(wanted.value[_cell(hashes.to_numpy().view(np.uint64))] > 0)

        met = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_hash"))
        found = self.docs.where(F.arrow_udf(may_be, "boolean")("_h")).join(asked, met).select("node", F.arrow_udf(told, "binary")("_text").alias("set"), "places")
        sent = found.select(F.explode("places").alias("p"), "node", "set").select("p.*", "node", "set")
        ordered = sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "first")
        return staged(ordered.mapInArrow(_against_first(percent), "a long, b long"), "similar")


def similar_sets(
    docs: DataFrame, texts: DataFrame, prefixes: DataFrame, levels, text: str, key: str, words: int, percent: int, subset: int
) -> DataFrame:
    """Links ``a, b`` between sets of ``texts`` (with their ``prefixes``) that have the components of all similar pairs."""
    from_size = boundary(texts, percent)
    verified = Verifier(docs, texts, text, key, words, percent)
    # Smaller sets are similar to equal ones only.
    able = prefixes.where(F.col("size") * (100 - percent) + percent >= 100)
    entries = able.mapInArrow(
        _post(from_size, levels, percent, subset), "list long, part long, node long, place long"
    )
    dealt = entries.repartition("list", "part").sortWithinPartitions("list", "part", "place", "node")
    paired = staged(
        dealt.mapInArrow(_pivots(percent), "list long, blocks long, node long, size long, at long, pivot long"), "paired"
    )
    lists = staged(_one_of_same(paired), "lists")
    # Each set meets the pivot that most of its lists have.
    met = lists.where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
    star = met.groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("b")).select(F.col("node").alias("a"), "b")
    # Parts of a list in different tasks have different pivots, which meet the smallest.
    parts = lists.where("blocks > 1").select("list", "pivot").distinct()
    centre = parts.groupBy("list").agg(F.min("pivot").alias("_least"))
    across = parts.join(centre, "list").where("pivot <> _least").select(F.col("pivot").alias("a"), F.col("_least").alias("b"))
    links, turn = verified(star.unionByName(across)), 0
    left = lists.select("list", "node", "size", "at")
    while True:
        found = components(links)
        rooted = left.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rooted.groupBy("list").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.count("*").alias("n"))
        apart = apart.where("_low < _high").drop("_low", "_high")
        left = staged(rooted.join(apart, "list").join(texts.select("node", "sketch"), "node"), "apart")
        if not left.limit(1).count():
            return links
        if turn < TURNS:
            # Each set meets the nearest of another class. Sets that have none in a list now will have none there later.
            near = staged(_compared(left, percent, nearest=True), "nearest")
            met = near.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
            more = verified(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
            left = staged(_one_of_same(near.select("list", F.col("a").alias("node"), "size", "at").distinct()), "lists")
            links, turn = links.unionByName(more), turn + 1
        else:
            rest = _compared(left, percent)
            return links.unionByName(verified(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))))


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    words: int = WORDS,
    percent: int = PERCENT,
    subset: int = SUBSET,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The carried columns of ``docs``, all by default, with ``n_shingles`` and ``component_id``.

    A document's set are the distinct shingles of its lower-cased (A-Z) words; with fewer words, but not none, the whole
    sequence is the one element. Two documents are linked when ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest key reachable by links, itself included. Null keys are passed over when the
    smallest is taken; a class of null keys has a null id. Texts that are null, empty or without words have an empty set and are
    linked with nothing, so they are their own component. Equal sets are always linked. Repeated rows stay; very long texts are taken whole;
    an empty table stays empty. Columns named like the new ones are replaced. Sets and elements are told apart by 64-bit hashes.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("n_shingles", "component_id")]
    value = F.col(f"`{text}`")
    levels = docs.sparkSession.sparkContext.broadcast(rarity(docs.select(value.alias("_text")), _count_repeats(words)))

    def mark(texts: pa.Array) -> pa.Array:
        return _marks(texts, levels.value, words, percent, subset)

    row = F.struct(F.col(f"`{key}`").isNull().alias("null"), F.col(f"`{key}`").alias("key"), F.xxhash64(value).alias("hash"))
    marked = staged(
        docs.select(
            F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_doc"), row.alias("_row"),
            F.arrow_udf(mark, MARKS)(value).alias("_m"),
        ).select("_doc", "_row", "_m.*"),
        "marked",
    )
    # Equal sets first: one row for each different set.
    some = marked.where("size > 0")
    each = some.groupBy("node")
    texts = staged(each.agg(F.min("_row").alias("_row"), *[F.first(c).alias(c) for c in ("size", "light", "heavy", "sketch")]), "texts")
    prefixes = each.agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    found = components(similar_sets(docs, texts, prefixes, levels, text, key, words, percent, subset))
    members = texts.select("node", "_row").join(found, "node", "left")
    least = members.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("_row").alias("_least"))
    owner = members.select("node", F.coalesce("root", "node").alias("root")).join(least, "root")
    # Written, so that the join with a set of many copies can split its rows over tasks.
    owner = staged(owner.select("node", F.col("_least.key").alias("component_id")), "owners")
    columns = [F.col(f"_doc.`{c}`") for c in kept]
    shown = F.col("size").cast("long").alias("n_shingles")
    linked = some.join(owner, "node").select(*columns, shown, "component_id")
    return linked.unionByName(marked.where("size = 0").select(*columns, shown, F.col("_row.key").alias("component_id")))
