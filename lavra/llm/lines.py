"""Near-duplicate lines by an exact set-similarity join of their words.

The words of a line, as a set, are ordered by rarity. Two sets of Jaccard similarity 4/5 or more share
a word among their first ``n - ceil(4n/5) + 1``; lists of the lines by such words hold all pairs. In a
list, the lengths of two lines, the places of the shared word and a 64-bit parity sketch of both sets
bound their overlap; what is left is verified on the words.

Rarity is read from a sketch of fixed size, the corpus-wide word counts added up by hash: any order
gives the same result, a better one shorter lists. Equal sets are put together within each batch and
then by their own list, so a line that fills the corpus enters the lists a few times. A line has to
match only one earlier line: of the candidates in a list the nearest few are verified first, and only
lines that had more and matched none are compared with all of theirs, in the lists where they had more.

A word that the corpus holds once leads to no other line, so nothing is posted under it. Rows come to a
list sorted by word alone; those that are alone under their word are left out before the rest is ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.substrings import LAST, _keyed, chunks, mixed, word_codes, word_hashes
from lavra.llm.text import columns_of
from lavra.session import staged

# Cells of the rarity sketch, a byte each, and how many of them travel as one row.
CELLS, CELL_BLOCK = 1 << 22, 1 << 16
# Candidates of a line in a list that are verified first.
FIRST = 4
# Lists up to this length are compared for all lists of a batch at once.
SHORT = 24


def needed(size: np.ndarray) -> np.ndarray:
    """Words that a set of this size must share with any set of similarity 4/5: ceil(4n/5)."""
    return -(-4 * size // 5)


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that sets of these sizes share at a similarity of 4/5 or more: ceil(4(a + b)/9)."""
    return -(-4 * (a + b) // 9)


def _cell(words: np.ndarray) -> np.ndarray:
    return (mixed(words) >> np.uint64(42)).astype(np.int64)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for part in (c for batch in batches for c in chunks(batch, "_text")):
        known, code, _ = word_codes(part.column("_text"))
        np.add.at(counts, _cell(known), np.bincount(code, minlength=len(known)))
    cells = np.flatnonzero(counts)
    for at in range(0, len(cells), 1 << 16):
        some = cells[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["cell", "n"])


def _pack_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithms of the counts, in eighths, by block."""
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        cells, counts = batch.column("cell").to_numpy(), batch.column("n").to_numpy()
        level = np.minimum(255, np.ceil(8 * np.log2(counts + 1))).astype(np.uint8)
        for block in np.unique(cells // CELL_BLOCK).tolist():
            own = cells // CELL_BLOCK == block
            blocks.setdefault(block, np.zeros(CELL_BLOCK, np.uint8))[cells[own] % CELL_BLOCK] = level[own]
    if blocks:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks)), pa.array([b.tobytes() for b in blocks.values()])], ["block", "levels"]
        )


def rarity(read: DataFrame, count=_count_cells) -> np.ndarray:
    """The sketch: a byte for each cell, larger for more frequent words (or what else ``count`` counts)."""
    counts = read.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    blocks = counts.withColumn("_b", F.floor(F.col("cell") / CELL_BLOCK)).repartition("_b").select("cell", "n")
    levels = np.zeros(CELLS, np.uint8)
    for r in blocks.mapInArrow(_pack_cells, "block long, levels binary").collect():
        levels[r["block"] * CELL_BLOCK :][:CELL_BLOCK] = np.frombuffer(r["levels"], np.uint8)
    return levels


class Sets:
    """The word sets of the lines of some texts: words by (line, rarity, hash), and each line's figures."""

    def __init__(self, part: pa.RecordBatch, levels: np.ndarray):
        texts = part.column("_text").cast(pa.binary()).to_pylist()
        split = [t.split(b"\n") if t else [] for t in texts]
        many = np.fromiter(map(len, split), np.int64, len(split))
        known, code, counts = word_codes(pa.array([x for s in split for x in s], pa.binary()).cast(pa.string()))
        line = np.repeat(np.arange(len(counts)), counts)
        level = levels[_cell(known)] if len(known) else np.zeros(0, np.uint8)
        # Line, rarity and half of the hash in one number; should two words of a line share it, by all of them.
        short = (level.astype(np.uint64) << np.uint64(32)) | (known >> np.uint64(32))
        number = (line.astype(np.uint64) << np.uint64(40)) | short[code]
        order = np.argsort(number)
        code, line, number = code[order], line[order], number[order]
        if len(counts) >> 24 or np.any((number[1:] == number[:-1]) & (code[1:] != code[:-1])):
            order = np.lexsort((known[code], level[code], line))
            code, line = code[order], line[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (line[1:] != line[:-1])
        code, line = code[new], line[new]
        self.words = known[code]
        used = np.flatnonzero(np.diff(line, prepend=-1))
        number = line[used]
        self.start, self.size = used, np.diff(np.append(used, len(line)))
        row = np.repeat(np.arange(len(many)), many)[number] if len(number) else number
        inside = number - (np.cumsum(many) - many)[row]
        self.doc = part.column("_id").to_numpy()[row]
        self.place = (inside << 32) | part.column("_hash").to_numpy()[row]
        if len(used):
            spread = mixed(known ^ np.uint64(0x5851F42D4C957F2D))[code]
            self.name = mixed(np.add.reduceat(spread, used) + self.size.astype(np.uint64)).view(np.int64)
            bits = np.uint64(1) << (spread >> np.uint64(58))
            self.sketch = np.bitwise_xor.reduceat(bits, used).view(np.int64)
        else:
            self.name = self.sketch = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.size)


POSTING = "word long, name long, sketch long, doc long, place long, where long"


# Level of a cell that counts one word.
ONCE = 8


def _post(levels, marked=None):
    """Postings of each batch's different sets; copies inside the batch are posted as such (at -2).

    With ``marked`` just the postings under words whose cells are marked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (c for batch in batches for c in chunks(batch, "_text")):
            sets = Sets(part, levels.value)
            order = np.lexsort((sets.place, sets.doc, sets.name))
            name = sets.name[order]
            first = np.concatenate(([True], name[1:] != name[:-1])) if len(name) else np.zeros(0, bool)
            alone, copies = order[first], order[~first]
            if len(copies):
                origin = alone[np.cumsum(first) - 1][~first]
                same = (sets.doc[origin] == sets.doc[copies]) & (sets.place[origin] >> 32 == sets.place[copies] >> 32)
                copies = copies[~same]
            prefix = np.where(sets.size >= 4, sets.size - needed(sets.size) + 1, 0)[alone]
            set_of = np.repeat(alone, prefix)
            at = np.arange(prefix.sum()) - np.repeat(np.cumsum(prefix) - prefix, prefix)
            word = sets.words[sets.start[set_of] + at]
            cell = _cell(word)
            # A cell that counts one word is that word's only place.
            met = levels.value[cell] > ONCE
            if marked is not None:
                met &= marked.value[cell] > 0
                alone, copies = alone[:0], copies[:0]
            set_of, at, word = set_of[met], at[met], word[met]
            rows = np.concatenate((alone, set_of, copies))
            word = np.concatenate((sets.name[alone], word.view(np.int64), mixed(sets.doc[copies]).view(np.int64)))
            where = np.concatenate((np.full(len(alone), -1), at, np.full(len(copies), -2)))
            columns = (word, sets.name[rows], sets.sketch[rows], sets.doc[rows], sets.place[rows], sets.size[rows] << 32 | (where + 2))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in POSTING.split(", ")])

    return run


# Where ``more`` is set, ``word`` is the list that holds more candidates of the line.
FOUND = "doc long, place long, other long, other_place long, more boolean, word long"


def _candidates(size, at, sketch, i, j):
    """Which of the pairs of places i, j can reach the similarity."""
    a, b = size[i], size[j]
    share = overlap(a, b)
    fits = (np.minimum(a, b) >= share) & (np.minimum(a - at[i], b - at[j]) >= share)
    return fits & (np.bitwise_count(sketch[i] ^ sketch[j]) <= a + b - 2 * share)


def _match(rows: dict[str, np.ndarray], first: int | None, lists: bool = False) -> list[np.ndarray]:
    """Copies and candidate pairs of whole lists, sorted by (word, name, doc, place); with ``lists`` each one's word too."""
    rows = rows | {"size": rows["where"] >> 32, "at": (rows["where"] & 0xFFFFFFFF) - 2}

    def copied(which: np.ndarray) -> list[np.ndarray]:
        n = int(which.sum())
        return [rows["doc"][which], rows["place"][which], np.full(n, LAST), np.full(n, -1), np.zeros(n, bool), rows["word"][which]]

    copy = rows["at"] == -2
    out = [copied(copy)]
    rows = {k: v[~copy] for k, v in rows.items()}
    group = rows["at"] == -1
    word, name = rows["word"], rows["name"]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1]) | (name[1:] != name[:-1])
    origin = np.maximum.accumulate(np.where(new, np.arange(len(word)), 0))
    later = (rows["doc"] != rows["doc"][origin]) | (rows["place"] >> 32 != rows["place"][origin] >> 32)
    out.append(copied(group & later))

    keep = ~group & new
    word, size, at, sketch, doc, place, asked = (rows[k][keep] for k in ("word", "size", "at", "sketch", "doc", "place", "asked"))
    order = np.lexsort((place, doc, word))
    word, size, at, sketch, doc, place, asked = (x[order] for x in (word, size, at, sketch, doc, place, asked))
    sketch = sketch.view(np.uint64)
    begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.zeros(0, int)
    many = np.diff(np.append(begin, len(word)))
    length, inside = np.repeat(many, many), np.arange(len(word)) - np.repeat(begin, many)

    def nearest(later: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all candidates of each of these lines the nearest few, and whether it had more."""
        strict = (doc[earlier] != doc[later]) | (place[earlier] >> 32 != place[later] >> 32)
        later, earlier = later[strict], earlier[strict]
        order = np.lexsort((earlier, np.bitwise_count(sketch[later] ^ sketch[earlier]), later))
        later, earlier = later[order], earlier[order]
        fresh = np.flatnonzero(np.diff(later, prepend=-1))
        total = np.diff(np.append(fresh, len(later)))
        nth = np.arange(len(later)) - np.repeat(fresh, total)
        some = nth < (first or LAST)
        return later[some], earlier[some], (np.repeat(total, total) > (first or LAST))[some]

    short = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for step in range(1, SHORT):
        j = np.flatnonzero((length <= SHORT) & (inside >= step) & asked)
        good = _candidates(size, at, sketch, j - step, j)
        short.append((j[good], j[good] - step))
    pairs = [nearest(*(np.concatenate(x) for x in zip(*short)))]
    for start, count in zip(begin[many > SHORT].tolist(), many[many > SHORT].tolist()):
        block = max(1, 2_000_000 // count)
        for low in range(0, count, block):
            x = start + np.arange(low, min(low + block, count))
            x = x[asked[x]]
            i, j = np.meshgrid(np.arange(start, start + count), x)
            i, j = i.ravel(), j.ravel()
            i, j = i[i < j], j[i < j]
            good = _candidates(size, at, sketch, i, j)
            # All candidates of a line are in its block, so no more than the nearest are kept from it.
            pairs.append(nearest(j[good], i[good]))
    later, earlier, more = (np.concatenate(x) for x in zip(*pairs))
    out.append([doc[later], place[later], doc[earlier], place[earlier], more, word[later]])
    return [np.concatenate(x) for x in zip(*out)][: None if lists else 5]


def _ordered(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rows of whole lists, sorted by word: without those that are alone under theirs, by (word, name, doc, place)."""
    word = rows["word"]
    new = np.concatenate(([True], word[1:] != word[:-1], [True])) if len(word) else np.zeros(1, bool)
    alone = new[1:] & new[:-1] & ((rows["where"] & 0xFFFFFFFF) != 0)
    rows = {k: v[~alone] for k, v in rows.items()}
    order = np.lexsort([rows[k] for k in ("place", "doc", "name", "word")])
    return {k: v[order] for k, v in rows.items()}


def _scan_lists(first: int | None):
    names = ("word", "name", "sketch", "doc", "place", "where", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}

        def told(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _match(_ordered(rows), first, True)], [c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if kept:
                now = {k: np.concatenate((kept[k], v)) for k, v in now.items()}
            word = now["word"]
            different = np.flatnonzero(word != word[-1]) if len(word) else []
            cut = int(different[-1]) + 1 if len(different) else 0
            if cut:
                yield told({k: v[:cut] for k, v in now.items()})
            kept = {k: v[cut:] for k, v in now.items()}
        if kept and len(kept["word"]):
            yield told(kept)

    return run


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word sets of the wanted lines."""
    for part in (c for batch in batches for c in chunks(batch, "_text")):
        doc, place, texts = [], [], []
        columns = (part.column(c).to_pylist() for c in ("_id", "_hash", "_lines"))
        for text, key, digest, wanted in zip(part.column("_text").cast(pa.binary()).to_pylist(), *columns):
            lines = text.split(b"\n")
            doc += [key] * len(wanted)
            place += [n << 32 | digest for n in wanted]
            texts += [lines[n] for n in wanted]
        words, counts = word_hashes(pa.array(texts, pa.binary()).cast(pa.string()))
        line = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((words, line))
        words, line = words[order], line[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        ends = np.concatenate(([0], np.cumsum(np.bincount(line[new], minlength=len(counts))))) * 8
        data = words[new].astype("<u8").tobytes()
        sets = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(place, pa.int64()), pa.array(sets, pa.binary())], ["doc", "place", "words"]
        )


def _similar(left: pa.Array, right: pa.Array) -> pa.Array:
    sides = [left.cast(pa.large_binary()), right.cast(pa.large_binary())]
    sizes = [pc.binary_length(side).to_numpy() // 8 for side in sides]
    words = np.concatenate([np.frombuffer(b"".join(side.to_numpy(zero_copy_only=False)), "<u8") for side in sides])
    pair = np.concatenate([np.repeat(np.arange(len(n)), n) for n in sizes])
    # A word of a pair as one number; a set has each word once, so equal numbers are shared words.
    number = mixed(words + mixed(pair))
    order = np.argsort(number)
    number = number[order]
    both = np.bincount(pair[order[1:][number[1:] == number[:-1]]], minlength=len(sizes[0]))
    return pa.array(5 * both >= 4 * (sizes[0] + sizes[1] - both), pa.bool_())


def _low(column: str = "place"):
    return F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)).alias("_hash")


def _verified(read: DataFrame, found: DataFrame) -> DataFrame:
    """``doc, place`` of the lines that match one of their candidates."""
    pairs = found.where("other_place >= 0").select("doc", "place", "other", "other_place").distinct()
    ends = pairs.select(F.explode(F.array(F.struct("doc", "place"), F.struct(F.col("other").alias("doc"), F.col("other_place").alias("place")))).alias("e"))
    lists = ends.select("e.*").distinct().groupBy(F.col("doc").alias("_id"), _low()).agg(
        F.collect_list(F.shiftright("place", 32)).alias("_lines")
    )
    sets = staged(read.join(lists, ["_id", "_hash"]).mapInArrow(_collect_sets, "doc long, place long, words binary"), "sets")
    sets = sets.dropDuplicates(["doc", "place"])
    both = pairs.join(sets.withColumnRenamed("words", "_a"), ["doc", "place"]).join(
        sets.select(F.col("doc").alias("other"), F.col("place").alias("other_place"), F.col("words").alias("_b")), ["other", "other_place"]
    )
    return both.where(F.arrow_udf(_similar, "boolean")("_a", "_b")).select("doc", "place").distinct()


def _lists(read: DataFrame, levels, first: int | None, asked: DataFrame | None = None, marked=None) -> DataFrame:
    postings = read.mapInArrow(_post(levels, marked), POSTING)
    if asked is None:
        postings = postings.withColumn("asked", F.lit(True))
    else:
        known = asked.withColumn("_a", F.lit(True))
        postings = postings.join(known, ["word", "doc", "place"], "left").withColumn("asked", F.coalesce("_a", F.lit(False))).drop("_a")
    met = postings.repartition("word").sortWithinPartitions("word")
    return staged(met.mapInArrow(_scan_lists(first), FOUND), "candidates")


def _mark_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = np.unique(_cell(batch.column("word").to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.ones(len(cells), np.int64))], ["cell", "n"])


def removed_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", first: int = FIRST) -> DataFrame:
    """``_id, _hash, _removed``: line numbers, from 0, that have an earlier similar line."""
    read = docs.select(*_keyed(docs, text, key), F.col(f"`{text}`").alias("_text"))
    context = docs.sparkSession.sparkContext
    levels = context.broadcast(rarity(read))
    found = _lists(read, levels, first)
    gone = staged(found.where("other_place < 0").select("doc", "place").unionByName(_verified(read, found)).distinct(), "gone")
    more = found.where("more").select("word", "doc", "place").distinct()
    asked = staged(more.join(gone, ["doc", "place"], "left_anti").select("word", "doc", "place"), "open")
    if asked.limit(1).count():
        # Only the lists that hold more candidates of a line without a match are put together again.
        marked = context.broadcast(rarity(asked.select("word"), _mark_cells))
        gone = gone.unionByName(_verified(read, _lists(read, levels, None, asked, marked))).distinct()
    return gone.groupBy(F.col("doc").alias("_id"), _low()).agg(F.sort_array(F.collect_set(F.shiftright("place", 32))).alias("_removed"))


def mark_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", carry=None) -> DataFrame:
    """The carried columns (all by default) with ``n_lines``, ``n_removed`` and ``removed``.

    Lines end at line feeds. A line is removed if its set of words (between white space, unchanged)
    has a Jaccard similarity of 4/5 or more with that of an earlier line: in a document of smaller
    key, or earlier in the same one; whether that line itself is removed makes no difference. Lines
    without words match nothing and stay. Keys are whole numbers, null keys one last document; rows
    that repeat a key count as one document, so equal rows do not match each other. Null texts have
    no lines, an empty text has one. Input columns named like the new ones are replaced. Words are
    told apart by 64-bit hashes.
    """
    new = ("n_lines", "n_removed", "removed")
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    lines = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(F.split(F.col(f"`{text}`"), "\n"))).cast("long")
    own = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_doc"), lines.alias("n_lines"), *_keyed(docs, text, key)
    )
    joined = own.join(removed_lines(docs, text, key), ["_id", "_hash"], "left")
    removed = F.coalesce("_removed", F.array().cast("array<long>"))
    return joined.select(
        *[F.col(f"_doc.`{c}`") for c in names], "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )


def remove_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with their similar lines taken out, by the rules of ``mark_lines``; columns as before."""
    own = docs.select(F.struct(*columns_of(docs)).alias("_doc"), F.col(f"`{text}`").alias("_text"), F.col(f"`{key}`").alias("_key"))
    marked = mark_lines(own, "_text", "_key")

    def rest(lines):
        stay = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col("removed"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i.cast("int"))), "\n")

    cut = F.when(F.col("n_removed") > 0, F.transform(F.array(F.split("_text", "\n")), rest)[0]).otherwise(F.col("_text"))
    cleaned = marked.withColumn("_clean", cut)
    return cleaned.select(*[F.col("_clean").alias(c) if c == text else F.col(f"_doc.`{c}`") for c in docs.columns])
