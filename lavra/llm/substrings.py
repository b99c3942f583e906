"""Removal of repeated word windows with compressed FM-indexes.

Equal windows must meet in one shard without comparing all shards with all documents. A window is
known by its anchor, the word n-gram in it with the smallest hash: equal windows have equal anchors.
Windows in a row that share an anchor form a segment of a document, so a document is about one
segment for every seven words, and

1. segments are counted by anchor; an anchor that occurs once holds nothing that repeats. Equal
   segments are put together on the way, within each batch before the shuffle and then by anchor, and
   all but the first of them are repeats as they stand;
2. segments that share an anchor with a different segment go, with their words, to the shard of the
   anchor. A shard builds an FM-index of them and streams them through it; backward search gives the
   windows that also occur elsewhere, and where first;
3. spans of repeated windows meet their document once more, which is cut.

An anchor with very many different segments (a passage that many documents share has such anchors at
its edges) is dealt out further, window by window, by the first and last word of each window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.fmindex import FMIndex
from lavra.llm.text import columns_of
from lavra.session import staged

WINDOW, GRAM = 20, 8
# Words that a shard's index is planned for, and of an anchor above which it is dealt out.
SHARD_WORDS, HOT_WORDS = 300_000, 30_000
# Bytes of text that are cut into segments at once.
CHUNK_BYTES = 8 << 20
# Bytes of text that are cut into words at once where texts do not meet each other: a word takes many times its bytes.
PIECE_BYTES = 1 << 20
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the different words of all texts, each word's number among them, words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts.fill_null("")))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    # Only a text without words gives an empty piece.
    filled = pc.not_equal(words, "")
    if not pc.all(filled).as_py():
        ends = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))[ends]
        words = words.filter(filled)
    coded = words.dictionary_encode()
    # One call for all words: to_pylist makes a scalar of each first, which took more time than all else here.
    known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known)), coded.indices.to_numpy(), np.diff(ends)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the number of words of each text."""
    known, code, counts = word_codes(texts)
    return known[code], counts


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text each; a longer text has its own."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy().astype(np.int64)
    group = np.cumsum(sizes) // size
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)]):
        yield batch.slice(a, b - a)


def segments(words: np.ndarray, counts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, first word in the text, windows, anchor and hash of every segment."""
    n = len(words)
    if n < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    power = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    back = np.multiply.accumulate(np.full(n, _INVERSE, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power, dtype=np.uint64)))
    value = mixed((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    place, wide, many = np.arange(len(value)), 1, window - gram + 1
    while wide < many:
        step = min(wide, many - wide)
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
        wide += step
    text = np.repeat(np.arange(len(counts)), counts)
    whole = text[: n - window + 1] == text[window - 1 :]
    opens = whole.copy()
    opens[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(opens)
    windows = np.bincount(np.cumsum(opens)[whole] - 1, minlength=len(start))
    end = start + windows + window - 1
    digest = mixed(mixed((sums[end] - sums[start]) * back[start]) + windows.astype(np.uint64))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    return text[start], start - offsets[text[start]], windows, value[start], digest


def _table(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema.split())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


CUT = "later long, anchor long, segment long, doc long, place long, windows long"


def _cut_documents(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (c for batch in batches for c in chunks(batch, "_text")):
            words, counts = word_hashes(part.column("_text"))
            text, start, windows, anchor, digest = segments(words, counts, window, gram)
            doc = part.column("_id").to_numpy()[text]
            place = (start << 32) | part.column("_hash").to_numpy()[text]
            order = np.lexsort((place, doc, digest))
            doc, place, windows, anchor, digest = (x[order] for x in (doc, place, windows, anchor, digest))
            # Equal segments of the batch: only the first has to meet those of other batches.
            fresh = np.diff(digest, prepend=~digest[:1]) != 0
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            later = (doc != doc[first]) | (place >> 32 != place[first] >> 32)
            anchor = np.where(later, mixed(doc), anchor)
            yield _table(
                "later anchor segment doc place windows",
                later.astype(np.int64), _signed(anchor), _signed(digest), doc, place, windows,
            )

    return run


FOUND = "kind long, doc long, place long, windows long, anchor long"
SPAN, INDEX = 0, 1


def _match_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments of whole anchors: repeats of a segment, and those that must be indexed."""
    names = ("later", "anchor", "segment", "doc", "place", "windows")
    kept = None  # Of the last anchor, the first rows of its last two segments, and whether told.
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy() for c in names] + [np.zeros(batch.num_rows, bool)]
        if kept:
            now = [np.concatenate(x) for x in zip(kept, now)]
        later, anchor, segment, doc, place, windows, told = now
        at = np.arange(len(anchor))
        new_anchor = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (later[1:] != later[:-1])))
        new_segment = new_anchor | np.concatenate(([True], segment[1:] != segment[:-1]))
        first = np.maximum.accumulate(np.where(new_segment, at, 0))
        group = np.cumsum(new_anchor) - 1
        kinds = np.bincount(group, weights=new_segment)[group]
        repeat = (later == 1) | (doc != doc[first]) | (place >> 32 != place[first] >> 32)
        index = (later == 0) & new_segment & (kinds > 1) & ~told
        fixed = at >= (len(kept[0]) if kept else 0)
        for kind, rows in ((SPAN, repeat & fixed), (INDEX, index)):  # A kept row may have to be indexed only now.
            count = int(rows.sum())
            if count:
                yield _table(
                    "kind doc place windows anchor", np.full(count, kind), doc[rows], place[rows], windows[rows], anchor[rows]
                )
        tail = np.flatnonzero(new_segment & (group == group[-1]))[-2:]
        told = told | (kinds > 1)
        kept = [x[tail] for x in (later, anchor, segment, doc, place, windows, told)]


CONTENT = "route long, doc long, place long, windows long, words binary"


def _collect_words(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (c for batch in batches for c in chunks(batch, "_text")):
            # Rows that repeat number and text stand together after the join: one of them is enough.
            named = np.stack([part.column(c).to_numpy() for c in ("_id", "_hash")], axis=1)
            part = part.take(pa.array(np.sort(np.unique(named, axis=0, return_index=True)[1])))
            words, counts = word_hashes(part.column("_text"))
            offsets = np.concatenate(([0], np.cumsum(counts)))
            lists = part.column("_wanted")
            wanted = lists.flatten()
            row = np.repeat(np.arange(len(counts)), np.diff(lists.offsets.to_numpy()))
            start, windows, anchor, hot = (wanted.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            # Windows of an anchor that is dealt out stand alone.
            times = np.where(hot, windows, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, start, anchor, hot = (np.repeat(x, times) for x in (row, start, anchor, hot))
            start = start + step
            windows = np.where(hot, 1, np.repeat(windows, times))
            begin = offsets[row] + start
            end = begin + windows + window - 1
            apart = mixed(words[begin] + mixed(words[end - 1] + anchor.astype(np.uint64)))
            route = np.where(hot, _signed(apart), anchor)
            size = end - begin
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            flat = words[np.repeat(begin, size) + inner].astype("<u8")
            bounds = np.concatenate(([0], np.cumsum(size) * 8)).astype(np.int32)
            content = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
            place = (start << 32) | part.column("_hash").to_numpy()[row]
            columns = [pa.array(x) for x in (route, part.column("_id").to_numpy()[row], place, windows)]
            yield pa.RecordBatch.from_arrays([*columns, content], ["route", "doc", "place", "windows", "words"])

    return run


def repeats_in_shard(doc: np.ndarray, place: np.ndarray, words: list[np.ndarray], window: int) -> np.ndarray:
    """Rows (segment, offset) of the windows whose words also start earlier in the shard."""
    order = np.lexsort((place, doc))
    sizes = np.array([len(words[i]) for i in order])
    symbols = np.unique(np.concatenate([words[i] for i in order]), return_inverse=True)[1] + 1
    owner = np.repeat(np.arange(len(order)), sizes)
    at = np.arange(len(symbols)) + owner
    text = np.zeros(len(symbols) + len(order) + 1, np.int64)
    text[at] = symbols
    offset = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    segment_at, offset_at = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    segment_at[at], offset_at[at] = order[owner], offset
    _, start, first = FMIndex(text, window).repeated(window)
    mine, theirs = segment_at[start], segment_at[first]
    here, there = (place[mine] >> 32) + offset_at[start], (place[theirs] >> 32) + offset_at[first]
    earlier = (doc[theirs] < doc[mine]) | ((doc[theirs] == doc[mine]) & (there < here))
    return np.stack((mine[earlier], offset_at[start][earlier]), axis=1)


def _index_shard(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        doc, place = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in ("doc", "place"))
        words = [np.frombuffer(w, "<u8") for b in parts for w in b.column("words").to_pylist()]
        found = repeats_in_shard(doc, place, words, window)
        if len(found):
            rows, offsets = found[:, 0], found[:, 1]
            yield _table(
                "kind doc place windows anchor", np.full(len(rows), SPAN), doc[rows], place[rows] + (offsets << 32),
                np.ones(len(rows), np.int64), np.zeros(len(rows), np.int64),
            )

    return run


def _keyed(docs: DataFrame, text: str, key: str) -> list[Column]:
    """Number of the document, nulls last, and 32 bits of its text to tell apart rows of one number."""
    return [
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("_id"),
        F.xxhash64(f"`{text}`").bitwiseAND(F.lit(0xFFFFFFFF)).alias("_hash"),
    ]


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``_id, _hash, start, windows``: runs of windows of a document that also start earlier."""
    spark = docs.sparkSession
    read = docs.select(*_keyed(docs, text, key), F.col(f"`{text}`").alias("_text"))
    cut = read.mapInArrow(_cut_documents(window, gram), CUT)
    met = cut.repartition("anchor").sortWithinPartitions("later", "anchor", "segment", "doc", "place")
    found = staged(met.mapInArrow(_match_segments, FOUND), "segments")

    start, hashed = F.shiftright("place", 32).alias("start"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("_hash")
    index = found.where(F.col("kind") == INDEX)
    total = index.agg(F.sum(F.col("windows") + window - 1)).first()[0] or 0
    shards = -(-total // SHARD_WORDS)
    spans = found.where(F.col("kind") == SPAN)
    if shards:
        # Anchors that would fill a tenth of a shard: fewer than ten for each shard.
        sizes = index.groupBy("anchor").agg(F.sum(F.col("windows") + window - 1).alias("_n"))
        hot = sizes.where(F.col("_n") > HOT_WORDS).select("anchor", F.lit(True).alias("_hot"))
        marked = index.join(hot, "anchor", "left")
        wanted = F.struct(start, "windows", "anchor", F.coalesce("_hot", F.lit(False)).alias("hot"))
        lists = marked.select(F.col("doc").alias("_id"), hashed, wanted.alias("w")).groupBy("_id", "_hash").agg(
            F.collect_list("w").alias("_wanted")
        )
        content = read.join(lists, ["_id", "_hash"]).mapInArrow(_collect_words(window), CONTENT)
        sharded = content.repartition(shards, "route")
        spans = spans.unionByName(sharded.mapInArrow(_index_shard(window), FOUND))
    return spans.select(F.col("doc").alias("_id"), hashed, start, "windows")


def _cut_words(window: int):
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        counts, removed, kept = [], [], []
        for text, runs in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist()):
            words = text.split() if text else []
            gone = 0
            if runs:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [r["start"] for r in runs], 1)
                np.add.at(edge, [r["start"] + r["windows"] + window - 1 for r in runs], -1)
                covered = np.cumsum(edge[:-1]) > 0
                gone = int(covered.sum())
                out = b" ".join(w for w, c in zip(words, covered.tolist()) if not c)
            else:
                out = b" ".join(words)
            counts.append(len(words))
            removed.append(gone)
            kept.append(out.decode())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["n_words", "n_removed", "kept"],
        )

    return F.arrow_udf(run, "n_words long, n_removed long, kept string")


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, gram: int = GRAM,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The carried columns (all by default) with ``n_words``, ``n_removed`` and ``kept``.

    A window is ``window`` consecutive words between white space, unchanged. A word is removed if a
    window over it has words that also start earlier: in a document of smaller key, or in the same
    document at an earlier place. Windows are judged on the input. ``kept`` is the rest, joined by
    single spaces. Keys are whole numbers; null keys are one last document. Rows that repeat a key
    count as the same document, so equal rows do not repeat each other and get equal results. Null
    and empty texts have no words; shorter texts than a window stay whole. Columns of the input
    named like the new ones are replaced. Windows are told apart by 64-bit hashes of their words.
    """
    new = ("n_words", "n_removed", "kept")
    rest = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry) if c not in new]
    spans = repeated_spans(docs, text, key, window, gram)
    lists = spans.groupBy("_id", "_hash").agg(F.collect_list(F.struct("start", "windows")).alias("_spans"))
    own = docs.select(
        F.struct(F.lit(0).alias("_"), *rest).alias("_doc"), F.col(f"`{text}`").alias("_text"), *_keyed(docs, text, key)
    )
    joined = own.join(lists, ["_id", "_hash"], "left")
    found = joined.withColumn("_cut", _cut_words(window)("_text", "_spans"))
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    return found.select(*[F.col(f"_doc.`{c}`") for c in names], "_cut.*")
