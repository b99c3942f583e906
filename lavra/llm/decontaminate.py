"""Benchmark decontamination with a hash set of the benchmark's word windows, all in Spark SQL.

The set is a hash table of the normalised windows, an array of buckets that Spark folds into one
constant and sends to every executor, after its size has been checked. Each document is then scanned
where it is read: a word pair rules out most places, the hash of the whole window finds its bucket, and
the words in the bucket verify it. No text is shuffled. A benchmark above the bound is joined instead.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.text import lower_ascii
from lavra.session import staged

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
PIECE = r"([0-9A-Za-z[^\x00-\x7F]]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
# Largest hash table, in bytes of its words and item names, that is sent to every executor.
TABLE_BYTES = 16 * 1024 * 1024
TABLE = "array<array<struct<words:array<string>,items:array<string>>>>"


def word_list(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and all characters beyond ASCII; null has none."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), GAP + "+"), ""), F.array().cast("array<string>"))


def _windows(benchmark: DataFrame, text: str, item: str, words: int) -> DataFrame:
    """One row per distinct window: its words and the sorted names of the items that hold it."""
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), word_list(F.col(f"`{text}`")).alias("w"))
    long = F.least(F.size("w"), F.lit(words))
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - long + 1), lambda i: F.slice("w", i, long))
    each = items.where(F.size("w") > 0).select("item", F.explode(cut).alias("words"))
    return each.where(F.col("item").isNotNull()).groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _slot(words: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(buckets)).cast("int")


class HashTable:
    """The windows by length, as constants: per length the buckets and the pairs that begin a window."""

    def __init__(self, windows: DataFrame):
        sized = windows.withColumn("n", F.size("words"))
        count = sized.count()
        self.buckets = 1 << max(4, (2 * count).bit_length())
        self.pairs = 8 * self.buckets
        at = F.when(F.col("n") > 1, _slot([F.col("words")[0], F.get("words", F.lit(1))], self.pairs))
        # The hash of the words one by one, as in a document; a window shorter than the longest has its own form.
        lengths = sorted(r.n for r in sized.select("n").distinct().collect())
        whole = F.coalesce(
            *[F.when(F.col("n") == n, _slot([F.get("words", F.lit(i)) for i in range(n)], self.buckets)) for n in lengths]
        ) if lengths else F.lit(0)
        rows = sized.select("n", "words", "items", at.alias("pair"), whole.alias("bucket")).collect()
        self.lengths = {}
        for n in lengths:
            own = [r for r in rows if r.n == n]
            buckets: list = [None] * self.buckets
            for r in own:
                buckets[r.bucket] = [*(buckets[r.bucket] or []), {"words": r.words, "items": r["items"]}]
            starts: list = [None] * self.pairs
            for r in own:
                if r.pair is not None:
                    starts[r.pair] = True
            self.lengths[n] = (
                F.from_json(F.lit(json.dumps(buckets)), TABLE),
                F.from_json(F.lit(json.dumps(starts)), "array<boolean>"),
            )

    def hits(self, words: str) -> Column:
        """Verified windows of a word list: structs of place (from 0), length and items."""
        found = [self._of_length(words, n, *tables) for n, tables in self.lengths.items()]
        none = F.array().cast("array<struct<at:int,n:int,items:array<string>>>")
        return F.concat(none, *found)

    def _of_length(self, words: str, n: int, table: Column, starts: Column) -> Column:
        def places(a: Column) -> Column:
            at = F.when(F.size(a) >= n, F.sequence(F.lit(0), F.size(a) - n))
            if n > 1:
                at = F.filter(at, lambda i: F.get(starts, _slot([F.get(a, i), F.get(a, i + 1)], self.pairs)))
            return F.flatten(F.transform(at, lambda i: verified(a, i)))

        def verified(a: Column, i: Column) -> Column:
            bucket = F.get(table, _slot([F.get(a, i + k) for k in range(n)], self.buckets))
            same = F.filter(bucket, lambda b: b["words"] == F.slice(a, i + 1, n))
            shaped = F.transform(same, lambda b: F.struct(i.alias("at"), F.lit(n).alias("n"), b["items"].alias("items")))
            return F.coalesce(shaped, F.array().cast("array<struct<at:int,n:int,items:array<string>>>"))

        # The list is bound once as a lambda variable instead of being read anew at every place.
        bound = F.transform(F.array(F.col(words)), places)[0]
        return F.coalesce(bound, F.array().cast("array<struct<at:int,n:int,items:array<string>>>"))


def _joined_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The same hits for a benchmark of any size: documents get numbers, their windows are joined."""
    marked = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "scanned")
    lengths = [r.n for r in windows.select(F.size("words").alias("n")).distinct().collect()]

    def windows_of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("_words") - n)
        cut = F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.slice("_words", i + 1, n).alias("words")))
        return F.when(F.size("_words") >= n, cut)

    none = F.array().cast("array<struct<at:int,n:int,words:array<string>>>")
    cut = F.concat(none, *[F.coalesce(windows_of(n), none) for n in lengths])
    places = marked.select("_row", F.explode(cut).alias("c")).select("_row", "c.*")
    found = places.join(windows, "words").groupBy("_row").agg(
        F.collect_list(F.struct("at", "n", "items")).alias("_hits")
    )
    none = F.array().cast("array<struct<at:int,n:int,items:array<string>>>")
    return marked.join(found, "_row", "left").drop("_row").withColumn("_hits", F.coalesce("_hits", none))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_places`` (word numbers from 0), ``items``, ``contaminated``.

    A benchmark window is ``words`` consecutive words of an item, or the whole of a shorter item; a
    word of a document is hit inside any occurrence of a window. Null and empty texts, on either
    side, have no words and no windows; items without a name are passed over. Repeated items count
    once, repeated documents each get their result. Input columns named like the new ones are
    replaced. An empty benchmark contaminates nothing.
    """
    new = ("n_words", "n_hit", "hit_places", "items", "contaminated", "_words", "_hits", "_row")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    windows = staged(_windows(benchmark, item_text, item, words), "windows")
    names = F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x))
    size = windows.agg(F.sum(F.octet_length(F.concat_ws(" ", "words")) + names)).first()[0] or 0
    spread = docs.select(*rest, word_list(F.col(f"`{text}`")).alias("_words"))
    if size <= table_bytes:
        found = spread.withColumn("_hits", HashTable(windows).hits("_words"))
    else:
        found = _joined_hits(spread, windows)
    places = F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1))))
    shown = found.select(
        *rest, F.size("_words").cast("long").alias("n_words"), places.alias("hit_places"),
        F.array_sort(F.array_distinct(F.flatten(F.col("_hits.items")))).alias("items"),
    )
    return shown.select(
        *rest, "n_words", F.size("hit_places").cast("long").alias("n_hit"), "hit_places", "items",
        (F.size("hit_places") > 0).alias("contaminated"),
    )


def without_spans(scanned: DataFrame, text: str = "text") -> Column:
    """The text of a scanned row without its hit words and what stands between them and the next word."""
    pieces = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(PIECE), F.lit(1))
    head = F.regexp_extract(F.col(f"`{text}`"), f"^{GAP}*", 0)

    def rest(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("hit_places"))
        return F.concat(head, F.array_join(F.transform(kept, lambda i: F.get(parts, i)), ""))

    return F.when(F.col("n_hit") > 0, F.transform(F.array(pieces), rest)[0]).otherwise(F.col(f"`{text}`"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", **options
) -> DataFrame:
    """``docs`` without what the benchmark holds: contaminated ``documents`` go, or only the hit ``spans``.

    The columns of ``docs`` are returned, whatever they are called. Where spans are cut, rows without
    a hit keep their text unchanged.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be documents or spans")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{text}`").alias("_text"))
    scanned = scan(own, benchmark, text="_text", **options)
    if remove == "documents":
        return scanned.where(~F.col("contaminated")).select("_doc.*")
    cleaned = scanned.withColumn("_clean", without_spans(scanned, "_text"))
    return cleaned.select(*[F.col("_clean").alias(c) if c == text else F.col(f"_doc.`{c}`") for c in docs.columns])
