"""Compression of vectors into codes of four small codebooks, in whole numbers.

Each component becomes an integer, each vector is cut into parts, and each part is named by the nearest
of up to 256 entries of its position's codebook. The codebooks are fitted in rounds over all rows.

Distances come from dictionaries: of a batch of rows each dimension's distinct integers are numbered,
and a table holds their squared differences to all entries. A part's distances are then rows of these
tables, gathered by number and added up. A table has as many rows as a batch has different
integers, whatever the range of the values. A round sends entry sums, not rows: tasks add up their own rows,
Spark adds up the tasks, and the driver sees one row per codebook component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.operators.joins import skew_join
from lavra.session import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Integers beyond this have no code: with up to 4,096 dimensions squared distances stay within 64 bits.
LARGEST = 1 << 24
# Rows whose distances are added up at once, so that they stay in a core's cache.
BLOCK = 512


def distances(values: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Squared distances of rows to all entries, a block of rows (with its first row's number) at a time."""
    width = values.shape[1]
    reach = int(np.abs(values).max()) + int(np.abs(entries).max())
    kind = np.int32 if width * reach * reach < 1 << 31 else np.int64
    tables, codes = [], []
    for d in range(width):
        known, code = np.unique(values[:, d], return_inverse=True)
        tables.append(((known[:, None] - entries[None, :, d]) ** 2).astype(kind))
        codes.append(code)
    for at in range(0, len(values), BLOCK):
        total = tables[0][codes[0][at : at + BLOCK]]
        for table, code in zip(tables[1:], codes[1:]):
            total += table[code[at : at + BLOCK]]
        yield at, total


def nearest(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part the nearest entry, the first of equals, and its squared distance."""
    parts, _, width = books.shape
    found = np.zeros((len(values), parts), np.int64)
    errors = np.zeros((len(values), parts), np.int64)
    for p in range(parts):
        for at, total in distances(values[:, p * width : (p + 1) * width], books[p]):
            best = total.argmin(axis=1)
            found[at : at + len(total), p] = best
            errors[at : at + len(total), p] = total[np.arange(len(total)), best]
    return found, errors


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy().astype(np.int64).reshape(-1, width)


def _add_up(books: np.ndarray):
    """Sums and counts of each entry's parts over all rows of a task."""
    parts, many, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, width, many), np.int64), np.zeros((parts, many), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(0), parts * width)
            found, _ = nearest(values, books)
            for p in range(parts):
                counts[p] += np.bincount(found[:, p], minlength=many)
                for d in range(width):
                    # A batch's sums are far below 2^53, so the weights are exact.
                    added = np.bincount(found[:, p], values[:, p * width + d], minlength=many)
                    sums[p, d] += added.astype(np.int64)
        part, entry = np.nonzero(counts)
        names = ["part", "entry", "position", "total", "n"]
        for d in range(width):
            cells = (part, entry, np.full(len(part), d), sums[part, d, entry], counts[part, entry])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names)

    return run


def fit_codebooks(vectors: DataFrame, start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Entries after some rounds over a table of one column of integer arrays, from the parts in ``start``.

    A round replaces each entry by its parts' mean, rounded down by component; an entry that no part
    is nearest to stays. ``start`` is (part, entry, position); sums are exact, so results do not depend on how
    rows are dealt out.
    """
    books = start.copy()
    for _ in range(rounds):
        rows = vectors.mapInArrow(_add_up(books), "part long, entry long, position long, total long, n long")
        sums = rows.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        # One row per component of a codebook, whatever the number of vectors.
        for r in sums.collect():
            books[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    carry: Sequence[str] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """Rows with ``code, error, label_error``, and the codebooks as integers (part, entry, position).

    Rows whose vector is null or holds a null or non-finite component are dropped. A component becomes
    ``floor(scale * x)``. The codebooks start as the parts of the ``entries`` smallest keys (equal keys
    by their integers; null keys never start one) and are fitted in ``rounds``. ``code`` has two hex digits for
    each part, ``error`` is the squared distance to the entries, ``label_error`` the sum of it over
    equal labels, null labels together.

    The width is that of the smallest key's vector that ``parts`` divides. Vectors of another
    width, empty ones, and those with integers beyond ``LARGEST`` stay with a null code and error and
    take no part in the fit. Without a codebook (no fitting vector, an empty table) all codes are null.
    Repeated rows stay and count each time. ``carry`` names the columns to return, all by default; columns named like the three
    new ones are replaced.
    """
    new = ("code", "error", "label_error")
    kept = [c for c in (table.columns if carry is None else carry) if c not in new]
    value = F.col(f"`{vector}`")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # A million times the largest code is far inside a long; what is beyond it has no code anyway.
    scaled = F.transform(value, lambda x: F.floor(F.greatest(F.least(x.cast("double"), F.lit(1e12)), F.lit(-1e12)) * scale))
    rows = staged(
        table.where(value.isNotNull() & finite).select(
            F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_row"),
            F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").alias("_label"), scaled.alias("_v"),
        ),
        "vectors",
    )
    fits = (F.size("_v") > 0) & (F.size("_v") % parts == 0) & F.forall("_v", lambda x: F.abs(x) <= LARGEST)
    named = rows.where(fits & F.col("_key").isNotNull())
    first = named.orderBy("_key", "_v").select("_v").first()
    width = len(first["_v"]) if first else parts
    coded = fits & (F.size("_v") == width)
    chosen = named.where(coded).orderBy("_key", "_v").limit(entries).select("_v").collect()
    start = np.array([r["_v"] for r in chosen], np.int64).reshape(len(chosen), parts, -1 if chosen else width // parts)
    books = fit_codebooks(rows.where(coded).select("_v"), start.transpose(1, 0, 2), rounds) if first else start.transpose(1, 0, 2)

    def code(vectors: pa.Array) -> pa.Array:
        found, errors = nearest(_matrix(vectors, width), books) if len(vectors) else (np.zeros((0, parts), np.int64), np.zeros((0, parts)))
        names = pa.array(["".join(f"{e:02x}" for e in row) for row in found.tolist()], pa.string())
        return pa.StructArray.from_arrays([names, pa.array(errors.sum(axis=1), pa.int64())], ["code", "error"])

    done = F.arrow_udf(code, "code string, error long")("_v")
    row, columns = F.col("_row"), ("_row", "_label", "code", "error")
    known = rows.where(coded).withColumn("_c", done).select("_row", "_label", "_c.*") if first else None
    unknown = rows.where(~coded) if first else rows
    unknown = unknown.select("_row", "_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    made = staged(known.unionByName(unknown) if first else unknown, "codes").select(*columns)
    sums = made.groupBy("_label").agg(F.sum("error").alias("_sum"))
    unlabelled = sums.where(F.col("_label").isNull()).first()
    joined = skew_join(made, sums.where(F.col("_label").isNotNull()), ["_label"])
    total = F.when(F.col("_label").isNull(), F.lit(unlabelled["_sum"] if unlabelled else None)).otherwise(F.col("_sum"))
    return joined.select(*[row[c].alias(c) for c in kept], "code", "error", total.cast("long").alias("label_error")), books
