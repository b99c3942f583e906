"""Reading raw and typed tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import quoted
from lavra.session import staged

# Cell texts that a raw read takes as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CORRUPT = "_corrupt_line"

# The characters that Windows-1252 puts at 0x80-0x9F (unassigned bytes left out).
CP1252_BYTES = "80 82 83 84 85 86 87 88 89 8A 8B 8C 8E 91 92 93 94 95 96 97 98 99 9A 9B 9C 9E 9F"
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def _csv_reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool = False):
    charset = "ISO-8859-1" if encoding.lower() in ("cp1252", "latin-1") else encoding
    return spark.read.options(
        header=True, sep=sep, encoding=charset, inferSchema=False, escape='"', enforceSchema=False,
        multiLine=multi_line,
    )


def _cell(c: Column, encoding: str, missing: Sequence[str]) -> Column:
    """Spark reads Latin-1 natively; the 27 characters where cp1252 differs are put right here."""
    if encoding.lower() == "cp1252":
        c = F.translate(c, "".join(chr(int(b, 16)) for b in CP1252_BYTES.split()), CP1252_CHARS)
    return F.when(~c.isin(*missing), c) if missing else c


def scan_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    missing: Sequence[str] = MISSING_CELLS,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV with every column as text. A missing path is an error.

    ``multi_line`` reads line breaks inside quotes as part of the cell; each file is then read by
    one task, so large inputs should come as many files.
    """
    raw = _csv_reader(spark, sep, encoding, multi_line).csv(path)
    return raw.select(*[_cell(F.col(quoted(c)), encoding, missing).alias(c) for c in raw.columns])


def scan_tolerant(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    missing: Sequence[str] = MISSING_CELLS,
    multi_line: bool = False,
) -> DataFrame:
    """As ``scan_raw``, but lines with too many fields are skipped and short ones padded with null.

    Spark marks long and short lines alike, so marked lines are told apart by counting the
    delimiters outside quotes. Column pruning inside the CSV parser would hide the marks and is off.
    """
    names = _csv_reader(spark, sep, encoding, multi_line).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    raw = (
        _csv_reader(spark, sep, encoding, multi_line)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False)
        .schema(schema)
        .csv(path)
    )
    unquoted = F.regexp_replace(F.col(CORRUPT), '"[^"]*"', "")
    delimiters = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))
    kept = raw.where(F.col(CORRUPT).isNull() | (delimiters < len(names)))
    return kept.select(*[_cell(F.col(quoted(c)), encoding, missing).alias(c) for c in names])


# Part of a record that a row is: all of it, the end (or middle) of one from an earlier split, the start of one.
WHOLE, ENDED, STARTED = 0, 1, 2
RECORDS = "_file long, _block long, _edge int, _header boolean, value string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines ``_file, _block, value, _open`` in the order of their splits; headers are left out.

    ``_open`` says whether the split starts inside quotes. Lines of an unfinished record wait for its end.
    """
    place, opened, edge, header = None, 0, WHOLE, False
    waiting: list[pa.Array] = []

    def rows(edges: Sequence[int], headers: Sequence[bool], values: pa.Array) -> pa.RecordBatch:
        files, blocks = ([x] * len(values) for x in place)
        columns = [pa.array(files, pa.int64()), pa.array(blocks, pa.int64()), pa.array(edges, pa.int32()), pa.array(headers, pa.bool_())]
        return pa.RecordBatch.from_arrays([*columns, values], [c.split()[0] for c in RECORDS.split(", ")])

    def joined(values: pa.Array, ends: Sequence[int]) -> pa.Array:
        """Lines of each record, up to these places, in one text."""
        if len(ends) == len(values):
            return values
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)
        return pc.binary_join(lists, "\n")

    def unfinished() -> Iterator[pa.RecordBatch]:
        if waiting:
            values = pa.concat_arrays(waiting)
            yield rows([edge or STARTED], [header], joined(values, [len(values)]))

    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, lines = batch.column("_file").to_numpy(), batch.column("_block").to_numpy(), batch.column("value")
        quotes = pc.count_substring(lines, '"').to_numpy()
        starts = np.concatenate(([0], np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(file)]):
            if place != (file[a], block[a]):
                yield from unfinished()
                place, waiting = (int(file[a]), int(block[a])), []
                opened = int(batch.column("_open")[a].as_py())
                edge, header = (ENDED if opened else WHOLE), place[1] == 0
            inside = (opened + np.cumsum(quotes[a:b])) % 2
            opened = int(inside[-1])
            ends = np.flatnonzero(inside == 0) + 1
            if not len(ends):
                waiting.append(lines.slice(a, b - a))
                continue
            more = sum(map(len, waiting))
            values = pa.concat_arrays([*waiting, lines.slice(a, int(ends[-1]))])
            texts = joined(values, ends + more)
            waiting = [lines.slice(a + int(ends[-1]), b - a - int(ends[-1]))] if ends[-1] < b - a else []
            if header:
                texts = texts.slice(1)
            edges = np.zeros(len(texts), np.int32)
            if edge:
                edges[0] = edge
            edge, header = WHOLE, False
            if len(texts):
                yield rows(edges, np.zeros(len(texts), bool), texts)
    yield from unfinished()


def scan_quoted(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", missing: Sequence[str] = MISSING_CELLS
) -> DataFrame:
    """As ``scan_raw`` with ``multi_line``, but a file is read in as many splits as its size asks for.

    A line belongs to the record before it when an odd number of quotes stands ahead of it in its file. Quotes are
    counted by split and the parities of the splits ahead are added (a row per split). Each split's task then puts its
    records together as it reads; only what a split has of records that cross its edges is shuffled. Files are told apart
    by 64-bit hashes. Files are UTF-8, lines end with ``\\n`` or ``\\r\\n``, each file has the same header, and every
    record has as many cells; a quote that is never closed takes the rest of its file along.
    """
    names = _csv_reader(spark, sep, "UTF-8", True).csv(path).columns
    split = [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = spark.read.option("lineSep", "\n").text(path).select(*split, "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # One row per split of a file. The driver lists the splits too; only those that start inside quotes are sent to all tasks.
    ahead = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = lines.groupBy("_file", "_block").agg(F.sum(quotes).alias("_all"))
    opened = splits.select("_file", "_block", (F.coalesce(F.sum("_all").over(ahead), F.lit(0)) % 2 == 1).alias("_open")).where("_open")
    marked = lines.join(F.broadcast(opened), ["_file", "_block"], "left").withColumn("_open", F.coalesce("_open", F.lit(False)))
    told = staged(marked.mapInArrow(_records, RECORDS), "records")
    # At most two rows per split: the end of a record, or all of the split inside one, and a start.
    parts = told.where("_edge > 0")
    upto = W.partitionBy("_file").orderBy("_block", "_edge").rowsBetween(W.unboundedPreceding, 0)
    started = F.max(F.when(F.col("_edge") == STARTED, F.col("_block"))).over(upto)
    joined = parts.withColumn("_record", started).groupBy("_file", "_record").agg(
        F.max("_header").alias("_header"), F.sort_array(F.collect_list(F.struct("_block", "_edge", "value"))).alias("_parts")
    )
    text = F.array_join(F.transform("_parts", lambda part: part["value"]), "\n")
    records = told.where("_edge = 0").select("value").unionByName(joined.where("not _header").select(text.alias("value")))
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    cells = F.from_csv(F.regexp_replace("value", "\r$", ""), F.lit(schema), {"sep": sep, "escape": '"', "maxCharsPerColumn": "-1"})
    filled = records.where(F.length(F.trim("value")) > 0).select(cells.alias("c"))
    return filled.select(*[_cell(F.col(f"c.c{i}"), "utf-8", missing).alias(c) for i, c in enumerate(names)])


def scan_typed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A layer table. Parquet carries its own types; a schema narrows or pins them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order; the scan reads only these."""
    present = set(df.columns)
    return df.select(*[quoted(c) for c in dict.fromkeys(wanted) if c in present])
