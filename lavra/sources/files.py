"""Tables about files and tables: encodings, delimiters, sizes, columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import quoted
from lavra.sources.scan import scan_raw

# Delimiters tried, in order of preference, and the one used when none occurs.
DELIMITERS = (";", ",", "|", "\t")
DEFAULT_DELIMITER = ";"

# Bytes that Windows-1252 leaves unassigned: a file holding one of them is read as Latin-1.
NOT_CP1252 = "^(..)*(81|8D|8F|90|9D)"


def profile_files(spark: SparkSession, path: str, by_folder: bool = False) -> DataFrame:
    """Encoding, delimiter and line count per file (or per folder of part files).

    Files are read as raw lines, so a large one is split over many tasks and every byte of it is
    looked at. The delimiter is the candidate that occurs most often in the first line outside quotes.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            F.col("value"),
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
            ).alias("place"),
        )
    )
    name = F.regexp_replace("file", "/[^/]*$", "") if by_folder else F.col("file")
    place = F.struct("file", "place") if by_folder else F.col("place")
    valid = F.expr("is_valid_utf8(value)")
    odd = ~valid & F.hex(F.col("value").cast("binary")).rlike(NOT_CP1252)
    profile = lines.groupBy(name.alias("path")).agg(
        F.count("*").alias("n_lines"),
        F.bool_and(valid).alias("utf8"),
        F.bool_or(odd).alias("odd"),
        F.min_by("value", place).alias("first_line"),
    )
    plain = F.regexp_replace("first_line", '"[^"]*"', "")
    counts = [
        F.length(plain) - F.length(F.replace(plain, F.lit(d), F.lit("")))
        for d in DELIMITERS
    ]
    best = F.greatest(*counts)
    separator = F.lit(DEFAULT_DELIMITER)
    for d, n in reversed(list(zip(DELIMITERS, counts))):
        separator = F.when((n == best) & (n > 0), F.lit(d)).otherwise(separator)
    encoding = F.when(F.col("utf8"), "utf-8").when(F.col("odd"), "latin-1").otherwise("cp1252")
    return profile.select(
        "path", encoding.alias("encoding"), separator.alias("separator"), "n_lines"
    )


def scan_by_profile(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All files of a tree as one text table: a reader for each encoding and delimiter, united by column name.

    Columns that some files lack are null in their rows. The driver learns the paths by kind, as it
    does when it lists the tree.
    """
    kinds = profile_files(spark, path).groupBy("encoding", "separator").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    parts = [
        scan_raw(spark, [unquote(p) for p in r["paths"]], r["separator"], r["encoding"], multi_line=multi_line)
        for r in kinds.orderBy("encoding", "separator").collect()
    ]
    if not parts:
        raise ValueError(f"no files in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and size of every matching file in a tree; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length")
    )


def largest_file(spark: SparkSession, path: str, glob: str = "*.{csv,CSV,txt,TXT}") -> DataFrame:
    """The biggest matching file; of equal ones the first by path."""
    return (
        list_files(spark, path, glob)
        .agg(F.min_by(F.struct("path", "length"), F.struct(-F.col("length"), "path")).alias("f"))
        .select("f.*")
    )


def schema_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of every table with rows, nulls and type; names that start with ``_`` are skipped.

    Each table is read once, by one aggregate over all of its columns.
    """
    parts = []
    for table, df in sorted(tables.items()):
        if table.startswith("_"):
            continue
        counts = df.agg(
            F.count("*").alias("rows"),
            F.array(*[F.count(quoted(c)) for c in df.columns]).alias("filled"),
        )
        names = F.array(*[F.lit(c) for c in df.columns])
        types = F.array(*[F.lit(t) for _, t in df.dtypes])
        parts.append(
            counts.select("rows", F.posexplode(F.arrays_zip(names.alias("name"), types.alias("type"), "filled")))
            .select(
                F.lit(table).alias("table_name"),
                (F.col("pos") + 1).cast("int").alias("position"),
                F.col("col.name").alias("column_name"),
                F.col("col.type").alias("column_type"),
                F.col("rows").alias("n_rows"),
                (F.col("rows") - F.col("col.filled")).alias("n_nulls"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
