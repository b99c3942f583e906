"""Chunked reading of a raw folder: each trigger takes some files, old ones are not read again.

Only row-wise transforms fit here; they are the same functions as for whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    progress: str,
    sep: str = ",",
    files_per_chunk: int = 1000,
) -> StreamingQuery:
    """Append the transformed rows of files that arrived since the last run, then stop.

    ``progress`` is a folder shared by all executors; it remembers the files already taken.
    """
    chunks = (
        spark.readStream.schema(schema)
        .options(header=True, sep=sep, escape='"', maxFilesPerTrigger=files_per_chunk)
        .csv(source)
    )
    return (
        transform(chunks)
        .writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )
