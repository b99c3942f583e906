"""Nested JSON and header-row payloads as flat tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_json(
    df: DataFrame,
    column: str,
    schema: T.DataType | str,
    plain: Mapping[str, str],
    branch: Mapping[str, str] | None = None,
    primary: str | None = None,
    fallback: str | None = None,
) -> DataFrame:
    """Fields of a JSON text column.

    ``plain`` maps output names to paths in the record. ``branch`` maps output names to paths below
    a struct that is found at ``primary`` or, for records where that is absent or empty, at
    ``fallback``. The choice is made once per record, for the whole struct: fields of the two
    places are never mixed. Back-quote path steps that hold hyphens.
    """
    record = df.withColumn("_record", F.from_json(F.col(column), schema))
    columns = [F.col(f"_record.{path}").alias(name) for name, path in plain.items()]
    if branch:
        first = F.col(f"_record.{primary}")
        # A present but empty object counts as absent, as does one whose known fields are all null.
        empty = first.isNull() | (F.to_json(first) == "{}")
        record = record.withColumn("_branch", F.when(empty, F.col(f"_record.{fallback}")).otherwise(first))
        columns += [F.col(f"_branch.{path}").alias(name) for name, path in branch.items()]
    kept = [c for c in df.columns if c != column]
    return record.select(*kept, *columns)


def variant_fields(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Fields of JSON records whose values differ in type from record to record.

    ``fields`` maps output names to a JSON path and a type. Records are parsed once into a variant, without a schema: a value that
    cannot be cast to its field's type is null in that field alone, and a text that is no JSON is null in all.
    Objects and arrays read as ``string`` are their JSON.
    """
    record = df.withColumn("_record", F.try_parse_json(F.col(column)))
    kept = [c for c in df.columns if c != column]
    return record.select(*kept, *[F.try_variant_get("_record", path, kind).alias(name) for name, (path, kind) in fields.items()])


def header_row_table(df: DataFrame, column: str) -> DataFrame:
    """Rows of an array of maps whose element 0 maps each internal key to its label.

    Every payload is read by its own header, so keys may mean different things in each; labels that
    a payload lacks are null in its rows. The columns are the labels of all payloads, in the order
    they first stand in. A payload with fewer than two elements raises when the rows are computed.
    """
    header = F.element_at(F.col(column), 1)
    places = df.select(F.posexplode(F.map_values(header)).alias("pos", "label")).groupBy("label").agg(F.min("pos").alias("pos"))
    # One row per output column.
    labels = [r["label"] for r in places.orderBy("pos", "label").collect() if r["label"] is not None]
    if not labels:
        raise ValueError("no payload")
    kept = [c for c in df.columns if c != column]
    complaint = F.raise_error(F.lit("payload without data rows")).cast(df.schema[column].dataType)
    whole = F.when(F.size(column) >= 2, F.col(column)).otherwise(complaint)
    rows = df.select(*kept, F.map_entries(header).alias("_header"), F.posexplode(whole).alias("_pos", "_row")).where("_pos > 0")

    def value(label: str) -> Column:
        key = F.get(F.filter("_header", lambda e: e["value"] == label), F.lit(0))["key"]
        return F.try_element_at("_row", key).alias(label)

    return rows.select(*kept, F.col("_pos").alias("_ordinal"), *[value(label) for label in labels])
