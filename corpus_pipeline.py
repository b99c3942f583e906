"""The corpus pipeline: quality, near copies, benchmark leaks, the mix of sources, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lavra.llm import decontaminate, mixing, quality, sharding, simhash
from lavra.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified quality rules keep.

    Null texts and texts of fewer than ten words go. Labels may be missing: then only the base rules act.
    """
    return quality.apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints of three-word shingles that are linked at three bits or fewer.

    The smallest key stays, null keys last; texts without words are copies of each other; an empty table stays empty.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; those without words, null ones and an empty table pass."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document that is taken twice is there twice.

    Documents without words are not taken. The shards that follow have an order of their own, so the
    mix is not put in order of its finish times.
    """
    return mixing.mix(docs, ordered=False)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard; null texts count as empty, and an empty table has no shards."""
    return sharding.assign_shards(docs, leaves=24)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

# Near copies are groups of verified fingerprint links, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
