"""Writing layers, reports, manifests and model runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.categories import CategoryFeatures

MANIFEST_SCHEMA = (
    "fonte string, url string, arquivo_original string, arquivo_tabular string, "
    "linhas_origem long, linhas_bronze long"
)
EXTERNAL_SCHEMA = "fonte string, ano int, arquivo string, chave_integracao string, uso string"


def write_layer(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite a layer table and return its row count.

    The rows of a Parquet table are counted from the footers of the files just written. (A metric
    observed during the write would do too, but then the session refuses to ship fitted models.)
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
        written = df.sparkSession.read.options(header=True, escape='"', multiLine=True, inferSchema=False)
        return written.csv(path).count() if df.columns else 0
    writer.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path).count()


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8; nothing outside ASCII is escaped."""
    df.write.mode("overwrite").json(path)


def append_manifest(spark: SparkSession, rows: Sequence[tuple], path: str) -> DataFrame:
    """Add one run's lineage rows (source, origin, files, rows in, rows kept)."""
    frame = spark.createDataFrame(list(rows), MANIFEST_SCHEMA).withColumn(
        "processado_em", F.current_timestamp()
    )
    frame.write.mode("append").parquet(path)
    return frame


def external_manifest(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Lineage of external sources: source, year, file, join key, use, time of processing."""
    return spark.createDataFrame(list(rows), EXTERNAL_SCHEMA).withColumn(
        "processado_em", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    )


def save_run(
    path: str, model: PipelineModel, predictions: DataFrame, metadata: DataFrame
) -> None:
    """Model, predictions and metadata in one folder; the model's category dictionary goes with it."""
    spark, stages = predictions.sparkSession, []
    for i, stage in enumerate(model.stages):
        if isinstance(stage, CategoryFeatures) and stage.getOrDefault(stage.columns):
            folder = f"{path}/categories-{i}"
            spark.read.parquet(stage.getOrDefault(stage.path)).write.mode("overwrite").parquet(folder)
            stage = stage.at(folder)
        stages.append(stage)
    model = PipelineModel(stages)
    model.write().overwrite().save(f"{path}/model")
    predictions.write.mode("overwrite").parquet(f"{path}/predictions")
    write_json(metadata, f"{path}/metadata")


def load_run(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model, predictions and metadata of a saved run."""
    return (
        PipelineModel.load(f"{path}/model"),
        spark.read.parquet(f"{path}/predictions"),
        spark.read.json(f"{path}/metadata"),
    )
