"""Fitted models on any Hadoop path, together with the feature names they expect."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def save_model(spark: SparkSession, model: PipelineModel, path: str, features: list[str], target: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    meta = spark.range(1).select(
        F.array(*[F.lit(f) for f in features]).alias("features"), F.lit(target).alias("target")
    )
    meta.write.mode("overwrite").json(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], str]:
    meta = spark.read.schema("features array<string>, target string").json(f"{path}/meta").first()
    return PipelineModel.load(f"{path}/model"), list(meta["features"]), meta["target"]
