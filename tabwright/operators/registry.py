"""Model versions and stages as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_versions(log: DataFrame) -> DataFrame:
    """Stage of every version from (model_name, version, stage, run_id, ts) events: the last event wins."""
    return log.groupBy("model_name", "version").agg(
        F.max_by("stage", "ts").alias("stage"), F.min_by("run_id", "ts").alias("run_id"), F.min("ts").alias("created_at")
    )


def list_versions(versions: DataFrame) -> DataFrame:
    """All versions by model and version number."""
    return versions.orderBy("model_name", F.col("version").cast("bigint"))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Highest version number per model and stage, one aggregation for all models."""
    others = [c for c in versions.columns if c not in ("model_name", "stage", "version")]
    newest = F.max(F.struct(F.col("version").cast("bigint").alias("version"), *others)).alias("v")
    return versions.groupBy("model_name", "stage").agg(newest).select("model_name", "stage", "v.*")


def resolve_versions(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """The version each request means: the given one, else the latest of its stage.

    ``requests`` holds (model_name, version or null, stage or null). A request
    that matches nothing has a null ``resolved`` version.
    """
    v = versions.select("model_name", F.col("version").cast("bigint").alias("resolved"), F.col("run_id"))
    newest = latest_versions(versions).select("model_name", "stage", F.col("version").alias("resolved"), "run_id")
    explicit = requests.filter("version is not null").alias("q").join(
        v.alias("v"), (F.col("q.model_name") == F.col("v.model_name")) & (F.col("q.version").cast("bigint") == F.col("v.resolved")), "left"
    )
    by_stage = requests.filter("version is null").alias("q").join(
        newest.alias("v"), (F.col("q.model_name") == F.col("v.model_name")) & (F.col("q.stage") == F.col("v.stage")), "left"
    )
    picked = ["q.model_name", "q.version", "q.stage", "v.resolved", "v.run_id"]
    return explicit.select(*picked).unionByName(by_stage.select(*picked))


def with_metrics(versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """(model_name, version, metric, value) through the run of each version."""
    return versions.select("model_name", "version", "stage", "run_id").join(metrics.select("run_id", "metric", "value"), "run_id")


def compare_versions(first: DataFrame, second: DataFrame, how: str = "inner") -> DataFrame:
    """Metrics of two versions by name: difference and percent change (0 for a zero base).

    ``how='full'`` also lists metrics that only one side has.
    """
    a = first.select("metric", F.col("value").alias("first"))
    b = second.select("metric", F.col("value").alias("second"))
    change = F.when(F.col("first") == 0, 0.0).otherwise(F.try_divide(F.col("second") - F.col("first"), F.nullif(F.col("first"), F.lit(0.0))) * 100)
    return (
        a.join(b, "metric", how)
        .withColumn("difference", F.col("second") - F.col("first"))
        .withColumn("percent_change", change)
    )


def shared_metric_names(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("metric").intersect(second.select("metric"))
