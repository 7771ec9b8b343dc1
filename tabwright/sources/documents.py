"""Nested experiment documents: ``map<experiment_id, struct<..., runs array<...>>>`` as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_POINT = "struct<value:double,timestamp:string,step:bigint>"
RUN = (
    "struct<run_id:string,run_name:string,experiment_id:string,status:string,started_at:string,ended_at:string,"
    f"parameters:map<string,string>,tags:map<string,string>,metrics:map<string,array<{METRIC_POINT}>>,"
    "artifacts:map<string,string>,logs:array<string>>"
)
EXPERIMENT = (
    "struct<experiment_id:string,experiment_name:string,description:string,status:string,created_at:string,"
    f"tags:map<string,string>,metadata:map<string,string>,runs:array<{RUN}>>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per experiment from files that each hold one JSON object keyed by experiment id."""
    whole = spark.read.text(path, wholetext=True)
    entries = F.explode(F.map_entries(F.from_json("value", f"map<string,{EXPERIMENT}>")))
    return whole.select(entries.alias("e")).select("e.value.*")


def write_documents(experiments: DataFrame, path: str) -> None:
    """One JSON object per experiment, keyed by its id, one file entry per line."""
    doc = F.to_json(F.map_from_arrays(F.array("experiment_id"), F.array(F.struct(*experiments.columns))))
    experiments.select(doc.alias("value")).write.mode("overwrite").text(path)


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """Documents written one per line; splits and parallelises like any line file."""
    entries = F.explode(F.map_entries(F.from_json("value", f"map<string,{EXPERIMENT}>")))
    return spark.read.text(path).select(entries.alias("e")).select("e.value.*")


def experiments_table(documents: DataFrame) -> DataFrame:
    return documents.drop("runs")


def runs_table(documents: DataFrame) -> DataFrame:
    """One row per run, also where its history is spread over several documents."""
    run = documents.select(F.explode("runs").alias("r")).select("r.*")
    return run.drop("metrics", "parameters", "artifacts", "logs", "tags").distinct()


def run_params_table(documents: DataFrame) -> DataFrame:
    run = documents.select(F.explode("runs").alias("r"))
    return run.select("r.experiment_id", "r.run_id", F.explode("r.parameters").alias("parameter", "value")).distinct()


def run_artifacts_table(documents: DataFrame) -> DataFrame:
    run = documents.select(F.explode("runs").alias("r"))
    return run.select("r.experiment_id", "r.run_id", F.explode("r.artifacts").alias("artifact", "path")).distinct()


def run_metrics_table(documents: DataFrame) -> DataFrame:
    """Long metric history; ``seq`` is the position in the logged list."""
    run = documents.select(F.explode("runs").alias("r"))
    metric = run.select("r.experiment_id", "r.run_id", F.explode("r.metrics").alias("metric", "points"))
    point = metric.select("experiment_id", "run_id", "metric", F.posexplode("points").alias("seq", "p"))
    return point.select("experiment_id", "run_id", "metric", "seq", "p.value", "p.timestamp", "p.step")
