"""Experiments, runs and their metric histories as tables.

A run or an experiment may own a large share of all rows, so "last", "best" and
"current" are aggregates (``max_by``) with map-side combine, never windows over
a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.features import small_once


def append_rows(df: DataFrame, path: str) -> None:
    """Add metric, parameter or artifact rows to a log table."""
    df.write.mode("append").parquet(path)


def current_state(log: DataFrame, id_column: str, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest non-null value of every field per id, from an event log ordered by ``order``."""
    when = F.struct(*order)
    latest = [F.max_by(f, F.when(F.col(f).isNotNull(), when)).alias(f) for f in fields]
    return log.groupBy(id_column).agg(*latest)


def lifecycle(log: DataFrame, id_column: str = "run_id", carried: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """Current status, start and end per run from (id, event, status, ts, seq) rows."""
    order = F.struct("ts", "seq")
    return log.groupBy(id_column).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in carried],
        F.max_by("status", order).alias("status"),
        F.min(F.when(F.col("event") == "start", F.col("ts"))).alias("started_at"),
        F.max(F.when(F.col("event") == "end", F.col("ts"))).alias("ended_at"),
    )


def runs_outside_active(runs: DataFrame, experiments: DataFrame) -> DataFrame:
    """Runs whose experiment is unknown or not active."""
    active = experiments.filter("status = 'active'").select("experiment_id")
    return runs.join(small_once(active), "experiment_id", "left_anti")


def runs_of_active(runs: DataFrame, experiments: DataFrame) -> DataFrame:
    active = experiments.filter("status = 'active'").select("experiment_id")
    return runs.join(small_once(active), "experiment_id", "left_semi")


def last_values(metrics: DataFrame, order: Sequence[str] = ("ts", "seq"), keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Last logged value per run and metric."""
    return metrics.groupBy(*keys, "metric").agg(F.max_by("value", F.struct(*order)).alias("value"))


def find_runs(runs: DataFrame, ids: DataFrame) -> DataFrame:
    """Runs with a requested id; ids that do not exist are ignored."""
    return runs.join(small_once(ids.select("run_id").distinct()), "run_id", "left_semi")


def run_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "finished").alias("completed_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    )


def finished_values(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Last values of finished runs, with their experiment and start time."""
    done = runs.filter("status = 'finished'").select("run_id", "experiment_id", "started_at")
    return last_values(metrics).join(done, "run_id")


def experiment_summaries(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Run counts and statistics of the last values, for all experiments at once."""
    stats = (
        finished_values(runs, metrics)
        .groupBy("experiment_id", "metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count("value").alias("count"),
        )
    )
    return run_counts(runs).join(stats, "experiment_id", "left")


def compare_runs(metrics: DataFrame, ids: Sequence[str], wanted: Sequence[str], maximize: bool = True) -> DataFrame:
    """Last values of the given runs side by side, with mean, population std and the best run.

    ``ids`` is a short list by nature; each becomes a column of the result.
    Runs without the metric stay null and cannot be best; of equal values the first run id wins.
    """
    chosen = last_values(metrics.filter(F.col("run_id").isin(*ids) & F.col("metric").isin(*wanted)))
    order = F.when(F.col("value").isNotNull(), F.struct((-F.col("value") if maximize else F.col("value")).alias("v"), "run_id"))
    return chosen.groupBy("metric").agg(
        *[F.max(F.when(F.col("run_id") == i, F.col("value"))).alias(i) for i in ids],
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min_by("run_id", order).alias("best_run"),
    )


def best_runs(runs: DataFrame, metrics: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """The best finished run of every experiment; of equal values the one started first wins."""
    value = F.col("value") if maximize else -F.col("value")
    ranked = finished_values(runs, metrics.filter(F.col("metric") == metric)).select(
        "experiment_id", F.struct((-value).alias("_order"), "started_at", "run_id", "value").alias("r")
    )
    best = ranked.groupBy("experiment_id").agg(F.min("r").alias("r"))
    return best.select("experiment_id", "r.run_id", "r.value", "r.started_at")
