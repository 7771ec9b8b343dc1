"""Quality reports, performance checks against a baseline, and alert tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.lineage import exists
from tabwright.operators.drift import drift_report, overall
from tabwright.operators.profile import correlations, duplicate_rate, missing_rate
from tabwright.roles import Roles
from tabwright.sources.tables import read_snapshot

# Metrics where more is worse, and where less is worse.
WORSE_IF_HIGHER = ("mae", "rmse")
WORSE_IF_LOWER = ("r2",)

ALERT_COLUMNS = ["subject", "message", "severity", "metric", "value", "threshold"]


def quality_report(df: DataFrame, missing_threshold: float = 0.05, duplicate_threshold: float = 0.01) -> DataFrame:
    """(check, value, threshold, breached) for missing values and duplicates; breached means strictly above."""
    missing = missing_rate(df).select(
        F.lit("missing").alias("check"), F.col("missing_per_row").alias("value"), F.lit(missing_threshold).alias("threshold")
    )
    duplicates = duplicate_rate(df).select(
        F.lit("duplicates").alias("check"), F.col("duplicate_rate").alias("value"), F.lit(duplicate_threshold).alias("threshold")
    )
    return missing.unionByName(duplicates).withColumn("breached", F.col("value") > F.col("threshold"))


def quality_issues(report: DataFrame) -> DataFrame:
    """One text over all breached checks."""
    label = F.when(F.col("check") == "missing", "High missing values").otherwise("High duplicate rate")
    text = F.format_string("%s: %.2f%%", label, F.col("value") * 100)
    texts = F.collect_list(F.when(F.col("breached"), F.struct(F.col("check").alias("c"), text.alias("t"))))
    ordered = F.transform(F.sort_array(texts, asc=False), lambda x: x["t"])
    return report.agg(F.array_join(ordered, "; ").alias("issues"), F.count_if("breached").alias("n_issues"))


def monitor_data(
    df: DataFrame, roles: Roles, snapshot_path: str | None = None, drift_threshold: float = 0.1, reference: DataFrame | None = None,
    exact: bool = False,
) -> DataFrame:
    """Quality checks and, where a reference exists, drift per column, as one long table."""
    quality = quality_report(df).select(F.lit("quality").alias("kind"), F.col("check").alias("name"), "value", "threshold", "breached")
    links = correlations(df, [*roles.numerical, roles.target]).select(
        F.lit("correlation").alias("kind"),
        F.concat_ws("~", "a", "b").alias("name"),
        F.col("correlation").alias("value"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(False).alias("breached"),
    )
    result = quality.unionByName(links)
    if reference is None and snapshot_path is not None:
        try:
            reference = read_snapshot(df.sparkSession, snapshot_path)
        except FileNotFoundError:
            reference = None
    if reference is not None:
        moved = drift_report(reference, df, roles.numerical, roles.categorical, drift_threshold, exact)
        result = result.unionByName(
            moved.select(
                F.lit("drift").alias("kind"), F.col("column").alias("name"), F.col("score").alias("value"),
                F.lit(drift_threshold).alias("threshold"), F.col("drifted").alias("breached"),
            )
        )
    return result


def latest_baseline(history: DataFrame) -> DataFrame:
    """Newest value per metric from an append-only (metric, value, recorded_at) table."""
    return history.groupBy("metric").agg(F.max_by("value", "recorded_at").alias("value"))


def compare_with_baseline(current: DataFrame, baseline: DataFrame, drop: float = 0.1) -> DataFrame:
    """Current against baseline by metric name; metrics absent from the baseline are left out.

    A metric is degraded if it is worse than the baseline by more than ``drop``
    in its own direction; metrics without a direction never are.
    """
    joined = current.select("metric", F.col("value").alias("current")).join(
        baseline.select("metric", F.col("value").alias("baseline")), "metric"
    )
    metric, cur, base = F.col("metric"), F.col("current"), F.col("baseline")
    limit = F.when(metric.isin(*WORSE_IF_HIGHER), base * (1 + drop)).when(metric.isin(*WORSE_IF_LOWER), base * (1 - drop))
    degraded = F.when(metric.isin(*WORSE_IF_HIGHER), cur > base * (1 + drop)).when(metric.isin(*WORSE_IF_LOWER), cur < base * (1 - drop))
    verb = F.when(metric.isin(*WORSE_IF_HIGHER), "increased").otherwise("decreased")
    text = F.format_string("%s %s from %.3f to %.3f", F.upper(metric), verb, base, cur)
    return (
        joined.withColumn("threshold", limit)
        .withColumn("degraded", F.coalesce(degraded, F.lit(False)))
        .withColumn("message", F.when(F.col("degraded"), text))
    )


def monitor_performance(spark: SparkSession, current: DataFrame, path: str, recorded_at: Column, drop: float = 0.1) -> DataFrame:
    """Check against the stored baseline; the first run stores its own metrics as the baseline."""
    if not exists(spark, path):
        current.select("metric", "value", recorded_at.alias("recorded_at")).write.mode("append").parquet(path)
    return compare_with_baseline(current, latest_baseline(spark.read.parquet(path)), drop)


def drift_alerts(summary: DataFrame) -> DataFrame:
    return summary.filter("alarm").select(
        F.lit("Data Drift Detected").alias("subject"),
        F.format_string("Data drift score %.3f exceeds threshold %.3f", F.col("drift_score"), F.col("threshold")).alias("message"),
        F.lit("warning").alias("severity"),
        F.lit("drift_score").alias("metric"),
        F.col("drift_score").alias("value"),
        F.col("threshold"),
    )


def quality_alerts(report: DataFrame) -> DataFrame:
    label = F.when(F.col("check") == "missing", "High missing values").otherwise("High duplicate rate")
    return report.filter("breached").select(
        F.lit("Data Quality Issue").alias("subject"),
        F.format_string("%s: %.2f%%", label, F.col("value") * 100).alias("message"),
        F.lit("error").alias("severity"),
        F.col("check").alias("metric"),
        F.col("value"),
        F.col("threshold"),
    )


def performance_alerts(compared: DataFrame) -> DataFrame:
    return compared.filter("degraded").select(
        F.lit("Model Performance Drop").alias("subject"),
        F.col("message"),
        F.lit("error").alias("severity"),
        F.col("metric"),
        F.col("current").alias("value"),
        F.col("threshold"),
    )


def drift_summary(reference: DataFrame, current: DataFrame, roles: Roles, threshold: float = 0.1) -> DataFrame:
    return overall(drift_report(reference, current, roles.numerical, roles.categorical, threshold), threshold)
