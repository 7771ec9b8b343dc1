"""Event-time versions of scoring, quality, drift, tests and metric logs.

Each function turns a streaming (or batch) table into the table to be written;
``sinks`` runs it. Windowed results are update-mode aggregates whose state is
bounded by the watermark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType, TimestampType

from tabwright.operators import abtest
from tabwright.operators.checks import missing_flag
from tabwright.operators.features import FeatureState
from tabwright.operators.histograms import Bins, cells, histogram_drift, state
from tabwright.operators.training import score
from tabwright.streaming import sinks


def with_event_time(df: DataFrame, ts: str, watermark: str = "1 day") -> DataFrame:
    """Cast the time to a zoned timestamp, which event-time operators need, and watermark it."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def _window(ts: str, length: str, slide: str | None) -> Column:
    return F.window(ts, length, slide) if slide else F.window(ts, length)


def _open(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), *[c for c in df.columns if c != "window"])


def scored_requests(
    requests: DataFrame, state: FeatureState, model: PipelineModel, ranges: Mapping[str, tuple[float, float]]
) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected); the same function as for batches."""
    return score(requests, state, model, ranges)


def windowed_quality(df: DataFrame, ts: str, columns: Sequence[str], length: str = "1 day", slide: str | None = None, watermark: str = "1 day") -> DataFrame:
    """Rows, missing cells and means per window."""
    cells = sum((missing_flag(df, c).cast("bigint") for c in columns), F.lit(0).cast("bigint"))
    timed = with_event_time(df.withColumn("_missing", cells), ts, watermark)
    numeric = [c for c in columns if dict(df.dtypes)[c] in ("double", "float", "int", "bigint")]
    return _open(
        timed.groupBy(_window(ts, length, slide)).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("_missing").alias("n_missing"),
            *[F.avg(c).alias(f"mean_{c}") for c in numeric],
        )
    )


def windowed_copies(df: DataFrame, ts: str, columns: Sequence[str], length: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """How often each distinct row occurs per window; ``window_duplicates`` turns that into rates."""
    return _open(with_event_time(df, ts, watermark).groupBy(_window(ts, length, None), *columns).agg(F.count(F.lit(1)).alias("copies")))


def window_duplicates(copies: DataFrame) -> DataFrame:
    counted = copies.groupBy("window_start").agg(F.sum("copies").alias("n_rows"), (F.sum("copies") - F.count(F.lit(1))).alias("n_duplicates"))
    return counted.withColumn("duplicate_rate", F.try_divide(F.col("n_duplicates").cast("double"), F.col("n_rows")))


def windowed_bins(df: DataFrame, ts: str, bins: Bins, length: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """A histogram per window on the bins of a reference table; null and NaN have bins of their own."""
    binned = cells(with_event_time(df, ts, watermark), bins, [ts])
    return _open(binned.groupBy(_window(ts, length, None), "column", "bin").agg(*state()))


def window_drift(histograms: DataFrame, reference: DataFrame, bins: Bins) -> DataFrame:
    """Drift per (window, column) of windowed histograms against the reference's histogram.

    As for batches; ``score`` is the PSI, or the change of the missing share where that is the
    larger. Both inputs are one row per bin.
    """
    found = histogram_drift(reference, histograms, bins, ["window_start"])
    return found.withColumn("score", F.greatest("psi", F.abs(F.col("missing_ref") - F.col("missing_cur"))))


#: What ``window_verdicts`` returns.
VERDICTS = StructType(
    [StructField("ts", TimestampType())]
    + [StructField(c, StringType()) for c in ("subject", "message", "severity", "metric")]
    + [StructField("value", DoubleType()), StructField("threshold", DoubleType()), StructField("alarm", BooleanType())]
)


def window_verdicts(drift: DataFrame, threshold: float = 0.1) -> DataFrame:
    """A row for every judged window, with the alert it would raise and whether it does.

    Quiet windows have rows too, so that a later verdict can clear an earlier alert.
    """
    text = F.format_string("Data drift score %.3f exceeds threshold %.3f", F.col("score"), F.lit(threshold))
    return drift.select(
        F.col("window_start").alias("ts"),
        F.lit("Data Drift Detected").alias("subject"),
        text.alias("message"),
        F.lit("warning").alias("severity"),
        F.col("column").alias("metric"),
        F.col("score").alias("value"),
        F.lit(threshold).alias("threshold"),
        (F.col("score") > threshold).alias("alarm"),
    )


def window_alerts(drift: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Alert rows for windows that drifted beyond the threshold."""
    return window_verdicts(drift, threshold).filter("alarm").drop("alarm")


def run_drift_alerts(
    histograms: DataFrame, reference: DataFrame, bins: Bins, counts_path: str, verdicts_path: str, checkpoint: str,
    threshold: float = 0.1, every: str | None = None,
) -> StreamingQuery:
    """Start a query that keeps the histograms of a stream and a verdict on every window they touch.

    ``histograms`` come from ``windowed_bins`` in update mode. Counts are filed by the day of their
    window, and a batch reads back the days it touches, not the whole history. Read the alerts
    with ``current_alerts``.
    """
    spark = histograms.sparkSession
    day = F.to_date("window_start")

    def judged(rows: DataFrame) -> DataFrame:
        touched = rows.select("window_start").distinct()
        days = [r[0] for r in touched.select(day).distinct().collect()]
        filed = sinks.latest_of(spark, counts_path, histograms.withColumn("day", day).schema, ["window_start", "column", "bin"], F.col("day").isin(days))
        return window_verdicts(window_drift(filed.drop("day").join(touched, "window_start", "left_semi"), reference, bins), threshold)

    outputs = {counts_path: lambda rows: rows.withColumn("day", day), verdicts_path: judged}
    return sinks.run_into(histograms, outputs, checkpoint, "update", every, {counts_path: ["day"]})


def current_alerts(spark: SparkSession, verdicts_path: str) -> DataFrame:
    """Alerts whose newest verdict still stands."""
    return sinks.latest_of(spark, verdicts_path, VERDICTS, ["ts", "metric"]).filter("alarm").drop("alarm")


def look_moments(df: DataFrame, ts: str, metric: str, by: Sequence[str], length: str = "1 day", watermark: str = "1 day", **arms) -> DataFrame:
    """Moments of both arms per (test, look); ``sequential_state`` accumulates them."""
    timed = with_event_time(df, ts, watermark).withColumn("window", _window(ts, length, None))
    return _open(abtest.moments(timed, metric, by=["window", *by], **arms))


def sequential_state(moments: DataFrame, by: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Cumulative tests over all looks seen so far, with the stop rule."""
    looks = abtest.evaluate_moments(abtest.accumulate(moments, by, "window_start"), alpha=alpha)
    return abtest.with_stop_rule(looks, alpha)


def metric_log(df: DataFrame, ts: str, identity: Sequence[str], watermark: str = "1 day") -> DataFrame:
    """Metric points without redeliveries."""
    return with_event_time(df, ts, watermark).dropDuplicatesWithinWatermark(list(identity))
