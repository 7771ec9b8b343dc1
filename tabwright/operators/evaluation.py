"""Regression metrics and residual diagnostics, each from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.distributions import chi2_p_value

TOLERANCES = (0.1, 0.2, 0.3)


def metric_columns(label: Column, pred: Column, tolerances: Sequence[float] = TOLERANCES) -> dict[str, Column]:
    """Aggregates over actual and predicted values.

    A constant label gives R2 = 1 for perfect predictions and 0 otherwise.
    Relative errors leave out rows whose actual value is 0 (``n_zero`` of them),
    except that a zero actual counts as within tolerance if predicted exactly.
    """
    error = label - pred
    ss_res = F.sum(error * error)
    ss_tot = F.count(error) * F.var_pop(F.when(error.isNotNull(), label))
    r2 = F.when(ss_tot > 0, F.lit(1.0) - ss_res / F.nullif(ss_tot, F.lit(0.0))).otherwise(F.when(ss_res == 0, 1.0).otherwise(0.0))
    relative = F.try_divide(error, F.nullif(label, F.lit(0.0)))
    out = {
        "n": F.count(error),
        "mae": F.avg(F.abs(error)),
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.when(F.count(error) > 0, r2),
        "mape": F.avg(F.abs(relative)) * 100,
        "mpe": F.avg(relative) * 100,
        "n_zero": F.count_if((label == 0) & error.isNotNull()),
    }
    for tol in tolerances:
        inside = (F.abs(error) <= F.lit(tol) * F.abs(label)).cast("double")
        out[f"accuracy_{round(tol * 100)}pct"] = F.avg(inside)
    return out


def regression_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """One row of metrics, or one per group of ``by``."""
    metrics = metric_columns(F.col(label).cast("double"), F.col(pred).cast("double"))
    return df.groupBy(*by).agg(*[expr.alias(f"{prefix}{name}") for name, expr in metrics.items()])


def as_long(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., metric, value) rows from a wide metric table."""
    metrics = [c for c in wide.columns if c not in keys]
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(*keys, F.inline(F.array(*rows)))


def report(df: DataFrame, label: str, pred: str, features: Sequence[str], model: Mapping[str, str]) -> DataFrame:
    """Metrics, sample count, features and model facts as one row."""
    wide = regression_metrics(df, label, pred)
    metrics = F.struct(*[c for c in wide.columns if c not in ("n", "n_zero")]).alias("metrics")
    facts = F.create_map(*[F.lit(x) for pair in model.items() for x in pair]) if model else F.lit(None)
    return wide.select(
        metrics,
        F.col("n").alias("sample_count"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        facts.cast("map<string,string>").alias("model"),
    )


def listing(df: DataFrame, key: str, label: str, pred: str) -> DataFrame:
    return df.select(key, F.col(label).alias("actual"), F.col(pred).alias("predicted"), F.abs(F.col(label) - F.col(pred)).alias("abs_error"))


def residual_bins(df: DataFrame, label: str, pred: str, low: float, high: float, bins: int) -> DataFrame:
    """Residuals against predictions, binned: the data behind a residual plot."""
    bin_ = F.width_bucket(F.col(pred).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    residual = F.col(label) - F.col(pred)
    return df.groupBy(bin_.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(residual).alias("mean_residual"), F.stddev_pop(residual).alias("std_residual")
    )


def actual_by_predicted(df: DataFrame, label: str, pred: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts on a grid of predicted x actual values."""
    def cell(c: str) -> Column:
        return F.width_bucket(F.col(c).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).cast("int")

    return df.groupBy(cell(pred).alias("predicted_bin"), cell(label).alias("actual_bin")).agg(F.count(F.lit(1)).alias("n"))


def residual_stats(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Population moments of the residuals: mean, std, min, max, skewness, excess kurtosis."""
    e = F.col(label) - F.col(pred)
    return df.groupBy(*by).agg(
        F.count(e).alias("n"),
        F.avg(e).alias("mean"),
        F.stddev_pop(e).alias("std"),
        F.min(e).alias("min"),
        F.max(e).alias("max"),
        F.skewness(e).alias("skewness"),
        F.kurtosis(e).alias("kurtosis"),
    )


def normality(stats: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera on the rows of ``residual_stats``; its chi-square(2) tail is exp(-x/2)."""
    jb = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow("kurtosis", F.lit(2)) / 4)
    return (
        stats.withColumn("jarque_bera", jb)
        .withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))
        .withColumn("normal", F.col("p_value") > alpha)
    )


def heteroscedasticity(df: DataFrame, label: str, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Breusch-Pagan: regress squared OLS residuals on the features, LM = n * R2.

    Both regressions are least squares from one Gram matrix each, so the table
    is read twice and nothing is collected but sums. Collinear features give a
    null statistic.
    """
    from tabwright.operators.training import least_squares, linear_prediction

    spark = df.sparkSession
    schema = "lm double, df int"
    rows = df.select(*features, label).na.drop()
    first = least_squares(rows, list(features), label)
    if first is None:
        return spark.createDataFrame([(None, len(features))], schema).select("lm", "df", F.lit(None).cast("double").alias("p_value"), F.lit(None).cast("boolean").alias("homoscedastic"))
    e = F.col(label) - linear_prediction(first, features)
    squared = rows.withColumn("_e2", e * e)
    second = least_squares(squared, list(features), "_e2")
    fit = regression_metrics(squared.withColumn("_p", linear_prediction(second, features)), "_e2", "_p")
    out = fit.select((F.col("n") * F.col("r2")).alias("lm"), F.lit(len(features)).alias("df"))
    return out.withColumn("p_value", chi2_p_value(F.col("lm"), F.col("df"))).withColumn("homoscedastic", F.col("p_value") > alpha)
