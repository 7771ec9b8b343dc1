"""Two-arm tests, many at once: every statistic is column math over per-test moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.functions.distributions import check_alternative, normal_quantile, t_critical, t_p_value, z_p_value
from tabwright.operators.joins import null_safe_join
from tabwright.operators.quantiles import quantile_table
from tabwright.operators.ranking import hashed_rank

SIDES = ("control", "treatment")
STRONG_EVIDENCE = "Strong statistical significance"
NEGLIGIBLE = "Negligible effect size"


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def moments(
    df: DataFrame, metric: str, arm: str = "arm", control: str = "control", treatment: str = "treatment", by: Sequence[str] = ()
) -> DataFrame:
    """One row per test with count, mean, variances and sum of each arm, from one partial aggregation."""
    exprs = []
    for side, name in zip(SIDES, (control, treatment)):
        x = F.when(F.col(arm) == name, F.col(metric).cast("double"))
        exprs += [
            F.count(x).alias(f"{side}_count"),
            F.avg(x).alias(f"{side}_mean"),
            F.var_samp(x).alias(f"{side}_var"),
            F.stddev_pop(x).alias(f"{side}_std"),
            F.sum(x).alias(f"{side}_sum"),
        ]
    return df.groupBy(*by).agg(*exprs)


def arm_statistics(df: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """Mean, population std, count and exact median for each group of ``by`` (test and arm).

    Null keys are groups too; a group without any value has a null median.
    """
    stats = df.groupBy(*by).agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"), F.count(metric).alias("count"))
    medians = quantile_table(df, [metric], [0.5], by).withColumnRenamed(f"{metric}_q50", "median")
    return null_safe_join(stats, medians, list(by), "left")


def welch(m: DataFrame) -> DataFrame:
    """Add Welch's ``statistic`` (control minus treatment) and ``df``."""
    a, b = _div(F.col("control_var"), F.col("control_count")), _div(F.col("treatment_var"), F.col("treatment_count"))
    spread = a + b
    dof = _div(spread * spread, _div(a * a, F.col("control_count") - 1) + _div(b * b, F.col("treatment_count") - 1))
    return m.withColumns({"statistic": _div(F.col("control_mean") - F.col("treatment_mean"), F.sqrt(spread)), "df": dof})


def pooled_z(m: DataFrame) -> DataFrame:
    """Add the two-proportion ``statistic`` with pooled variance."""
    n1, n2 = F.col("control_count"), F.col("treatment_count")
    p = _div(F.col("control_sum") + F.col("treatment_sum"), n1 + n2)
    se = F.sqrt(p * (1 - p) * (_div(F.lit(1), n1) + _div(F.lit(1), n2)))
    return m.withColumns({"statistic": _div(F.col("control_mean") - F.col("treatment_mean"), se), "df": F.lit(None).cast("double")})


def t_interval(mean: Column, variance: Column, count: Column, critical: Column) -> tuple[Column, Column]:
    half = critical * F.sqrt(_div(variance, count))
    return mean - half, mean + half


def wilson_interval(share: Column, count: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    z = normal_quantile(1 - (1 - confidence) / 2)
    n = count.cast("double")
    centre = share + _div(F.lit(z * z), 2 * n)
    spread = F.sqrt(_div(share * (1 - share), n) + _div(F.lit(z * z), 4 * n * n)) * z
    scale = 1 + _div(F.lit(z * z), n)
    return _div(centre - spread, scale), _div(centre + spread, scale)


def effect_size(metric_type: str) -> Column:
    """Cohen's d from population stds with (n - 1) weights, or the absolute difference of shares."""
    gap = F.abs(F.col("treatment_mean") - F.col("control_mean"))
    if metric_type == "proportion":
        return gap
    n1, n2 = F.col("control_count"), F.col("treatment_count")
    pooled = _div((n1 - 1) * F.pow("control_std", F.lit(2)) + (n2 - 1) * F.pow("treatment_std", F.lit(2)), n1 + n2 - 2)
    return _div(gap, F.sqrt(pooled))


def run_tests(
    df: DataFrame, metric: str, by: Sequence[str], metric_type: str = "continuous", alternative: str = "two-sided",
    arm: str = "arm", control: str = "control", treatment: str = "treatment",
    alpha: float = 0.05, practical: float = 0.01, medians: bool = True,
) -> DataFrame:
    """The full result row of every test in ``by``."""
    check_alternative(alternative)
    tested = evaluate_moments(moments(df, metric, arm, control, treatment, by), metric_type, alternative, alpha, practical)
    if medians:
        mid = quantile_table(df.filter(F.col(arm).isin(control, treatment)), [metric], [0.5], [*by, arm])
        sides = mid.groupBy(*by).agg(
            F.max(F.when(F.col(arm) == control, F.col(f"{metric}_q50"))).alias("control_median"),
            F.max(F.when(F.col(arm) == treatment, F.col(f"{metric}_q50"))).alias("treatment_median"),
        )
        tested = null_safe_join(tested, sides, list(by), "left")
    return tested


def evaluate_moments(
    m: DataFrame, metric_type: str = "continuous", alternative: str = "two-sided", alpha: float = 0.05, practical: float = 0.01
) -> DataFrame:
    """Test statistic, p-value, intervals, effect and lift for rows of ``moments``."""
    if metric_type not in ("continuous", "proportion"):
        raise ValueError(f"Unsupported metric type: {metric_type}")
    if metric_type == "continuous":
        tested = welch(m).withColumn("p_value", t_p_value(F.col("statistic"), F.col("df"), alternative))
        for side in SIDES:
            tested = tested.withColumn(f"_t_{side}", t_critical(F.col(f"{side}_count") - 1))
    else:
        tested = pooled_z(m).withColumn("p_value", z_p_value(F.col("statistic"), alternative))
    for side in SIDES:
        mean, n = F.col(f"{side}_mean"), F.col(f"{side}_count")
        if metric_type == "continuous":
            low, high = t_interval(mean, F.col(f"{side}_var"), n, F.col(f"_t_{side}"))
        else:
            low, high = wilson_interval(mean, n)
        tested = tested.withColumns({f"{side}_ci_low": low, f"{side}_ci_high": high})
    return (
        tested.withColumns(
            {
                "test_type": F.lit("t-test" if metric_type == "continuous" else "z-test"),
                "metric_type": F.lit(metric_type),
                "alternative": F.lit(alternative),
                "alpha": F.lit(alpha),
                "significant": F.col("p_value") < alpha,
                "effect_size": effect_size(metric_type),
                "lift": _div(F.col("treatment_mean") - F.col("control_mean"), F.col("control_mean")),
                "total_count": F.col("control_count") + F.col("treatment_count"),
            }
        )
        .withColumn("practically_significant", F.col("effect_size") > practical)
        .drop("_t_control", "_t_treatment")
    )


def batches(
    df: DataFrame, key: str, by: Sequence[str], batch_size: int, arm: str = "arm", seed: int = 42, portable: bool = False
) -> DataFrame:
    """Add ``look``: rows of each arm in hash order, ``batch_size`` per look."""
    ranked = hashed_rank(df, unit_hash(F.col(key), seed, portable), [key], by=[*by, arm], name="_rank")
    return ranked.withColumn("look", (F.floor((F.col("_rank") - 1) / batch_size) + 1).cast("bigint")).drop("_rank")


def cumulative_looks(
    df: DataFrame, metric: str, by: Sequence[str], look: str = "look",
    arm: str = "arm", control: str = "control", treatment: str = "treatment",
) -> DataFrame:
    """Moments of all rows up to each look.

    Rows shrink to one per (test, look) before any window; sums are taken around
    the overall mean of the test, so large means do not cancel the variance.
    """
    per_look = moments(df, metric, arm, control, treatment, [*by, look])
    return accumulate(per_look, by, look)


def accumulate(per_look: DataFrame, by: Sequence[str], look: str = "look") -> DataFrame:
    """Running moments over rows of ``moments`` that are keyed by test and look."""
    whole = Window.partitionBy(*by)
    total = sum((F.coalesce(F.sum(f"{s}_sum").over(whole), F.lit(0.0)) for s in SIDES), F.lit(0.0))
    count = sum((F.sum(f"{s}_count").over(whole) for s in SIDES), F.lit(0))
    centred = per_look.withColumn("_mu", _div(total, count))
    upto = whole.orderBy(look).rowsBetween(Window.unboundedPreceding, 0)
    out = [*by, look]
    for side in SIDES:
        n, mean = F.col(f"{side}_count"), F.col(f"{side}_mean")
        shift = F.coalesce(n * (mean - F.col("_mu")), F.lit(0.0))
        within = F.coalesce(n * F.pow(f"{side}_std", F.lit(2)), F.lit(0.0))
        square = within + F.coalesce(n * F.pow(mean - F.col("_mu"), F.lit(2)), F.lit(0.0))
        big_n, s, q = F.sum(n).over(upto), F.sum(shift).over(upto), F.sum(square).over(upto)
        m2 = F.greatest(q - F.coalesce(_div(s * s, big_n), F.lit(0.0)), F.lit(0.0))
        out += [
            big_n.alias(f"{side}_count"),
            (F.col("_mu") + _div(s, big_n)).alias(f"{side}_mean"),
            F.when(big_n > 1, _div(m2, big_n - 1)).alias(f"{side}_var"),
            F.when(big_n > 0, F.sqrt(_div(m2, big_n))).alias(f"{side}_std"),
            F.coalesce(F.sum(f"{side}_sum").over(upto), F.lit(0.0)).alias(f"{side}_sum"),
        ]
    return centred.select(*out)


def with_stop_rule(looks: DataFrame, alpha: float = 0.05, negligible: float = 0.01) -> DataFrame:
    """Add the reason to stop at a look, or null."""
    reason = F.when(F.col("p_value") < alpha / 10, STRONG_EVIDENCE).when(F.col("effect_size") < negligible, NEGLIGIBLE)
    return looks.withColumn("stop_reason", reason)


def sequential(df: DataFrame, metric: str, by: Sequence[str], look: str = "look", alpha: float = 0.05, **columns) -> DataFrame:
    """All looks of sequential tests, cumulative, with the stop rule applied."""
    looks = evaluate_moments(cumulative_looks(df, metric, by, look, **columns), alpha=alpha)
    return with_stop_rule(looks, alpha)


def sequential_outcome(looks: DataFrame, by: Sequence[str], look: str = "look") -> DataFrame:
    """Per test: whether and why it stopped early, the final look and the rows seen by then."""
    stop = F.min(F.when(F.col("stop_reason").isNotNull(), F.struct(F.col(look), "stop_reason", "total_count")))
    last = F.max(F.struct(F.col(look), F.col("total_count")))
    return (
        looks.groupBy(*by)
        .agg(stop.alias("_stop"), last.alias("_last"))
        .select(
            *by,
            F.col("_stop").isNotNull().alias("early_stop"),
            F.col("_stop.stop_reason").alias("stop_reason"),
            F.coalesce(F.col(f"_stop.{look}"), F.col(f"_last.{look}")).alias("final_look"),
            F.coalesce("_stop.total_count", "_last.total_count").alias("total_sample_size"),
        )
    )


def design_continuous(
    df: DataFrame, metric: str, by: Sequence[str], improvement: float, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Sample size per segment for a relative improvement of the mean."""
    za, zb = normal_quantile(1 - alpha / 2), normal_quantile(power)
    mde = F.col("baseline") * improvement
    size = F.pow(_div(F.lit(za + zb), F.col("effect_size")), F.lit(2)) + za * za / 2
    return (
        df.groupBy(*by)
        .agg(F.avg(metric).alias("baseline"), F.stddev_samp(metric).alias("std"))
        .withColumn("minimum_detectable_effect", mde)
        .withColumn("effect_size", F.abs(_div(mde, F.col("std"))))
        .withColumn("_n", size)
        .withColumns({"n_per_group": F.ceil("_n"), "n_total": F.ceil(F.col("_n") * 2)})
        .drop("_n")
    )


def design_proportion(
    df: DataFrame, metric: str, by: Sequence[str], improvement: float, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Sample size per segment for a relative improvement of a share."""
    z = normal_quantile(1 - alpha / 2) + normal_quantile(power)
    p1, p2 = F.col("baseline"), F.col("baseline") * (1 + improvement)
    mid = (p1 + p2) / 2
    return (
        df.groupBy(*by)
        .agg(F.avg(metric).alias("baseline"))
        .withColumn("minimum_detectable_effect", p1 * improvement)
        .withColumn("effect_size", F.abs(p1 - p2))
        .withColumn("_n", _div(z * z * mid * (1 - mid), F.pow(p1 - p2, F.lit(2))))
        .withColumns({"n_per_group": F.ceil("_n"), "n_total": F.ceil(F.col("_n") * 2)})
        .drop("_n")
    )


def arm_rewards(df: DataFrame, metric: str, arm: str = "arm", by: Sequence[str] = ()) -> DataFrame:
    """Total, count and average reward per arm of logged plays, regret against the best arm."""
    stats = df.groupBy(*by, arm).agg(
        F.sum(metric).alias("total_reward"), F.count(metric).alias("count"), F.avg(metric).alias("average_reward")
    )
    rivals = Window.partitionBy(*(by or [F.lit(0)]))
    best = F.max("average_reward").over(rivals)
    return stats.withColumn("regret", best - F.col("average_reward")).withColumn("is_best", F.col("regret") == 0)


def summarize(results: DataFrame) -> DataFrame:
    """Totals, lifts and p-values over a table of test results."""
    significant = F.count_if("significant")
    return results.agg(
        F.count(F.lit(1)).alias("total_tests"),
        significant.alias("significant_tests"),
        F.count_if("practically_significant").alias("practically_significant_tests"),
        F.avg("lift").alias("average_lift"),
        F.median("lift").alias("median_lift"),
        F.max("lift").alias("max_lift"),
        F.min("lift").alias("min_lift"),
        F.avg("p_value").alias("average_p_value"),
        F.try_divide(significant.cast("double"), F.count(F.lit(1))).alias("significant_ratio"),
    )


def paired_test(scores: DataFrame, first: str, second: str, alpha: float = 0.05) -> DataFrame:
    """Paired t-test of two models per metric on a (model, fold, metric, value) table."""
    pairs = scores.filter(F.col("model").isin(first, second)).groupBy("metric", "fold").agg(
        F.max(F.when(F.col("model") == first, F.col("value"))).alias("a"),
        F.max(F.when(F.col("model") == second, F.col("value"))).alias("b"),
    )
    d = F.col("a") - F.col("b")
    stats = pairs.groupBy("metric").agg(
        F.count(d).alias("n"),
        F.avg("a").alias("model1_mean"),
        F.avg("b").alias("model2_mean"),
        F.avg(d).alias("difference"),
        F.stddev_samp(d).alias("_sd"),
    )
    t = _div(F.col("difference"), _div(F.col("_sd"), F.sqrt(F.col("n").cast("double"))))
    return (
        stats.withColumn("t_statistic", t)
        .withColumn("p_value", t_p_value(F.col("t_statistic"), F.col("n") - 1))
        .withColumn("significant", F.col("p_value") < alpha)
        .drop("_sd")
    )
