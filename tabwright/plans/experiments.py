"""Queries over two-arm tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import rounded
from tabwright.operators import abtest, evaluation, split
from tabwright.operators.quantiles import quantiles
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query

# Normal quantiles at 0.975 and 0.8.
Z_ALPHA = 1.959963984540054
Z_BETA = 0.8416212335729143


def rounded_columns(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), digits) for c in columns})


def t_tail(t: str, df: str) -> str:
    """Two-sided Student-t p-value in SQL: Simpson's rule over the arc tangent."""
    angle = f"atan(abs({t}) / sqrt({df}))"
    area = (
        f"(select sum((case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end)"
        f" * pow(cos(i * {angle} / 2000.0), {df} - 1)) * {angle} / 6000.0 from range(2001) r(i))"
    )
    scale = f"2 * exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt(pi())"
    return f"(1 - {scale} * {area})"


def z_tail(z: str) -> str:
    area = (
        f"(select sum((case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end)"
        f" * exp(-pow(i * abs({z}) / 2000.0, 2) / 2)) * abs({z}) / 6000.0 from range(2001) r(i))"
    )
    return f"(1 - 2 * {area} / sqrt(2 * pi()))"


def moments_sql(source: str, metric: str, by: str, name: str = "m") -> str:
    sides = ", ".join(
        f"count({metric}) filter (arm = '{s}') as {s[0]}n, avg({metric}) filter (arm = '{s}') as {s[0]}m, "
        f"var_samp({metric}) filter (arm = '{s}') as {s[0]}v, stddev_pop({metric}) filter (arm = '{s}') as {s[0]}s, "
        f"sum({metric}) filter (arm = '{s}') as {s[0]}sum"
        for s in abtest.SIDES
    )
    return f"{name} as (select {by}, {sides} from {source} group by {by})"


# Arms too small for a statistic leave it null.
WELCH = """w as (select *, (cm - tm) / nullif(sqrt(cv/cn + tv/tn), 0) as t,
  pow(cv/cn + tv/tn, 2) / nullif(pow(cv/cn, 2)/nullif(cn - 1, 0) + pow(tv/tn, 2)/nullif(tn - 1, 0), 0) as df,
  abs(tm - cm) / nullif(sqrt(((cn - 1)*cs*cs + (tn - 1)*ts*ts) / nullif(cn + tn - 2, 0)), 0) as d, (tm - cm) / nullif(cm, 0) as lift from m)"""


@query(
    "arm_statistics",
    f"""with {b.ARMS} select segment, arm, round(avg(value), 6) + 0.0 as mean, round(stddev_pop(value), 6) + 0.0 as std,
  count(value) as "count", round(median(value), 6) + 0.0 as median from arms group by segment, arm""",
)
def arm_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(abtest.arm_statistics(b.arms(spark, sf_dir), "value", ["segment", "arm"]), "mean", "std", "median")


_UNKNOWN = f"""{b.ARMS}, u as (select case when user_id % 3 > 0 then segment end as segment, arm, case when segment <> 'purchase' or user_id % 2 = 0 then value end as value from arms)"""


def _unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arms of which some rows have no segment, and one arm of one segment no value."""
    segment, user = F.col("segment"), F.col("user_id")
    return b.arms(spark, sf_dir).select(
        F.when(user % 3 > 0, segment).alias("segment"), "arm", F.when((segment != "purchase") | (user % 2 == 0), F.col("value")).alias("value")
    )


@query(
    "medians_with_unknown_segment",
    f"""with {_UNKNOWN} select segment, arm, round(avg(value), 6) + 0.0 as mean, round(stddev_pop(value), 6) + 0.0 as std,
  count(value) as "count", round(median(value), 6) + 0.0 as median from u group by segment, arm""",
)
def medians_with_unknown_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unknown segment is a group like any other, and so is one without values."""
    return rounded_columns(abtest.arm_statistics(_unknown(spark, sf_dir), "value", ["segment", "arm"]), "mean", "std", "median")


@query(
    "quantiles_by_ranks",
    f"""with {_UNKNOWN}, q as (select segment, unnest([0.1, 0.5, 0.9]) as prob, unnest(quantile_cont(value, [0.1, 0.5, 0.9])) as value from u group by segment)
select segment, prob::double as prob, round(value, 6) + 0.0 as value from q""",
)
def quantiles_by_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for columns with too many values for one task, on a table with an unknown group."""
    found = quantiles(_unknown(spark, sf_dir), ["value"], [0.1, 0.5, 0.9], ["segment"], max_counters=0)
    return rounded_columns(found.select("segment", "prob", "value"), "value")


@query(
    "welch_tests",
    f"""with {b.ARMS}, {moments_sql('arms', 'value', 'segment')}, {WELCH}
select segment, round(t, 6) + 0.0 as statistic, round(df, 4) + 0.0 as df, round({t_tail('t', 'df')}, 6) + 0.0 as p_value from w""",
)
def welch_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = abtest.evaluate_moments(abtest.moments(b.arms(spark, sf_dir), "value", by=["segment"]))
    picked = tested.select("segment", "statistic", "df", "p_value")
    return rounded_columns(rounded_columns(picked, "df", digits=4), "statistic", "p_value")


@query(
    "one_sided_welch_tests",
    f"""with {b.ARMS}, {moments_sql('arms', 'value', 'segment')}, {WELCH},
p as (select *, {t_tail('t', 'df')} as p2 from w)
select segment, 'greater' as alternative, round(case when t >= 0 then p2/2 else 1 - p2/2 end, 6) + 0.0 as p_value from p
union all select segment, 'less', round(case when t < 0 then p2/2 else 1 - p2/2 end, 6) + 0.0 from p""",
)
def one_sided_welch_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = abtest.moments(b.arms(spark, sf_dir), "value", by=["segment"])
    parts = [abtest.evaluate_moments(m, alternative=a).select("segment", "alternative", "p_value") for a in ("greater", "less")]
    return rounded_columns(parts[0].unionByName(parts[1]), "p_value")


_Z = """z as (select *, (csum + tsum) / (cn + tn) as p from m),
zz as (select *, (cm - tm) / sqrt(p * (1 - p) * (1.0/cn + 1.0/tn)) as stat from z)"""


def _wilson_sql(side: str, name: str) -> str:
    z2 = Z_ALPHA * Z_ALPHA
    p, n = f"{side}m", f"{side}n"
    scale = f"(1 + {z2!r} / {n})"
    centre = f"({p} + {z2!r} / (2.0 * {n}))"
    spread = f"({Z_ALPHA!r} * sqrt({p} * (1 - {p}) / {n} + {z2!r} / (4.0 * {n} * {n})))"
    return (
        f"round(({centre} - {spread}) / {scale}, 6) + 0.0 as {name}_ci_low, round(({centre} + {spread}) / {scale}, 6) + 0.0 as {name}_ci_high"
    )


_PROPORTION_COLUMNS = f"""round(stat, 6) + 0.0 as statistic, round({z_tail('stat')}, 6) + 0.0 as p_value,
  round(abs(tm - cm), 6) + 0.0 as effect_size, {_wilson_sql('c', 'control')}, {_wilson_sql('t', 'treatment')}"""
_PROPORTION = ["statistic", "p_value", "effect_size", "control_ci_low", "control_ci_high", "treatment_ci_low", "treatment_ci_high"]


@query(
    "proportion_tests_by_day",
    f"""with {b.ARMS}, {moments_sql('arms', 'conversion', 'look')}, {_Z} select look, {_PROPORTION_COLUMNS} from zz""",
)
def proportion_tests_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = abtest.moments(b.arms(spark, sf_dir), "conversion", by=["look"])
    return rounded_columns(abtest.evaluate_moments(m, "proportion").select("look", *_PROPORTION), *_PROPORTION)


@query(
    "label_proportion_tests",
    f"""with arms as (select case when doc_id % 2 = 0 then 'control' else 'treatment' end as arm, toxic, quality from labels),
{moments_sql('arms', 'quality', 'toxic')}, {_Z} select toxic, {_PROPORTION_COLUMNS} from zz""",
)
def label_proportion_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = b.table(spark, sf_dir, "labels").withColumn("arm", F.when(F.col("doc_id") % 2 == 0, "control").otherwise("treatment"))
    m = abtest.moments(labelled, "quality", by=["toxic"])
    return rounded_columns(abtest.evaluate_moments(m, "proportion").select("toxic", *_PROPORTION), *_PROPORTION)


def _t_critical_sql(df: str) -> str:
    """Expansion of the 0.975 quantile in 1/df, exact to 1e-9 for the large df at hand."""
    z = Z_ALPHA
    g1, g2 = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    return f"({z!r} + {g1!r}/{df} + {g2!r}/pow({df}, 2) + {g3!r}/pow({df}, 3))"


_RESULT = [
    "control_mean", "control_std", "control_median", "treatment_mean", "treatment_std", "treatment_median", "control_ci_low",
    "control_ci_high", "treatment_ci_low", "treatment_ci_high", "statistic", "p_value", "effect_size", "lift",
]


@query(
    "ab_test_results",
    f"""with {b.ARMS}, {moments_sql('arms', 'value', 'segment')}, {WELCH},
med as (select segment, median(value) filter (arm = 'control') as cmed, median(value) filter (arm = 'treatment') as tmed from arms group by segment),
p as (select w.*, cmed, tmed, {t_tail('t', 'df')} as pv, {_t_critical_sql('(cn - 1)')} * sqrt(cv / cn) as ch, {_t_critical_sql('(tn - 1)')} * sqrt(tv / tn) as th
  from w join med using (segment))
select segment, 't-test' as test_type, cn as control_count, tn as treatment_count, cn + tn as total_count,
  {', '.join(f'round({e}, 5) + 0.0 as {c}' for c, e in zip(_RESULT, ['cm', 'cs', 'cmed', 'tm', 'ts', 'tmed', 'cm - ch', 'cm + ch', 'tm - th', 'tm + th', 't', 'pv', 'd', 'lift']))},
  pv < 0.05 as significant, d > 0.01 as practically_significant from p""",
)
def ab_test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statistics of one test per segment, medians and intervals included."""
    results = abtest.run_tests(b.arms(spark, sf_dir), "value", ["segment"])
    plain = ["segment", "test_type", "control_count", "treatment_count", "total_count", "significant", "practically_significant"]
    return rounded_columns(results.select(*plain, *_RESULT), *_RESULT, digits=5)


@query(
    "test_report",
    f"""with {b.ARMS}, {moments_sql('arms', 'value', 'segment')}, {WELCH}, r as (select *, {t_tail('t', 'df')} as p from w)
select count(*) as total_tests, count(*) filter (p < 0.05) as significant_tests, count(*) filter (d > 0.01) as practically_significant_tests,
  round(avg(lift), 6) + 0.0 as average_lift, round(median(lift), 6) + 0.0 as median_lift, round(max(lift), 6) + 0.0 as max_lift,
  round(min(lift), 6) + 0.0 as min_lift, round(avg(p), 6) + 0.0 as average_p_value,
  round(count(*) filter (p < 0.05) / cast(count(*) as double), 6) + 0.0 as significant_ratio from r""",
)
def test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = abtest.run_tests(b.arms(spark, sf_dir), "value", ["segment"], medians=False)
    summary = abtest.summarize(results)
    return rounded_columns(summary, "average_lift", "median_lift", "max_lift", "min_lift", "average_p_value", "significant_ratio")


_CUMULATIVE = f"""days as (select distinct segment, look from arms),
upto as (select d.segment, d.look, a.arm, a.value from days d join arms a on a.segment = d.segment and a.look <= d.look),
{moments_sql('upto', 'value', 'segment, look')}, {WELCH},
p as (select *, {t_tail('t', 'df')} as p from w),
s as (select *, case when p < 0.005 then '{abtest.STRONG_EVIDENCE}' when d < 0.01 then '{abtest.NEGLIGIBLE}' end as reason from p)"""


@query(
    "sequential_looks",
    f"""with {b.ARMS}, {_CUMULATIVE}
select segment, look, cn + tn as total_count, round(p, 6) + 0.0 as p_value, round(d, 6) + 0.0 as effect_size, round(lift, 6) + 0.0 as lift,
  p < 0.05 as significant, reason as stop_reason from s""",
)
def sequential_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = abtest.sequential(b.arms(spark, sf_dir), "value", ["segment"])
    picked = looks.select("segment", "look", "total_count", "p_value", "effect_size", "lift", "significant", "stop_reason")
    return rounded_columns(picked, "p_value", "effect_size", "lift")


@query(
    "sequential_outcomes",
    f"""with {b.ARMS}, {_CUMULATIVE}, f as (select segment, min(look) filter (reason is not null) as stop, max(look) as last from s group by segment)
select f.segment, stop is not null as early_stop, s.reason as stop_reason, coalesce(stop, last) as final_look, s.cn + s.tn as total_sample_size
from f join s on s.segment = f.segment and s.look = coalesce(stop, last)""",
)
def sequential_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abtest.sequential_outcome(abtest.sequential(b.arms(spark, sf_dir), "value", ["segment"]), ["segment"])


@query(
    "hash_ordered_batches",
    f"""with {b.ARMS}, r as (select segment, arm, value, row_number() over (partition by segment, arm order by {b.unit_sql(42, 'event_id')}, event_id) as k from arms)
select segment, arm, cast((k - 1) // 100 + 1 as bigint) as look, count(*) as n, round(avg(value), 6) + 0.0 as mean from r group by all""",
)
def hash_ordered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = abtest.batches(b.arms(spark, sf_dir), "event_id", ["segment"], 100, portable=True)
    return looks.groupBy("segment", "arm", "look").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("value")).alias("mean"))


@query(
    "sample_sizes_for_means",
    f"""with {b.ARMS}, s as (select segment, avg(value) as baseline, stddev_samp(value) as std from arms group by segment),
e as (select *, baseline * 0.05 as mde, abs(baseline * 0.05 / std) as d from s),
n as (select *, pow({Z_ALPHA + Z_BETA!r} / d, 2) + {Z_ALPHA * Z_ALPHA / 2!r} as n from e)
select segment, round(baseline, 6) + 0.0 as baseline, round(std, 6) + 0.0 as std, round(mde, 6) + 0.0 as minimum_detectable_effect,
  round(d, 6) + 0.0 as effect_size, cast(ceil(n) as bigint) as n_per_group, cast(ceil(2 * n) as bigint) as n_total from n""",
)
def sample_sizes_for_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    design = abtest.design_continuous(b.arms(spark, sf_dir), "value", ["segment"], 0.05)
    return rounded_columns(design, "baseline", "std", "minimum_detectable_effect", "effect_size")


@query(
    "sample_sizes_for_shares",
    f"""with {b.ARMS}, s as (select arm, avg(conversion) as p1, avg(conversion) * 1.1 as p2 from arms group by arm),
n as (select *, pow({Z_ALPHA + Z_BETA!r}, 2) * ((p1 + p2) / 2) * (1 - (p1 + p2) / 2) / pow(p1 - p2, 2) as n from s)
select arm, round(p1, 6) + 0.0 as baseline, round(p1 * 0.1, 6) + 0.0 as minimum_detectable_effect, round(abs(p1 - p2), 6) + 0.0 as effect_size,
  cast(ceil(n) as bigint) as n_per_group, cast(ceil(2 * n) as bigint) as n_total from n""",
)
def sample_sizes_for_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    design = abtest.design_proportion(b.arms(spark, sf_dir), "conversion", ["arm"], 0.1)
    return rounded_columns(design, "baseline", "minimum_detectable_effect", "effect_size")


@query(
    "arm_rewards",
    f"""with {b.ARMS}, s as (select segment, sum(value) as t, count(value) as n, avg(value) as a from arms group by segment)
select segment, round(t, 4) + 0.0 as total_reward, n as "count", round(a, 6) + 0.0 as average_reward,
  round((select max(a) from s) - a, 6) + 0.0 as regret, a = (select max(a) from s) as is_best from s""",
)
def arm_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = abtest.arm_rewards(b.arms(spark, sf_dir), "value", arm="segment")
    return rounded_columns(rounded_columns(stats, "total_reward", digits=4), "average_reward", "regret")


def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, fold, metric, value) of two fixed scorers."""
    rows = split.kfold(b.preds(spark, sf_dir), "o_orderkey", 5, 42, portable=True)
    other = F.lit(2600) + F.col("temp") * 1800
    parts = []
    for model, pred in (("two_terms", F.col("pred")), ("one_term", other)):
        wide = evaluation.regression_metrics(rows.withColumn("p", pred), "cnt", "p", by=["fold"])
        long = evaluation.as_long(wide.select("fold", "mae", "mse", "r2"), ["fold"])
        parts.append(long.select(F.lit(model).alias("model"), "fold", "metric", "value"))
    return parts[0].unionByName(parts[1])


FOLD_SCORES = f"""{b.PREDS}, f as (select cnt, cast(floor({b.unit_sql()} * 5) as int) as fold, pred as p1, 2600 + temp*1800 as p2 from preds),
scores as (
  {' union all '.join(f'''select '{m}' as model, fold, unnest(['mae', 'mse', 'r2']) as metric,
  unnest([avg(abs(cnt - {p})), avg((cnt - {p})^2), 1 - sum((cnt - {p})^2) / (count(*) * var_pop(cnt))]) as value from f group by fold''' for m, p in (('two_terms', 'p1'), ('one_term', 'p2')))})"""


@query(
    "paired_fold_test",
    f"""with {FOLD_SCORES},
d as (select metric, fold, max(value) filter (model = 'two_terms') as a, max(value) filter (model = 'one_term') as b from scores group by metric, fold),
t as (select metric, count(*) as n, avg(a) as ma, avg(b) as mb, avg(a - b) as diff, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) as t from d group by metric),
p as (select *, {t_tail('t', '(n - 1)')} as p from t)
select metric, n, round(ma, 4) + 0.0 as model1_mean, round(mb, 4) + 0.0 as model2_mean, round(diff, 4) + 0.0 as difference,
  round(t, 4) + 0.0 as t_statistic, round(p, 6) + 0.0 as p_value, p < 0.05 as significant from p""",
)
def paired_fold_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = abtest.paired_test(fold_scores(spark, sf_dir), "two_terms", "one_term")
    return rounded_columns(rounded_columns(tested, "p_value"), "model1_mean", "model2_mean", "difference", "t_statistic", digits=4)
