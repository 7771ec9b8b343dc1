"""Queries over quality, drift, performance and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import rounded
from tabwright.lineage import new_path
from tabwright.operators import drift, evaluation, monitoring
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.plans.experiments import rounded_columns
from tabwright.sources import tables

NUMERIC = (*b.NUMERICAL, "cnt")


def _long_sql(columns, cast: str) -> str:
    return " union all ".join(
        f"select '{c}' as c, cast({c} as {cast}) as v, {r} as r from {side}" for c in columns for side, r in (("ref", 1), ("cur", 0))
    )


NUMERIC_DRIFT = f"""{b.SIDES}, vals as ({_long_sql(NUMERIC, 'double')}),
cnts as (select c, v, sum(r) as nr, sum(1 - r) as nc from vals group by c, v),
tot as (select c, sum(r) as tr, sum(1 - r) as tc, stddev_pop(v) filter (r = 1) as s,
  list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) filter (r = 1)) as edges from vals group by c),
cum as (select c, v, sum(nr) over w / tr as f, sum(nc) over w / tc as g, lead(v) over w as nxt, s
  from cnts join tot using (c) window w as (partition by c order by v)),
dist as (select c, max(abs(f - g)) as ks, sum(abs(f - g) * coalesce(nxt - v, 0)) / max(greatest(s, 0.001)) as wasserstein from cum group by c),
bins as (select c, len(list_filter(edges, lambda e: v > e)) as bin, sum(nr) / max(tr) as p, sum(nc) / max(tc) as q from cnts join tot using (c) group by c, bin),
psi as (select c, sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))) as psi from bins group by c)"""

LABEL_DRIFT = f"""lvals as ({_long_sql(b.CATEGORICAL, 'varchar')}),
lcnt as (select c, v, sum(r) as nr, sum(1 - r) as nc from lvals group by c, v),
lshare as (select c, v, nr / sum(nr) over (partition by c) as p, nc / sum(nc) over (partition by c) as q from lcnt),
js as (select c, sqrt(greatest(0, sum((case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end) / 2 + (case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2))) as js,
  sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))) as psi from lshare group by c)"""

REPORT = f"""{NUMERIC_DRIFT}, {LABEL_DRIFT},
report as (select c as "column", 'numerical' as kind, 'wasserstein' as method, wasserstein as score from dist
  union all select c, 'categorical', 'jensen_shannon', js from js)"""


@query(
    "numeric_drift",
    f"""with {NUMERIC_DRIFT} select c as "column", round(ks, 6) + 0.0 as ks, round(wasserstein, 6) + 0.0 as wasserstein, round(psi, 6) + 0.0 as psi
from dist join psi using (c)""",
)
def numeric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = b.reference_and_current(spark, sf_dir)
    return rounded_columns(drift.numeric_drift(ref, cur, NUMERIC), "ks", "wasserstein", "psi")


@query(
    "label_drift",
    f"""with {b.SIDES}, {LABEL_DRIFT} select c as "column", round(js, 6) + 0.0 as jensen_shannon, round(psi, 6) + 0.0 as psi from js""",
)
def label_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = b.reference_and_current(spark, sf_dir)
    return rounded_columns(drift.categorical_drift(ref, cur, b.CATEGORICAL), "jensen_shannon", "psi")


@query(
    "drift_report",
    f"""with {REPORT} select "column", kind, method, round(score, 6) + 0.0 as score, score >= 0.1 as drifted from report""",
)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = b.reference_and_current(spark, sf_dir)
    return rounded_columns(drift.drift_report(ref, cur, NUMERIC, b.CATEGORICAL, exact=True).drop("error"), "score")


# Stated edges; cnt runs from 0 to some 6,500.
EDGES = {c: [i / 20 for i in range(1, 20)] for c in b.NUMERICAL} | {"cnt": [250.0 * i for i in range(4, 24)]}
_EDGES = " union all ".join(f"select '{c}' as c, {e}::double[] as edges" for c, e in EDGES.items())

# Stretches between neighbouring values carry a constant gap; those inside a bin add up with their sign.
BINNED_DRIFT = f"""{NUMERIC_DRIFT}, stated as ({_EDGES}),
rows_of as (select c, f, g, f - g as gap, v, nxt, 2 * len(list_filter(edges, lambda e: v > e)) + list_contains(edges, v)::int as bin,
  2 * len(list_filter(edges, lambda e: nxt > e)) + list_contains(edges, nxt)::int as next_bin, s
  from cum join stated using (c)),
ends as (select c, unnest(edges) as e from stated),
at_edges as (select c, e, coalesce(max(f) filter (v <= e), 0) as f, coalesce(max(g) filter (v <= e), 0) as g from ends join cum using (c) group by c, e
  union all select c, e, coalesce(max(f) filter (v < e), 0), coalesce(max(g) filter (v < e), 0) from ends join cum using (c) group by c, e),
ks as (select c, max(abs(f - g)) as ks from at_edges group by c),
inner_parts as (select c, bin, max(v) - min(v) as w, sum(case when next_bin = bin then gap * (nxt - v) else 0 end) as i,
  sum(case when next_bin > bin then abs(gap) * (nxt - v) else 0 end) as sure, max(f) as f1, max(g) as g1, max(s) as s from rows_of group by c, bin),
bounds as (select *, coalesce(lag(f1) over w2, 0) - g1 as least, f1 - coalesce(lag(g1) over w2, 0) as most from inner_parts window w2 as (partition by c order by bin)),
bounded as (select c, sum(sure + abs(i)) / greatest(max(s), 0.001) as wasserstein,
  sum(case when least < 0 and most > 0 and w > 0 then (i * (most + least) - 2 * w * least * most) / (most - least) - abs(i) else 0 end) / greatest(max(s), 0.001) as wasserstein_error,
  max(case when w > 0 then greatest(most, -least) else abs(f1 - g1) end) as ks_most, max(abs(f1 - g1)) as ks_known from (select * exclude (f1, g1), f1, g1 from bounds) group by c),
bin_shares as (select c, bin, f1 - coalesce(lag(f1) over w2, 0) as p, g1 - coalesce(lag(g1) over w2, 0) as q from inner_parts window w2 as (partition by c order by bin)),
bin_psi as (select c, sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))) as psi
  from (select c, sum(p) as p, sum(q) as q from bin_shares group by c, bin // 2) group by c)"""


@query(
    "binned_drift",
    f"""with {BINNED_DRIFT} select c as "column", round(ks, 6) + 0.0 as ks, round(greatest(ks_most - ks, 0), 6) + 0.0 as ks_error, round(wasserstein, 6) + 0.0 as wasserstein,
  round(wasserstein_error, 6) + 0.0 as wasserstein_error, round(bin_psi.psi, 6) + 0.0 as psi, 0.0::double as missing_ref, 0.0::double as missing_cur
from ks join bounded using (c) join bin_psi using (c)""",
)
def binned_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift on stated bins with the errors that the bins leave open."""
    ref, cur = b.reference_and_current(spark, sf_dir)
    found = drift.binned_drift(ref, cur, NUMERIC, drift.Bins.on_edges(ref, EDGES))
    return rounded_columns(found, *[c for c in found.columns if c != "column"])


@query("drift_flags_from_bins", f"""with {REPORT} select "column", kind, method, score >= 0.1 as drifted from report""")
def drift_flags_from_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default report, on fitted bins: its flags are those of the exact distances."""
    ref, cur = b.reference_and_current(spark, sf_dir)
    return drift.drift_report(ref, cur, NUMERIC, b.CATEGORICAL).select("column", "kind", "method", "drifted")


_HOLES = f"""{b.SIDES}, ref_h as (select temp as gone, null::double as never, temp as half, cnt as kept from ref),
cur_h as (select null::double as gone, null::double as never, case when o_orderkey % 2 = 0 then temp end as half, cnt as kept from cur)"""


@query(
    "drift_with_missing_values",
    f"""with {_HOLES}, a as (select 'gone' as c, count(gone) / count(*) as r from ref_h union all select 'never', count(never) / count(*) from ref_h
  union all select 'half', count(half) / count(*) from ref_h union all select 'kept', count(kept) / count(*) from ref_h),
z as (select 'gone' as c, count(gone) / count(*) as q from cur_h union all select 'never', count(never) / count(*) from cur_h
  union all select 'half', count(half) / count(*) from cur_h union all select 'kept', count(kept) / count(*) from cur_h)
select c as "column", round(1 - r, 6) + 0.0 as missing_ref, round(1 - q, 6) + 0.0 as missing_cur, case when r = 0 and q = 0 then 0.0 when r = 0 or q = 0 then 1.0 end as ks_if_empty
from a join z using (c)""",
)
def drift_with_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing shares per side; a column empty on one side is as far off as can be, on both sides not at all."""
    ref, cur = b.reference_and_current(spark, sf_dir)
    none = F.lit(None).cast("double")
    ref = ref.select(F.col("temp").alias("gone"), none.alias("never"), F.col("temp").alias("half"), F.col("cnt").alias("kept"))
    cur = cur.select(none.alias("gone"), none.alias("never"), F.when(F.col("o_orderkey") % 2 == 0, F.col("temp")).alias("half"), F.col("cnt").alias("kept"))
    columns = ["gone", "never", "half", "kept"]
    missing = drift.missing_shares(drift.value_counts(ref, cur, columns, "double"))
    found = drift.numeric_drift(ref, cur, columns).join(missing, "column")
    picked = found.select("column", "missing_ref", "missing_cur", F.when(F.col("sides") < 2, F.col("ks")).alias("ks_if_empty"))
    return rounded_columns(picked, "missing_ref", "missing_cur")


_ALARM = f"""{REPORT}, summary as (select coalesce(avg(score) filter (score >= 0.1), 0) as drift_score,
  coalesce(array_to_string(list_sort(list("column") filter (score >= 0.1)), ','), '') as drifted_columns from report)"""


@query(
    "drift_alarm",
    f"""with {_ALARM} select round(drift_score, 6) + 0.0 as drift_score, drifted_columns, cast(0.1 as double) as threshold, drift_score > 0.1 as alarm from summary""",
)
def drift_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = b.reference_and_current(spark, sf_dir)
    summary = drift.overall(drift.drift_report(ref, cur, NUMERIC, b.CATEGORICAL, exact=True))
    return rounded_columns(summary.withColumn("drifted_columns", F.array_join("drifted_columns", ",")), "drift_score")


QUALITY = f"""{b.DEMAND_DIRTY}, n as (select cast(count(*) as double) as n, count(*) - count(temp) as missing from demand_dirty),
u as (select count(*) as u from (select distinct * from demand_dirty)),
quality as (select 'missing' as "check", missing / n as value, cast(0.05 as double) as threshold from n
  union all select 'duplicates', (n - u) / n, cast(0.01 as double) from n, u)"""


@query(
    "quality_report",
    f"""with {QUALITY} select "check", round(value, 6) + 0.0 as value, threshold, value > threshold as breached from quality""",
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(monitoring.quality_report(b.demand_dirty(spark, sf_dir)), "value")


_ISSUE = """case "check" when 'missing' then 'High missing values' else 'High duplicate rate' end || printf(': %.2f%%', value * 100)"""


@query(
    "quality_issues",
    f"""with {QUALITY} select string_agg({_ISSUE}, '; ' order by "check" desc) as issues, count(*) as n_issues from quality where value > threshold""",
)
def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.quality_issues(monitoring.quality_report(b.demand_dirty(spark, sf_dir)))


_LINKS = " union all ".join(
    f"select '{a}~{c}' as name, corr({a}, {c}) as value from cur"
    for i, a in enumerate((*b.NUMERICAL, "cnt"))
    for c in (*b.NUMERICAL, "cnt")[i + 1 :]
)


@query(
    "data_monitoring",
    f"""with {REPORT}, n as (select cast(count(*) as double) as n from cur)
select 'quality' as kind, 'missing' as name, 0.0::double as value, 0.05::double as threshold, false as breached from n
union all select 'quality', 'duplicates', round((n - (select count(*) from (select distinct * from cur))) / n, 6) + 0.0, 0.01::double,
  (n - (select count(*) from (select distinct * from cur))) / n > 0.01 from n
union all select 'correlation', name, round(value, 6) + 0.0, null, false from ({_LINKS})
union all select 'drift', "column", round(score, 6) + 0.0, 0.1::double, score >= 0.1 from report where "column" <> 'cnt'""",
)
def data_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality, correlations and drift of the current table against a stored snapshot."""
    ref, cur = b.reference_and_current(spark, sf_dir)
    path = new_path(spark, "reference")
    tables.write_snapshot(ref, path)
    return rounded_columns(monitoring.monitor_data(cur, b.DEMAND_ROLES, path, exact=True), "value")


# Current metrics are those of the test split, the baseline those of the training split under a better scorer.
_SCORED = f"""{b.PREDS}, s as (select *, {b.SPLIT_SQL} as split from preds),
current as (select 'mae' as metric, avg(abs(cnt - pred)) as cur from s where split = 'test'
  union all select 'rmse', sqrt(avg((cnt - pred)^2)) from s where split = 'test'
  union all select 'r2', 1 - sum((cnt - pred)^2) / (count(*) * var_pop(cnt)) from s where split = 'test'
  union all select 'mape', 100 * avg(abs((cnt - pred) / nullif(cnt, 0))) from s where split = 'test'),
base as (select 'mae' as metric, avg(abs(cnt - pred - 550)) as base from s where split = 'train'
  union all select 'rmse', sqrt(avg((cnt - pred - 550)^2)) from s where split = 'train'
  union all select 'r2', 1 - sum((cnt - pred - 550)^2) / (count(*) * var_pop(cnt)) from s where split = 'train'),
cmp as (select metric, cur, base, case when metric in ('mae', 'rmse') then cur > base * 1.1 when metric = 'r2' then cur < base * 0.9 else false end as degraded,
  case when metric in ('mae', 'rmse') then base * 1.1 when metric = 'r2' then base * 0.9 end as threshold from current join base using (metric)),
performance as (select *, case when degraded then upper(metric) || (case when metric = 'r2' then ' decreased' else ' increased' end)
  || printf(' from %.3f to %.3f', base, cur) end as message from cmp)"""


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.operators.split import split_label

    scored = b.preds(spark, sf_dir).withColumn("split", split_label(b.portable_unit()))
    current = evaluation.as_long(evaluation.regression_metrics(scored.filter("split = 'test'"), "cnt", "pred").select("mae", "rmse", "r2", "mape"))
    better = scored.filter("split = 'train'").withColumn("pred", F.col("pred") + 550)
    past = evaluation.as_long(evaluation.regression_metrics(better, "cnt", "pred").select("mae", "rmse", "r2"))
    history = past.withColumn("recorded_at", F.lit(2)).unionByName(past.withColumns({"value": F.lit(0.0), "recorded_at": F.lit(1)}))
    return monitoring.compare_with_baseline(current, monitoring.latest_baseline(history))


@query(
    "performance_check",
    f"""with {_SCORED} select metric, round(cur, 4) + 0.0 as current, round(base, 4) + 0.0 as baseline, round(threshold, 4) + 0.0 as threshold,
  degraded, message from performance""",
)
def performance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(_performance(spark, sf_dir), "current", "baseline", "threshold", digits=4)


@query(
    "alerts",
    f"""with {_SCORED}, {QUALITY[len(b.DEMAND) + 2:]},
{_ALARM[len(b.DEMAND) + 2:]}
select 'Data Drift Detected' as subject, printf('Data drift score %.3f exceeds threshold %.3f', drift_score, 0.1) as message, 'warning' as severity,
  'drift_score' as metric, round(drift_score, 6) + 0.0 as value, 0.1::double as threshold from summary where drift_score > 0.1
union all select 'Data Quality Issue', {_ISSUE}, 'error', "check", round(value, 6) + 0.0, threshold from quality where value > threshold
union all select 'Model Performance Drop', message, 'error', metric, round(cur, 6) + 0.0, round(threshold, 6) + 0.0 from performance where degraded""",
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that breached a threshold, from all three monitors."""
    ref, cur = b.reference_and_current(spark, sf_dir)
    summary = drift.overall(drift.drift_report(ref, cur, NUMERIC, b.CATEGORICAL, exact=True))
    quality = monitoring.quality_report(b.demand_dirty(spark, sf_dir))
    raised = (
        monitoring.drift_alerts(summary)
        .unionByName(monitoring.quality_alerts(quality))
        .unionByName(monitoring.performance_alerts(_performance(spark, sf_dir)))
    )
    return raised.withColumns({"value": rounded(F.col("value")), "threshold": rounded(F.col("threshold"))})
