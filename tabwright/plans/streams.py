"""Queries that run a stream over a table to its end and read the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import rounded
from tabwright.lineage import new_path
from tabwright.operators import drift
from tabwright.operators.histograms import histogram
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.plans.experiments import WELCH, moments_sql, rounded_columns, t_tail
from tabwright.plans.models import request_scorer
from tabwright.plans.tables import _VIOLATIONS, REQUEST_RANGES
from tabwright.operators import abtest, training
from tabwright.streaming import operators, sinks


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sinks.read_stream(spark, f"{sf_dir}/{name}.parquet")


def _updated(spark: SparkSession, stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an update-mode aggregation over what is there and read its final rows."""
    path = new_path(spark, name)
    sinks.run_into(stream, {path: lambda rows: rows}, new_path(spark, f"{name}-progress"), "update").awaitTermination()
    return sinks.latest_of(spark, path, stream.schema, keys)


@query(
    "streamed_scores_equal_batch",
    f"""with {b.REQUESTS}, v as (select concat_ws('; ', {_VIOLATIONS}) as violations from requests)
select count(*) filter (violations = '') as n_scored, count(*) filter (violations <> '') as n_rejected, cast(0 as bigint) as n_different from v""",
)
def streamed_scores_equal_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored as a stream, compared row by row with the batch scores."""
    state, model, _ = request_scorer(spark, sf_dir)
    live = b.requests_of(b.demand_of(_stream(spark, sf_dir, "orders")))
    scored_path, rejected_path = new_path(spark, "scored"), new_path(spark, "rejected")
    scored, rejected = operators.scored_requests(live, state, model, REQUEST_RANGES)
    outputs = {
        scored_path: lambda rows: operators.scored_requests(rows, state, model, REQUEST_RANGES)[0],
        rejected_path: lambda rows: operators.scored_requests(rows, state, model, REQUEST_RANGES)[1],
    }
    sinks.run_into(live, outputs, new_path(spark, "scoring-progress")).awaitTermination()
    got = sinks.table_of(spark, scored_path, scored.schema).select("o_orderkey", "prediction")
    n_rejected = sinks.table_of(spark, rejected_path, rejected.schema).agg(F.count(F.lit(1)).alias("n_rejected"))
    batch, _ = training.score(b.requests(spark, sf_dir), state, model, REQUEST_RANGES)
    both = got.join(batch.select("o_orderkey", F.col("prediction").alias("_batch")), "o_orderkey", "full")
    compared = both.agg(
        F.count("prediction").alias("n_scored"), F.count_if(~F.col("prediction").eqNullSafe(F.col("_batch"))).alias("n_different")
    )
    return compared.withColumn("n_rejected", F.lit(n_rejected.first()["n_rejected"]))


@query(
    "streamed_quality_by_day",
    """select date_trunc('day', ts)::timestamp as window_start, count(*) as n_rows, cast(count(*) * 3 - count(value) - count(user_id) - count(event_type) as bigint) as n_missing,
  round(avg(value), 6) + 0.0 as mean_value, round(avg(user_id), 6) + 0.0 as mean_user_id from events group by 1""",
)
def streamed_quality_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = operators.windowed_quality(_stream(spark, sf_dir, "events"), "ts", ["value", "user_id", "event_type"])
    out = _updated(spark, windows, "quality", ["window_start"])
    return rounded_columns(_plain_time(out), "mean_value", "mean_user_id")


def _plain_time(df: DataFrame, column: str = "window_start") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query(
    "streamed_quality_sliding",
    """with w as (select ts, value, unnest([date_trunc('day', ts), date_trunc('day', ts) - interval 1 day])::timestamp as window_start from events)
select window_start, count(*) as n_rows, cast(count(*) - count(value) as bigint) as n_missing, round(avg(value), 6) + 0.0 as mean_value from w group by 1""",
)
def streamed_quality_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-day windows that start every day."""
    windows = operators.windowed_quality(_stream(spark, sf_dir, "events"), "ts", ["value"], "2 days", "1 day")
    return rounded_columns(_plain_time(_updated(spark, windows, "sliding", ["window_start"])), "mean_value")


@query(
    "streamed_duplicates",
    """with c as (select date_trunc('day', ts)::timestamp as window_start, user_id, event_type, count(*) as copies from events group by all)
select window_start, cast(sum(copies) as bigint) as n_rows, cast(sum(copies) - count(*) as bigint) as n_duplicates,
  round((sum(copies) - count(*)) / cast(sum(copies) as double), 6) + 0.0 as duplicate_rate from c group by window_start""",
)
def streamed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (user, type) pairs per day."""
    keys = ["user_id", "event_type"]
    copies = operators.windowed_copies(_stream(spark, sf_dir, "events"), "ts", keys)
    rates = operators.window_duplicates(_updated(spark, copies, "copies", ["window_start", *keys]))
    return rounded_columns(_plain_time(rates), "duplicate_rate")


STREAM_DRIFT = """e as (select list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) as edges from events),
x as (select date_trunc('day', ts)::timestamp as window_start, len(list_filter(edges, lambda q: value > q)) as bin from events, e),
r as (select bin, count(*) / (select count(*) from x) as p from x group by bin),
d as (select window_start, bin, count(*) as n from x group by all),
t as (select window_start, sum(n) as total from d group by window_start),
drifted as (select t.window_start, 'value' as "column", sum((greatest(coalesce(n / total, 0), 1e-6) - greatest(p, 1e-6)) * ln(greatest(coalesce(n / total, 0), 1e-6) / greatest(p, 1e-6))) as psi
  from t cross join r left join d on d.window_start = t.window_start and d.bin = r.bin group by t.window_start)"""


def _stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = b.table(spark, sf_dir, "events")
    bins = drift.Bins.on_edges(reference, drift.quantile_edges(reference, ["value"]))
    live = operators.windowed_bins(_stream(spark, sf_dir, "events"), "ts", bins)
    final = _updated(spark, live, "bins", ["window_start", "column", "bin"])
    return operators.window_drift(final, histogram(reference, bins), bins).select("window_start", "column", "psi")


@query("streamed_drift", f"""with {STREAM_DRIFT} select window_start, "column", round(psi, 6) + 0.0 as psi from drifted""")
def streamed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily distribution of event values against that of the whole table."""
    return rounded_columns(_plain_time(_stream_drift(spark, sf_dir)), "psi")


@query(
    "streamed_alerts",
    f"""with {STREAM_DRIFT} select window_start as ts, 'Data Drift Detected' as subject, printf('Data drift score %.3f exceeds threshold %.3f', psi, 0.005) as message,
  'warning' as severity, "column" as metric, round(psi, 6) + 0.0 as value, 0.005::double as threshold from drifted where psi > 0.005""",
)
def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert rows written per micro-batch; later batches of a window replace earlier ones."""
    reference = b.table(spark, sf_dir, "events")
    bins = drift.Bins.on_edges(reference, drift.quantile_edges(reference, ["value"]))
    live = operators.windowed_bins(_stream(spark, sf_dir, "events"), "ts", bins)
    counts, path = new_path(spark, "bins"), new_path(spark, "alerts")
    operators.run_drift_alerts(live, histogram(reference, bins), bins, counts, path, new_path(spark, "alerts-progress"), 0.005).awaitTermination()
    return rounded_columns(_plain_time(operators.current_alerts(spark, path), "ts"), "value").withColumn("threshold", F.lit(0.005))


STATED_EDGES = [10.0 * i for i in range(1, 10)]


@query(
    "streamed_drift_with_missing",
    f"""with e as (select date_trunc('day', ts)::timestamp as w, case when event_id % 11 = 0 then null when day(ts) % 2 = 0 and event_id % 3 = 0 then 'nan'::double else value end as v from events),
x as (select w, v, len(list_filter({STATED_EDGES}, lambda q: v > q)) as bin from e where v is not null and not isnan(v)),
r as (select bin, count(*) / (select count(*) from x) as p from x group by bin),
d as (select w, bin, count(*) as n from x group by all),
t as (select w, sum(n) as total from d group by w),
psi as (select t.w, sum((greatest(coalesce(n / total, 0), 1e-6) - greatest(p, 1e-6)) * ln(greatest(coalesce(n / total, 0), 1e-6) / greatest(p, 1e-6))) as psi
  from t cross join r left join d on d.w = t.w and d.bin = r.bin group by t.w),
gone as (select w, avg(case when v is null or isnan(v) then 1.0 else 0.0 end) as missing_cur, (select avg(case when v is null or isnan(v) then 1.0 else 0.0 end) from e) as missing_ref from e group by w)
select w as window_start, round(psi, 6) + 0.0 as psi, round(missing_ref, 6) + 0.0 as missing_ref, round(missing_cur, 6) + 0.0 as missing_cur,
  round(greatest(psi, abs(missing_ref - missing_cur)), 6) + 0.0 as score from psi join gone using (w)""",
)
def streamed_drift_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that turns null or NaN on some days is missing there, not high and not unseen."""
    nan = (F.dayofmonth("ts") % 2 == 0) & (F.col("event_id") % 3 == 0)
    value = F.when(F.col("event_id") % 11 != 0, F.when(nan, F.lit(float("nan"))).otherwise(F.col("value")))
    reference = b.table(spark, sf_dir, "events").withColumn("value", value)
    bins = drift.Bins.on_edges(reference, {"value": STATED_EDGES})
    live = operators.windowed_bins(_stream(spark, sf_dir, "events").withColumn("value", value), "ts", bins)
    final = _updated(spark, live, "holes", ["window_start", "column", "bin"])
    found = operators.window_drift(final, histogram(reference, bins), bins)
    picked = found.select("window_start", "psi", "missing_ref", "missing_cur", "score")
    return rounded_columns(_plain_time(picked), "psi", "missing_ref", "missing_cur", "score")


@query(
    "streamed_sequential_looks",
    f"""with {b.ARMS}, days as (select distinct segment, look from arms),
upto as (select d.segment, d.look, a.arm, a.value from days d join arms a on a.segment = d.segment and a.look <= d.look),
{moments_sql('upto', 'value', 'segment, look')}, {WELCH}, p as (select *, {t_tail('t', 'df')} as p from w)
select segment, look, cn + tn as total_count, round(p, 6) + 0.0 as p_value, round(d, 6) + 0.0 as effect_size,
  case when p < 0.005 then '{abtest.STRONG_EVIDENCE}' when d < 0.01 then '{abtest.NEGLIGIBLE}' end as stop_reason from p""",
)
def streamed_sequential_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = b.arms_of(_stream(spark, sf_dir, "events"))
    moments = operators.look_moments(live, "ts", "value", ["segment"])
    looks = operators.sequential_state(_updated(spark, moments, "looks", ["window_start", "segment"]), ["segment"])
    picked = looks.select("segment", F.to_date("window_start").alias("look"), "total_count", "p_value", "effect_size", "stop_reason")
    return rounded_columns(picked, "p_value", "effect_size")


@query(
    "streamed_metric_log",
    f"""with {b.RUNS} select run_id, count(*) as n, round(sum(value), 4) + 0.0 as total from run_metrics group by run_id""",
)
def streamed_metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric points of which some arrive twice, logged once."""
    copies = F.explode(F.when(F.col("event_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    live = _stream(spark, sf_dir, "events").select("*", copies.alias("_copy")).drop("_copy")
    points = operators.metric_log(live, "ts", ["event_id"]).select(F.concat_ws("-", "event_type", "user_id").alias("run_id"), "value", "ts")
    path = new_path(spark, "metric-log")
    sinks.append_to(points, path, new_path(spark, "metric-log-progress")).awaitTermination()
    log = spark.read.schema(points.schema).parquet(path)
    return log.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 4).alias("total"))
