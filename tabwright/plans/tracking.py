"""Queries over experiment runs and model versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import rounded
from tabwright.lineage import new_path
from tabwright.operators import registry, tracking
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.plans.experiments import rounded_columns
from tabwright.sources.tables import merge_metrics

_LAST = "last as (select run_id, metric, arg_max(value, (ts, seq)) as value from run_metrics group by run_id, metric)"
_DONE = f"{b.RUNS}, {_LAST}, done as (select l.*, r.experiment_id, r.started_at from last l join runs r using (run_id) where status = 'finished')"


@query("last_metric_values", f"with {b.RUNS}, {_LAST} select run_id, metric, value from last")
def last_metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.last_values(b.run_metrics(spark, sf_dir))


def lifecycle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start events of all runs and end events of those that ended."""
    runs = b.runs(spark, sf_dir)
    start = runs.select("run_id", "experiment_id", F.lit("start").alias("event"), F.lit("running").alias("status"), F.col("started_at").alias("ts"), F.lit(0).alias("seq"))
    end = runs.filter("status <> 'running'").select(
        "run_id", F.lit(None).cast("string").alias("experiment_id"), F.lit("end").alias("event"), "status", F.col("ended_at").alias("ts"), F.lit(1).alias("seq")
    )
    return start.unionByName(end)


@query(
    "run_lifecycle",
    f"""with {b.RUNS} select run_id, experiment_id, status, epoch_us(started_at) as started_us,
  case when status <> 'running' then epoch_us(ended_at) end as ended_us from runs""",
)
def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = tracking.lifecycle(lifecycle_log(spark, sf_dir))
    micros = [F.unix_micros(F.col(c).cast("timestamp")).alias(f"{c.split('_')[0]}_us") for c in ("started_at", "ended_at")]
    return state.select("run_id", "experiment_id", "status", *micros)


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per experiment; those with an error or view kind have been closed."""
    kinds = b.runs(spark, sf_dir).groupBy("experiment_id").agg(F.count(F.lit(1)).alias("n_runs"))
    return kinds.withColumn("status", F.when(F.col("experiment_id").isin("error", "view"), "closed").otherwise("active"))


@query(
    "runs_outside_active_experiments",
    f"with {b.RUNS} select run_id, experiment_id, status from runs where experiment_id in ('error', 'view')",
)
def runs_outside_active_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tracking.runs_outside_active(b.runs(spark, sf_dir), experiments(spark, sf_dir))
    return found.select("run_id", "experiment_id", "status")


@query(
    "runs_of_active_experiments",
    f"with {b.RUNS} select run_id, experiment_id, status from runs where experiment_id not in ('error', 'view')",
)
def runs_of_active_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tracking.runs_of_active(b.runs(spark, sf_dir), experiments(spark, sf_dir))
    return found.select("run_id", "experiment_id", "status")


@query(
    "runs_by_id",
    f"""with {b.RUNS} select run_id, status from runs where run_id in (select 'click-' || user_id from events)""",
)
def runs_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids that name no run are ignored."""
    ids = b.table(spark, sf_dir, "events").select(F.concat(F.lit("click-"), "user_id").alias("run_id"))
    return tracking.find_runs(b.runs(spark, sf_dir), ids).select("run_id", "status")


@query(
    "appended_metrics",
    f"""with {b.RUNS} select run_id, metric, count(*) as n, round(sum(value), 4) + 0.0 as total from (
  select run_id, metric, value from run_metrics union all select run_id, 'value_squared', value * value from run_metrics) group by run_id, metric""",
)
def appended_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bulk appends to one log table."""
    points = b.run_metrics(spark, sf_dir)
    path = new_path(spark, "run-metrics")
    tracking.append_rows(points, path)
    tracking.append_rows(points.withColumns({"metric": F.lit("value_squared"), "value": F.col("value") * F.col("value")}), path)
    log = spark.read.schema(points.schema).parquet(path)
    return log.groupBy("run_id", "metric").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 4).alias("total"))


@query(
    "experiment_summaries",
    f"""with {_DONE}, c as (select experiment_id, count(*) as total_runs, count(*) filter (status = 'finished') as completed_runs,
  count(*) filter (status = 'failed') as failed_runs from runs group by experiment_id)
select c.*, metric, round(avg(value), 6) + 0.0 as mean, round(stddev_pop(value), 6) + 0.0 as std, min(value) as "min", max(value) as "max", count(value) as "count"
from c join done using (experiment_id) group by all""",
)
def experiment_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(tracking.experiment_summaries(b.runs(spark, sf_dir), b.run_metrics(spark, sf_dir)), "mean", "std")


_COMPARED = ["click-2", "click-3", "purchase-4", "purchase-nobody"]


@query(
    "compared_runs",
    f"""with {b.RUNS}, {_LAST}, c as (select * from last where run_id in ({', '.join(f"'{i}'" for i in _COMPARED)}))
select metric, {', '.join(f'''max(value) filter (run_id = '{i}') as "{i}"''' for i in _COMPARED)}, round(avg(value), 6) + 0.0 as mean,
  round(stddev_pop(value), 6) + 0.0 as std, (list(run_id order by value desc, run_id) filter (value is not null))[1] as best_run from c group by metric""",
)
def compared_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(tracking.compare_runs(b.run_metrics(spark, sf_dir), _COMPARED, ["value"]), "mean", "std")


@query(
    "best_runs",
    f"""with {_DONE}, r as (select *, row_number() over (partition by experiment_id order by value desc, started_at) as k from done)
select experiment_id, run_id, value from r where k = 1""",
)
def best_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tracking.best_runs(b.runs(spark, sf_dir), b.run_metrics(spark, sf_dir), "value")
    return best.select("experiment_id", "run_id", "value")


@query(
    "lowest_runs",
    f"""with {_DONE}, r as (select *, row_number() over (partition by experiment_id order by value, started_at) as k from done)
select experiment_id, run_id, value from r where k = 1""",
)
def lowest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tracking.best_runs(b.runs(spark, sf_dir), b.run_metrics(spark, sf_dir), "value", maximize=False)
    return best.select("experiment_id", "run_id", "value")


@query(
    "runs_per_experiment",
    f"""with {b.RUNS} select r.experiment_id, r.run_id, r.status, count(*) as n_points from runs r join run_metrics m using (run_id) group by all""",
)
def runs_per_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments joined with their runs; points are counted before the join."""
    counts = b.run_metrics(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_points"))
    return b.runs(spark, sf_dir).join(counts, "run_id").select("experiment_id", "run_id", "status", "n_points")


# -- registry ------------------------------------------------------------------


@query("listed_versions", f"with {b.VERSIONS} select model_name, version, stage, run_id from versions")
def listed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.list_versions(b.model_versions(spark, sf_dir)).select("model_name", "version", "stage", "run_id")


@query(
    "latest_versions",
    f"""with {b.VERSIONS} select model_name, stage, max(version) as version, arg_max(run_id, version) as run_id, arg_max(score, version) as score
from versions group by model_name, stage""",
)
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_versions(b.model_versions(spark, sf_dir))


@query(
    "resolved_versions",
    f"""with {b.VERSIONS}, q as (
  select model_name, max(version) as version, cast(null as varchar) as stage from versions group by model_name
  union all select model_name, null, 'Production' from versions group by model_name
  union all select model_name, null, 'Nowhere' from versions group by model_name)
select q.*, case when q.version is not null then q.version else (select max(v.version) from versions v where v.model_name = q.model_name and v.stage = q.stage) end as resolved from q""",
)
def resolved_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = b.model_versions(spark, sf_dir)
    newest = versions.groupBy("model_name").agg(F.max("version").alias("version")).withColumn("stage", F.lit(None).cast("string"))
    asked = newest
    for stage in ("Production", "Nowhere"):
        asked = asked.unionByName(newest.withColumns({"version": F.lit(None).cast("bigint"), "stage": F.lit(stage)}))
    return registry.resolve_versions(asked, versions).drop("run_id")


def version_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics of the versions: their score, and its sign unless the run has an odd id."""
    v = b.model_versions(spark, sf_dir)
    score = v.select("run_id", F.lit("score").alias("metric"), F.col("score").alias("value"))
    sign = v.filter("run_id % 2 = 0").select("run_id", F.lit("sign").alias("metric"), F.signum("score").alias("value"))
    return score.unionByName(sign)


VERSION_METRICS = f"""{b.VERSIONS}, version_metrics as (select run_id, 'score' as metric, score as value from versions
  union all select run_id, 'sign', cast(sign(score) as double) from versions where run_id % 2 = 0)"""


@query(
    "version_metrics",
    f"with {VERSION_METRICS} select model_name, version, stage, run_id, metric, value from versions join version_metrics using (run_id)",
)
def version_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.with_metrics(b.model_versions(spark, sf_dir), version_metrics(spark, sf_dir))


_TWO = f"""{VERSION_METRICS},
ends as (select min(version) as lo, max(version) as hi from versions),
a as (select metric, value from version_metrics, ends where run_id = lo), b as (select metric, value from version_metrics, ends where run_id = hi)"""


def _ends(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Metrics of the oldest and the newest version."""
    by_version = version_metrics(spark, sf_dir).groupBy("metric").agg(
        F.min(F.struct("run_id", "value")).alias("lo"), F.max(F.struct("run_id", "value")).alias("hi")
    )
    ends = b.model_versions(spark, sf_dir).agg(F.min("version").alias("lo_id"), F.max("version").alias("hi_id")).first()
    first = by_version.filter(F.col("lo.run_id") == ends["lo_id"]).select("metric", "lo.value")
    second = by_version.filter(F.col("hi.run_id") == ends["hi_id"]).select("metric", "hi.value")
    return first, second


@query(
    "compared_versions",
    f"""with {_TWO} select metric, round(a.value, 4) + 0.0 as "first", round(b.value, 4) + 0.0 as second, round(b.value - a.value, 4) + 0.0 as difference,
  round(case when a.value = 0 then 0 else (b.value - a.value) / a.value * 100 end, 4) + 0.0 as percent_change from a full join b using (metric)""",
)
def compared_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the registry side by side; one-sided metrics are listed too."""
    compared = registry.compare_versions(*_ends(spark, sf_dir), how="full")
    return rounded_columns(compared, "first", "second", "difference", "percent_change", digits=4)


@query("shared_metrics", f"with {_TWO} select metric from a intersect select metric from b")
def shared_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.shared_metric_names(*_ends(spark, sf_dir))


@query(
    "current_stages",
    """select c_mktsegment as model_name, c_custkey as version, case when c_nationkey % 4 = 0 then 'None'
  when c_nationkey % 4 = 1 then 'Staging' when c_nationkey % 4 = 2 then 'Production' else 'Archived' end as stage, c_custkey as run_id from customer""",
)
def current_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration and stage events folded into the current stage of each version."""
    v = b.model_versions(spark, sf_dir)
    registered = v.select("model_name", "version", F.lit("None").alias("stage"), "run_id", F.lit(1).alias("ts"))
    staged = v.filter("stage <> 'None'").select("model_name", "version", F.lit("Staging").alias("stage"), F.lit(None).cast("bigint").alias("run_id"), F.lit(2).alias("ts"))
    moved = v.filter("stage in ('Production', 'Archived')").select("model_name", "version", "stage", F.lit(None).cast("bigint").alias("run_id"), F.lit(3).alias("ts"))
    return registry.current_versions(registered.unionByName(staged).unionByName(moved)).drop("created_at")


@query(
    "merged_metrics",
    f"""with {VERSION_METRICS} select 'mean' as scope, metric, round(avg(value), 6) + 0.0 as value from version_metrics group by metric
union all select 'highest', metric, round(max(value), 6) + 0.0 from version_metrics group by metric""",
)
def merged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = version_metrics(spark, sf_dir).groupBy("metric")
    merged = merge_metrics(mean=rows.agg(F.avg("value").alias("value")), highest=rows.agg(F.max("value").alias("value")))
    return rounded_columns(merged, "value")
