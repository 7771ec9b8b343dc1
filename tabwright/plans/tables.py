"""Queries over sources, sinks, checks and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import closed_form_demand, demand_confidence, format_metric, rounded
from tabwright.lineage import new_path
from tabwright.operators import checks, evaluation, features
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.sources import documents, tables

# Inclusive request ranges.
REQUEST_RANGES = {
    "season": (1, 4),
    "yr": (0, 1),
    "mnth": (1, 12),
    "holiday": (0, 1),
    "weekday": (0, 6),
    "workingday": (0, 1),
    "weathersit": (1, 4),
    "temp": (0.0, 1.0),
    "atemp": (0.0, 1.0),
    "hum": (0.0, 1.0),
    "windspeed": (0.0, 1.0),
}

# Model inputs in their training order.
MODEL_INPUTS = [
    "instant", "season", "yr", "mnth", "holiday", "weekday", "workingday", "weathersit", "temp", "atemp", "hum",
    "windspeed", "casual", "registered", "year", "month", "day", "day_of_week", "temp_hum_interaction",
    "wind_category", "temp_season_adjusted",
]

DAY_SCHEMA = (
    "o_orderkey bigint, instant bigint, dteday string, season int, yr int, mnth int, holiday int, weekday int, "
    "workingday int, weathersit int, temp double, atemp double, hum double, windspeed double, cnt double"
)


def _by_month(days: DataFrame) -> DataFrame:
    return days.groupBy("yr", "mnth").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg("temp")).alias("mean_temp"),
        rounded(F.avg("cnt"), 4).alias("mean_cnt"),
        F.min("dteday").alias("first_text"),
    )


_BY_MONTH = """select yr, mnth, count(*) as n, round(avg(temp), 6) + 0.0 as mean_temp, round(avg(cnt), 4) + 0.0 as mean_cnt,
  min(dteday) as first_text from demand group by yr, mnth"""


@query("csv_ingest", f"with {b.DEMAND} {_BY_MONTH}")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "days-csv")
    tables.write_rows(b.demand(spark, sf_dir).drop("o_orderdate"), path, "csv")
    return _by_month(tables.read_rows(spark, path, DAY_SCHEMA, fmt="csv", require_rows=True))


@query(
    "load_with_row_check",
    "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) + 0.0 as total from orders group by o_orderstatus",
)
def load_with_row_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read_rows(spark, f"{sf_dir}/orders.parquet", fmt="parquet", require_rows=True)
    total = F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rounded(total, 2).alias("total"))


@query("snapshot_round_trip", f"with {b.SIDES} select * exclude (o_orderdate) from ref")
def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "reference")
    tables.write_snapshot(b.reference_and_current(spark, sf_dir)[0], path)
    return tables.read_snapshot(spark, path).drop("o_orderdate")


@query("json_records", "select event_id, cast(json_extract(props, '$.k') as bigint) as k, false as corrupt from events")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = tables.parse_json_rows(b.table(spark, sf_dir, "events"), "props", "k bigint")
    return parsed.select("event_id", F.col("record.k").alias("k"), F.col("corrupt_record").isNotNull().alias("corrupt"))


POINTS_PER_DOCUMENT = 10_000


def _experiment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run tables nested into documents.

    A document carries at most POINTS_PER_DOCUMENT points of a run; a longer
    history continues in further documents of the same run.
    """
    points = (
        b.run_metrics(spark, sf_dir)
        .groupBy("experiment_id", "run_id", "metric", F.expr(f"seq div {POINTS_PER_DOCUMENT}").alias("chunk"))
        .agg(
            F.array_sort(
                F.collect_list(F.struct("seq", "value", F.col("ts").cast("string").alias("timestamp")))
            ).alias("points")
        )
        .select(
            "run_id",
            F.map_from_arrays(
                F.array("metric"),
                F.array(F.transform("points", lambda p: F.struct(p["value"].alias("value"), p["timestamp"].alias("timestamp"), p["seq"].alias("step")))),
            ).alias("metrics"),
        )
    )
    run = b.runs(spark, sf_dir).join(points, "run_id")
    text = {"run_name": F.col("run_id"), "started_at": F.col("started_at").cast("string"), "ended_at": F.col("ended_at").cast("string")}
    run = run.withColumns(text).withColumn("parameters", F.create_map(F.lit("owner"), F.col("owner").cast("string")))
    fields = ["run_id", "run_name", "experiment_id", "status", "started_at", "ended_at", "parameters", "metrics"]
    return run.select("experiment_id", F.array(F.struct(*fields)).alias("runs"))


@query(
    "experiment_documents",
    f"""with {b.RUNS}
select m.experiment_id, m.run_id, r.status, cast(r.owner as varchar) as owner, m.metric, m.seq as step, m.value
from run_metrics m join runs r using (run_id)""",
)
def experiment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "experiments")
    documents.write_documents(_experiment_documents(spark, sf_dir), path)
    docs = documents.read_document_lines(spark, path)
    runs = documents.runs_table(docs).select("run_id", "status")
    params = documents.run_params_table(docs).filter("parameter = 'owner'").select("run_id", F.col("value").alias("owner"))
    points = documents.run_metrics_table(docs).select("experiment_id", "run_id", "metric", "step", "value")
    return points.join(runs.join(params, "run_id"), "run_id")


@query(
    "metric_table_round_trip",
    f"""with {b.PREDS}, s as (select *, {b.SPLIT_SQL} as split from preds),
m as (select split, avg(abs(cnt - pred)) as mae, sqrt(avg((cnt - pred)^2)) as rmse from s group by split)
select split as scope, 'mae' as metric, round(mae, 4) + 0.0 as value from m
union all select split, 'rmse', round(rmse, 4) + 0.0 from m""",
)
def metric_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.preds(spark, sf_dir).withColumn("split", _split())
    wide = evaluation.regression_metrics(rows, "cnt", "pred", by=["split"])
    long = wide.select(F.col("split").alias("scope"), F.expr("stack(2, 'mae', mae, 'rmse', rmse) as (metric, value)"))
    path = new_path(spark, "metrics")
    tables.write_metrics(long, path)
    return tables.read_metrics(spark, path).withColumn("value", rounded(F.col("value"), 4))


def _split():
    from tabwright.operators.split import split_label

    return split_label(b.portable_unit())


@query(
    "report_as_json",
    f"""with {b.PREDS} select 'preds' as model, count(*) as n, round(avg(abs(cnt - pred)), 4) + 0.0 as mae,
  round(avg(cnt - pred), 4) + 0.0 as bias from preds""",
)
def report_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.preds(spark, sf_dir)
    report = rows.agg(
        F.lit("preds").alias("model"),
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg(F.abs(F.col("cnt") - F.col("pred"))), 4).alias("mae"),
        rounded(F.avg(F.col("cnt") - F.col("pred")), 4).alias("bias"),
    )
    path = new_path(spark, "report")
    tables.write_report(report, path)
    return spark.read.schema("model string, n bigint, mae double, bias double").json(path)


# -- checks ------------------------------------------------------------------


@query(
    "training_table_findings",
    f"""with {b.DEMAND_DIRTY},
f as (select 'null_values' as "check", 'temp' as "column", 'warning' as severity, count(*) filter (temp is null) as n from demand_dirty
union all select 'empty', '*', 'error', case when count(*) = 0 then 1 else 0 end from demand_dirty
union all select 'missing_column', 'casual', 'error', 1
union all select 'not_numeric', 'dteday', 'error', 1
union all select 'numeric_categorical', c, 'warning', 1 from (values {', '.join(f"('{c}')" for c in b.CATEGORICAL)}) t(c))
select "check", "column", severity, cast(n as bigint) as n from f where n > 0""",
)
def training_table_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = b.Roles(numerical=(*b.NUMERICAL, "dteday"), categorical=b.CATEGORICAL, target="casual")
    return checks.findings(b.demand_dirty(spark, sf_dir), roles)


_NULLS = " union all ".join(
    f"""select '{c}' as "column", cast(count(*) filter ({c} is null) as bigint) as n_null from demand_dirty"""
    for c in (*b.CATEGORICAL, *b.NUMERICAL, "cnt")
)


@query("null_counts", f"with {b.DEMAND_DIRTY} {_NULLS}")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_counts(b.demand_dirty(spark, sf_dir), [*b.CATEGORICAL, *b.NUMERICAL, "cnt"])


@query(
    "schema_differences",
    """with want(c) as (values ('o_orderkey'), ('o_custkey'), ('o_totalprice'), ('o_comment')),
have(c) as (select column_name from (describe select * from orders))
select 'missing' as issue, c as "column", 'error' as severity from (select c from want except select c from have)
union all select 'extra', c, 'warning' from (select c from have except select c from want)""",
)
def schema_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = ["o_orderkey", "o_custkey", "o_totalprice", "o_comment"]
    return checks.schema_findings(spark, b.table(spark, sf_dir, "orders"), expected)


@query(
    "model_input_findings",
    f"""with {b.DEMAND_DIRTY}
select 'null_values' as "check", 'temp' as "column", 'warning' as severity, cast(count(*) filter (temp is null) as bigint) as n
from demand_dirty
union all select 'missing_column', 'casual', 'error', 1
union all select 'not_numeric', 'dteday', 'error', 1""",
)
def model_input_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.model_input_findings(b.demand_dirty(spark, sf_dir), ["temp", "hum", "casual", "dteday"])


_VIOLATIONS = ", ".join(
    f"case when {c} < {lo} or {c} > {hi} then '{c} out of range' end" for c, (lo, hi) in REQUEST_RANGES.items()
)


@query(
    "rejected_requests",
    f"""with {b.REQUESTS}, v as (select *, concat_ws('; ', {_VIOLATIONS}) as violations from requests)
select o_orderkey, season, hum, violations from v where violations <> ''""",
)
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = checks.split_by_ranges(b.requests(spark, sf_dir), REQUEST_RANGES)
    return rejected.select("o_orderkey", "season", "hum", F.array_join("violations", "; ").alias("violations"))


@query(
    "valid_requests",
    f"""with {b.REQUESTS}, v as (select *, concat_ws('; ', {_VIOLATIONS}) as violations from requests)
select * exclude (violations) replace (round(atemp, 6) + 0.0 as atemp) from v where violations = ''""",
)
def valid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = checks.split_by_ranges(b.requests(spark, sf_dir), REQUEST_RANGES)
    return valid.withColumn("atemp", rounded(F.col("atemp")))


@query(
    "complete_rows",
    f"""with {b.DEMAND_DIRTY} select season, count(*) as n, round(avg(temp), 6) + 0.0 as mean_temp
from demand_dirty where temp is not null group by season""",
)
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = checks.drop_incomplete(b.demand_dirty(spark, sf_dir))
    return kept.groupBy("season").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("temp")).alias("mean_temp"))


_FILLED = ", ".join(
    c if c in (*b.CATEGORICAL, "temp", "hum", "windspeed") else "round(atemp, 6) + 0.0 as atemp" if c == "atemp"
    else "row_number() over (order by o_orderkey) as instant" if c == "instant" else f"0 as {c}"
    for c in MODEL_INPUTS
)


@query("complete_model_inputs", f"with {b.REQUESTS} select o_orderkey, {_FILLED} from requests")
def complete_model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = checks.complete_columns(b.requests(spark, sf_dir), MODEL_INPUTS, key="o_orderkey")
    return filled.withColumn("atemp", rounded(F.col("atemp")))


@query(
    "apply_known_state",
    f"""with {b.DEMAND}, st as (select avg(temp) as m, stddev_pop(temp) as s from demand),
codes as (select mnth, dense_rank() over (order by mnth) - 1 as code from (select distinct mnth from demand))
select o_orderkey, cast(code as int) as mnth, round((temp - m) / s, 6) + 0.0 as temp
from demand join codes using (mnth), st""",
)
def apply_known_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.demand(spark, sf_dir)
    state = features.FeatureState.fit(rows, b.DEMAND_ROLES)
    few = state.apply(rows.select("o_orderkey", "mnth", "temp"), only_present=True)
    return few.withColumn("temp", rounded(F.col("temp")))


@query(
    "experiments_by_status_and_tags",
    f"""with {b.RUNS} select run_id, experiment_id, status from runs
where status = 'finished' and experiment_id = 'click' and owner % 2 = 0""",
)
def experiments_by_status_and_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    parity = F.when(F.col("owner") % 2 == 0, "even").otherwise("odd")
    tagged = b.runs(spark, sf_dir).withColumn(
        "tags", F.create_map(F.lit("kind"), F.col("experiment_id"), F.lit("owner"), parity)
    )
    return checks.filter_tagged(tagged, "finished", {"kind": "click", "owner": "even"}).select("run_id", "experiment_id", "status")


@query(
    "formatted_metrics",
    f"""with {b.PREDS} select season, printf('%.4f', round(avg(abs(cnt - pred)), 6)) as mae from preds group by season""",
)
def formatted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = b.preds(spark, sf_dir).groupBy("season").agg(rounded(F.avg(F.abs(F.col("cnt") - F.col("pred")))).alias("mae"))
    return wide.select("season", format_metric(F.col("mae")).alias("mae"))


@query(
    "closed_form_scores",
    f"""with {b.DEMAND_DIRTY}, s as (select o_orderkey, cast(greatest(0,
  trunc(2000 + coalesce(temp, 0.5) * 1500 - (weathersit - 1) * 200 + season * 100)) as int) as demand from demand_dirty)
select o_orderkey, demand, case when demand > 1000 and demand < 5000 then 'High' else 'Medium' end as confidence from s""",
)
def closed_form_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.demand_dirty(spark, sf_dir)
    demand = closed_form_demand(F.col("temp"), F.col("weathersit"), F.col("season"))
    return rows.select("o_orderkey", demand.alias("demand")).withColumn("confidence", demand_confidence(F.col("demand")))
