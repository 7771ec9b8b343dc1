"""Queries over feature state, outliers, profiles and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import day_parts, parse_day, rounded
from tabwright.lineage import new_path
from tabwright.operators import features, outliers, profile
from tabwright.operators.features import FeatureState
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query


def _r(*columns: str) -> list:
    return [rounded(F.col(c)).alias(c) for c in columns]


def _scaled_sql(columns=b.NUMERICAL) -> str:
    return ", ".join(f"(d.{c} - m_{c}) / s_{c} as {c}" for c in columns)


_MOMENTS = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in b.NUMERICAL)
_CODES = ", ".join(f"cast(dense_rank() over (order by {c}) - 1 as int) as {c}" for c in b.CATEGORICAL)
# Preprocessed demand: codes, scaled numericals and calendar parts.
PROCESSED = (
    b.DEMAND
    + f""", moments as (select {_MOMENTS} from demand),
processed as (select d.o_orderkey, d.instant, {_CODES}, {_scaled_sql()}, d.cnt,
  cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(day(o_orderdate) as int) as day,
  cast(isodow(o_orderdate) - 1 as int) as day_of_week from demand d, moments)"""
)
_FENCE = ", ".join(
    f"quantile_cont({c}, 0.25) as q1_{c}, quantile_cont({c}, 0.75) as q3_{c}" for c in b.NUMERICAL
)
_CLIP = ", ".join(
    f"least(greatest({c}, q1_{c} - 1.5*(q3_{c} - q1_{c})), q3_{c} + 1.5*(q3_{c} - q1_{c})) as {c}" for c in b.NUMERICAL
)
CLIPPED = PROCESSED + f""", fences as (select {_FENCE} from processed),
clipped as (select p.* replace ({_CLIP}) from processed p, fences)"""
_WIND = "case when windspeed <= 0.1 then 'calm' when windspeed <= 0.3 then 'light' else 'windy' end"
FEATURED = CLIPPED + f""", classed as (select *, {_WIND} as wind from clipped),
wind_codes as (select wind, cast(dense_rank() over (order by wind) - 1 as int) as code from (select distinct wind from classed)),
season_means as (select season, avg(temp) as mean_temp from classed group by season),
featured as (select c.* exclude (wind), temp * hum as temp_hum_interaction, code as wind_category,
  temp - mean_temp as temp_season_adjusted from classed c join wind_codes using (wind) join season_means using (season))"""


def fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureState]:
    """Demand preprocessed, clipped and with derived columns, and the state behind it."""
    days = b.demand(spark, sf_dir).drop("o_orderdate")
    state = FeatureState.fit(days, b.DEMAND_ROLES)
    clipped = outliers.clip_outliers(state.apply(days), b.NUMERICAL)
    state.fit_derived(clipped)
    return state.derive(clipped), state


@query(
    "feature_table_by_season",
    f"""with {FEATURED} select season, wind_category, count(*) as n, round(avg(temp_hum_interaction), 6) + 0.0 as mean_interaction,
  round(stddev_pop(temp_season_adjusted), 6) + 0.0 as std_adjusted, round(max(windspeed), 6) + 0.0 as max_wind,
  round(avg(cnt), 4) + 0.0 as mean_cnt from featured group by season, wind_category""",
)
def feature_table_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = fitted(spark, sf_dir)
    return rows.groupBy("season", "wind_category").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg("temp_hum_interaction")).alias("mean_interaction"),
        rounded(F.stddev_pop("temp_season_adjusted")).alias("std_adjusted"),
        rounded(F.max("windspeed")).alias("max_wind"),
        rounded(F.avg("cnt"), 4).alias("mean_cnt"),
    )


_ALL = ["temp_hum_interaction", "temp_season_adjusted", *b.NUMERICAL]


@query(
    "feature_table",
    f"""with {FEATURED} select o_orderkey, instant, {', '.join(b.CATEGORICAL)}, year, month, day, day_of_week, wind_category, cnt,
  {', '.join(f'round({c}, 6) + 0.0 as {c}' for c in _ALL)} from featured""",
)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = fitted(spark, sf_dir)
    plain = ["o_orderkey", "instant", *b.CATEGORICAL, "year", "month", "day", "day_of_week", "wind_category", "cnt"]
    return rows.select(*plain, *_r(*_ALL))


@query(
    "parsed_days",
    f"""with {b.DEMAND} select o_orderkey, cast(o_orderdate as date) as day, cast(year(o_orderdate) as int) as year,
  cast(month(o_orderdate) as int) as month, cast(day(o_orderdate) as int) as day_of_month,
  cast(isodow(o_orderdate) - 1 as int) as day_of_week from demand""",
)
def parsed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = parse_day(F.col("dteday"))
    parts = day_parts(day)
    return b.demand(spark, sf_dir).select(
        "o_orderkey", day.alias("day"), parts["year"].alias("year"), parts["month"].alias("month"),
        parts["day"].alias("day_of_month"), parts["day_of_week"].alias("day_of_week"),
    )


@query(
    "label_codes",
    f"with {b.DEMAND} "
    + " union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as value, dense_rank() over (order by {c}) - 1 as code from (select distinct {c} from demand)"""
        for c in b.CATEGORICAL
    ),
)
def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = FeatureState.fit(b.demand(spark, sf_dir), b.DEMAND_ROLES)
    return state.label_table(spark).select("column", "value", "code")


@query(
    "decimal_label_codes",
    """select o_orderkey, dense_rank() over (order by rate) - 1 as rate_code from
  (select l_orderkey as o_orderkey, max(cast(l_discount * 150 as decimal(9, 2))) as rate from lineitem group by l_orderkey)""",
)
def decimal_label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of decimal labels follow their size, not their text."""
    rate = F.max((F.col("l_discount") * 150).cast("decimal(9,2)")).alias("rate")
    rows = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(rate)
    state = FeatureState.fit(rows, b.Roles(numerical=(), categorical=("rate",), target="o_orderkey"))
    return state.apply(rows).select("o_orderkey", F.col("rate").cast("bigint").alias("rate_code"))


@query(
    "long_vocabulary_codes",
    "select c_custkey, dense_rank() over (order by c_name) - 1 as c_name from customer",
)
def long_vocabulary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with as many labels as rows: the codes stay a table and join in."""
    roles = b.Roles(numerical=(), categorical=("c_name",), target="c_acctbal")
    customers = b.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    state = FeatureState.fit(customers, roles)
    return state.apply(customers).withColumn("c_name", F.col("c_name").cast("bigint"))


@query(
    "encoded_requests",
    f"""with {b.REQUESTS}, codes as (select season, dense_rank() over (order by season) - 1 as code from (select distinct season from demand))
select o_orderkey, cast(coalesce(code, -1) as int) as season from requests left join codes using (season)""",
)
def encoded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that were never fitted become -1."""
    state = FeatureState.fit(b.demand(spark, sf_dir), b.DEMAND_ROLES)
    coded = state.apply(b.requests(spark, sf_dir), unseen="keep")
    return coded.select("o_orderkey", "season")


@query(
    "scaler_state",
    f"with {b.DEMAND} "
    + " union all ".join(
        f"""select '{c}' as "column", round(avg({c}), 6) + 0.0 as mean, round(stddev_pop({c}), 6) + 0.0 as scale from demand""" for c in b.NUMERICAL
    ),
)
def scaler_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = FeatureState.fit(b.demand(spark, sf_dir), b.DEMAND_ROLES)
    return state.scaler_table(spark).select("column", *_r("mean", "scale"))


@query(
    "preprocessed_rows",
    f"""with {PROCESSED} select o_orderkey, {', '.join(b.CATEGORICAL)}, year, day_of_week,
  {', '.join(f'round({c}, 6) + 0.0 as {c}' for c in b.NUMERICAL)} from processed""",
)
def preprocessed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.demand(spark, sf_dir).drop("o_orderdate")
    rows = FeatureState.fit(days, b.DEMAND_ROLES).apply(days)
    return rows.select("o_orderkey", *b.CATEGORICAL, "year", "day_of_week", *_r(*b.NUMERICAL))


@query(
    "feature_state_round_trip",
    f"""with {CLIPPED}, wind as (select distinct {_WIND} as value from clipped) select 'scaler' as kind, c as "column", cast(null as varchar) as value, round(m, 6) + 0.0 as number from (
  {' union all '.join(f"select '{c}' as c, m_{c} as m from moments" for c in b.NUMERICAL)})
union all select 'label', 'wind_category', value, cast(dense_rank() over (order by value) - 1 as double) from wind
union all select 'label', 'mnth', cast(mnth as varchar), cast(dense_rank() over (order by mnth) - 1 as double) from (select distinct mnth from demand)""",
)
def feature_state_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All state survives saving and loading, wind classes included."""
    _, state = fitted(spark, sf_dir)
    path = new_path(spark, "state")
    state.save(spark, path)
    again = FeatureState.load(spark, path, b.DEMAND_ROLES)
    labels = again.label_table(spark).filter(F.col("column").isin("wind_category", "mnth"))
    return (
        again.scaler_table(spark)
        .select(F.lit("scaler").alias("kind"), "column", F.lit(None).cast("string").alias("value"), rounded(F.col("mean")).alias("number"))
        .unionByName(labels.select(F.lit("label").alias("kind"), "column", "value", F.col("code").cast("double").alias("number")))
    )


def _clip_one(c: str) -> str:
    return f"round(least(greatest({c}, q1_{c} - 0.5*(q3_{c} - q1_{c})), q3_{c} + 0.5*(q3_{c} - q1_{c})), 6) + 0.0 as {c}"


@query(
    "outliers_clipped",
    f"""with {b.DEMAND}, fences as (select {_FENCE} from demand)
select o_orderkey, {', '.join(map(_clip_one, b.NUMERICAL))} from demand, fences""",
)
def outliers_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outliers.handle_outliers(b.demand(spark, sf_dir), b.NUMERICAL, "iqr", 0.5)
    return rows.select("o_orderkey", *_r(*b.NUMERICAL))


def _zscore_sql() -> str:
    out, source = [], "demand"
    for i, c in enumerate(b.NUMERICAL):
        out.append(
            f"z{i} as (select d.* from {source} d, (select avg({c}) as m, stddev_samp({c}) as s from {source}) where abs({c} - m) / s < 1.5)"
        )
        source = f"z{i}"
    return ", ".join(out) + f" select o_orderkey, season, cnt from {source}"


@query("outliers_dropped", f"with {b.DEMAND}, {_zscore_sql()}")
def outliers_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.handle_outliers(b.demand(spark, sf_dir), b.NUMERICAL, "zscore", 1.5).select("o_orderkey", "season", "cnt")


_ONE_PASS = " and ".join(f"abs({c} - m_{c}) / s_{c} < 1.5" for c in b.NUMERICAL)


@query(
    "outliers_dropped_in_one_pass",
    f"""with {b.DEMAND}, m as (select {', '.join(f'avg({c}) as m_{c}, stddev_samp({c}) as s_{c}' for c in b.NUMERICAL)} from demand)
select o_orderkey, season, cnt from demand, m where {_ONE_PASS}""",
)
def outliers_dropped_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = outliers.drop_by_zscore(b.demand(spark, sf_dir), b.NUMERICAL, 1.5, simultaneous=True)
    return kept.select("o_orderkey", "season", "cnt")


@query(
    "derived_features_on_raw_units",
    f"""with {b.DEMAND}, m as (select season, avg(temp) as mean_temp from demand group by season)
select o_orderkey, round(temp * hum, 6) + 0.0 as temp_hum_interaction,
  cast(case when windspeed <= 0.1 then 0 when windspeed <= 0.3 then 1 else 2 end as int) as wind_category,
  round(temp - mean_temp, 6) + 0.0 as temp_season_adjusted from demand join m using (season)""",
)
def derived_features_on_raw_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.demand(spark, sf_dir)
    state = FeatureState(b.DEMAND_ROLES).fit_derived(days)
    rows = state.derive(days, group_mean="batch")
    return rows.select("o_orderkey", "wind_category", *_r("temp_hum_interaction", "temp_season_adjusted"))


@query(
    "default_wind_code",
    f"with {b.DEMAND} select o_orderkey, cast(1 as int) as wind_category from demand",
)
def default_wind_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a fitted wind encoder every class takes the default code."""
    return FeatureState(b.DEMAND_ROLES).derive(b.demand(spark, sf_dir)).select("o_orderkey", "wind_category")


@query(
    "group_mean_on_rows",
    f"""with {b.DEMAND}, m as (select season, avg(temp) as mean_temp from demand group by season)
select o_orderkey, season, round(mean_temp, 6) + 0.0 as season_mean from demand join m using (season)""",
)
def group_mean_on_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.demand(spark, sf_dir)
    means = features.small_once(days.groupBy("season").agg(rounded(F.avg("temp")).alias("season_mean")))
    return days.join(means, "season").select("o_orderkey", "season", "season_mean")


# -- profiles ------------------------------------------------------------------

_PROFILED = ("temp", "hum", "cnt", "season")
_DESCRIBE = " union all ".join(
    f"""select '{c}' as "column", unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max', 'null_count']) as stat,
  unnest([cast(count({c}) as double), avg({c}), stddev_samp({c}), cast(min({c}) as double), quantile_cont({c}, 0.25), quantile_cont({c}, 0.5),
  quantile_cont({c}, 0.75), cast(max({c}) as double), cast(count(*) - count({c}) as double)]) as value from demand_dirty"""
    for c in _PROFILED
)


@query(
    "column_statistics",
    f"""with {b.DEMAND_DIRTY}, s as ({_DESCRIBE}) select "column", stat, round(value, 4) + 0.0 as value from s""",
)
def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.describe(b.demand_dirty(spark, sf_dir), _PROFILED)
    return stats.withColumn("value", rounded(F.col("value"), 4))


@query("table_shape", f"with {b.DEMAND_DIRTY} select count(*) as n_rows, cast(14 + 2 as bigint) as n_columns from demand_dirty")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(b.demand_dirty(spark, sf_dir))


@query(
    "duplicate_rate",
    f"""with {b.DEMAND_DIRTY}, n as (select count(*) as n_rows from demand_dirty),
u as (select count(*) as n_unique from (select distinct * from demand_dirty))
select n_rows, n_rows - n_unique as n_duplicates, round((n_rows - n_unique) / cast(n_rows as double), 6) + 0.0 as duplicate_rate from n, u""",
)
def duplicate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rate(b.demand_dirty(spark, sf_dir)).withColumn("duplicate_rate", rounded(F.col("duplicate_rate")))


@query(
    "missing_rate",
    f"""with {b.DEMAND_DIRTY}, m as (select count(*) as n_rows, count(*) - count(temp) as n_missing from demand_dirty)
select n_rows, n_missing, round(n_missing / cast(n_rows as double), 6) + 0.0 as missing_per_row,
  round(n_missing / cast(n_rows * 16 as double), 6) + 0.0 as missing_per_cell from m""",
)
def missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = profile.missing_rate(b.demand_dirty(spark, sf_dir))
    return rates.select("n_rows", "n_missing", *_r("missing_per_row", "missing_per_cell"))


_CORR = " union all ".join(
    f"select '{a}' as a, '{c}' as b, round(corr({a}, {c}), 6) + 0.0 as correlation from demand"
    for i, a in enumerate((*b.NUMERICAL, "cnt"))
    for c in (*b.NUMERICAL, "cnt")[i + 1 :]
)


@query("correlations", f"with {b.DEMAND} {_CORR}")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.correlations(b.demand(spark, sf_dir), (*b.NUMERICAL, "cnt"))
    return found.withColumn("correlation", rounded(F.col("correlation")))


_RANKED = ", ".join(
    f"(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0) as {c}" for c in ("temp", "hum", "cnt")
)


@query(
    "rank_correlations",
    f"""with {b.DEMAND}, r as (select {_RANKED} from demand)
select 'temp' as a, 'hum' as b, round(corr(temp, hum), 6) + 0.0 as correlation from r
union all select 'temp', 'cnt', round(corr(temp, cnt), 6) + 0.0 from r
union all select 'hum', 'cnt', round(corr(hum, cnt), 6) + 0.0 from r""",
)
def rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.correlations(b.demand(spark, sf_dir), ("temp", "hum", "cnt"), "spearman")
    return found.withColumn("correlation", rounded(F.col("correlation")))
