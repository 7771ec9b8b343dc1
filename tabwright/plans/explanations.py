"""Queries over attributions, partial dependence, surrogates and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import closed_form_demand, rounded
from tabwright.operators import explain, neighbors, training
from tabwright.operators.trees import TreeScorer
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.plans.experiments import rounded_columns
from tabwright.plans.models import forest

KEY = "o_orderkey"
COEFFICIENTS = {"temp": 2000.0, "hum": -1500.0}
INTERCEPT = 3000.0
_BACKGROUND = f"bg as (select * from demand order by {b.unit_sql()}, o_orderkey limit {{n}}), bm as (select avg(temp) as mt, avg(hum) as mh from bg)"
_LINEAR = """a as (select o_orderkey, unnest(['temp', 'hum']) as feature, unnest([temp, hum]) as feature_value,
  unnest([2000 * (temp - mt), -1500 * (hum - mh)]) as contribution, 3000 + 2000 * mt - 1500 * mh as base_value, 3000 + 2000 * temp - 1500 * hum as prediction from demand, bm)"""


def linear_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.lit(INTERCEPT) + F.col("temp") * COEFFICIENTS["temp"] + F.col("hum") * COEFFICIENTS["hum"])


def closed_form_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", closed_form_demand(F.col("temp"), F.col("weathersit"), F.col("season")))


@query(
    "linear_attributions",
    f"""with {b.DEMAND}, {_BACKGROUND.format(n=100)}, {_LINEAR} select o_orderkey, feature, round(feature_value, 6) + 0.0 as feature_value,
  round(contribution, 4) + 0.0 as contribution, round(base_value, 4) + 0.0 as base_value from a""",
)
def linear_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.demand(spark, sf_dir)
    background = explain.default_background(rows, KEY, portable=True)
    out = explain.linear_attributions(rows, KEY, COEFFICIENTS, INTERCEPT, background)
    return rounded_columns(rounded_columns(out, "contribution", "base_value", digits=4), "feature_value")


@query(
    "sampled_attributions",
    f"""with {b.DEMAND}, {_BACKGROUND.format(n=8)}, {_LINEAR} select o_orderkey, feature, round(feature_value, 6) + 0.0 as feature_value,
  round(contribution, 4) + 0.0 as contribution, round(base_value, 4) + 0.0 as base_value, round(prediction, 4) + 0.0 as prediction from a""",
)
def sampled_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling estimator on a linear scorer, where it must hit the closed form."""
    rows = b.demand(spark, sf_dir)
    background = explain.default_background(rows, KEY, 8, portable=True)
    out = explain.attributions(rows, KEY, list(COEFFICIENTS), linear_scorer, background)
    return rounded_columns(rounded_columns(out, "contribution", "base_value", "prediction", digits=4), "feature_value")


@query(
    "global_importance",
    f"""with {b.DEMAND}, {_BACKGROUND.format(n=100)}, {_LINEAR} select feature, round(avg(abs(contribution)), 4) + 0.0 as importance from a group by feature""",
)
def global_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.demand(spark, sf_dir)
    background = explain.default_background(rows, KEY, portable=True)
    return rounded_columns(explain.global_importance(explain.linear_attributions(rows, KEY, COEFFICIENTS, INTERCEPT, background)), "importance", digits=4)


EXPLAINED = ["season", "weathersit", *b.NUMERICAL]


def _small_forest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, training.PipelineModel]:
    rows = b.demand(spark, sf_dir).select(KEY, *EXPLAINED, "cnt")
    return rows, training.fit(rows, "rf", EXPLAINED, "cnt", n_estimators=5, max_depth=5, partitions=8)


def _forest_attributions(rows: DataFrame, model: training.PipelineModel) -> DataFrame:
    sample = explain.default_background(rows, KEY, portable=True)
    return explain.attributions(rows, KEY, EXPLAINED, TreeScorer(model), sample)


@query("forest_attributions_add_up", f"with {b.DEMAND} select count(*) as n_rows, cast(0 as bigint) as n_off from demand")
def forest_attributions_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose attributions and base value do not add up to the prediction: none."""
    rows, model = _small_forest(spark, sf_dir)
    sums = _forest_attributions(rows, model).groupBy(KEY).agg(
        (F.sum("contribution") + F.max("base_value") - F.max("prediction")).alias("gap")
    )
    return sums.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs("gap") > 1e-6).alias("n_off"))


@query("forest_explanations")
def forest_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute attribution of a forest next to its own importance."""
    rows, model = _small_forest(spark, sf_dir)
    return explain.explain_model(_forest_attributions(rows, model), training.feature_importance(model))


def _surrogates(rows: DataFrame, model: training.PipelineModel) -> DataFrame:
    return explain.local_surrogates(rows, KEY, EXPLAINED, TreeScorer(model), rows, top=4)


@query("local_surrogates")
def local_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _small_forest(spark, sf_dir)
    return _surrogates(rows, model)


@query("explanation_report")
def explanation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _small_forest(spark, sf_dir)

    def surrogates_of(picked: DataFrame) -> DataFrame:
        return explain.local_surrogates(picked, KEY, EXPLAINED, TreeScorer(model), rows, samples=1000)

    return explain.explanation_report(rows, KEY, _forest_attributions(rows, model), surrogates_of, rows.count())


@query("explained_rows")
def explained_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution and surrogate rule of every row and feature."""
    rows, model = _small_forest(spark, sf_dir)
    sample = explain.default_background(rows, KEY, portable=True)
    return explain.explain_table(rows, KEY, EXPLAINED, TreeScorer(model), sample, rows, top=4)


TEMP_GRID = [0.0, 0.125, 0.25, 0.5, 0.75, 1.0]
SEASON_GRID = [1.0, 2.0, 3.0, 4.0]


def _scorer_sql(temp: str = "temp", season: str = "season") -> str:
    return f"greatest(0, trunc(2000 + {temp} * 1500 - (weathersit - 1) * 200 + {season} * 100))"


def _grid_sql(name: str, values: list[float]) -> str:
    return f"(values {', '.join(f'({v}::double)' for v in values)}) {name}({name})"


@query(
    "partial_dependence",
    f"""with {b.DEMAND} select 'temp' as feature, g as grid_value, round(avg({_scorer_sql('g')}), 4) + 0.0 as value
from demand, {_grid_sql('g', TEMP_GRID)} group by g""",
)
def partial_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.partial_dependence(b.demand(spark, sf_dir), "temp", TEMP_GRID, closed_form_scorer)
    return rounded_columns(out, "value", digits=4)


@query(
    "individual_curves",
    f"""with {b.DEMAND} select o_orderkey, 'season' as feature, g as grid_value, {_scorer_sql(season='g')} as value from demand, {_grid_sql('g', SEASON_GRID)}""",
)
def individual_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.demand(spark, sf_dir)
    return explain.individual_curves(rows, KEY, "season", explain.grid_values(rows, "season"), closed_form_scorer)


_SHUFFLED = ("temp", "season", "weathersit")
_SQUARED = "pow(greatest(0, trunc(2000 + {temp} * 1500 - ({weathersit} - 1) * 200 + {season} * 100)) - r.cnt, 2)"
_RISES = " union all ".join(
    f"select '{c}' as feature, r.rep as rep, avg({_SQUARED.format(**{f: ('o' if f == c else 'r') + '.' + f for f in _SHUFFLED})}) - "
    f"avg({_SQUARED.format(**{f: f'r.{f}' for f in _SHUFFLED})}) as rise from r join r o on o.rep = r.rep and o.k = r.k % r.n + 1 group by r.rep"
    for c in _SHUFFLED
)


@query(
    "permutation_importance",
    f"""with {b.DEMAND}, r as (select rep, o_orderkey, temp, season, weathersit, cnt, count(*) over (partition by rep) as n,
  row_number() over (partition by rep order by {b.unit_sql('(42 + rep)')}, o_orderkey) as k from demand, range(5) reps(rep)), rises as ({_RISES})
select feature, round(avg(rise), 4) + 0.0 as importance, round(stddev_pop(rise), 4) + 0.0 as std from rises group by feature""",
)
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five repeats with the closed-form scorer on all rows."""
    out = explain.permutation_importance(b.demand(spark, sf_dir), KEY, _SHUFFLED, "cnt", closed_form_scorer, portable=True)
    return rounded_columns(out, "importance", "std", digits=4)


_JOINT = f"""j as (select g, h, avg({_scorer_sql('g', 'h')}) as v from demand, {_grid_sql('g', TEMP_GRID)}, {_grid_sql('h', SEASON_GRID)} group by g, h),
pa as (select g, avg({_scorer_sql('g')}) as a from demand, {_grid_sql('g', TEMP_GRID)} group by g),
pb as (select h, avg({_scorer_sql(season='h')}) as b from demand, {_grid_sql('h', SEASON_GRID)} group by h)"""


@query("feature_interaction", f"with {b.DEMAND}, {_JOINT} select g as a_value, h as b_value, round(v, 4) + 0.0 as value from j")
def feature_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.interaction(b.demand(spark, sf_dir), "temp", "season", TEMP_GRID, SEASON_GRID, closed_form_scorer)
    return rounded_columns(out, "value", digits=4)


@query(
    "interaction_strength",
    f"""with {b.DEMAND}, {_JOINT} select 'temp' as a, 'season' as b, round(var_pop(v - a - b) / var_pop(v), 8) + 0.0 as h_squared from j join pa using (g) join pb using (h)""",
)
def interaction_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.interaction_strength(b.demand(spark, sf_dir), "temp", "season", TEMP_GRID, SEASON_GRID, closed_form_scorer)
    return rounded_columns(out, "h_squared", digits=8)


@query("top_features")
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most important features of the forest over all inputs."""
    _, model = forest(spark, sf_dir)
    return spark.createDataFrame(training.feature_importance(model, 5), "feature string, importance double")


@query(
    "nearest_neighbor_regression",
    """with e as (select vec_id, cast(embedding as double[]) as v, label from embeddings),
d as (select a.vec_id, b.label, row_number() over (partition by a.vec_id order by list_distance(a.v, b.v), b.vec_id) as k from e a join e b on a.vec_id <> b.vec_id)
select vec_id, round(avg(label), 6) + 0.0 as prediction from d where k <= 5 group by vec_id""",
)
def nearest_neighbor_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "embeddings")
    out = neighbors.knn_regression(rows, rows, "vec_id", "embedding", "label", exclude_self=True)
    return out.withColumn("prediction", rounded(F.col("prediction")))
