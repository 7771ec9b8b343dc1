"""Queries over training, scoring and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import prediction_interval, rounded
from tabwright.lineage import new_path
from tabwright.operators import evaluation, linear, split, training
from tabwright.operators.features import FeatureState
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query
from tabwright.plans.experiments import FOLD_SCORES, fold_scores, rounded_columns
from tabwright.plans.features import fitted
from tabwright.plans.tables import REQUEST_RANGES
from tabwright.sources import models

KEY = "o_orderkey"
FEATURES = [*b.CATEGORICAL, *b.NUMERICAL]
SMALL_FOREST = {"n_estimators": 10, "max_depth": 5, "partitions": 8}  # dealt to a fixed number of partitions: one model whatever the files and cores
T_975_DF4 = 2.7764451051977987  # fixed value


def metrics_sql(y: str, p: str) -> dict[str, str]:
    return {
        "n": "count(*)",
        "mae": f"avg(abs({y} - {p}))",
        "mse": f"avg(({y} - {p})^2)",
        "rmse": f"sqrt(avg(({y} - {p})^2))",
        "r2": f"1 - sum(({y} - {p})^2) / (count(*) * var_pop({y}))",
        "mape": f"100 * avg(abs(({y} - {p}) / nullif({y}, 0)))",
        "mpe": f"100 * avg(({y} - {p}) / nullif({y}, 0))",
        "n_zero": f"count(*) filter ({y} = 0)",
        **{f"accuracy_{t}pct": f"avg(cast(abs({y} - {p}) <= {t / 100} * abs({y}) as int))" for t in (10, 20, 30)},
    }


def _select(y: str, p: str, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(
        f"{e} as {m}" if m in ("n", "n_zero") else f"round({e}, 4) + 0.0 as {m}" for m, e in metrics_sql(y, p).items() if m not in skip
    )


ROUNDED = ["mae", "mse", "rmse", "r2", "mape", "mpe", "accuracy_10pct", "accuracy_20pct", "accuracy_30pct"]


@query("regression_metrics", f"with {b.PREDS} select {_select('cnt', 'pred')} from preds")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(evaluation.regression_metrics(b.preds(spark, sf_dir), "cnt", "pred"), *ROUNDED, digits=4)


@query("metrics_by_split", f"with {b.PREDS}, s as (select *, {b.SPLIT_SQL} as split from preds) select split, {_select('cnt', 'pred')} from s group by split")
def metrics_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed scorer judged on train, validation and test rows."""
    rows = split.split_rows(b.preds(spark, sf_dir), KEY, portable=True)
    return rounded_columns(training.evaluate_splits(rows, "cnt", "pred"), *ROUNDED, digits=4)


@query(
    "evaluation_report",
    f"""with {b.PREDS}, m as (select {_select('cnt', 'pred')} from preds)
select mae, rmse, r2, accuracy_20pct, n as sample_count, 'temp,hum' as features, 'linear' as model_type from m""",
)
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.report(b.preds(spark, sf_dir), "cnt", "pred", ["temp", "hum"], {"type": "linear"})
    picked = [rounded(F.col(f"metrics.{m}"), 4).alias(m) for m in ("mae", "rmse", "r2", "accuracy_20pct")]
    return report.select(*picked, "sample_count", F.array_join("features", ",").alias("features"), F.col("model")["type"].alias("model_type"))


@query(
    "prediction_listing",
    f"with {b.PREDS} select o_orderkey, cnt as actual, round(pred, 6) + 0.0 as predicted, round(abs(cnt - pred), 6) + 0.0 as abs_error from preds",
)
def prediction_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(evaluation.listing(b.preds(spark, sf_dir), KEY, "cnt", "pred"), "predicted", "abs_error")


_BIN = "cast(case when {c} < 1500 then 0 when {c} >= 5000 then 11 else floor(({c} - 1500) / 350) + 1 end as int)"


@query(
    "residual_bins",
    f"""with {b.PREDS} select {_BIN.format(c='pred')} as bin, count(*) as n, round(avg(cnt - pred), 4) + 0.0 as mean_residual,
  round(stddev_pop(cnt - pred), 4) + 0.0 as std_residual from preds group by bin""",
)
def residual_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = evaluation.residual_bins(b.preds(spark, sf_dir), "cnt", "pred", 1500, 5000, 10)
    return rounded_columns(bins, "mean_residual", "std_residual", digits=4)


@query(
    "actual_by_predicted",
    f"""with {b.PREDS} select {_BIN.format(c='pred')} as predicted_bin, {_BIN.format(c='cnt')} as actual_bin, count(*) as n from preds group by all""",
)
def actual_by_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.actual_by_predicted(b.preds(spark, sf_dir), "cnt", "pred", 1500, 5000, 10)


def residual_sql(source: str, e: str) -> str:
    return f"""mo as (select avg({e}) as mu from {source}),
rs as (select count(*) as n, avg({e}) as mean, sqrt(avg(pow({e} - mu, 2))) as std, min({e}) as lo, max({e}) as hi,
  avg(pow({e} - mu, 3)) / pow(avg(pow({e} - mu, 2)), 1.5) as sk, kurtosis_pop({e}) as ku from {source}, mo)"""


_STATS = ", ".join(f"round({c}, 4) + 0.0 as {n}" for c, n in (("mean", "mean"), ("std", "std"), ("lo", '"min"'), ("hi", '"max"'), ("sk", "skewness"), ("ku", "kurtosis")))
STATS = ["mean", "std", "min", "max", "skewness", "kurtosis"]


@query("residual_statistics", f"with {b.PREDS}, {residual_sql('preds', '(cnt - pred)')} select n, {_STATS} from rs")
def residual_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(evaluation.residual_stats(b.preds(spark, sf_dir), "cnt", "pred"), *STATS, digits=4)


_JB = "n / 6.0 * (sk * sk + ku * ku / 4)"


@query(
    "residual_normality",
    f"""with {b.PREDS}, {residual_sql('preds', '(cnt - pred)')} select n, round({_JB}, 4) + 0.0 as jarque_bera, round(exp(-({_JB}) / 2), 6) + 0.0 as p_value,
  exp(-({_JB}) / 2) > 0.05 as normal from rs""",
)
def residual_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = evaluation.normality(evaluation.residual_stats(b.preds(spark, sf_dir), "cnt", "pred"))
    return rounded_columns(rounded_columns(tested.select("n", "jarque_bera", "p_value", "normal"), "p_value"), "jarque_bera", digits=4)


@query(
    "heteroscedasticity",
    f"""with {b.DEMAND}, f as (select regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i from demand),
e as (select temp, pow(cnt - i - s * temp, 2) as e2 from demand, f) select round(count(*) * regr_r2(e2, temp), 4) + 0.0 as lm, cast(1 as int) as df from e""",
)
def heteroscedasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = evaluation.heteroscedasticity(b.demand(spark, sf_dir), "cnt", ["temp"])
    return rounded_columns(tested.select("lm", "df"), "lm", digits=4)


@query(
    "prediction_intervals",
    f"""with {b.PREDS} select o_orderkey, round(greatest(0, pred - 1.96 * (pred * 0.1)), 6) + 0.0 as lower, round(pred + 1.96 * (pred * 0.1), 6) + 0.0 as upper from preds""",
)
def prediction_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = prediction_interval(F.col("pred"))
    return b.preds(spark, sf_dir).select(KEY, rounded(low).alias("lower"), rounded(high).alias("upper"))


# -- linear models, which SQL can follow ------------------------------------------


@query(
    "single_feature_models",
    f"""with {b.DEMAND}, s as (select count(*) as n, avg(temp) as mx, avg(cnt) as my, covar_pop(temp, cnt) as cxy, var_pop(temp) as cxx from demand),
m as (select 'linear' as model, cxy / cxx as slope, mx, my from s
  union all select 'ridge', cxy * n / (cxx * n + 1), mx, my from s
  union all select 'lasso', greatest(abs(cxy) - 1, 0) * sign(cxy) / cxx, mx, my from s)
select model, round(slope, 3) + 0.0 as slope, round(my - slope * mx, 3) + 0.0 as intercept from m""",
)
def single_feature_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, ridge and lasso regression with a penalty of 1."""
    rows = b.demand(spark, sf_dir)
    out = []
    for name in ("linear", "ridge", "lasso"):
        fitted_ = training.fit(rows, name, ["temp"], "cnt", alpha=1.0).stages[-1]
        out.append((name, float(fitted_.coefficients[0]), float(fitted_.intercept)))
    return rounded_columns(spark.createDataFrame(out, "model string, slope double, intercept double"), "slope", "intercept", digits=3)


@query(
    "linear_predictions",
    f"""with {b.DEMAND}, f as (select regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i from demand where {b.unit_sql()} < 0.8)
select o_orderkey, round(i + s * temp, 4) + 0.0 as prediction from demand, f""",
)
def linear_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training split, applied to all rows."""
    rows = split.split_rows(b.demand(spark, sf_dir), KEY, portable=True)
    model = training.fit(rows.filter("split = 'train'"), "linear", ["temp"], "cnt")
    return rounded_columns(training.predict(model, rows).select(KEY, "prediction"), "prediction", digits=4)


@query(
    "leave_one_out",
    f"""with {b.DEMAND}, f as (select regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i, regr_avgx(cnt, temp) as mx, regr_sxx(cnt, temp) as sxx, count(*) as n from demand),
e as (select (cnt - i - s * temp) / (1 - (1.0 / n + pow(temp - mx, 2) / sxx)) as e from demand, f)
select count(*) as n, round(avg(abs(e)), 4) + 0.0 as mae, round(sqrt(avg(e * e)), 4) + 0.0 as rmse from e""",
)
def leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("loo_residual")
    rows = training.leave_one_out(b.demand(spark, sf_dir), ["temp"], "cnt")
    return rows.agg(F.count(e).alias("n"), rounded(F.avg(F.abs(e)), 4).alias("mae"), rounded(F.sqrt(F.avg(e * e)), 4).alias("rmse"))


def _folds(spark: SparkSession, sf_dir: str, k: int = 5) -> tuple[DataFrame, list]:
    rows = split.kfold(b.demand(spark, sf_dir), KEY, k, portable=True)
    return rows, split.fold_frames(rows, k)


OOF = f"""{b.DEMAND}, f as (select *, cast(floor({b.unit_sql()} * 5) as int) as fold from demand),
fits as (select k.fold, regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i from range(5) k(fold), f where f.fold <> k.fold group by k.fold),
oof as (select f.*, i + s * temp as p from f join fits on f.fold = fits.fold)"""


@query("out_of_fold_predictions", f"with {OOF} select o_orderkey, fold as held_out_fold, round(p, 4) + 0.0 as prediction from oof")
def out_of_fold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _folds(spark, sf_dir)
    predicted = linear.out_of_fold(rows, ["temp"], "cnt")
    return rounded_columns(predicted.select(KEY, "held_out_fold", "prediction"), "prediction", digits=4)


@query(
    "residual_analysis",
    f"""with {OOF}, {residual_sql('oof', '(cnt - p)')}, b0 as (select regr_slope(cnt, temp) as bs, regr_intercept(cnt, temp) as bi from demand),
e2 as (select temp, pow(cnt - bi - bs * temp, 2) as e2 from demand, b0), bp as (select count(*) * regr_r2(e2, temp) as lm from e2)
select n, {_STATS}, round({_JB}, 4) + 0.0 as jarque_bera, exp(-({_JB}) / 2) > 0.05 as normal, round(lm, 4) + 0.0 as lm from rs, bp""",
)
def residual_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments, normality and Breusch-Pagan over out-of-fold residuals."""
    rows, _ = _folds(spark, sf_dir)
    predicted = linear.out_of_fold(rows, ["temp"], "cnt")
    moments = evaluation.normality(evaluation.residual_stats(predicted, "cnt", "prediction"))
    lm = evaluation.heteroscedasticity(rows, "cnt", ["temp"]).first()["lm"]
    joined = moments.select("n", *STATS, "jarque_bera", "normal").withColumn("lm", F.lit(lm))
    return rounded_columns(joined, *STATS, "jarque_bera", "lm", digits=4)


_FOUR = ", ".join(metrics_sql("cnt", "p")[m] for m in ("mae", "mse", "rmse", "r2"))


@query(
    "cross_validation",
    f"""with {OOF}, tr as (select fits.fold as k, cnt, i + s * temp as p from fits join f on f.fold <> fits.fold),
s as (select 'test' as side, fold, unnest(['mae', 'mse', 'rmse', 'r2']) as metric, unnest([{_FOUR}]) as value from oof group by fold
  union all select 'train', k, unnest(['mae', 'mse', 'rmse', 'r2']), unnest([{_FOUR}]) from tr group by k)
select side, metric, count(*) as n, round(avg(value), 3) + 0.0 as mean, round(stddev_pop(value), 3) + 0.0 as std,
  round(avg(value) - {T_975_DF4!r} * stddev_samp(value) / sqrt(count(*)), 3) + 0.0 as ci_lower,
  round(avg(value) + {T_975_DF4!r} * stddev_samp(value) / sqrt(count(*)), 3) + 0.0 as ci_upper from s group by side, metric""",
)
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds of a linear model, both sides, summarised with intervals."""
    rows, _ = _folds(spark, sf_dir)
    summary = training.fold_summary(linear.cross_validate(rows, ["temp"], "cnt"), ["side", "metric"])
    return rounded_columns(summary, "mean", "std", "ci_lower", "ci_upper", digits=3)


@query(
    "fold_summary",
    f"""with {FOLD_SCORES} select model, metric, count(*) as n, round(avg(value), 4) + 0.0 as mean, round(stddev_pop(value), 4) + 0.0 as std,
  round(avg(value) - {T_975_DF4!r} * stddev_samp(value) / sqrt(count(*)), 4) + 0.0 as ci_lower,
  round(avg(value) + {T_975_DF4!r} * stddev_samp(value) / sqrt(count(*)), 4) + 0.0 as ci_upper from scores group by model, metric""",
)
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(training.fold_summary(fold_scores(spark, sf_dir)), "mean", "std", "ci_lower", "ci_upper", digits=4)


@query(
    "best_model_by_r2",
    f"""with {FOLD_SCORES}, m as (select model, avg(value) as r2 from scores where metric = 'r2' group by model)
select arg_max(model, r2) as best_model, round(max(r2), 6) + 0.0 as r2 from m""",
)
def best_model_by_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(training.best_model(training.fold_summary(fold_scores(spark, sf_dir))), "r2")


_FRACTIONS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


@query(
    "learning_curve",
    f"""with {b.DEMAND}, f as (select *, cast(floor({b.unit_sql()} * 5) as int) as fold, {b.unit_sql(43)} as v from demand),
fits as (select k.fold as k, q.fraction, regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i, regr_r2(cnt, temp) as train
  from range(5) k(fold), (values {', '.join(f'({x}::double)' for x in _FRACTIONS)}) q(fraction), f where f.fold <> k.fold and v < q.fraction group by all),
val as (select k, fraction, max(train) as train, {metrics_sql('cnt', '(i + s * temp)')['r2']} as val from fits join f on f.fold = k group by k, fraction)
select fraction, round(avg(train), 4) + 0.0 as train_mean, round(stddev_pop(train), 4) + 0.0 as train_std, round(avg(val), 4) + 0.0 as val_mean,
  round(stddev_pop(val), 4) + 0.0 as val_std from val group by fraction""",
)
def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = training.curve_points(_curve(spark, sf_dir))
    return rounded_columns(points, "train_mean", "train_std", "val_mean", "val_std", digits=4)


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _folds(spark, sf_dir)
    return linear.learning_curve(rows, ["temp"], "cnt", KEY, _FRACTIONS, portable=True)


@query(
    "learning_curve_diagnostics",
    f"""with {OOF}, t as (select avg(r2) as t from (select regr_r2(cnt, temp) as r2 from range(5) k(fold), f where f.fold <> k.fold group by k.fold)),
v as (select avg(r2) as v from (select {metrics_sql('cnt', 'p')['r2']} as r2 from oof group by fold))
select round(t, 4) + 0.0 as final_train_score, round(v, 4) + 0.0 as final_val_score, round(abs(t - v), 4) + 0.0 as score_gap,
  abs(t - v) < 0.05 as converged, t > v + 0.05 as overfitting, v < 0.7 as underfitting from t, v""",
)
def learning_curve_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = training.curve_diagnostics(_curve(spark, sf_dir))
    return rounded_columns(checked, "final_train_score", "final_val_score", "score_gap", digits=4)


# -- forests, which only Spark can repeat -----------------------------------------


def forest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, training.PipelineModel]:
    """Demand rows with a split, and a small forest fitted on the training rows."""
    rows = split.split_rows(b.demand(spark, sf_dir), KEY, portable=True)
    return rows, training.fit(rows.filter("split = 'train'"), "rf", FEATURES, "cnt", **SMALL_FOREST)


@query("forest_metrics_by_split")
def forest_metrics_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.split_rows(b.demand(spark, sf_dir), KEY, portable=True)
    return training.train(rows, FEATURES, "cnt", **SMALL_FOREST)[1]


@query(
    "train_with_cv",
    f"""with {OOF}, s as (select *, {b.SPLIT_SQL} as split from demand), t as (select *, cast(floor({b.unit_sql()} * 5) as int) as fold from s where split = 'train'),
cvfits as (select k.fold, regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i from range(5) k(fold), t where t.fold <> k.fold group by k.fold),
cv as (select avg(mae) as cv_mae from (select avg(abs(cnt - (i + s * temp))) as mae from t join cvfits on t.fold = cvfits.fold group by t.fold)),
whole as (select regr_slope(cnt, temp) as s, regr_intercept(cnt, temp) as i from t)
select split, count(*) as n, round(avg(abs(cnt - (whole.i + whole.s * temp))), 3) + 0.0 as mae, case when split = 'train' then round(max(cv_mae), 3) + 0.0 end as cv_mae
from s, whole, cv group by split""",
)
def train_with_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model trained on the training rows, with its cross-validated error beside the metrics of every split."""
    rows = split.split_rows(b.demand(spark, sf_dir), KEY, portable=True).persist()
    folds = split.fold_frames(split.kfold(rows.filter("split = 'train'"), KEY, 5, portable=True), 5)
    _, metrics = training.train(rows, ["temp"], "cnt", "linear", folds=folds)
    return rounded_columns(metrics.select("split", "n", "mae", "cv_mae"), "mae", "cv_mae", digits=3)


@query("forest_importance")
def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most important features."""
    _, model = forest(spark, sf_dir)
    ranked = spark.createDataFrame(training.feature_importance(model), "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature").limit(10)


@query("tuning_trials")
def tuning_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.split_rows(b.demand(spark, sf_dir), KEY, portable=True)
    small = {"n_estimators": (3, 8), "max_depth": (3, 6), "min_samples_leaf": (1, 10)}
    return training.tune(rows, FEATURES, "cnt", trials=4, ranges=small)[1]


@query("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds of the whole zoo, every model with its defaults; an unknown name is skipped."""
    rows = split.kfold(b.demand(spark, sf_dir), KEY, 5).select(*FEATURES, F.col("cnt").cast("double").alias("cnt"), "fold")
    rows = training.deal(rows, [*FEATURES, "cnt"], SMALL_FOREST["partitions"]).cache()  # once for all models and folds
    folds = split.fold_frames(rows, 5)
    zoo = ["linear", "ridge", "lasso", "rf", "gb", "dt", "svr"]
    scores = training.compare_models(rows, folds, zoo, FEATURES, "cnt", parallelism=5, train_scores=False)  # held-out scores are all it returns
    rows.unpersist()
    return training.fold_summary(scores.filter("side = 'test'"))


_SAVED = f"with {b.DEMAND} select count(*) as n, cast(0 as bigint) as n_different, 11 as n_features, 'cnt' as target from demand"


@query("saved_model_predictions", _SAVED)
def saved_model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reloaded model predicts every row like the one that was saved."""
    rows, model = forest(spark, sf_dir)
    path = new_path(spark, "model")
    models.save_model(spark, model, path, FEATURES, "cnt")
    again, features, target = models.load_model(spark, path)
    first = training.predict(model, rows).withColumnRenamed("prediction", "first")
    both = training.predict(again, first)
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("first") != F.col("prediction")).alias("n_different"),
        F.lit(len(features)).alias("n_features"),
        F.lit(target).alias("target"),
    )


def request_scorer(spark: SparkSession, sf_dir: str) -> tuple[FeatureState, training.PipelineModel, list[str]]:
    """State and forest for raw requests, trained on demand with derived features."""
    rows, state = fitted(spark, sf_dir)
    features = [*FEATURES, "temp_hum_interaction", "wind_category", "temp_season_adjusted"]
    return state, training.fit(rows, "rf", features, "cnt", **SMALL_FOREST), features


@query("scored_requests")
def scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, model, _ = request_scorer(spark, sf_dir)
    scored, _ = training.score(b.requests(spark, sf_dir), state, model, REQUEST_RANGES)
    return scored.select(KEY, "prediction", "lower", "upper")
