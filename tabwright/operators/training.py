"""Model zoo, fitting, tuning, cross-validation and scoring on ``pyspark.ml``."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass
from itertools import combinations_with_replacement
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import prediction_interval, unit_hash
from tabwright.functions.distributions import t_critical
from tabwright.lineage import dealt, shared_folder
from tabwright.operators import forests
from tabwright.operators.checks import split_by_ranges
from tabwright.operators.evaluation import as_long, regression_metrics
from tabwright.operators.features import FeatureState

VECTOR = "_features"
PREDICTION = "prediction"
SCORES = "model string, fold int, side string, metric string, value double"

# Defaults of the forest and the tuning ranges (inclusive).
FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1, "seed": 42}
TUNING_RANGES = {"n_estimators": (50, 300), "max_depth": (5, 30), "min_samples_leaf": (1, 10)}
DEEPEST = 30  # pyspark.ml refuses deeper trees
PART_ROWS = 250_000  # rows that one partition of dealt rows holds, about


def _tree_params(params: Mapping) -> dict:
    """``max_depth`` of None means as deep as trees can be; a deeper one than that is refused."""
    depth = params.get("max_depth")
    if depth is not None and int(depth) > DEEPEST:
        raise ValueError(f"max_depth {depth} is more than {DEEPEST}, the deepest that trees can be")
    return {
        "maxDepth": DEEPEST if depth is None else int(depth),
        "minInstancesPerNode": int(params.get("min_samples_leaf", 1)),
        "maxBins": int(params.get("max_bins", 32)),
        "seed": int(params.get("seed", 42)),
    }


def _forest(params: Mapping):
    return RandomForestRegressor(numTrees=int(params.get("n_estimators", 100)), featureSubsetStrategy="all", **_tree_params(params))


def _boosted(params: Mapping):
    shape = _tree_params({"max_depth": 3, **params})
    return GBTRegressor(maxIter=int(params.get("n_estimators", 100)), stepSize=float(params.get("learning_rate", 0.1)), **shape)


def _plain_linear(params: Mapping):
    return LinearRegression(solver="normal", standardization=False)


def _lasso(params: Mapping):
    return LinearRegression(elasticNetParam=1.0, regParam=float(params.get("alpha", 1.0)), standardization=False, maxIter=500, tol=1e-12)


def _ridge(params: Mapping):
    """``n`` and ``label_std`` (population) translate a penalty on the sum of squares into Spark's scaled one."""
    penalty = float(params.get("alpha", 1.0)) / params["n"] * params["label_std"]
    return LinearRegression(solver="normal", elasticNetParam=0.0, regParam=penalty, standardization=False)


ZOO: dict[str, Callable] = {
    "linear": _plain_linear,
    "ridge": _ridge,
    "lasso": _lasso,
    "rf": _forest,
    "gb": _boosted,
    "dt": lambda params: DecisionTreeRegressor(**_tree_params(params)),
}


def fit(df: DataFrame, model: str, features: Sequence[str], target: str, **params) -> PipelineModel:
    """Fit one model of the zoo; rows with a missing feature or target are left out.

    Bagging draws per partition. ``partitions`` deals the rows by their values to that many,
    or to one per PART_ROWS rows where that is more, so that the fitted forest is the same
    whatever the files and the cluster; without it the rows stay where they are, which spares
    a shuffle.
    """
    if model not in ZOO:
        raise ValueError(f"Unknown model: {model}")
    rows = _complete(df, features, target, params)
    if model == "gb":
        _let_checkpoint(rows.sparkSession)
    if model == "ridge":
        n, std = rows.agg(F.count(F.lit(1)), F.stddev_pop(target)).first()
        params = {**params, "n": n, "label_std": std}
    estimator = ZOO[model](params).setFeaturesCol(VECTOR).setLabelCol(target).setPredictionCol(PREDICTION)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=VECTOR), estimator]).fit(rows)


def _let_checkpoint(spark: SparkSession) -> None:
    """Boosting checkpoints every ten rounds where it has a folder; without one each round carries the plans of all before."""
    if spark.sparkContext.getCheckpointDir() is None:
        with suppress(ValueError):  # a cluster that names no shared folder
            spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _complete(df: DataFrame, features: Sequence[str], target: str, params: Mapping) -> DataFrame:
    rows = df.select(*features, F.col(target).cast("double").alias(target)).na.drop()
    return deal(rows, [*features, target], int(params["partitions"])) if params.get("partitions") else rows


def fit_to_score(df: DataFrame, model: str, features: Sequence[str], target: str, **params) -> PipelineModel | forests.Forest:
    """``fit`` for a model that only predicts: trees without a depth limit stay on the executors (``forests``)."""
    if model not in ("rf", "dt") or params.get("max_depth") is not None:
        return fit(df, model, features, target, **params)
    trees = int(params.get("n_estimators", 100)) if model == "rf" else 1
    return forests.fit(_complete(df, features, target, params), features, target, _tree_params(params), trees, bagged=model == "rf")


def deal(df: DataFrame, columns: Sequence[str], partitions: int) -> DataFrame:
    """Rows dealt by the values of ``columns`` to as many partitions as ``fit`` would take.

    Whatever rows of it are fitted without ``partitions``, each partition holds those, in the
    order, that dealing them alone to the same number would give: one shuffle serves all folds.
    """
    return dealt(df, max(partitions, math.ceil(df.count() / PART_ROWS)), columns)


def predict(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """Add ``prediction``; the assembled vector is dropped again."""
    if model is None:
        raise ValueError("Model must be trained before making predictions")
    return model.transform(df).drop(VECTOR)


def feature_importance(model: PipelineModel | None, top: int | None = None) -> list[tuple[str, float]]:
    """(feature, importance), largest first; coefficients' absolute values for linear models."""
    if model is None:
        raise ValueError("Model must be trained before getting feature importance")
    names, fitted = model.stages[0].getInputCols(), model.stages[-1]
    raw = fitted.featureImportances if hasattr(fitted, "featureImportances") else np.abs(fitted.coefficients.toArray())
    values = raw.toArray() if hasattr(raw, "toArray") else raw
    ranked = sorted(zip(names, map(float, values)), key=lambda x: (-x[1], x[0]))
    return ranked[:top] if top else ranked


def train(
    df: DataFrame, features: Sequence[str], target: str, model: str = "rf",
    folds: Sequence[tuple[DataFrame, DataFrame]] | None = None, **params,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the ``train`` rows of a table with a ``split`` column; metrics of every split as one table.

    With ``folds`` of the training rows, their mean held-out error is estimated first; it comes
    along as ``cv_mae`` on the row of the training split.
    """
    params = {**(FOREST_DEFAULTS if model == "rf" else {}), **params}
    train_rows = df.filter("split = 'train'")
    cv_mae = None
    if folds is not None:
        scores = cross_validate(train_rows, folds, model, features, target, train_scores=False, **params)
        cv_mae = scores.filter("metric = 'mae'").agg(F.avg("value")).first()[0]
    fitted = fit(train_rows, model, features, target, **params)
    metrics = evaluate_splits(predict(fitted, df), target)
    if folds is not None:
        metrics = metrics.withColumn("cv_mae", F.when(F.col("split") == "train", F.lit(cv_mae)))
    return fitted, metrics


def evaluate_splits(predicted: DataFrame, target: str, pred: str = PREDICTION) -> DataFrame:
    """Metrics and row counts per split, in one pass."""
    return regression_metrics(predicted, target, pred, by=["split"])


# -- least squares on sums ------------------------------------------------------


@dataclass
class LinearFit:
    intercept: float
    coefficients: np.ndarray
    means: np.ndarray
    scatter: np.ndarray  # sum over rows of (x - mean)(x - mean)'
    n: int


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> LinearFit | None:
    """Ordinary least squares from the covariances of one aggregation; None if features are collinear."""
    pairs = list(combinations_with_replacement(range(len(features)), 2))
    x = [F.col(f).cast("double") for f in features]
    y = F.col(target).cast("double")
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("my"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.covar_pop(c, y).alias(f"y{i}") for i, c in enumerate(x)],
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if not row["n"]:
        return None
    cov = np.zeros((len(features), len(features)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    if np.linalg.matrix_rank(cov, hermitian=True) < len(features):
        return None
    coefficients = np.linalg.solve(cov, np.array([row[f"y{i}"] for i in range(len(features))]))
    means = np.array([row[f"m{i}"] for i in range(len(features))])
    return LinearFit(float(row["my"] - coefficients @ means), coefficients, means, cov * row["n"], row["n"])


def linear_prediction(fit_: LinearFit, features: Sequence[str]) -> Column:
    out = F.lit(fit_.intercept)
    for f, b in zip(features, fit_.coefficients):
        out = out + F.lit(float(b)) * F.col(f)
    return out


def leave_one_out(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Leave-one-out residuals of a linear model: e / (1 - h), without refitting."""
    rows = df.na.drop(subset=[*features, target])
    fitted = least_squares(rows, features, target)
    if fitted is None:
        raise ValueError("Features are collinear")
    inverse = np.linalg.inv(fitted.scatter)
    centred = [F.col(f) - F.lit(float(m)) for f, m in zip(features, fitted.means)]
    leverage = F.lit(1.0 / fitted.n)
    for i, a in enumerate(centred):
        for j, b in enumerate(centred):
            leverage = leverage + F.lit(float(inverse[i, j])) * a * b
    residual = F.col(target) - linear_prediction(fitted, features)
    return rows.withColumn("leverage", leverage).withColumn("loo_residual", F.try_divide(residual, 1 - F.col("leverage")))


# -- cross-validation -----------------------------------------------------------


def _in_threads(tasks: Sequence[Callable], parallelism: int) -> list:
    """Run independent fits side by side; the cluster interleaves their stages."""
    if not tasks:
        return []
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda t: t(), [inheritable_thread_target(t) for t in tasks])


def cross_validate(
    df: DataFrame, folds: Sequence[tuple[DataFrame, DataFrame]], model: str, features: Sequence[str], target: str,
    train_scores: bool = True, parallelism: int = 4, **params,
) -> DataFrame:
    """(model, fold, side, metric, value) with test and train scores, fit and score seconds."""
    if model not in ZOO:
        raise ValueError(f"Unknown model: {model}")

    def one(i: int, train_rows: DataFrame, test_rows: DataFrame) -> list[tuple]:
        start = time.time()
        fitted = fit_to_score(train_rows, model, features, target, **params)
        fit_seconds = time.time() - start
        sides = [("test", test_rows)] + ([("train", train_rows)] if train_scores else [])
        out, start = [], time.time()
        try:
            for side, rows in sides:
                predicted = predict(fitted, rows.select(*dict.fromkeys([*features, target])))
                row = regression_metrics(predicted, target, PREDICTION).select("mae", "mse", "rmse", "r2").first()
                out += [(model, i, side, m, row[m]) for m in ("mae", "mse", "rmse", "r2")]
        finally:
            if isinstance(fitted, forests.Forest):
                fitted.unpersist()
        return out + [(model, i, "test", "fit_seconds", fit_seconds), (model, i, "test", "score_seconds", time.time() - start)]

    rows = _in_threads([lambda i=i, a=a, b=b: one(i, a, b) for i, (a, b) in enumerate(folds)], parallelism)
    return df.sparkSession.createDataFrame([r for part in rows for r in part], SCORES)


def fold_summary(scores: DataFrame, by: Sequence[str] = ("model", "metric"), confidence: float = 0.95) -> DataFrame:
    """Mean, population std and Student-t interval of the mean over folds."""
    stats = scores.groupBy(*by).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n"),
        F.stddev_samp("value").alias("_s"),
    )
    half = F.col("_t") * F.col("_s") / F.sqrt(F.col("n").cast("double"))
    return (
        stats.withColumn("_t", t_critical(F.col("n") - 1, confidence))
        .withColumns({"ci_lower": F.col("mean") - half, "ci_upper": F.col("mean") + half})
        .drop("_t", "_s")
    )


def compare_models(
    df: DataFrame, folds: Sequence[tuple[DataFrame, DataFrame]], models: Sequence[str], features: Sequence[str], target: str,
    params: Mapping[str, Mapping] | None = None, parallelism: int = 4, train_scores: bool = True,
) -> DataFrame:
    """Fold scores of several models; names outside the zoo are skipped."""
    known = [m for m in models if m in ZOO]
    if not known:
        raise ValueError("No known model to compare")
    scores = None
    for m in known:
        part = cross_validate(df, folds, m, features, target, train_scores, parallelism, **(params or {}).get(m, {}))
        scores = part if scores is None else scores.unionByName(part)
    return scores


def best_model(summary: DataFrame) -> DataFrame:
    """The model with the highest mean R2, from rows of ``fold_summary``."""
    r2 = summary.filter(F.col("metric") == "r2")
    return r2.agg(F.max_by("model", "mean").alias("best_model"), F.max("mean").alias("r2"))


def out_of_fold(
    folds: Sequence[tuple[DataFrame, DataFrame]], model: str, features: Sequence[str], target: str, parallelism: int = 4, **params
) -> DataFrame:
    """Every row predicted by the model that did not see it."""
    def one(i: int, train_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
        return predict(fit(train_rows, model, features, target, **params), test_rows).withColumn("_fold", F.lit(i))

    parts = _in_threads([lambda i=i, a=a, b=b: one(i, a, b) for i, (a, b) in enumerate(folds)], parallelism)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("_fold", "held_out_fold")


def learning_curve(
    df: DataFrame, folds: Sequence[tuple[DataFrame, DataFrame]], model: str, features: Sequence[str], target: str, key: str,
    fractions: Sequence[float] = tuple((i + 1) / 10 for i in range(10)), seed: int = 43, portable: bool = False,
    parallelism: int = 4, **params,
) -> DataFrame:
    """(fraction, fold, side, value): R2 on nested training subsets and on the held-out fold."""
    unit = unit_hash(F.col(key), seed, portable)

    def one(fraction: float, i: int, train_rows: DataFrame, test_rows: DataFrame) -> list[tuple]:
        part = train_rows.filter(unit < F.lit(float(fraction)))
        fitted = fit(part, model, features, target, **params)
        sides = (("train", part), ("val", test_rows))
        return [(fraction, i, s, regression_metrics(predict(fitted, r), target, PREDICTION).first()["r2"]) for s, r in sides]

    tasks = [lambda f=f, i=i, a=a, b=b: one(f, i, a, b) for f in fractions for i, (a, b) in enumerate(folds)]
    rows = [r for part in _in_threads(tasks, parallelism) for r in part]
    return df.sparkSession.createDataFrame(rows, "fraction double, fold int, side string, value double")


def curve_points(curve: DataFrame) -> DataFrame:
    return curve.groupBy("fraction").agg(
        *[f(F.when(F.col("side") == s, F.col("value"))).alias(f"{s}_{n}") for s in ("train", "val") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )


def curve_diagnostics(curve: DataFrame, gap: float = 0.05, floor: float = 0.7) -> DataFrame:
    """Converged, overfitting and underfitting flags from the largest training subset."""
    last = curve_points(curve).agg(
        F.max_by("train_mean", "fraction").alias("final_train_score"), F.max_by("val_mean", "fraction").alias("final_val_score")
    )
    train_, val = F.col("final_train_score"), F.col("final_val_score")
    return last.withColumns(
        {
            "score_gap": F.abs(train_ - val),
            "converged": F.abs(train_ - val) < gap,
            "overfitting": train_ > val + gap,
            "underfitting": val < floor,
        }
    )


def tune(
    df: DataFrame, features: Sequence[str], target: str, trials: int = 50, seed: int = 42, parallelism: int = 4,
    ranges: Mapping[str, tuple[int, int]] | None = None, model: str = "rf",
) -> tuple[PipelineModel, DataFrame]:
    """Seeded random search on the ``train`` split, judged by MAE on ``val``.

    Returns the best model and the table of all trials.
    """
    draw = random.Random(seed)
    space = ranges or TUNING_RANGES
    settings = [{p: draw.randint(lo, hi) for p, (lo, hi) in sorted(space.items())} for _ in range(trials)]
    data = df.select(*features, target, "split").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_rows, val_rows = data.filter("split = 'train'"), data.filter("split = 'val'")

        errors: dict[int, float] = {}
        kept: list[tuple[float, int, PipelineModel]] = []  # the best model so far, no other
        lock = Lock()

        def judge(trial: int, params: dict) -> None:
            fitted = fit(train_rows, model, features, target, **params)
            mae = regression_metrics(predict(fitted, val_rows), target, PREDICTION).first()["mae"]
            with lock:
                errors[trial] = mae
                if not kept or (mae, trial) < kept[0][:2]:
                    kept[:] = [(mae, trial, fitted)]

        _in_threads([lambda i=i, p=p: judge(i, p) for i, p in enumerate(settings)], parallelism)
    finally:
        data.unpersist()
    best = kept[0][1]
    rows = [(i, {k: str(v) for k, v in s.items()}, errors[i], i == best) for i, s in enumerate(settings)]
    table = df.sparkSession.createDataFrame(rows, "trial int, params map<string,string>, val_mae double, best boolean")
    return kept[0][2], table


# -- scoring --------------------------------------------------------------------


def score(
    requests: DataFrame, state: FeatureState, model: PipelineModel, ranges: Mapping[str, tuple[float, float]],
    group_mean: str = "fitted",
) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) for a batch or a stream of raw requests: check, encode, derive, predict, interval."""
    valid, rejected = split_by_ranges(requests, ranges)
    ready = state.derive(state.apply(valid, unseen="keep", only_present=True), group_mean)
    low, high = prediction_interval(F.col(PREDICTION))
    return predict(model, ready).withColumns({"lower": low, "upper": high}), rejected


def metric_rows(predicted: DataFrame, target: str, pred: str = PREDICTION) -> DataFrame:
    return as_long(regression_metrics(predicted, target, pred))
