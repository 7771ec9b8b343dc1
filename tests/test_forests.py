"""Trees without a depth limit: the trees of pyspark.ml, whichever part of them one task finishes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import forests, split, training
from tabwright.plans import bindings as b
from tabwright.plans import models

FEATURES = ["season", "temp", "hum", "windspeed"]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    found = training.deal(b.demand(spark, sf_dir).select(*FEATURES, F.col("cnt").cast("double").alias("cnt")), [*FEATURES, "cnt"], 3).cache()
    yield found
    found.unpersist()


def _scores(model, rows):
    return [(r["cnt"], r["prediction"]) for r in model.transform(rows).select("cnt", "prediction").orderBy("cnt", "prediction").collect()]


def test_model_comparison_fits_every_model_with_its_defaults(spark, sf_dir, monkeypatch):
    asked = {}

    def compare(df, folds, zoo, features, target, params=None, parallelism=4, train_scores=True):
        asked.update(zoo=zoo, params=params or {}, folds=len(folds), rows=df.count())
        return spark.createDataFrame([("rf", 0, "test", "r2", 1.0)], training.SCORES)

    monkeypatch.setattr(training, "compare_models", compare)
    models.model_comparison(spark, sf_dir)
    assert {"linear", "ridge", "lasso", "rf", "gb", "dt"} <= set(asked["zoo"]) and asked["folds"] == 5
    assert not any({"n_estimators", "max_depth"} & set(p) for p in asked["params"].values())
    assert asked["rows"] == b.demand(spark, sf_dir).count()
    assert training._boosted({}).getMaxIter() == training._forest({}).getNumTrees() == 100
    assert training._tree_params({})["maxDepth"] == training.DEEPEST


@pytest.mark.parametrize("local", [40, 10**9])
def test_a_tree_is_that_of_pyspark(rows, monkeypatch, local):
    monkeypatch.setattr(forests, "LOCAL_ROWS", local)
    want = training.fit(rows, "dt", FEATURES, "cnt", max_depth=30, min_samples_leaf=15)
    got = training.fit_to_score(rows, "dt", FEATURES, "cnt", min_samples_leaf=15)
    assert isinstance(got, forests.Forest) and got.n_nodes == want.stages[-1].numNodes > 50
    np.testing.assert_allclose(_scores(got, rows), _scores(want, rows), rtol=1e-9)
    assert len(got.tops[0][0]) > 1 or local > 40  # upper nodes only where rows are many


def test_a_forest_is_the_same_whatever_one_task_finishes(rows, monkeypatch):
    whole = training.fit_to_score(rows, "rf", FEATURES, "cnt", n_estimators=7)
    monkeypatch.setattr(forests, "LOCAL_ROWS", 100)
    monkeypatch.setattr(forests, "SCORED_ROWS", 64)
    parts = training.fit_to_score(rows, "rf", FEATURES, "cnt", n_estimators=7)
    assert parts.n_nodes == whole.n_nodes and parts.grown.count() > whole.grown.count() == 7
    np.testing.assert_allclose(_scores(parts, rows), _scores(whole, rows), rtol=1e-9)


def test_a_forest_scores_held_out_rows_like_that_of_pyspark(rows):
    folds = split.fold_frames(rows.withColumn("fold", (F.xxhash64(*FEATURES) % 2 + 2) % 2), 2)
    r2 = []
    for limit in (None, 30):
        scores = training.cross_validate(rows, folds, "rf", FEATURES, "cnt", train_scores=False, n_estimators=30, max_depth=limit)
        r2.append(np.mean([r["value"] for r in scores.filter("metric = 'r2'").collect()]))
    assert abs(r2[0] - r2[1]) < 0.02


def test_odd_rows(spark):
    schema = "x double, z int, y double"
    few = spark.createDataFrame([(1.0, 1, 5.0), (1.0, 1, 7.0), (None, 1, 1.0), (2.0, 1, 9.0), (float("nan"), 2, 1.0)], schema)
    tree = training.fit_to_score(few, "dt", ["x", "z"], "y")  # missing ones are left out, equal rows end in one leaf
    known = few.filter("x < 3")
    assert tree.n_nodes == 3 and [r[0] for r in tree.transform(known).select("prediction").orderBy("y").collect()] == [6.0, 6.0, 9.0]
    forest = training.fit_to_score(known.limit(1), "rf", ["x", "z"], "y", n_estimators=20)  # trees that draw nothing do not count
    assert 0 < len(forest.tops) < 20 and {r[0] for r in forest.transform(known).select("prediction").collect()} <= {5.0, 7.0, 9.0}
    assert tree.transform(known.filter("false")).count() == 0
    with pytest.raises(Exception, match="missing"):
        tree.transform(few).count()
    with pytest.raises(ValueError, match="No rows"):
        training.fit_to_score(few.filter("false"), "dt", ["x", "z"], "y")


def test_thresholds():
    values, counts = np.arange(100.0), np.ones(100, "int64")
    assert list(forests._thresholds(values[:3], counts[:3], 32)) == [0.5, 1.5]
    cuts = forests._thresholds(values, counts, 4)
    assert list(cuts) == [24.5, 49.5, 74.5]


def test_many_values_take_quantiles(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id / 7.0D as x", "cast(id as double) as y")
    n, (few,) = forests._edges(rows, ["x"], 32)
    monkeypatch.setattr(forests, "MOST_VALUES", 100)
    again, (many,) = forests._edges(rows, ["x"], 32)
    assert n == again == 4000 and len(few) == len(many) == 31
    np.testing.assert_allclose(few, many, atol=0.2)
