"""Explanations read from the tables of fitted trees equal those that ask the model."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import explain, training
from tabwright.operators.trees import Trees, TreeScorer
from tabwright.plans import bindings as b

FEATURES = ["season", "weathersit", "temp", "hum"]


@pytest.fixture(scope="module")
def days(spark, sf_dir):
    return b.demand(spark, sf_dir).cache()


@pytest.fixture(scope="module", params=["rf", "dt", "gb"])
def model(request, days):
    sizes = {"n_estimators": 3, "max_depth": 4, "partitions": 4} if request.param != "dt" else {"max_depth": 4}
    return training.fit(days, request.param, FEATURES, "cnt", **sizes)


def test_tables_score_like_the_model(days, model):
    found = training.predict(model, days.select(*FEATURES).limit(500)).toPandas()
    trees = Trees.of(model, FEATURES[::-1])  # in any order of features
    x = [found[f].to_numpy(dtype="float64") for f in FEATURES[::-1]]
    assert np.allclose(trees.score(trees.cells(x)), found["prediction"], rtol=1e-12)
    edges = [e if len(e) else np.zeros(1) for e in trees.edges]  # on a threshold itself
    rows = [dict(zip(FEATURES[::-1], (float(e[i % len(e)]) for e in edges))) for i in range(20)]
    at = training.predict(model, days.sparkSession.createDataFrame(rows)).toPandas()
    x = [at[f].to_numpy(dtype="float64") for f in FEATURES[::-1]]
    assert np.allclose(trees.score(trees.cells(x)), at["prediction"], rtol=1e-12)


def test_trees_in_several_tables(days, model, monkeypatch):
    whole = Trees.of(model, FEATURES)
    x = days.select(*FEATURES).limit(300).toPandas().to_numpy(dtype="float64").T
    want = whole.score(whole.cells(x))
    monkeypatch.setattr("tabwright.operators.trees.MAX_CELLS", 1)
    assert Trees.of(model, FEATURES) is None
    parts = Trees(whole.features, whole.leaves, whole.weights, whole.divisor)
    assert len(parts.tables) == len(whole.leaves)
    assert np.allclose(parts.score(parts.cells(x)), want, rtol=1e-12)


def test_attributions_are_means_over_all_orders_and_all_background_rows(days, model):
    rows, background = days.orderBy("o_orderkey").limit(12).cache(), days.orderBy("cnt", "o_orderkey").limit(7).cache()
    got = explain.attributions(rows, "o_orderkey", FEATURES, TreeScorer(model), background)
    got = {(r["o_orderkey"], r["feature"]): r for r in got.collect()}
    assert len(got) == 12 * len(FEATURES)
    trees = Trees.of(model, FEATURES)
    score = lambda z: trees.score(trees.cells(z.T)).mean()
    bg = np.array(background.select(*FEATURES).collect(), dtype="float64")
    for r in rows.collect():
        x = np.array([r[f] for f in FEATURES], dtype="float64")
        sums = np.zeros(len(FEATURES))
        orders = list(permutations(range(len(FEATURES))))
        for order in orders:
            z, before = bg.copy(), score(bg)
            for j in order:
                z[:, j] = x[j]
                sums[j] += score(z) - before
                before = score(z)
        for j, f in enumerate(FEATURES):
            row = got[r["o_orderkey"], f]
            assert row["contribution"] == pytest.approx(sums[j] / len(orders), abs=1e-8)
            assert row["base_value"] == pytest.approx(score(bg)) and row["prediction"] == pytest.approx(score(x[None, :]))
            assert row["feature_value"] == x[j]


def test_surrogates_equal_those_of_widened_rows(days, model):
    rows = days.limit(60).cache()
    ask = lambda scorer: {
        (r["o_orderkey"], r["feature"]): r for r in explain.local_surrogates(rows, "o_orderkey", FEATURES, scorer, days, samples=300, top=3).collect()
    }
    got, want = ask(TreeScorer(model)), ask(lambda df: training.predict(model, df))
    assert len(want) == 180 and set(got) == set(want)
    for k, r in want.items():
        assert got[k]["rule"] == r["rule"]
        for c in ("weight", "intercept", "local_prediction", "prediction"):
            assert got[k][c] == pytest.approx(r[c], rel=1e-7, abs=1e-7), c


def test_missing_features_are_an_error_and_no_rows_are_none(days, model):
    empty = days.filter("false")
    assert explain.attributions(empty, "o_orderkey", FEATURES, TreeScorer(model), days.limit(5)).count() == 0
    assert explain.local_surrogates(empty, "o_orderkey", FEATURES, TreeScorer(model), days).count() == 0
    holes = days.limit(3).withColumn("temp", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="missing"):
        explain.attributions(holes, "o_orderkey", FEATURES, TreeScorer(model), days.limit(5)).collect()


def test_plans_widen_no_rows(spark, sf_dir, monkeypatch):
    """The explanations of forests ask the model for nothing per sample or background row."""
    from tabwright.plans import explanations

    monkeypatch.setattr(TreeScorer, "__call__", lambda *_: pytest.fail("rows were widened"))
    for plan in (explanations.forest_attributions_add_up, explanations.local_surrogates, explanations.explained_rows, explanations.explanation_report):
        plan(spark, sf_dir)


def test_explained_table_equals_joined_explanations_and_joins_nothing(days, model):
    rows, bg = days.limit(60).cache(), explain.default_background(days, "o_orderkey", 20)
    scorer = TreeScorer(model)
    got = explain.explain_table(rows, "o_orderkey", FEATURES, scorer, bg, days, samples=300, top=2)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    surrogates = explain.local_surrogates(rows, "o_orderkey", FEATURES, scorer, days, samples=300, top=2)
    want = explain.explain_rows(explain.attributions(rows, "o_orderkey", FEATURES, scorer, bg), surrogates, "o_orderkey")
    assert got.dtypes == want.dtypes
    found = got.orderBy("o_orderkey", "feature").collect()
    assert found == want.orderBy("o_orderkey", "feature").collect()
    assert len(found) == 240 and sum(r["rule"] is not None for r in found) == sum(r["weight"] is not None for r in found) == 120


def test_explained_table_of_other_scorers(days):
    rows, bg = days.limit(5).cache(), explain.default_background(days, "o_orderkey", 4)
    score = lambda df: df.withColumn("prediction", F.col("temp") * 2 - F.col("hum"))
    found = explain.explain_table(rows, "o_orderkey", ["temp", "hum"], score, bg, days, samples=50, top=1).collect()
    assert len(found) == 10 and sum(r["rule"] is not None for r in found) == 5


def test_explained_rows_plan_joins_nothing(spark, sf_dir):
    from tabwright.plans import explanations

    assert "Join" not in explanations.explained_rows(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
