import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import abtest, evaluation, explain, monitoring, neighbors, split, training
from tabwright.plans import bindings as b
from tabwright.sources import models, tables


@pytest.fixture(scope="module")
def days(spark, sf_dir):
    return b.demand(spark, sf_dir).cache()


def test_exact_split_sizes(spark):
    rows = split.split_rows(spark.range(731).withColumnRenamed("id", "k"), "k", exact=True)
    assert {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()} == {"train": 584, "val": 73, "test": 74}


def test_split_is_stable_under_repartition(days):
    one, two = (split.split_rows(d, "o_orderkey").select("o_orderkey", "split") for d in (days, days.repartition(7)))
    assert one.exceptAll(two).count() == 0 and one.count() == days.count()


def test_seeds_give_unrelated_folds(days):
    rows = split.repeated_kfold(days, "o_orderkey", portable=True)
    same = rows.filter("fold_0 = fold_1").count() / rows.count()
    assert 0.1 < same < 0.3


def test_stratified_folds_are_balanced(days):
    folds = split.stratified_kfold(days, "o_orderkey", "season").groupBy("season", "fold").count().toPandas()
    spread = folds.groupby("season")["count"].agg(lambda c: c.max() - c.min())
    assert (spread <= 1).all()


def test_unknown_strategy(days):
    with pytest.raises(ValueError, match="Unknown CV strategy"):
        split.with_folds(days, "nothing", "o_orderkey")


def test_time_series_folds_move_forward(days):
    rows = split.with_folds(days, "timeseries", "o_orderkey", by="o_orderdate")
    for past, future in split.fold_frames(rows, 5, "timeseries"):
        assert past.agg(F.max("o_orderdate")).first()[0] <= future.agg(F.min("o_orderdate")).first()[0]


def test_untrained_model_refuses(days):
    with pytest.raises(ValueError, match="trained"):
        training.predict(None, days)
    with pytest.raises(ValueError, match="trained"):
        training.feature_importance(None)
    with pytest.raises(ValueError, match="Unknown model"):
        training.fit(days, "svr", ["temp"], "cnt")


def test_forest_learns_the_demand_formula(days):
    rows = split.split_rows(days, "o_orderkey")
    _, metrics = training.train(rows, [*b.CATEGORICAL, *b.NUMERICAL], "cnt", n_estimators=20, max_depth=10)
    test = {r["split"]: r for r in metrics.collect()}["test"]
    assert test["r2"] > 0.6 and test["n"] > 100


def test_linear_model_recovers_the_formula(days):
    fitted = training.least_squares(days, ["temp", "hum"], "cnt")
    model = training.fit(days, "linear", ["temp", "hum"], "cnt").stages[-1]
    assert np.allclose(fitted.coefficients, model.coefficients.toArray(), rtol=1e-6)
    assert training.least_squares(days.withColumn("t2", F.col("temp") * 2), ["temp", "t2"], "cnt") is None


def test_leave_one_out_equals_refitting(days):
    few = days.limit(12).cache()
    loo = {r["o_orderkey"]: r["loo_residual"] for r in training.leave_one_out(few, ["temp", "hum"], "cnt").collect()}
    rows = few.select("o_orderkey", "temp", "hum", "cnt").toPandas()
    for i in range(len(rows)):
        rest = rows.drop(i)
        x = np.c_[np.ones(len(rest)), rest[["temp", "hum"]]]
        beta = np.linalg.lstsq(x, rest["cnt"], rcond=None)[0]
        assert loo[rows["o_orderkey"][i]] == pytest.approx(rows["cnt"][i] - beta @ [1, rows["temp"][i], rows["hum"][i]])


def test_perfect_and_constant_labels(spark):
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert evaluation.regression_metrics(flat, "y", "p").first()["r2"] == 1.0
    off = flat.withColumn("p", F.lit(2.0))
    assert evaluation.regression_metrics(off, "y", "p").first()["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    row = evaluation.regression_metrics(zero, "y", "p").first()
    assert row["mape"] == 50.0 and row["n_zero"] == 1


def test_model_round_trip(spark, days, tmp_path):
    model = training.fit(days, "dt", ["temp", "hum"], "cnt", max_depth=3)
    models.save_model(spark, model, str(tmp_path / "m"), ["temp", "hum"], "cnt")
    again, features, target = models.load_model(spark, str(tmp_path / "m"))
    assert (features, target) == (["temp", "hum"], "cnt")
    first, second = (training.predict(m, days).select("o_orderkey", "prediction") for m in (model, again))
    assert first.exceptAll(second).count() == 0


def test_one_row_arms_give_no_test(spark):
    rows = spark.createDataFrame([("t", "control", 1.0), ("t", "treatment", 2.0)], "test string, arm string, value double")
    row = abtest.evaluate_moments(abtest.moments(rows, "value", by=["test"])).first()
    assert row["p_value"] is None and row["significant"] is None and row["lift"] == 1.0


def test_unknown_metric_type(spark):
    rows = spark.createDataFrame([("t", "control", 1.0)], "test string, arm string, value double")
    with pytest.raises(ValueError, match="Unsupported metric type"):
        abtest.evaluate_moments(abtest.moments(rows, "value", by=["test"]), "median")


def test_cumulative_looks_do_not_cancel(spark):
    rows = spark.range(2000).select(
        F.lit("t").alias("test"), (F.col("id") % 4).alias("look"), F.when(F.col("id") % 2 == 0, "control").otherwise("treatment").alias("arm"),
        (F.lit(1e9) + F.col("id") % 10).alias("value"),
    )
    upto = abtest.cumulative_looks(rows, "value", ["test"]).orderBy(F.desc("look")).first()
    direct = abtest.moments(rows, "value", by=["test"]).first()
    assert upto["control_count"] == direct["control_count"] and upto["control_var"] == pytest.approx(direct["control_var"], rel=1e-6)


def test_first_performance_run_stores_the_baseline(spark, tmp_path):
    path = str(tmp_path / "baseline")
    now = F.current_timestamp()
    good = spark.createDataFrame([("mae", 10.0), ("r2", 0.9)], "metric string, value double")
    assert monitoring.monitor_performance(spark, good, path, now).filter("degraded").count() == 0
    bad = spark.createDataFrame([("mae", 11.5), ("r2", 0.85)], "metric string, value double")
    degraded = monitoring.monitor_performance(spark, bad, path, now).filter("degraded").collect()
    assert [r["metric"] for r in degraded] == ["mae"] and degraded[0]["message"] == "MAE increased from 10.000 to 11.500"


def test_missing_and_empty_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_rows(spark, str(tmp_path / "none.csv"), "a int")
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "empty.parquet"))
    with pytest.raises(ValueError, match="No rows"):
        tables.read_rows(spark, str(tmp_path / "empty.parquet"), require_rows=True)


def test_corrupt_json_is_kept(spark):
    rows = spark.createDataFrame([('{"k": 1}',), ("{broken",)], "props string")
    parsed = tables.parse_json_rows(rows, "props", "k int").collect()
    assert parsed[0]["record"]["k"] == 1 and parsed[1]["corrupt_record"] == "{broken"
    lists = spark.createDataFrame([('[{"k": 1}, {"k": 2}]',), ('{"k": 3}',)], "props string")
    assert sorted(r["record"]["k"] for r in tables.json_array_rows(lists, "props", "k:int").collect()) == [1, 2, 3]


@pytest.mark.parametrize("pivots, block", [(1, 64), (16, 50), (40, 4096)])
def test_neighbors_equal_brute_force(spark, days, pivots, block):
    rows = days.limit(400).select("o_orderkey", F.array(*b.NUMERICAL).alias("v"), "cnt").cache()
    got = {r["o_orderkey"]: r["prediction"] for r in neighbors.knn_regression(rows, rows, "o_orderkey", "v", "cnt", pivots=pivots, block=block, exclude_self=True).collect()}
    data = rows.toPandas()
    x, y, ids = np.stack(data["v"].to_numpy()), data["cnt"].to_numpy(), data["o_orderkey"].to_numpy()
    assert len(got) == len(data)
    for i in range(len(data)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        best = np.lexsort((ids, np.round(d, 12)))[:5]
        assert got[ids[i]] == pytest.approx(y[best].mean())


def test_attributions_add_up(days):
    rows = days.limit(50).cache()
    model = training.fit(days, "dt", ["temp", "hum", "season"], "cnt", max_depth=4)
    scorer = lambda df: training.predict(model, df)
    out = explain.attributions(rows, "o_orderkey", ["temp", "hum", "season"], scorer, days.limit(10))
    gap = out.groupBy("o_orderkey").agg((F.sum("contribution") + F.max("base_value") - F.max("prediction")).alias("g"))
    assert gap.count() == 50 and gap.filter(F.abs("g") > 1e-6).count() == 0
    truth = training.predict(model, rows).select("o_orderkey", F.col("prediction").alias("p"))
    assert out.join(truth, "o_orderkey").filter(F.abs(F.col("prediction") - F.col("p")) > 1e-9).count() == 0


def test_surrogate_finds_the_only_feature_that_matters(days):
    scorer = lambda df: df.withColumn("prediction", F.col("temp") * 1000.0)
    out = explain.local_surrogates(days.limit(20), "o_orderkey", ["temp", "hum", "atemp"], scorer, days, samples=400, top=1)
    assert {r["feature"] for r in out.filter(F.abs(F.col("weight")) > 100).collect()} == {"temp"}
    assert out.count() == 20


def test_background_must_be_small(spark):
    with pytest.raises(ValueError, match="Background"):
        explain.background_rows(spark.range(2000).toDF("x"), ["x"])


def test_explanations_use_the_whole_background_and_all_samples(spark, sf_dir, monkeypatch):
    from tabwright.plans import explanations

    asked = {}
    monkeypatch.setattr(explanations, "_small_forest", lambda *_: (spark.range(1), None))
    monkeypatch.setattr(explanations.training, "feature_importance", lambda *_: None)
    monkeypatch.setattr(explain, "attributions", lambda rows, key, features, scorer, background: asked.update(background=background) or rows.selectExpr(
        "id as o_orderkey", "0.0 as contribution", "0.0 as base_value", "0.0 as prediction"))
    for name in ("explain_model", "explain_rows", "explanation_report"):
        monkeypatch.setattr(explain, name, lambda *_: None)
    monkeypatch.setattr(explain, "default_background", lambda rows, key, n=100, portable=False: n)
    monkeypatch.setattr(explain, "local_surrogates", lambda *_, samples=1000, top=None: asked.update(samples=samples))
    for plan in (explanations.forest_attributions_add_up, explanations.forest_explanations, explanations.explained_rows, explanations.explanation_report):
        asked.pop("background", None)
        plan(spark, sf_dir)
        assert asked["background"] == 100, plan.__name__
    explanations.local_surrogates(spark, sf_dir)
    assert asked["samples"] == 1000
