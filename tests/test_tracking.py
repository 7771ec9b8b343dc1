import pytest

from tabwright.operators import tracking


@pytest.mark.parametrize("maximize, best", [(True, "b"), (False, "a")])
def test_of_equal_values_the_first_run_is_best(spark, maximize, best):
    rows = [("c", 3.0), ("b", 3.0), ("d", 1.0), ("a", 1.0), ("e", None)]
    metrics = spark.createDataFrame([(r, "loss", v, i) for i, (r, v) in enumerate(rows)], "run_id string, metric string, value double, seq int")
    metrics = metrics.selectExpr("'x' as experiment_id", "*", "timestamp_seconds(seq) as ts").repartition(4)
    assert tracking.compare_runs(metrics, list("abcde"), ["loss"], maximize).first().best_run == best
