from pyspark.sql import functions as F

from tabwright.operators import explain


def _scorer(df):
    return df.withColumn("prediction", 3 * F.col("a"))


def _importances(rows):
    out = explain.permutation_importance(rows, "id", ["a", "b"], "y", _scorer, repeats=3).collect()
    return {r.feature: (r.importance, r["std"]) for r in out}


def test_only_used_features_matter(spark):
    rows = spark.range(500).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"), (3.0 * F.col("id")).alias("y"))
    found = _importances(rows)
    # mean squared gap of 3a between unrelated rows: 9 * 2 * var(a)
    assert abs(found["a"][0] / (18 * (500**2 - 1) / 12) - 1) < 0.2
    assert found["b"] == (0.0, 0.0)
    assert _importances(rows.repartition(5)) == found


def test_one_row_and_missing_targets(spark):
    rows = spark.createDataFrame([(1, 2.0, 1.0, 5.0), (2, 9.0, 1.0, None)], "id int, a double, b double, y double")
    assert _importances(rows) == {"a": (0.0, 0.0), "b": (0.0, 0.0)}
    assert _importances(rows.filter("y is null")) == {}


def test_every_row_gets_another_rows_value(spark):
    rows = spark.range(2).select("id", F.col("id").cast("double").alias("a"), F.lit(0).alias("b"), (3.0 * F.col("id")).alias("y"))
    assert _importances(rows)["a"] == (9.0, 0.0)
