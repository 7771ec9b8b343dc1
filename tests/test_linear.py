import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import linear, split, training


@pytest.fixture(scope="module")
def rows(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    df = spark.range(600).select("id", (F.col("id") % 37 * 1.0).alias("a"), (F.col("id") % 11 * 1.5).alias("b"))
    df = df.withColumn("y", 3 + 2 * F.col("a") - F.col("b") + noise).unionByName(df.limit(5).withColumn("y", F.lit(None).cast("double")))
    return split.kfold(df, "id", 4).cache()


def test_sums_put_together_equal_sums_of_all(rows):
    parts = linear.sums_by(rows, [F.col("fold")], ["a", "b"], "y")
    whole = linear.sums_by(rows, [F.lit(0)], ["a", "b"], "y")[0,]
    joined = linear._together(parts.values(), 3)
    assert joined.n == whole.n == 600
    assert np.allclose(joined.product, whole.product) and np.allclose(joined.mean, whole.mean)


def test_folds_equal_refitting(rows):
    scores = linear.cross_validate(rows, ["a", "b"], "y").collect()
    known = rows.na.drop()
    refitted = training.cross_validate(known, split.fold_frames(known, 4), "linear", ["a", "b"], "y").collect()
    want = {(r.fold, r.side, r.metric): r.value for r in refitted if "seconds" not in r.metric}
    got = {(r.fold, r.side, r.metric): r.value for r in scores}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


def test_out_of_fold_and_curve_equal_refitting(rows):
    known = rows.na.drop()
    got = {r.id: r.prediction for r in linear.out_of_fold(known, ["a", "b"], "y").collect()}
    want = {r.id: r.prediction for r in training.out_of_fold(split.fold_frames(known, 4), "linear", ["a", "b"], "y").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    fractions = (0.3, 1.0)
    curves = [
        linear.learning_curve(known, ["a", "b"], "y", "id", fractions),
        training.learning_curve(known, split.fold_frames(known, 4), "linear", ["a", "b"], "y", "id", fractions),
    ]
    one, two = ({(r.fraction, r.fold, r.side): r.value for r in c.collect()} for c in curves)
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], rel=1e-6) for k in two)


def test_collinear_features_are_refused(rows):
    with pytest.raises(ValueError, match="collinear"):
        linear.fold_lines(rows.withColumn("c", F.col("a") * 2), ["a", "c"], "y")
