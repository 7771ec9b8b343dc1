"""No result depends on size, and no row vanishes because its key is null."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tabwright import Roles
from tabwright.operators import abtest, drift, explain, split, training
from tabwright.operators.features import FeatureState
from tabwright.operators.quantiles import quantile_table, quantiles
from tabwright.operators.ranking import hashed_rank, ordered_rank


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(200).select(
        "id", F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("g"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).when(F.col("id") % 5 > 0, F.col("id") * 1.0).alias("v"),
    ).cache()


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles_agree_on_both_paths_for_null_groups(rows, by):
    a, b = (quantiles(rows, ["v"], [0.1, 0.5, 0.9], by, max_counters=m) for m in (10**6, 0))
    assert a.count() == 3 * (3 if by else 1)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_groups_without_values_and_null_groups_keep_their_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "g string, v double")
    got = {r.g: (r["mean"], r["count"], r["median"]) for r in abtest.arm_statistics(df, "v", ["g"]).collect()}
    assert got == {"a": (2.0, 2, 2.0), None: (5.0, 1, 5.0), "b": (None, 0, None)}
    assert quantile_table(df, ["v"], [0.5], ["g"]).count() == 2


@pytest.mark.parametrize(
    "dtype, values",
    [
        ("decimal(9,2)", [decimal.Decimal("10.00"), decimal.Decimal("2.00"), decimal.Decimal("1.00")]),
        ("date", [datetime.date(2020, 1, 10), datetime.date(2020, 1, 2)]),
        ("int", [10, 9, 100]), ("boolean", [True, False]), ("double", [10.5, 9.25]), ("string", ["b", "B", "a"]),
    ],
)
def test_labels_have_the_same_codes_inline_and_as_a_table(spark, tmp_path, dtype, values):
    df = spark.createDataFrame([(v, 1.0) for v in [*values, None]], f"label {dtype}, x double")
    roles = Roles(numerical=("x",), categorical=("label",), target="y")
    want = {v: i for i, v in enumerate(sorted(values))}
    for most in (256, 0):
        state = FeatureState.fit(df, roles, max_inline=most)
        state.save(spark, str(tmp_path / f"state{most}"))
        for s in (state, FeatureState.load(spark, str(tmp_path / f"state{most}"), roles, max_inline=most)):
            coded = s.apply(df.withColumn("raw", F.col("label"))).collect()
            assert {r.raw: r.label for r in coded if r.raw is not None} == want
            assert [r.label for r in coded if r.raw is None] == [None]


def test_ranks_keep_rows_with_null_keys(rows):
    unit = F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id"), F.lit(997)) / 997)
    assert hashed_rank(rows, unit, ["id"]).select("rank").distinct().count() == 200
    assert ordered_rank(rows.select(F.when(F.col("id") > 5, F.col("id")).alias("k")), "k").count() == 200


def test_a_column_without_values_on_one_side_has_drifted(spark):
    ref = spark.createDataFrame([(1.0, None, 1.0, "x", None)] * 10, "gone double, never double, half double, label string, nolabel string")
    cur = ref.select(F.lit(None).cast("double").alias("gone"), "never", F.when(F.rand(1) < 2, F.lit(None)).otherwise(F.lit(1.0)).alias("half"), "label", "nolabel")
    report = {r.column: r for r in drift.drift_report(ref, cur, ["gone", "never", "half"], ["label", "nolabel"]).collect()}
    assert {c: r.drifted for c, r in report.items()} == {"gone": True, "never": False, "half": True, "label": False, "nolabel": False}
    assert report["gone"].score == 1.0 and drift.overall(drift.drift_report(ref, cur, ["gone"], [])).first().alarm
    some = ref.withColumn("gone", F.when(F.monotonically_increasing_id() % 2 == 0, F.col("gone")))
    assert drift.drift_report(ref, some, ["gone"], []).first().drifted


def test_the_forest_does_not_depend_on_the_files(rows):
    df = rows.select((F.col("id") * 1.0).alias("x"), (F.col("id") % 11 * 1.0).alias("z"), (F.col("id") % 13 * 2.0).alias("y"))
    first = None
    for parts in (1, 3, 7):
        model = training.fit(df.repartition(parts), "rf", ["x", "z"], "y", n_estimators=5, max_depth=4, partitions=4)
        got = [r.prediction for r in training.predict(model, df.orderBy("x").limit(20)).orderBy("x").collect()]
        first = first or got
        assert got == first


def test_limits_are_refused_not_bent(spark):
    with pytest.raises(ValueError, match="max_depth"):
        training.fit(spark.range(5).select(F.col("id").alias("x"), F.col("id").alias("y")), "dt", ["x"], "y", max_depth=50)
    big = spark.range(3000).select(F.col("id").cast("double").alias("x"))
    out = explain.linear_attributions(big.withColumn("id", F.col("x")), "id", {"x": 2.0}, 1.0, big)
    assert out.agg(F.sum("contribution")).first()[0] == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError, match="grid_steps"):
        explain.grid_values(big, "x", most=100)


def test_repeated_folds_can_be_cross_validated(rows):
    df = split.with_folds(rows.select("id", (F.col("id") * 1.0).alias("x"), (F.col("id") * 2.0).alias("y")), "repeated", "id", k=3)
    folds = split.fold_frames(df, 3, "repeated")
    assert len(folds) == 9 and all(a.count() + b.count() == 200 for a, b in folds)
    scores = training.cross_validate(df, folds, "linear", ["x"], "y", train_scores=False).filter("metric = 'mae'")
    assert scores.count() == 9
    split_rows = df.withColumn("split", F.when(F.col("id") % 4 > 0, "train").otherwise("test"))
    train_rows = split.kfold(split_rows.filter("split = 'train'"), "id", 3)
    _, metrics = training.train(split_rows, ["x"], "y", "linear", folds=split.fold_frames(train_rows, 3))
    got = {r.split: r.cv_mae for r in metrics.collect()}
    assert got["test"] is None and got["train"] == pytest.approx(0.0, abs=1e-6)
