import pytest
from pyspark.sql import functions as F

from tabwright.operators import checks, outliers, profile
from tabwright.operators.features import FeatureState
from tabwright.plans import bindings as b
from tabwright.roles import Roles

ROLES = Roles(numerical=("temp", "hum"), categorical=("season", "weather"), target="cnt")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(100).select(
        "id",
        (F.col("id") % 17 + 10.0).alias("temp"),
        (F.col("id") % 23 * 2.0).alias("hum"),
        (F.col("id") % 4 + 1).cast("int").alias("season"),
        (F.col("id") % 13).cast("int").alias("weather"),
        (F.col("id") * 10.0).alias("cnt"),
        F.date_format(F.date_add(F.lit("2023-01-01"), F.col("id").cast("int")), "dd-MM-yyyy").alias("dteday"),
    )


def test_validate_errors(spark, rows):
    with pytest.raises(ValueError, match="empty"):
        checks.validate(rows.limit(0), ROLES)
    with pytest.raises(ValueError, match="Missing required columns"):
        checks.validate(rows.drop("hum"), ROLES)
    with pytest.raises(ValueError, match="should be numeric"):
        checks.validate(rows.withColumn("hum", F.lit("x")), ROLES)
    warnings = {(r["check"], r["column"]) for r in checks.validate(rows, ROLES).collect()}
    assert warnings == {("numeric_categorical", "season"), ("numeric_categorical", "weather")}


def test_schema_and_model_input(rows):
    assert checks.has_schema(rows, ["temp", "hum"]) and not checks.has_schema(rows, ["nothing"])
    assert checks.is_model_input(rows, ["temp"]) and not checks.is_model_input(rows, ["dteday"])
    assert checks.feature_list(rows, ROLES) == ["season", "weather", "temp", "hum"]
    assert "dteday" in checks.feature_list(rows, ROLES, "all")


def test_codes_follow_typed_order(rows):
    state = FeatureState.fit(rows, ROLES)
    assert state.labels["weather"].inline == {i: i for i in range(13)}
    assert state.labels["season"].inline == {1: 0, 2: 1, 3: 2, 4: 3}


def test_long_vocabularies_get_the_same_codes(rows):
    short = FeatureState.fit(rows, ROLES).apply(rows).select("id", "season", "weather")
    long = FeatureState.fit(rows, ROLES, max_inline=0)
    assert long.labels["weather"].table is not None
    assert long.apply(rows).select("id", "season", "weather").exceptAll(short).count() == 0


def test_scaling_uses_population_std(rows):
    out = FeatureState.fit(rows, ROLES).apply(rows).agg(F.avg("temp").alias("m"), F.stddev_pop("temp").alias("s")).first()
    assert out["m"] == pytest.approx(0.0, abs=1e-12) and out["s"] == pytest.approx(1.0)


def test_constant_column_scales_to_zero(rows):
    flat = rows.withColumn("hum", F.lit(3.0))
    out = FeatureState.fit(flat, ROLES).apply(flat)
    assert out.filter("hum <> 0").count() == 0


def test_unfitted_state_refuses(rows):
    with pytest.raises(ValueError, match="not fitted"):
        FeatureState(ROLES).apply(rows)


@pytest.mark.parametrize("max_inline", [256, 0])
def test_unseen_label_policies(rows, max_inline):
    state = FeatureState.fit(rows, ROLES, max_inline=max_inline)
    odd = rows.withColumn("season", F.when(F.col("id") == 7, 9).otherwise(F.col("season")))
    with pytest.raises(Exception, match="unseen label"):
        state.apply(odd).collect()
    assert state.apply(odd, unseen="keep").filter("season = -1").count() == 1
    assert state.apply(odd, unseen="drop").count() == 99


def test_state_round_trip(spark, rows, tmp_path):
    state = FeatureState.fit(rows, ROLES)
    state.save(spark, str(tmp_path / "state"))
    again = FeatureState.load(spark, str(tmp_path / "state"), ROLES)
    assert again.scaler == state.scaler and again.feature_names == state.feature_names
    assert again.apply(rows).exceptAll(state.apply(rows)).count() == 0


def test_outliers(rows):
    spiky = rows.withColumn("temp", F.when(F.col("id") == 0, 1000.0).otherwise(F.col("temp")))
    clipped = outliers.handle_outliers(spiky, ["temp"], "iqr")
    assert clipped.count() == 100 and clipped.agg(F.max("temp")).first()[0] < 50
    assert outliers.handle_outliers(spiky, ["temp"], "zscore", 3.0).count() == 99
    with pytest.raises(ValueError, match="Unknown outlier"):
        outliers.handle_outliers(rows, ["temp"], "magic")


def test_batch_and_fitted_group_means_agree_on_the_training_table(rows):
    state = FeatureState(ROLES).fit_derived(rows)
    cols = ["id", F.round("temp_season_adjusted", 9)]
    assert state.derive(rows).select(*cols).exceptAll(state.derive(rows, "batch").select(*cols)).count() == 0


def test_single_request_gets_the_fitted_mean(rows):
    state = FeatureState(ROLES).fit_derived(rows)
    one = rows.filter("id = 5")
    assert state.derive(one, "batch").first()["temp_season_adjusted"] == 0.0
    assert state.derive(one).first()["temp_season_adjusted"] != 0.0


def test_duplicates_and_missing_on_empty(spark):
    none = spark.createDataFrame([], "a int, b double")
    assert profile.duplicate_rate(none).first()["duplicate_rate"] == 0.0
    assert profile.missing_rate(none).first()["missing_per_row"] == 0.0


def test_duplicates_treat_nulls_as_equal(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert profile.duplicate_rate(rows).first()["n_duplicates"] == 1


def test_missing_request_fields_are_rejected(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, None), (3, 7.0)], "id int, temp double")
    valid, rejected = checks.split_by_ranges(rows, {"temp": (0, 1), "hum": (0, 1)})
    assert valid.count() == 0
    found = {r["id"]: r["violations"] for r in rejected.collect()}
    assert found[2] == ["temp is missing", "hum is missing"] and "temp out of range" in found[3]


def test_demand_columns(spark, sf_dir):
    assert set(b.DEMAND_ROLES.required) <= set(b.demand(spark, sf_dir).columns)
