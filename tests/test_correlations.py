import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.operators import joins, profile


@pytest.mark.parametrize("heavy", [0.001, 0.2, 2.0])
def test_mid_ranks_equal_pandas(spark, monkeypatch, heavy):
    monkeypatch.setattr(joins, "HEAVY", heavy)
    rng = np.random.default_rng(3)
    table = pd.DataFrame({"a": rng.integers(0, 5, 800) * 1.0, "b": rng.normal(size=800), "c": np.where(rng.random(800) < 0.5, 7.0, rng.random(800))})
    table.loc[::90, "b"] = np.nan
    table.loc[3, "a"] = -0.0
    df = spark.createDataFrame([[None if math.isnan(v) and i % 2 else v for v in r] for i, r in enumerate(table.to_numpy().tolist())], "a double, b double, c double")
    whole = table.dropna()
    want = whole.corr("spearman")
    got = profile.correlations(df.withColumns({"n": F.lit("x"), "column": F.lit(1)}), ("a", "b", "c"), "spearman").collect()
    assert len(got) == 3
    for r in got:
        assert r.correlation == pytest.approx(want.loc[r.a, r.b], abs=1e-12)
    ranks = sorted(tuple(r) for r in profile.mid_ranks(df, ("a", "b", "c")).select("_r0", "_r1", "_r2").collect())
    assert ranks == sorted(map(tuple, whole.rank().to_numpy().tolist()))


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert math.isnan(profile.correlations(df, ("a", "b"), "spearman").first()["correlation"])
    assert profile.correlations(df, ("a", "b"), "pearson").first()["correlation"] is None
    assert math.isnan(profile.correlations(df.filter("a > 5"), ("a", "b"), "spearman").first()["correlation"])


def test_spread_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v int")
    right = spark.createDataFrame([(None, 2, "x"), ("a", 1, "y")], "k string, n long, w string")
    assert sorted((r.v, r.w) for r in joins.spread_join(left, right, "k", "n").collect()) == [(1, "x"), (2, "x"), (3, "y")]
