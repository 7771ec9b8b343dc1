import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.operators import quantiles, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one group and one value."""
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 1009).cast("double")).alias("x"),
    )
    return rows.repartition(5)


def test_hashed_rank_is_a_permutation_within_groups(skewed):
    ranked = ranking.hashed_rank(skewed, unit_hash(F.col("id")), ["id"], by=["g"]).toPandas()
    assert len(ranked) == 3000
    for _, part in ranked.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))


def test_hashed_rank_ignores_partitioning(skewed):
    one = ranking.hashed_rank(skewed, unit_hash(F.col("id")), ["id"]).select("id", "rank")
    two = ranking.hashed_rank(skewed.repartition(13), unit_hash(F.col("id")), ["id"], buckets=3).select("id", "rank")
    assert one.exceptAll(two).count() == 0


def test_ordered_rank(skewed):
    ranked = ranking.ordered_rank(skewed, "id").select("id", "rank").toPandas()
    assert (ranked["rank"] == ranked["id"] + 1).all()


def test_running_totals(spark):
    rows = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") * 3).alias("v"), F.lit(2).alias("n"))
    got = ranking.running_totals(rows, ["k"], "v", ["n"], parts=6).toPandas().sort_values(["k", "v"])
    for _, part in got.groupby("k"):
        assert part["upto_n"].tolist() == list(range(2, 2 * len(part) + 1, 2))
        assert part["next"].tolist()[:-1] == part["v"].tolist()[1:]


@pytest.mark.parametrize("max_counters", [10**6, 1])
def test_quantiles_are_exact_on_both_paths(skewed, max_counters):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["value"] for r in quantiles.quantiles(skewed, ["x"], probs, max_counters=max_counters).collect()}
    x = np.array([r["x"] for r in skewed.select("x").collect()])
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p))


def test_grouped_quantiles_agree_on_both_paths(skewed):
    a = quantiles.quantiles(skewed, ["x"], [0.3, 0.5], by=["g"])
    c = quantiles.quantiles(skewed, ["x"], [0.3, 0.5], by=["g"], max_counters=1)
    near = lambda d: {(r["g"], r["prob"]): round(r["value"], 9) for r in d.collect()}
    assert near(a) == near(c)
