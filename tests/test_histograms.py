import math
import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import drift
from tabwright.operators.histograms import Bins, binned_drift, cells, histogram, histogram_drift, merged


def _tables(spark, seed):
    """Two tables of continuous, tied, constant, shifted and partly missing columns."""
    rng = random.Random(seed)

    def rows(n, shift):
        return [
            (rng.gauss(shift, 1), float(rng.randrange(5)), 7.0, rng.random() ** 3 + shift,
             rng.choice([None, math.nan, rng.random()]), rng.choice([1e9 + rng.random(), 1e9 + 5.0]))
            for _ in range(n)
        ]

    schema = "normal double, tied double, constant double, skewed double, holes double, far double"
    return spark.createDataFrame(rows(700, 0.0), schema), spark.createDataFrame(rows(400, 0.3), schema)


def _distances(ref, cur):
    """Kolmogorov-Smirnov and Wasserstein distances from their definition, over all values."""
    ref, cur = ([x for x in side if x is not None and not math.isnan(x)] for side in (ref, cur))
    values = sorted({*ref, *cur})
    gaps = [sum(x <= v for x in ref) / len(ref) - sum(x <= v for x in cur) / len(cur) for v in values]
    mean = sum(ref) / len(ref)
    std = math.sqrt(sum((x - mean) ** 2 for x in ref) / len(ref))
    area = sum(abs(g) * (b - a) for g, a, b in zip(gaps, values, values[1:]))
    return max(map(abs, gaps)), area / max(std, 0.001)


@pytest.mark.parametrize("bins", [2, 10, 100])
def test_exact_distances_lie_within_the_stated_error(spark, bins):
    ref, cur = _tables(spark, bins)
    found = {r.column: r for r in binned_drift(ref, cur, ref.columns, Bins.fit(ref, ref.columns, bins, 2)).collect()}
    there, here = ref.toPandas(), cur.toPandas()
    for c in ref.columns:
        ks, wasserstein = _distances(list(there[c]), list(here[c]))
        r = found[c]
        slack = 1e-6 if c == "far" else 1e-9  # sums around 1e9 keep fewer digits
        assert r.ks - slack <= ks <= r.ks + r.ks_error + slack, c
        assert r.wasserstein - slack <= wasserstein <= r.wasserstein + r.wasserstein_error + slack, c
    assert found["constant"].ks == found["constant"].wasserstein == found["constant"].wasserstein_error == 0
    if bins == 100:
        assert found["tied"].ks_error == found["tied"].wasserstein_error == 0
        assert all(r.ks_error < 0.1 and r.wasserstein_error < 0.1 for r in found.values())
    gone = there["holes"].isna().mean()
    assert abs(found["holes"].missing_ref - gone) < 1e-12


def test_histograms_of_parts_merge_into_that_of_the_whole(spark):
    ref, cur = _tables(spark, 3)
    bins = Bins.fit(ref, ref.columns)
    parts = cur.withColumn("part", F.monotonically_increasing_id() % 5)
    together = merged(histogram(parts, bins, ["part"]).drop("part"))
    names = ["column", "bin", "n", F.round("total", 6).alias("total"), "low", "high"]
    assert together.select(*names).exceptAll(histogram(cur, bins).select(*names)).count() == 0
    one, other = (histogram_drift(histogram(ref, bins), h, bins).orderBy("column").collect() for h in (together, histogram(cur, bins)))
    assert all(abs(a.wasserstein - b.wasserstein) < 1e-9 and a.ks == b.ks for a, b in zip(one, other))


def test_flags_are_those_of_the_exact_mode_even_near_the_threshold(spark):
    ref, cur = _tables(spark, 5)
    exact = {r.column: r for r in drift.drift_report(ref, cur, ref.columns, [], exact=True).collect()}
    coarse = Bins.fit(ref, ref.columns, 2, 2)
    for threshold in (exact["normal"].score, exact["skewed"].score + 1e-6, 0.1):
        want = {r.column: r.drifted for r in drift.drift_report(ref, cur, ref.columns, [], threshold, exact=True).collect()}
        got = {r.column: r.drifted for r in drift.drift_report(ref, cur, ref.columns, [], threshold, bins=coarse).collect()}
        assert got == want


def test_sides_without_values(spark):
    rows = spark.createDataFrame([(1.0, None), (2.0, None), (math.nan, None)], "a double, b double")
    none = rows.filter("false")
    bins = Bins.fit(rows, ["a", "b"])
    for ref, cur, a in ((rows, none, 1.0), (none, rows, 1.0), (none, none, 0.0)):
        found = {r.column: r for r in binned_drift(ref, cur, ["a", "b"], bins).collect()}
        assert found["a"].ks == found["a"].wasserstein == found["a"].psi == a
        assert found["b"].ks == 0 and found["b"].missing_ref == found["b"].missing_cur == 1
    assert binned_drift(none, rows, ["a"]).first().ks == 1


def test_edges_and_missing_values_have_bins_of_their_own(spark):
    values = spark.createDataFrame([(x,) for x in (-math.inf, 0.0, 1.0, 1.5, 2.0, 9.0, math.inf, math.nan, None)], "x double")
    got = [r.bin for r in cells(values.coalesce(1), Bins.on_edges(values, {"x": [1.0, 2.0, 3.0]})).collect()]
    assert got == [0, 0, 1, 2, 3, 6, 6, -2, -1]
    assert cells(values, Bins.on_edges(values, {"x": []})).select("bin").distinct().count() == 3


def test_no_values_are_shuffled(spark):
    ref, _ = _tables(spark, 1)
    plan = histogram(ref, Bins.fit(ref, ref.columns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
