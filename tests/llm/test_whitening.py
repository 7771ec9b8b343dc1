import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import whitening

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows):
    """The whole covariance in fractions, then LAPACK on it."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    gaps = np.array([[n * a - s for a, s in zip(x, sums)] for x in distinct], dtype=object)
    cov = (gaps.T @ gaps) / Fraction(n**3)
    cov = np.array([[float(v) for v in row] for row in cov])
    values, vectors = np.linalg.eigh(cov)
    return kept, n, sums, values[::-1], vectors[:, ::-1]


def check(spark, rows, k=16):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = whitening.whitened(df.withColumns({c: F.lit("x") for c in ("x", "rows", "n", "component", "sums")})).collect()
    kept, n, sums, values, vectors = brute(rows)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    k = min(k, sum(values > 1e-13 * values.sum()))
    assert set(by_row) == {i for i, _ in kept} and len(got) == len(kept) * k
    table = np.array([[by_row[i][c].whitened for c in range(1, k + 1)] for i, _ in kept])
    want = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for _, x in kept]) @ vectors[:, :k] / np.sqrt(values[:k])
    sign = np.sign((table * want).sum(axis=0))
    assert np.abs(table - want * sign).max() < 1e-7
    for i, x in kept:
        r = by_row[i][1]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums)) and r.identity_error < 1e-9
    for c in range(1, k + 1):
        assert by_row[kept[0][0]][c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)


def vectors(seed, rows, d, clusters=4):
    rng = np.random.default_rng(seed)
    return (rng.normal(0, 1, (clusters, d))[rng.integers(0, clusters, rows)] + rng.normal(0, 0.4, (rows, d))).tolist()


def test_more_dimensions_than_the_block(spark):
    check(spark, list(enumerate(vectors(1, 700, 48))))


def test_few_dimensions_and_faulty_rows(spark):
    rows = list(enumerate(vectors(2, 60, 5))) + [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    check(spark, rows + [(200 + k, rows[0][1]) for k in range(40)])


def test_low_rank(spark):
    rng = np.random.default_rng(4)
    whole = rng.integers(-40, 40, (90, 3)) @ rng.integers(-3, 4, (3, 40))
    check(spark, [(k, (v / 64).tolist()) for k, v in enumerate(whole)])


def test_other_lengths_null_ids_and_no_variance(spark):
    rows = [(None, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [2.0, 2.5]), (3, []), (4, [1.0, 2.0, 3.0])]
    got = whitening.whitened(spark.createDataFrame(rows, ROWS)).collect()
    assert {r.vec_id for r in got} == {None, 1, 2} and len(got) == 6
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0])] * 3, ROWS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None)], ROWS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([], ROWS)).collect() == []


def test_entries_beyond_longs_times_rows():
    x = np.array([[1 << 62, 5], [-(1 << 62), 7]])
    n, sums = 2, [0, 12]
    assert whitening.deviations(x, n, sums) == [(1 << 63) ** 2 + 4, (1 << 63) ** 2 + 4]
    assert whitening.centred(x, n, sums).tolist() == [[float(1 << 62), -1.0], [-float(1 << 62), 1.0]]
