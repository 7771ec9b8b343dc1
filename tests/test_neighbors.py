"""Nearest neighbours by matrix products equal those of exact distances, ties and odd values included."""

import numpy as np
import pytest

from tabwright.operators import neighbors


def _want(ids, x, y, k, exclude):
    out = {}
    for i, q in zip(ids, x):
        d = neighbors._distances(q[None, :], x)[0]
        d[(ids == i) & exclude] = np.inf
        order = [j for j in np.lexsort((ids, d)) if np.isfinite(d[j])][:k]
        out[i] = [(ids[j], float(np.sqrt(d[j])), y[j]) for j in order]
    return out


def _check(spark, ids, x, y, k=5, exclude=True, **options):
    rows = spark.createDataFrame([(int(i), [float(v) for v in r], float(w)) for i, r, w in zip(ids, x, y)], "id long, v array<double>, y double").repartition(3)
    found = neighbors.nearest(rows, rows, "id", "v", "y", k, exclude_self=exclude, **options).orderBy("id", "rank").collect()
    got = {i: [] for i in ids}
    for r in found:
        got[r["id"]].append((r["neighbor"], r["distance"], r["label"]))
    assert got == _want(ids, x, y, k, exclude)


@pytest.mark.parametrize("block", [40, 65_536])
@pytest.mark.parametrize("kind", ["far from zero", "copies", "grid", "odd"])
def test_nearest_are_exact(spark, kind, block):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6))
    if kind == "far from zero":
        x = 1e7 + x  # squares cancel in a matrix product
    if kind == "copies":
        x[:200] = x[0]
    if kind == "grid":
        x = rng.integers(0, 2, size=(300, 6)).astype("float64")  # ties everywhere
    if kind == "odd":
        x[5, 2], x[6, 1], x[7], x[8] = np.nan, np.inf, 1e100, -1e100
    with np.errstate(over="ignore", invalid="ignore"):
        _check(spark, rng.permutation(300), x, rng.random(300), block=block, pivots=8)


def test_rows_travel_once_per_block(spark, monkeypatch):
    """A table of one block is met in a few tiles; before, each query was sent to every cell."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 32))
    rows = spark.createDataFrame([(i, r.tolist(), 0.0) for i, r in enumerate(x)], "id long, v array<double>, y double")
    plan = neighbors.nearest(rows, rows, "id", "v", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "cell" in plan and "block" in plan
    count = np.array([3, 0, 200, 40, 50, 10])
    first, parts = neighbors._blocks(count, 100)
    assert first.tolist() == [0, 0, 1, 3, 3, 3] and parts.tolist() == [1, 1, 2, 1, 1, 1]


def test_copies_do_not_flood_a_task():
    """Of copies of one vector only k + 1 are compared."""
    import pandas as pd

    t = pd.DataFrame({"_id": range(1000), "_v": [np.ones(4)] * 999 + [np.zeros(4)]})
    assert neighbors._first_copies(t, 6)["_id"].tolist() == [0, 1, 2, 3, 4, 5, 999]


def test_squares_that_overflow():
    t = np.array([[1e160, 0.0], [1e160 * (1 + 1e-15), 0.0], [0.0, 1.0]])
    none = np.zeros(1, dtype=int)
    with np.errstate(over="ignore", invalid="ignore"):
        query, row = neighbors._close(t[:1], t, none, none + 1, np.array([np.inf]), 1)
    assert query.tolist() == [0] and row.tolist() == [1]
