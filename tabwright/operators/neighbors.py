"""Exact nearest-neighbour regression, by bounds where they help and matrix products elsewhere.

Training rows are assigned to the nearest of a few pivots. For a query, pivot
distances and cell radii bound the distance of its k-th neighbour; cells that
lie beyond the bound cannot hold a neighbour and are not visited. Crowded cells
are cut and small ones put together, so that all blocks are about equal; queries
come in chunks. A task compares one block with one chunk by matrix products, whose
error is bounded, and takes exact distances of the few rows that may be nearest.
Tasks return k candidates per query, never pairs; a row travels once per block or
chunk, so the larger these are, the less is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.lineage import cut
from tabwright.operators.split import sample_rows
from tabwright.shipping import ship_active

SLACK = 1e-9
TILES = 48  # pairs of a block and a chunk, at least, where there are rows for them


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension (no cancellation)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j][:, None] - b[:, j][None, :]
        out += gap * gap
    return out


def _close(q: np.ndarray, t: np.ndarray, low: np.ndarray, high: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) places that hold the ``k`` nearest rows of every query with all ties of the k-th, and few others.

    Rows from ``low`` to ``high`` do not count for a query, nor do those beyond ``limit``, a squared
    distance that k rows are known to reach. Places come ordered by query.
    """
    qq, tt = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", t, t)
    whole = np.isfinite(t).all(axis=1)
    if np.isfinite(tt[whole]).all() and np.isfinite(qq[np.isfinite(q).all(axis=1)]).all():
        d = (-2.0 * q) @ t.T
        d += tt
        # rounding of a product and of the sums is below (dimensions + 4) units of |q|^2 + |t|^2 each
        slack = (8 * q.shape[1] + 32) * np.finfo("float64").eps * (qq + tt[whole].max(initial=0.0))
    else:  # squares overflow: distances may still be finite
        d, qq = _distances(q, t), np.zeros(len(q))
        slack = qq
    d[:, ~whole] = np.inf
    for step in range(int((high - low).max(initial=0))):
        asking = np.flatnonzero(low + step < high)
        d[asking, low[asking] + step] = np.inf
    near = limit - qq  # without the query's own square, as d
    fresh = np.flatnonzero(~np.isfinite(limit))
    if len(fresh) and k < d.shape[1]:
        some = d[fresh, : max(64 * k, 1024)]  # the k-th of some rows bounds the k-th of all
        if k < some.shape[1]:
            near[fresh] = np.partition(some, k - 1, axis=1)[:, k - 1]
    place = np.flatnonzero(d <= (near + slack)[:, None])
    place = place[np.isfinite(d.ravel()[place])]
    return np.divmod(place, d.shape[1])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in column])


def _assign(pivots: np.ndarray):
    ship_active()

    @F.pandas_udf("cell int, distance double")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            if len(vectors) == 0:
                yield pd.DataFrame({"cell": [], "distance": []})
                continue
            d = np.sqrt(_distances(_matrix(vectors), pivots))
            cell = d.argmin(axis=1)
            yield pd.DataFrame({"cell": cell.astype("int32"), "distance": d[np.arange(len(d)), cell]})

    return assign


def _route(pivots: np.ndarray, count: np.ndarray, near: np.ndarray, far: np.ndarray, k: int):
    """Cells that may hold one of the k nearest rows of a query."""

    @F.pandas_udf("array<int>")
    def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            if len(vectors) == 0:
                yield pd.Series([], dtype="object")
                continue
            d = np.sqrt(_distances(_matrix(vectors), pivots))
            reach = d + far[None, :]
            order = reach.argsort(axis=1)
            seen = np.cumsum(count[order], axis=1)
            enough = np.minimum((seen < k).sum(axis=1), len(pivots) - 1)
            bound = np.take_along_axis(np.take_along_axis(reach, order, 1), enough[:, None], 1)
            closest = np.maximum(np.maximum(d - far[None, :], near[None, :] - d), 0.0)
            visit = (closest <= bound * (1 + SLACK) + SLACK) & (count[None, :] > 0)
            yield pd.Series([np.flatnonzero(v).astype("int32").tolist() for v in visit])

    return route


def _blocks(count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per cell its first block and how many it has: crowded cells are cut, small ones share a block."""
    first, parts = np.zeros(len(count), dtype=int), np.ones(len(count), dtype=int)
    at, room = -1, 0
    for c, n in enumerate(int(v) for v in count):
        if n > size:
            parts[c] = math.ceil(n / size)
            first[c] = at + 1
            at, room = at + int(parts[c]), 0
        else:
            if n > room:
                at, room = at + 1, size
            first[c], room = max(at, 0), room - n
    return first, parts


def _per_cell(values: Sequence[int], cell: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), cell + 1)


def nearest(
    train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 5,
    pivots: int = 64, block: int = 65_536, exclude_self: bool = False, seed: int = 42,
) -> DataFrame:
    """(key, neighbor, distance, label, rank) of the k nearest training rows; equal distances go by key."""
    # no distance to a row with missing or infinite entries is finite, so it is nobody's neighbour
    train = train.filter(F.forall(F.col(vector), lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False))))
    picked = sample_rows(train.select(key, vector), key, pivots, seed).collect()
    centre = np.array([[float(x) for x in r[vector]] for r in picked])
    if not len(centre):
        raise ValueError("No training rows")
    wanted = k + 1 if exclude_self else k

    placed = train.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.col(label).cast("double").alias("_y"))
    placed = cut(placed.withColumn("_c", _assign(centre)("_v")).select("_id", "_v", "_y", "_c.cell", "_c.distance"))
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("lo"), F.max("distance").alias("hi")).collect()}
    cells = range(len(centre))
    count = np.array([stats[c]["n"] if c in stats else 0 for c in cells])
    near = np.array([stats[c]["lo"] if c in stats else 0.0 for c in cells])
    far = np.array([stats[c]["hi"] if c in stats else 0.0 for c in cells])

    asked = queries.select(F.col(key).alias("_q"), F.col(vector).cast("array<double>").alias("_qv"))
    asked = cut(asked.withColumn("_cells", _route(centre, count, near, far, wanted)("_qv")))
    first, parts = _blocks(count, block)
    n_blocks, n_asked = int((first + parts).max()), asked.count()
    chunks = max(1, math.ceil(n_asked / block), min(math.ceil(n_asked / 512), math.ceil(TILES / n_blocks)))
    tiles = max(n_blocks * chunks, int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    cell = F.col("cell")
    spread = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), n).cast("int")
    of_cell = lambda c: F.sequence(_per_cell(first, c), _per_cell(first, c) + _per_cell(parts, c) - 1)
    visited = F.array_distinct(F.flatten(F.transform("_cells", of_cell)))
    left = asked.withColumn("chunk", spread("_q", F.lit(chunks), 1)).withColumn("block", F.explode(visited))
    own_block = _per_cell(first, cell) + spread("_id", _per_cell(parts, cell), 2)
    right = placed.drop("distance").withColumn("block", own_block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    middle = np.nan_to_num(np.median(centre, axis=0), nan=0.0, posinf=0.0, neginf=0.0)  # any will do; a near one rounds less

    def closest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"_q": [], "_id": [], "_d2": [], "_y": []})
        if q.empty or t.empty:
            return empty
        t = _first_copies(t.sort_values("_id", kind="stable"), k + 1)
        ids, labels, points, homes = t["_id"].to_numpy(), t["_y"].to_numpy(), np.asfortranarray(_matrix(t["_v"])), t["cell"].to_numpy()
        names, asks = q["_q"].to_numpy(), _matrix(q["_qv"])
        at_cell = {c: np.flatnonzero(homes == c) for c in np.unique(homes)}
        visits = np.zeros((len(q), len(count)), dtype=bool)
        for i, some in enumerate(q["_cells"]):
            visits[i, np.asarray(some, dtype=int)] = True
        parts_ = []
        for low in range(0, len(q), 512):
            part = _best(asks[low : low + 512], names[low : low + 512], visits[low : low + 512], points, ids, at_cell, middle, k, exclude_self)
            query, row, d2 = part
            parts_.append(pd.DataFrame({"_q": names[low : low + 512][query], "_id": ids[row], "_d2": d2, "_y": labels[row]}))
        return pd.concat(parts_, ignore_index=True)

    types = dict(placed.dtypes)["_id"]
    keys = ["block", "chunk"]
    left, right = left.repartition(tiles, *keys), right.repartition(tiles, *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(closest, f"_q {types}, _id {types}, _d2 double, _y double")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy("_d2", "_id"))
    top = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.select(F.col("_q").alias(key), F.col("_id").alias("neighbor"), F.sqrt("_d2").alias("distance"), F.col("_y").alias("label"), "rank")


def _first_copies(t: pd.DataFrame, n: int) -> pd.DataFrame:
    """Of rows with one vector the ``n`` smallest keys: only these can be among the nearest."""
    if t["_id"].duplicated().any():
        return t
    same = pd.Series([np.asarray(v, dtype="float64").tobytes() for v in t["_v"]], index=t.index)
    return t[t.groupby(same, sort=False).cumcount() < n]


def _best(
    asks: np.ndarray, names: np.ndarray, visits: np.ndarray, points: np.ndarray, ids: np.ndarray, at_cell: dict[int, np.ndarray],
    middle: np.ndarray, k: int, exclude_self: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of the k nearest visited rows per query, by distance and then by id; rows are sorted by id."""
    n = len(asks)
    best_row, best_d = np.full((n, k), -1), np.full((n, k), np.inf)
    columns = points.T
    common = [c for c in at_cell if visits[:, c].all()]  # such cells need no products of their own
    groups = [(slice(None), np.sort(np.concatenate([at_cell[c] for c in common])))] if common else []
    groups += [(visits[:, c], rows) for c, rows in at_cell.items() if c not in common]
    for who, rows in groups:
        some = np.arange(n)[who]
        for low in range(0, len(rows) if len(some) else 0, 8192):
            part = rows[low : low + 8192]
            none = np.zeros(len(some), dtype=int)
            own = [np.searchsorted(ids[part], names[some], side=side) for side in ("left", "right")] if exclude_self else [none, none]
            query, row = _close(asks[some] - middle, points[part] - middle, *own, best_d[some, -1], k)
            if not len(query):
                continue
            gap = np.zeros(len(query))
            a, t = some[query], part[row]
            for j in range(asks.shape[1]):  # summed as in _distances
                gap += (asks[:, j].take(a) - columns[j].take(t)) ** 2
            held, slot = np.nonzero(best_row[some] >= 0)
            who = np.concatenate([some[held], some[query]])
            row = np.concatenate([best_row[some[held], slot], part[row]])
            gap = np.concatenate([best_d[some[held], slot], gap])
            known = np.isfinite(gap)
            who, row, gap = who[known], row[known], gap[known]
            order = np.lexsort((row, gap, who))
            who, row, gap = who[order], row[order], gap[order]
            start = np.searchsorted(who, who, side="left")
            rank = np.arange(len(who)) - start
            kept = rank < k
            best_row[some], best_d[some] = -1, np.inf
            best_row[who[kept], rank[kept]], best_d[who[kept], rank[kept]] = row[kept], gap[kept]
    query, slot = np.nonzero(best_row >= 0)
    return query, best_row[query, slot], best_d[query, slot]


def knn_regression(train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 5, **options) -> DataFrame:
    """(key, prediction): mean label of the k nearest training rows."""
    found = nearest(train, queries, key, vector, label, k, **options)
    return found.groupBy(key).agg(F.avg("label").alias("prediction"))
