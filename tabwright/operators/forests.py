"""Regression trees without a depth limit: large nodes by histograms, what is left of a tree in one task.

``pyspark.ml`` sends a histogram of all features from every partition for every node, also for
one of two rows, and keeps all nodes on the driver. Trees that grow until their leaves are pure
have about as many nodes as rows. Here only nodes of more than LOCAL_ROWS rows are split by
histograms that are summed over the partitions; the rows of a smaller one meet in one task,
which finishes it. The finished parts stay a table on the executors, and rows that are to be
predicted travel to them.

Bins, gain and stopping are those of ``pyspark.ml``: a threshold between any two values of a
feature that has at most ``max_bins`` of them, otherwise at equal shares (of all rows, not of some);
the largest decrease of variance; Poisson(1) draws for bagging, by tree and block of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabwright.operators.quantiles import quantile_literals
from tabwright.shipping import ship

BLOCK_ROWS = 65_536  # rows that travel together to a fit
SCORED_ROWS = 16_384  # and to a prediction
LOCAL_ROWS = 250_000  # rows of a node, repeats counted, that one task finishes
MOST_TASKS = 2_000
MOST_VALUES = 2_000  # of a feature in a partition that are counted one by one

Nodes = tuple[np.ndarray, np.ndarray, np.ndarray]  # feature (-1 in a leaf), cut, left child; the right one is next to it

_VALUES = "n long, feature int, seen binary, counts binary"
_BLOCK = "block long, x binary, y binary"
_SUMS = "tree int, node int, part int, sums binary, low binary, high binary"
_CUT = "tree int, node int, feature int, cut int, n_left long, n_right long"
_SHIPPED = "tree int, node long, block long, x binary, y binary, w binary"
_GROWN = "tree int, node long, feature binary, cut binary, value binary"
_ROUTED = "tree int, node long, block long, rows binary, place binary, x binary"
_SCORED = "tree int, node long, block long, rows binary, place binary, value binary"


@dataclass(frozen=True)
class Shape:
    """How trees are grown; ``edges`` are the thresholds of every feature."""

    edges: tuple[np.ndarray, ...]
    depth: int
    least: int
    seed: int
    bagged: bool

    @property
    def code(self) -> np.dtype:
        return np.dtype("uint8" if max(map(len, self.edges)) < 256 else "uint16")

    def codes(self, table: pa.Table, features: Sequence[str]) -> np.ndarray:
        """Features x rows: how many thresholds lie below a value."""
        out = np.empty((len(features), table.num_rows), self.code)
        for j, (f, edges) in enumerate(zip(features, self.edges)):
            x = table.column(f).to_numpy()
            if np.isnan(x).any():
                raise ValueError(f"Feature {f} has missing values")
            out[j] = np.searchsorted(edges, x, side="left")
        return out

    def unpacked(self, x: bytes) -> np.ndarray:
        return np.frombuffer(x, self.code).reshape(len(self.edges), -1)

    def drawn(self, tree: int, block: int, n: int) -> np.ndarray:
        """How often a tree takes each row of a block."""
        if not self.bagged:
            return np.ones(n, "uint8")
        return np.random.default_rng([self.seed & (2**64 - 1), tree, block]).poisson(1.0, n).astype("uint8")


def _batch(schema: str, *columns: Sequence) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    known = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, known[k]) for c, k in zip(columns, kinds)], list(names))


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows each and a rest, whatever the size of the batches."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            while t.num_rows >= rows:
                yield t.slice(0, rows)
                t = t.slice(rows)
            held, n = t.to_batches(), t.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _numbered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.Table]]:
    part = TaskContext.get().partitionId()
    for i, t in enumerate(_chunks(batches, rows)):
        yield part << 32 | i, t


# -- growing ----------------------------------------------------------------------


def _walk(nodes: Nodes, x: np.ndarray) -> np.ndarray:
    """The leaf that each row comes to."""
    feature, cut, left = nodes
    at = np.zeros(x.shape[1], "int32")
    live = np.arange(x.shape[1]) if feature[0] >= 0 else np.zeros(0, "int64")
    while live.size:
        node = at[live]
        at[live] = left[node] + (x[feature[node], live] > cut[node])
        live = live[feature[at[live]] >= 0]
    return at


def _best(sums: Callable[[int], tuple[np.ndarray, np.ndarray]], d: int, n: np.ndarray, s: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, cut) of the largest gain for every node; -1 where nothing is gained.

    ``sums(f)`` has counts and label sums, nodes x bins; ``n`` and ``s`` those of whole nodes.
    """
    feature, cut, best = np.full(len(n), -1, "int16"), np.zeros(len(n), "int32"), s * s / n
    for f in range(d):
        count, total = sums(f)
        if count.shape[1] < 2:
            continue
        lower, ls = np.cumsum(count[:, :-1], axis=1), np.cumsum(total[:, :-1], axis=1)
        upper, us = n[:, None] - lower, s[:, None] - ls
        ok = (lower >= least) & (upper >= least)
        score = np.where(ok, ls * ls / np.maximum(lower, 1) + us * us / np.maximum(upper, 1), -np.inf)
        j = score.argmax(axis=1)
        found = score[np.arange(len(n)), j]
        better = found > best
        feature[better], cut[better], best[better] = f, j[better], found[better]
    return feature, cut


def _histogram(nodes: np.ndarray, k: int, codes: np.ndarray, bins: int, w: np.ndarray, wy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = nodes * bins + codes
    return tuple(np.bincount(at, v, k * bins).reshape(k, bins) for v in (w, wy))


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, shape: Shape, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, value) of the nodes level by level; the k-th node that is split has the children 1 + 2k and 2 + 2k.

    A node ends where its labels are equal, nothing is gained, or ``depth`` is reached.
    """
    bins = [len(e) + 1 for e in shape.edges]
    cells = max(1, 250_000 // max(bins))  # nodes whose histograms are held at a time
    out: list[tuple[np.ndarray, ...]] = []
    starts = np.zeros(1, "int64")
    w = w.astype("float64")
    while len(starts):
        wy = w * y
        n, s = np.add.reduceat(w, starts), np.add.reduceat(wy, starts)
        feature, cut = np.full(len(starts), -1, "int16"), np.zeros(len(starts), "int32")
        ends = np.append(starts[1:], len(y))
        mixed = (np.minimum.reduceat(y, starts) < np.maximum.reduceat(y, starts)) & (n >= 2 * shape.least)
        asked = np.flatnonzero(mixed) if len(out) < depth else np.zeros(0, "int64")
        for i in range(0, len(asked), cells):
            some = asked[i : i + cells]
            k, sizes = len(some), (ends - starts)[some]
            own = np.repeat(np.arange(k), sizes)
            rows = np.arange(sizes.sum()) + np.repeat(starts[some] - np.append(0, np.cumsum(sizes)[:-1]), sizes)
            xs, ws, wys = x[:, rows], w[rows], wy[rows]
            feature[some], cut[some] = _best(lambda f: _histogram(own, k, xs[f], bins[f], ws, wys), len(bins), n[some], s[some], shape.least)  # noqa: B023
        split = feature >= 0
        out.append((feature, cut, s / n))
        node = np.repeat(np.arange(len(starts)), ends - starts)
        kept = np.flatnonzero(split[node])
        node = node[kept]
        child = 2 * (np.cumsum(split) - 1)[node] + (x[feature[node], kept] > cut[node])
        order = np.argsort(child, kind="stable")
        x, y, w = x[:, kept[order]], y[kept[order]], w[kept[order]]
        starts = np.append(0, np.cumsum(np.bincount(child, minlength=2 * split.sum()))[:-1]) if len(kept) else starts[:0]
    return tuple(np.concatenate(part) for part in zip(*out))


def _thresholds(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Middles between values: all of them, or those nearest to equal shares, as ``pyspark.ml`` takes them."""
    middles = values[:-1] + (values[1:] - values[:-1]) / 2
    if len(values) <= max_bins:
        return middles
    share, below, out = counts.sum() / max_bins, np.cumsum(counts), []
    for i in range(len(middles)):
        target = share * (len(out) + 1)
        if abs(below[i] - target) < abs(below[i + 1] - target):
            out.append(middles[i])
    return np.array(out)


def _edges(rows: DataFrame, features: Sequence[str], max_bins: int) -> tuple[int, tuple[np.ndarray, ...]]:
    """Number of rows, and the thresholds of every feature, from all rows."""
    d, most = len(features), max(max_bins, MOST_VALUES)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, [_merged([]) for _ in features]
        for b in batches:
            n += b.num_rows
            for j, f in enumerate(features):
                if len(seen[j][0]) <= most:
                    seen[j] = _merged([seen[j], np.unique(b.column(f).to_numpy(zero_copy_only=False), return_counts=True)])
        few = [s if len(s[0]) <= most else None for s in seen]
        yield _batch(_VALUES, [n] * d, range(d), *([s and s[i].tobytes() for s in few] for i in (0, 1)))

    found: list[list] = [[] for _ in features]
    n = 0
    for size, j, v, c in rows.mapInArrow(counted, _VALUES).collect():
        found[j].append(None if v is None else (np.frombuffer(v), np.frombuffer(c, "int64")))
        n += size if j == 0 else 0
    many = [f for f, parts in zip(features, found) if any(p is None for p in parts)]
    cuts = quantile_literals(rows, many, [i / max_bins for i in range(1, max_bins)]) if many else {}
    edges = [np.unique(cuts[f]) if f in cuts else _thresholds(*_merged(parts), max_bins) for f, parts in zip(features, found)]
    return n, tuple(e[np.isfinite(e)] for e in edges)


def _merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Values in order and how often they come, from such of parts."""
    values, place = np.unique(np.concatenate([np.zeros(0), *(v for v, _ in parts)]), return_inverse=True)
    counts = np.zeros(len(values), "int64")
    np.add.at(counts, place, np.concatenate([np.zeros(0, "int64"), *(c for _, c in parts)]))
    return values, counts


def _upper_nodes(blocks: DataFrame, n: int, trees: int, shape: Shape) -> list[Nodes]:
    """The trees down to nodes that one task can finish, each level from one pass over the rows."""
    tops = [[[-1], [0], [0], [0]] for _ in range(trees)]  # the last is a node's depth
    offsets = np.append(0, np.cumsum([len(e) + 1 for e in shape.edges]))
    wanted = {t: [0] for t in range(trees) if n > LOCAL_ROWS and shape.depth > 0}
    while wanted:
        partial = {t: (_nodes(tops[t]), np.array(nodes)) for t, nodes in wanted.items()}

        def sums(batches: Iterator[pa.RecordBatch], partial=partial) -> Iterator[pa.RecordBatch]:
            kept = {t: [np.zeros((len(at), 2, offsets[-1])), np.full(len(at), np.inf), np.full(len(at), -np.inf)] for t, (_, at) in partial.items()}
            for b in batches:
                for block, xb, yb in zip(*(b.column(c).to_pylist() for c in ("block", "x", "y"))):
                    x, y = shape.unpacked(xb), np.frombuffer(yb)
                    for t, (nodes, asked) in partial.items():
                        w = shape.drawn(t, block, len(y))
                        place = np.full(len(nodes[0]), -1)
                        place[asked] = np.arange(len(asked))
                        own = place[_walk(nodes, x)]
                        rows = np.flatnonzero((own >= 0) & (w > 0))
                        own, xs, ys, ws = own[rows], x[:, rows], y[rows], w[rows].astype("float64")
                        total, low, high = kept[t]
                        for f in range(len(shape.edges)):
                            for i, part in enumerate(_histogram(own, len(asked), xs[f], offsets[f + 1] - offsets[f], ws, ws * ys)):
                                total[:, i, offsets[f] : offsets[f + 1]] += part
                        np.minimum.at(low, own, ys)
                        np.maximum.at(high, own, ys)
            part = TaskContext.get().partitionId()
            for t, (total, low, high) in kept.items():
                k = len(low)
                yield _batch(_SUMS, [t] * k, partial[t][1], [part] * k, [a.tobytes() for a in total], [a.tobytes() for a in low], [a.tobytes() for a in high])

        def cuts(table: pa.Table) -> pa.Table:
            table = table.sort_by("part")
            total = sum(np.frombuffer(v) for v in table.column("sums").to_pylist()).reshape(1, 2, -1)
            low, high = (np.frombuffer(b"".join(table.column(c).to_pylist())) for c in ("low", "high"))
            per = lambda f: total[:, :, offsets[f] : offsets[f + 1]]
            n, s = (per(0)[:, i].sum(axis=1) for i in (0, 1))
            feature, cut = np.array([-1]), np.array([0])
            if n[0] >= 2 * shape.least and low.min() < high.max():
                feature, cut = _best(lambda f: (per(f)[:, 0], per(f)[:, 1]), len(shape.edges), n, s, shape.least)
            left = int(per(int(feature[0]))[0, 0, : cut[0] + 1].sum()) if feature[0] >= 0 else 0
            t, node = (table.column(c)[0].as_py() for c in ("tree", "node"))
            return pa.Table.from_batches([_batch(_CUT, [t], [node], feature, cut, [left], [int(n[0]) - left])])

        found = blocks.mapInArrow(sums, _SUMS).groupBy("tree", "node").applyInArrow(cuts, _CUT).collect()
        wanted = {}
        for t, node, feature, cut, *sizes in sorted(map(tuple, found)):
            if feature < 0:
                continue
            features, bins, left, depth = tops[t]
            features[node], bins[node], left[node] = feature, cut, len(features)
            for size in sizes:
                if size > LOCAL_ROWS and depth[node] + 1 < shape.depth:
                    wanted.setdefault(t, []).append(len(features))
                for column, v in zip(tops[t], (-1, 0, 0, depth[node] + 1)):
                    column.append(v)
    return tops


def _nodes(top: list[list[int]]) -> Nodes:
    return tuple(np.array(c, "int32") for c in top[:3])


@dataclass(frozen=True)
class Forest:
    """Fitted trees: their upper nodes here, the rest a table that ``unpersist`` gives up."""

    features: tuple[str, ...]
    shape: Shape
    tops: dict[int, Nodes]  # of the trees that drew any row
    grown: DataFrame
    n_nodes: int

    def unpersist(self) -> None:
        self.grown.unpersist()

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the mean over the trees; features must be known in every row.

        The rows that come to the same finished part meet there, in blocks of their codes.
        """
        features, shape, tops = self.features, self.shape, self.tops
        typed = df.withColumns({f"_code_{j}": F.col(f).cast("double") for j, f in enumerate(features)})
        codes = [f"_code_{j}" for j in range(len(features))]
        ship(df.sparkSession)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, t in _numbered(batches, SCORED_ROWS):
                x, held = shape.codes(t, codes), pa.BufferOutputStream()
                own = t.drop_columns(codes)
                with pa.ipc.new_stream(held, own.schema) as to:
                    to.write_table(own)
                yield _batch(_ROUTED, [-1], [block], [block], [held.getvalue().to_pybytes()], [None], [None])
                for tree, nodes in tops.items():
                    at = _walk(nodes, x)
                    met = np.unique(at)
                    places = [np.flatnonzero(at == node).astype("int32") for node in met]
                    yield _batch(_ROUTED, [tree] * len(met), met, [block] * len(met), [None] * len(met), [p.tobytes() for p in places], [x[:, p].tobytes() for p in places])

        def score(routed: pa.Table, grown: pa.Table) -> pa.Table:
            if not grown.num_rows:  # the rows themselves
                return routed.rename_columns([c.split()[0] for c in _SCORED.split(", ")])
            feature, cut = (np.frombuffer(grown.column(c)[0].as_py(), "int16" if c == "feature" else shape.code) for c in ("feature", "cut"))
            split = feature >= 0
            nodes = feature, cut, 2 * np.cumsum(split) - 1
            value, leaf = np.frombuffer(grown.column("value")[0].as_py()), np.cumsum(~split) - 1
            found = [value[leaf[_walk(nodes, shape.unpacked(x))]].tobytes() for x in routed.column("x").to_pylist()]
            kept = [routed.column(c).to_pylist() for c in ("tree", "node", "block", "rows", "place")]
            return pa.Table.from_batches([_batch(_SCORED, *kept, found)])

        def together(table: pa.Table) -> pa.Table:
            table = table.sort_by([("tree", "ascending"), ("node", "ascending")])
            rows = pa.ipc.open_stream(table.column("rows")[0].as_py()).read_all()
            total = np.zeros(rows.num_rows)
            for place, value in zip(table.column("place").to_pylist()[1:], table.column("value").to_pylist()[1:]):
                total[np.frombuffer(place, "int32")] += np.frombuffer(value)
            return rows.append_column("prediction", pa.array(total / len(tops)))

        routed = typed.mapInArrow(route, _ROUTED).groupBy("tree", "node")
        scored = routed.cogroup(self.grown.groupBy("tree", "node")).applyInArrow(score, _SCORED)
        schema = StructType([*df.schema.fields, StructField("prediction", DoubleType())])
        return scored.groupBy("block").applyInArrow(together, schema)


def fit(rows: DataFrame, features: Sequence[str], target: str, params: Mapping, trees: int, bagged: bool) -> Forest:
    """Trees of ``params`` (of ``training._tree_params``) over complete rows; ``bagged`` draws rows per tree.

    The draws go by partition and place, so rows that are dealt by their values give one forest.
    """
    names = [f"_x_{j}" for j in range(len(features))]
    rows = rows.select(*[F.col(f).cast("double").alias(x) for f, x in zip(features, names)], F.col(target).cast("double").alias("_y"))
    ship(rows.sparkSession)
    n, edges = _edges(rows, names, params["maxBins"])
    if not n:
        raise ValueError("No rows to fit")
    shape = Shape(edges, params["maxDepth"], params["minInstancesPerNode"], params["seed"], bagged)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, t in _numbered(batches, BLOCK_ROWS):
            yield _batch(_BLOCK, [block], [shape.codes(t, names).tobytes()], [t.column("_y").to_numpy().tobytes()])

    blocks = rows.mapInArrow(pack, _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tops = _upper_nodes(blocks, n, trees, shape)
        depths, uppers = [np.array(t[3]) for t in tops], tuple(_nodes(t) for t in tops)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block, xb, yb in zip(*(b.column(c).to_pylist() for c in ("block", "x", "y"))):
                    x, y = shape.unpacked(xb), np.frombuffer(yb)
                    for t, nodes in enumerate(uppers):
                        w, at = shape.drawn(t, block, len(y)), _walk(nodes, x)
                        for node in np.unique(at[w > 0]):
                            own = np.flatnonzero((at == node) & (w > 0))
                            yield _batch(_SHIPPED, [t], [node], [block], [x[:, own].tobytes()], [y[own].tobytes()], [w[own].tobytes()])

        def finish(table: pa.Table) -> pa.Table:
            table = table.sort_by("block")
            t, node = (table.column(c)[0].as_py() for c in ("tree", "node"))
            x = np.concatenate([shape.unpacked(v) for v in table.column("x").to_pylist()], axis=1)
            y, w = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("y", "float64"), ("w", "uint8")))
            feature, cut, value = grow(x, y, w, shape, shape.depth - int(depths[t][node]))
            kept = [feature.tobytes(), cut.astype(shape.code).tobytes(), value[feature < 0].tobytes()]
            return pa.Table.from_batches([_batch(_GROWN, [t], [node], *([v] for v in kept))])

        parts = min(MOST_TASKS, sum(int((u[0] < 0).sum()) for u in uppers))
        shipped = blocks.mapInArrow(spread, _SHIPPED).repartition(parts, "tree", "node")
        grown = shipped.groupBy("tree", "node").applyInArrow(finish, _GROWN).persist(StorageLevel.DISK_ONLY)
        sizes = dict(map(tuple, grown.groupBy("tree").agg(F.sum(F.length("feature")) / 2).collect()))
    finally:
        blocks.unpersist()
    if not sizes:
        raise ValueError("No rows were drawn")
    kept = {t: uppers[t] for t in sorted(sizes)}
    return Forest(tuple(features), shape, kept, grown, int(sum(sizes.values())) + sum(int((u[0] >= 0).sum()) for u in uppers))
