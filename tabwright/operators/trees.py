"""Fitted trees as small tables, for explanations that would ask the model billions of times.

The thresholds of all trees cut every feature into cells; a tree is constant on each box of
cells. So a prediction is a look-up, and what a leaf adds to a Shapley value depends only on
which of the few features on its path lie inside its box: one small table per leaf, summed
over the background beforehand.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from math import factorial, prod

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tabwright.operators.training import predict

MAX_CELLS = 1 << 22  # numbers in one look-up table: 32 MB
MAX_SHARES = 1 << 22  # numbers in the tables of all leaves

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


@dataclass(frozen=True)
class TreeScorer:
    """A scorer that explanations can also read as trees."""

    model: PipelineModel | None

    def __call__(self, df: DataFrame) -> DataFrame:
        return predict(self.model, df)


@dataclass(frozen=True)
class Leaf:
    value: float
    box: dict[int, tuple[float, float]]  # feature: above the first, up to the second


@dataclass(frozen=True)
class Trees:
    """Leaves per tree; a prediction is the weighted sum of the trees' values over ``divisor``."""

    features: tuple[str, ...]
    leaves: tuple[tuple[Leaf, ...], ...]
    weights: tuple[float, ...]
    divisor: float

    @classmethod
    def of(cls, model: PipelineModel | None, features: Sequence[str]) -> Trees | None:
        """The trees of a fitted pipeline over these features; None if it is another model, none or too large for tables."""
        if model is None:
            return None
        fitted, names = model.stages[-1], model.stages[0].getInputCols()
        text = fitted.toDebugString if hasattr(fitted, "toDebugString") else ""
        if set(names) != set(features) or " in {" in text or "If (" not in text:
            return None
        place = [list(features).index(n) for n in names]
        lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
        if not lines[0].startswith("Tree "):
            lines = ["Tree 0", *lines]
        starts = [i for i, line in enumerate(lines) if line.startswith("Tree ")]
        leaves = []
        for at in starts:
            found: list[Leaf] = []
            _read(lines, at + 1, {}, place, found)
            leaves.append(tuple(found))
        weights = getattr(fitted, "treeWeights", [1.0])
        averaged = type(fitted).__name__.startswith("RandomForest")
        out = cls(tuple(features), tuple(leaves), tuple(float(w) for w in weights), float(len(leaves)) if averaged else 1.0)
        return out if out._fits() else None

    def _fits(self) -> bool:
        shares = sum(len(leaf.box) << len(leaf.box) for tree in self.leaves for leaf in tree)
        return shares <= MAX_SHARES and all(prod(len(e) + 1 for e in _edges([tree], len(self.features))) <= MAX_CELLS for tree in self.leaves)

    @cached_property
    def edges(self) -> list[np.ndarray]:
        """Per feature: all thresholds, ascending."""
        return _edges(self.leaves, len(self.features))

    @cached_property
    def tables(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """Trees in groups, each small enough for one table: per feature the offset of a cell, and the table's values."""
        groups: list[list[int]] = [[]]
        for t in range(len(self.leaves)):
            wider = _edges([self.leaves[u] for u in [*groups[-1], t]], len(self.features))
            if groups[-1] and prod(len(e) + 1 for e in wider) > MAX_CELLS:
                groups.append([])
            groups[-1].append(t)
        out = []
        for group in groups:
            edges = _edges([self.leaves[t] for t in group], len(self.features))
            shape = [len(e) + 1 for e in edges]
            total, one = np.zeros(shape), np.empty(shape)
            for t in group:
                for leaf in self.leaves[t]:
                    one[tuple(slice(*_range(leaf.box.get(j), e)) for j, e in enumerate(edges))] = leaf.value
                total += self.weights[t] * one
            stride = [prod(shape[j + 1 :]) for j in range(len(shape))]
            offsets = []
            for j, e in enumerate(edges):
                # a cell of all trees' thresholds lies in one cell of the group's
                low = np.concatenate([self.edges[j], [np.inf]])
                offsets.append((np.searchsorted(e, low, side="left") * stride[j]).astype("int64"))
            out.append((offsets, total.ravel()))
        return out

    def cells(self, x: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Per feature: the cell of every value."""
        return [np.searchsorted(e, v, side="left") for e, v in zip(self.edges, x)]

    def score(self, cells: Sequence[np.ndarray]) -> np.ndarray:
        out = None
        for offsets, values in self.tables:
            at = sum((o.take(c, mode="clip") for o, c in zip(offsets[1:], cells[1:])), offsets[0].take(cells[0], mode="clip"))
            found = values.take(at, mode="clip")  # never out of range; clipping is the fastest mode
            out = found if out is None else out + found
        return out / self.divisor

    def shapley(self, background: np.ndarray) -> Shapley:
        """Exact Shapley values against the mean over the background rows: every order of features, every row."""
        cells = self.cells(background.T)
        terms = []
        for tree, weight in zip(self.leaves, self.weights):
            for leaf in tree:
                path = sorted(leaf.box)
                if path:
                    inside = [_inside(leaf.box[f], self.edges[f], 1 << i) for i, f in enumerate(path)]
                    seen = sum(bits.take(cells[f]) for bits, f in zip(inside, path))
                    shares = _shares(len(path), seen) * (weight * leaf.value / self.divisor)
                    terms.append((path, inside, [np.ascontiguousarray(shares[:, i]) for i in range(len(path))]))
        return Shapley(self, float(self.score(cells).mean()), terms)


@dataclass(frozen=True)
class Shapley:
    trees: Trees
    base: float
    terms: list

    def __call__(self, cells: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Per feature: the contribution to every row."""
        out = [np.zeros(len(cells[0])) for _ in self.trees.features]
        for path, inside, shares in self.terms:
            own = sum((bits.take(cells[f], mode="clip") for bits, f in zip(inside[1:], path[1:])), inside[0].take(cells[path[0]], mode="clip"))
            for f, share in zip(path, shares):
                out[f] += share.take(own, mode="clip")
        return out


def _read(lines: list[str], at: int, box: dict, place: list[int], found: list[Leaf]) -> int:
    """Leaves below the line ``at``; returns the line after them."""
    if lines[at].startswith("Predict:"):
        found.append(Leaf(float(lines[at].split(":")[1]), box))
        return at + 1
    feature, edge = _SPLIT.match(lines[at]).groups()
    j, t = place[int(feature)], float(edge)
    low, high = box.get(j, (-np.inf, np.inf))
    at = _read(lines, at + 1, {**box, j: (low, min(high, t))}, place, found)
    return _read(lines, at + 1, {**box, j: (max(low, t), high)}, place, found)


def _edges(trees: Sequence[Sequence[Leaf]], d: int) -> list[np.ndarray]:
    seen: list[set] = [set() for _ in range(d)]
    for tree in trees:
        for leaf in tree:
            for j, ends in leaf.box.items():
                seen[j].update(e for e in ends if np.isfinite(e))
    return [np.array(sorted(s)) for s in seen]


def _range(ends: tuple[float, float] | None, edges: np.ndarray) -> tuple[int, int]:
    """First cell of a box, and the one after its last."""
    low, high = ends or (-np.inf, np.inf)
    first = 0 if low == -np.inf else int(np.searchsorted(edges, low)) + 1
    return first, len(edges) + 1 if high == np.inf else int(np.searchsorted(edges, high)) + 1


def _inside(ends: tuple[float, float], edges: np.ndarray, bit: int) -> np.ndarray:
    first, after = _range(ends, edges)
    cell = np.arange(len(edges) + 1)
    return np.where((cell >= first) & (cell < after), bit, 0).astype("int32")


def _shares(k: int, seen: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1, by which path features of a row lie inside: mean over the background.

    For one background row, features only the row has inside must all come in (n of them), those
    only the background has must all stay out (m): (n-1)! m! / (n+m)! for each of the first, minus
    n! (m-1)! / (n+m)! for each of the second, nothing if some feature is inside for neither.
    """
    own, full = np.arange(1 << k)[:, None], (1 << k) - 1
    masks, counts = np.unique(seen, return_counts=True)
    gain, loss = np.zeros((k + 1, k + 1)), np.zeros((k + 1, k + 1))
    for n in range(k + 1):
        for m in range(k + 1 - n):
            gain[n, m] = factorial(n - 1) * factorial(m) / factorial(n + m) if n else 0.0
            loss[n, m] = factorial(n) * factorial(m - 1) / factorial(n + m) if m else 0.0
    ups, downs = own & ~masks & full, masks & ~own
    bits = np.arange(k)
    n = ((ups[..., None] >> bits) & 1).sum(axis=-1)
    m = ((downs[..., None] >> bits) & 1).sum(axis=-1)
    reached = ((own | masks) == full) * (counts / counts.sum())
    out = np.empty((1 << k, k))
    for i in range(k):
        part = ((ups >> i) & 1) * gain[n, m] - ((downs >> i) & 1) * loss[n, m]
        out[:, i] = (part * reached).sum(axis=1)
    return out
