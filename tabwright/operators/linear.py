"""Linear models on folds and subsets from one pass of sums.

A least-squares fit, and its squared error on any rows, follow from counts, means and
centred products. One aggregation by fold (and subset) gives these for all parts; parts
are then put together on the driver, a few numbers each, so every fold and every
training size is fitted without reading the table again.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.operators.training import SCORES


@dataclass(frozen=True)
class Line:
    intercept: float
    coefficients: np.ndarray

    def column(self, features: Sequence[str]) -> Column:
        out = F.lit(float(self.intercept))
        for f, b in zip(features, self.coefficients):
            out = out + F.lit(float(b)) * F.col(f)
        return out


@dataclass(frozen=True)
class Sums:
    """Rows, means and centred products of the features and, last, the target."""

    n: int
    mean: np.ndarray
    product: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.n / n)
        return Sums(n, mean, self.product + other.product + np.outer(gap, gap) * (self.n * other.n / n))

    def line(self) -> Line:
        xx, xy = self.product[:-1, :-1], self.product[:-1, -1]
        if self.n < 2 or np.linalg.matrix_rank(xx, hermitian=True) < len(xx):
            raise ValueError("Features are collinear")
        b = np.linalg.solve(xx, xy)
        return Line(float(self.mean[-1] - b @ self.mean[:-1]), b)

    def r2(self, line: Line) -> float | None:
        """Of a line on these rows; null without spread of the target."""
        w = np.append(-line.coefficients, 1.0)
        off = w @ self.mean - line.intercept
        error = float(w @ self.product @ w + self.n * off * off)
        total = float(self.product[-1, -1])
        return 1.0 - error / total if total > 0 else None


def sums_by(df: DataFrame, by: Sequence[Column], features: Sequence[str], target: str) -> dict[tuple[Hashable, ...], Sums]:
    """Sums per value of ``by``, in one aggregation; rows with a missing feature or target are left out."""
    x = [F.col(c).cast("double") for c in (*features, target)]
    pairs = list(combinations_with_replacement(range(len(x)), 2))
    rows = df.na.drop(subset=[*features, target]).groupBy(*[c.alias(f"by{i}") for i, c in enumerate(by)]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs],
    )
    out = {}
    for r in rows.collect():
        product = np.zeros((len(x), len(x)))
        for i, j in pairs:
            product[i, j] = product[j, i] = r[f"c{i}_{j}"] * r["n"]
        out[tuple(r[f"by{i}"] for i in range(len(by)))] = Sums(r["n"], np.array([r[f"m{i}"] for i in range(len(x))]), product)
    return out


def _together(parts: Iterable[Sums], width: int) -> Sums:
    return reduce(Sums.__add__, parts, Sums(0, np.zeros(width), np.zeros((width, width))))


def fold_lines(df: DataFrame, features: Sequence[str], target: str, fold: str = "fold") -> dict[int, Line]:
    """The line fitted on all other folds, for each fold."""
    parts = {k[0]: s for k, s in sums_by(df, [F.col(fold)], features, target).items() if k[0] is not None}
    width = len(features) + 1
    return {k: _together((s for j, s in parts.items() if j != k), width).line() for k in sorted(parts)}


def out_of_fold(df: DataFrame, features: Sequence[str], target: str, fold: str = "fold") -> DataFrame:
    """``prediction`` of every row by the line that did not see its fold, and ``held_out_fold``."""
    prediction = F.lit(None).cast("double")
    for k, line in fold_lines(df, features, target, fold).items():
        prediction = F.when(F.col(fold) == k, line.column(features)).otherwise(prediction)
    return df.withColumns({"prediction": prediction, "held_out_fold": F.col(fold)})


def cross_validate(df: DataFrame, features: Sequence[str], target: str, fold: str = "fold") -> DataFrame:
    """(model, fold, side, metric, value): test and train scores of every fold, in two passes altogether."""
    rows = df.na.drop(subset=[*features, target])
    y = F.col(target).cast("double")
    lines = fold_lines(rows, features, target, fold)
    sides, values = [], []
    for k, line in lines.items():
        for side, inside in (("test", F.col(fold) == k), ("train", F.col(fold) != k)):
            error = F.when(inside, y - line.column(features))
            square = F.avg(error * error)
            spread = F.var_pop(F.when(inside, y))
            for metric, value in (
                ("mae", F.avg(F.abs(error))), ("mse", square), ("rmse", F.sqrt(square)), ("r2", 1 - F.try_divide(square, spread)),
            ):
                sides.append((k, side, metric))
                values.append(value)
    found = rows.agg(*[v.alias(f"v{i}") for i, v in enumerate(values)]).first()
    scores = [("linear", k, side, metric, found[f"v{i}"]) for i, (k, side, metric) in enumerate(sides)]
    return df.sparkSession.createDataFrame(scores, SCORES)


def learning_curve(
    df: DataFrame, features: Sequence[str], target: str, key: str,
    fractions: Sequence[float] = tuple((i + 1) / 10 for i in range(10)), fold: str = "fold", seed: int = 43, portable: bool = False,
) -> DataFrame:
    """(fraction, fold, side, value): R2 on nested training subsets and on the held-out fold, from one pass."""
    steps = sorted(float(f) for f in fractions)
    unit = unit_hash(F.col(key), seed, portable)
    step = sum(((unit >= F.lit(f)).cast("int") for f in steps), F.lit(0))  # 0: in every subset
    parts = sums_by(df, [F.col(fold), step], features, target)
    folds, width = sorted({k for k, _ in parts}), len(features) + 1
    out = []
    for i, fraction in enumerate(steps):
        for k in folds:
            train = _together((s for (j, at), s in parts.items() if j != k and at <= i), width)
            held_out = _together((s for (j, _), s in parts.items() if j == k), width)
            line = train.line()
            out += [(fraction, k, "train", train.r2(line)), (fraction, k, "val", held_out.r2(line))]
    return df.sparkSession.createDataFrame(out, "fraction double, fold int, side string, value double")
