"""Explanations as batch jobs: attributions, partial dependence, local surrogates.

A scorer is any function that adds ``prediction`` to a table holding the feature
columns: ``model.transform`` or plain column math. Every explanation widens rows
inside their own task (``explode`` over a small literal), scores once, and folds
the widened rows back by aggregation, so only one row per key is shuffled.
A ``TreeScorer`` spares the widened rows: attributions and surrogates then come from
tables of the fitted trees, inside one map over the rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.lineage import cut
from tabwright.operators.quantiles import quantile_literals
from tabwright.operators.ranking import hashed_rank
from tabwright.operators.split import sample_rows
from tabwright.operators.trees import Shapley, Trees, TreeScorer
from tabwright.shipping import ship

Scorer = Callable[[DataFrame], DataFrame]

MAX_BACKGROUND = 1000


def _literal_rows(rows: list[list[float]]) -> Column:
    """A small matrix as one constant column."""
    return F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")


def background_rows(background: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """The background on the driver; refused beyond MAX_BACKGROUND rows."""
    rows = background.select(*[F.col(f).cast("double") for f in features]).limit(MAX_BACKGROUND + 1).collect()
    if not rows:
        raise ValueError("Explainer needs background rows")
    if len(rows) > MAX_BACKGROUND:
        raise ValueError(f"Background holds more than {MAX_BACKGROUND} rows; sample it first")
    return [[float(v) for v in r] for r in rows]


def default_background(training: DataFrame, key: str, size: int = 100, seed: int = 42, portable: bool = False) -> DataFrame:
    return sample_rows(training, key, size, seed, portable)


def _spread(df: DataFrame, key: str, *columns: Column) -> DataFrame:
    """Narrow rows placed by key: widening then uses all tasks, and folding back needs no second shuffle."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(F.col(key), *columns).repartition(tasks, key)


def _long(
    df: DataFrame, key: str, features: Sequence[str], value: Callable[[str], Column], contribution: Callable[[str], Column], *kept: str,
    more: Callable[[str], list[Column]] = lambda f: [],
) -> DataFrame:
    rows = [
        F.struct(F.lit(f).alias("feature"), value(f).cast("double").alias("feature_value"), contribution(f).alias("contribution"), *more(f))
        for f in features
    ]
    return df.select(key, *kept, F.inline(F.array(*rows)))


def linear_attributions(
    df: DataFrame, key: str, coefficients: Mapping[str, float], intercept: float, background: DataFrame
) -> DataFrame:
    """Exact attributions of a linear model: coefficient times distance from the background mean.

    Only the means of the background are needed, so it may have any size.
    """
    features = list(coefficients)
    row = background.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    if any(row[f"m{i}"] is None for i in range(len(features))):
        raise ValueError("Explainer needs background rows")
    means = {f: row[f"m{i}"] for i, f in enumerate(features)}
    base = intercept + sum(coefficients[f] * means[f] for f in features)
    return _long(
        df.withColumn("base_value", F.lit(base)), key, features, F.col,
        lambda f: F.lit(float(coefficients[f])) * (F.col(f) - F.lit(means[f])), "base_value",
    )


def attributions(
    df: DataFrame, key: str, features: Sequence[str], scorer: Scorer, background: DataFrame,
    permutations: int | None = None, seed: int = 42,
) -> DataFrame:
    """Sampled Shapley values: (key, base_value, prediction, feature, feature_value, contribution).

    For each random feature order a row is walked from a background row to
    itself, one feature at a time; a feature's value is the mean change at its
    step. By default there are as many orders as background rows, so each of
    them is used once and contributions add up to prediction minus base exactly.
    ``key`` must be unique.

    With a ``TreeScorer`` and no ``permutations`` nothing is sampled: the values are those
    of every order and every background row, which the sampled ones scatter around.
    """
    rows = background_rows(background, features)
    trees = _trees(scorer, features) if permutations is None else None
    if trees is not None:
        return _tree_attributions(df, key, features, trees.shapley(np.array(rows)))
    m, d = permutations or len(rows), len(features)
    if m % len(rows):
        raise ValueError(f"Use a multiple of the {len(rows)} background rows as permutations, so that all rows share one base")
    own = [F.col(f).cast("double").alias(f"_x_{j}") for j, f in enumerate(features)]
    noise = [F.struct(F.xxhash64(key, "_perm", F.lit(seed), F.lit(j)).alias("h"), F.lit(j).alias("j")) for j in range(d)]
    start = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(len(rows)))
    walked = (
        _spread(df, key, *own)
        .withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
        .withColumn("_b", F.element_at(_literal_rows(rows), ((start + F.col("_perm")) % len(rows) + 1).cast("int")))
        .withColumn("_order", F.transform(F.array_sort(F.array(*noise)), lambda s: s["j"]))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    place = {f: F.array_position("_order", F.lit(j)).cast("int") for j, f in enumerate(features)}
    walked = walked.withColumns({f"_place_{j}": place[f] for j, f in enumerate(features)}).drop("_order")
    mixed = walked.withColumns(
        {
            f: F.when(F.col(f"_place_{j}") <= F.col("_step"), F.col(f"_x_{j}")).otherwise(F.element_at("_b", j + 1))
            for j, f in enumerate(features)
        }
    ).drop("_b", "_perm")
    scored = scorer(mixed)
    p, step = F.col("prediction"), F.col("_step")
    sums = {
        f: F.sum(F.when(F.col(f"_place_{j}") == step, p).when(F.col(f"_place_{j}") == step + 1, -p).otherwise(0.0)) / m
        for j, f in enumerate(features)
    }
    folded = scored.groupBy(key).agg(
        *[F.any_value(f"_x_{j}").alias(f"_x_{j}") for j in range(d)],
        (F.sum(F.when(step == 0, p).otherwise(0.0)) / m).alias("base_value"),
        F.avg(F.when(step == d, p)).alias("prediction"),
        *[expr.alias(f"_c_{j}") for j, expr in enumerate(sums.values())],
    )
    index = {f: j for j, f in enumerate(features)}
    return _long(
        folded, key, features, lambda f: F.col(f"_x_{index[f]}"), lambda f: F.col(f"_c_{index[f]}"), "base_value", "prediction"
    )


def _trees(scorer: Scorer, features: Sequence[str]) -> Trees | None:
    return Trees.of(scorer.model, features) if isinstance(scorer, TreeScorer) else None


def _own_values(batch: pd.DataFrame, d: int) -> list[np.ndarray]:
    x = [batch[f"_x_{j}"].to_numpy(dtype="float64") for j in range(d)]
    if any(np.isnan(v).any() for v in x):
        raise ValueError("A feature of an explained row is missing")
    return x


def _tree_attributions(df: DataFrame, key: str, features: Sequence[str], shapley: Shapley) -> DataFrame:
    d = len(features)
    rows = _spread(df, key, *[F.col(f).cast("double").alias(f"_x_{j}") for j, f in enumerate(features)])
    ship(rows.sparkSession)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = shapley.trees.cells(_own_values(batch, d))
            shares = {f"_c_{j}": c for j, c in enumerate(shapley(cells))}
            yield batch.assign(base_value=shapley.base, prediction=shapley.trees.score(cells), **shares)

    added = ["base_value", "prediction", *[f"_c_{j}" for j in range(d)]]
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes] + [f"{c} double" for c in added])
    folded = rows.mapInPandas(attribute, schema)
    index = {f: j for j, f in enumerate(features)}
    return _long(
        folded, key, features, lambda f: F.col(f"_x_{index[f]}"), lambda f: F.col(f"_c_{index[f]}"), "base_value", "prediction"
    )


def global_importance(attributed: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (
        attributed.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def permutation_importance(
    df: DataFrame, key: str, features: Sequence[str], target: str, scorer: Scorer, repeats: int = 5, seed: int = 42, portable: bool = False
) -> DataFrame:
    """(feature, importance, std): how much the mean squared error rises when a feature is shuffled between rows.

    In each repeat the rows are ranked by a hash of the unique ``key`` and take the feature of
    the row ranked next (the last one that of the first), so no row keeps its own, and nothing
    is sorted as a whole. Rows without a target are left out, rows without a prediction do not
    count; a single row has no other, so its importances are 0. ``std`` is over the repeats.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(target).cast("double").alias("_y"), F.struct(*features).alias("_own")).filter("_y is not null")
    every = rows.withColumn("_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    ranked = cut(hashed_rank(every, unit_hash(F.col("_key"), F.col("_repeat") + seed, portable), ["_key"], ["_repeat"], "_rank"))
    n = ranked.filter("_repeat = 0").count()
    before = F.when(F.col("_rank") == 1, n).otherwise(F.col("_rank") - 1).cast("bigint")
    lent = ranked.select("_repeat", before.alias("_rank"), F.col("_own").alias("_other"))
    moved = ranked.join(lent, ["_repeat", "_rank"]).withColumn("_feature", F.explode(F.array(F.lit(None).cast("string"), *map(F.lit, features))))
    mixed = {f: F.when(F.col("_feature") == f, F.col("_other")[f]).otherwise(F.col("_own")[f]) for f in features}
    scored = scorer(moved.select("_repeat", "_feature", "_y", *[c.alias(f) for f, c in mixed.items()]))
    error = scored.groupBy("_repeat", "_feature").agg(F.avg(F.pow(F.col("prediction") - F.col("_y"), F.lit(2))).alias("_mse"))
    plain = error.filter("_feature is null").select("_repeat", F.col("_mse").alias("_plain"))
    rise = error.filter("_feature is not null").join(F.broadcast(plain), "_repeat").withColumn("_rise", F.col("_mse") - F.col("_plain"))
    return rise.groupBy(F.col("_feature").alias("feature")).agg(F.avg("_rise").alias("importance"), F.stddev_pop("_rise").alias("std"))


# -- partial dependence -----------------------------------------------------------


def grid_values(df: DataFrame, feature: str, most: int = 10_000) -> list[float]:
    """All values of a feature, such as a code; refused beyond ``most``, where ``grid_steps`` is meant."""
    seen = df.select(F.col(feature).cast("double").alias("v")).filter("v is not null").distinct().limit(most + 1).collect()
    if len(seen) > most:
        raise ValueError(f"{feature} has more than {most} values; use grid_steps")
    return sorted(r["v"] for r in seen)


def grid_steps(df: DataFrame, feature: str, steps: int = 100, low: float = 0.05, high: float = 0.95) -> list[float]:
    """Even steps between two quantiles of a feature."""
    lo, hi = quantile_literals(df, [feature], [low, high])[feature]
    return [float(x) for x in np.linspace(lo, hi, steps)]


def _on_grid(df: DataFrame, grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every row once per grid point, with the grid values in place of its own."""
    for i, values in enumerate(grid.values()):
        df = df.withColumn(f"_point_{i}", F.explode(F.element_at(_literal_rows([[float(v) for v in values]]), 1)))
    point = F.array(*[F.col(f"_point_{i}") for i in range(len(grid))])
    widened = df.withColumn("_point", point).drop(*[f"_point_{i}" for i in range(len(grid))])
    return widened.withColumns({f: F.element_at("_point", i + 1) for i, f in enumerate(grid)})


def partial_dependence(df: DataFrame, feature: str, grid: Sequence[float], scorer: Scorer) -> DataFrame:
    """(feature, grid_value, value): mean prediction with the feature set to each grid value."""
    scored = scorer(_on_grid(df, {feature: grid}))
    means = scored.groupBy(F.element_at("_point", 1).alias("grid_value")).agg(F.avg("prediction").alias("value"))
    return means.select(F.lit(feature).alias("feature"), "grid_value", "value")


def individual_curves(df: DataFrame, key: str, feature: str, grid: Sequence[float], scorer: Scorer) -> DataFrame:
    """(key, feature, grid_value, value): one curve per row."""
    scored = scorer(_on_grid(df, {feature: grid}))
    return scored.select(
        key, F.lit(feature).alias("feature"), F.element_at("_point", 1).alias("grid_value"), F.col("prediction").cast("double").alias("value")
    )


def interaction(df: DataFrame, a: str, b: str, grid_a: Sequence[float], grid_b: Sequence[float], scorer: Scorer) -> DataFrame:
    """(a_value, b_value, value): mean prediction on a two-feature grid."""
    scored = scorer(_on_grid(df, {a: grid_a, b: grid_b}))
    return scored.groupBy(F.element_at("_point", 1).alias("a_value"), F.element_at("_point", 2).alias("b_value")).agg(
        F.avg("prediction").alias("value")
    )


def interaction_strength(df: DataFrame, a: str, b: str, grid_a: Sequence[float], grid_b: Sequence[float], scorer: Scorer) -> DataFrame:
    """H statistic of a feature pair on a grid: share of the joint effect that is not additive."""
    joint = interaction(df, a, b, grid_a, grid_b, scorer)
    one = partial_dependence(df, a, grid_a, scorer).select(F.col("grid_value").alias("a_value"), F.col("value").alias("_a"))
    two = partial_dependence(df, b, grid_b, scorer).select(F.col("grid_value").alias("b_value"), F.col("value").alias("_b"))
    cells = joint.join(F.broadcast(one), "a_value").join(F.broadcast(two), "b_value")  # one row per grid value
    # Centring every surface at its grid mean turns both sums into variances.
    rest = F.var_pop(F.col("value") - F.col("_a") - F.col("_b"))
    return cells.agg(
        F.lit(a).alias("a"), F.lit(b).alias("b"), F.coalesce(F.try_divide(rest, F.var_pop("value")), F.lit(0.0)).alias("h_squared")
    )


# -- local surrogates -------------------------------------------------------------


def quartile_bins(training: DataFrame, features: Sequence[str]) -> dict[str, dict]:
    """Per feature: quartile edges, and share, lowest and highest value of each bin (at most 4)."""
    edges = {f: sorted(set(q)) for f, q in quantile_literals(training, features, [0.25, 0.5, 0.75]).items()}
    exprs = []
    for i, f in enumerate(features):
        bin_, x = _bin(F.col(f), edges[f]), F.col(f).cast("double")
        for k in range(len(edges[f]) + 1):
            inside = F.when(bin_ == k, x)
            exprs += [F.count(inside).alias(f"n{i}_{k}"), F.min(inside).alias(f"l{i}_{k}"), F.max(inside).alias(f"h{i}_{k}")]
    row = training.agg(*exprs).first()
    out = {}
    for i, f in enumerate(features):
        bins = range(len(edges[f]) + 1)
        total = sum(row[f"n{i}_{k}"] for k in bins)
        fallback = edges[f][0]
        out[f] = {
            "edges": edges[f],
            "share": [row[f"n{i}_{k}"] / total for k in bins],
            "low": [row[f"l{i}_{k}"] if row[f"l{i}_{k}"] is not None else fallback for k in bins],
            "high": [row[f"h{i}_{k}"] if row[f"h{i}_{k}"] is not None else fallback for k in bins],
        }
    return out


def _bin(value: Column, edges: Sequence[float]) -> Column:
    return sum(((value > F.lit(float(e))).cast("int") for e in edges), F.lit(0))


def _rule(feature: str, bin_: Column, edges: Sequence[float]) -> Column:
    """Readable bin, such as ``temp <= 0.25`` or ``0.25 < temp <= 0.50``."""
    text = F.when(bin_ == 0, F.lit(f"{feature} <= {edges[0]:.2f}"))
    for k in range(1, len(edges)):
        text = text.when(bin_ == k, F.lit(f"{edges[k - 1]:.2f} < {feature} <= {edges[k]:.2f}"))
    return text.otherwise(F.lit(f"{feature} > {edges[-1]:.2f}"))


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: spreads consecutive integers evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _perturbed_schema(rows: DataFrame, features: Sequence[str]) -> str:
    key, dtype = rows.dtypes[0]
    doubles = [*[f"_x_{j}" for j in range(len(features))], *features, *[f"_z_{j}" for j in range(len(features))]]
    return f"`{key}` {dtype}, _sample int, " + ", ".join(f"`{c}` double" for c in doubles)


def _perturb(bins: list[dict], features: list[str], samples: int, key: str):
    """Draw ``samples`` neighbours per row: a training bin by its share, then a value inside it.

    Sample 0 is the row itself. ``_z_j`` tells whether feature j stayed in its own bin.
    Numbers depend on the row's seed only, so a repeated task draws the same ones.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, 200_000 // samples)
        sample = np.arange(samples, dtype="uint64")
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                n = len(part)
                seeds = part["_seed"].to_numpy().astype("int64").view("uint64")
                out = {key: np.repeat(part[key].to_numpy(), samples), "_sample": np.tile(sample.astype("int32"), n)}
                values, kept = {}, {}
                for j, spec in enumerate(bins):
                    x = part[f"_x_{j}"].to_numpy(dtype="float64")
                    h = _mix(_mix(seeds[:, None] + sample[None, :] * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(j + 1))
                    share = (h >> np.uint64(32)).astype("float64") / 2.0**32
                    inside = (h & np.uint64(0xFFFFFFFF)).astype("float64") / 2.0**32
                    drawn = np.searchsorted(np.cumsum(spec["share"])[:-1], share, side="right")
                    own = np.searchsorted(np.asarray(spec["edges"]), x, side="left")
                    low, high = np.asarray(spec["low"]), np.asarray(spec["high"])
                    value = low[drawn] + inside * (high[drawn] - low[drawn])
                    value[:, 0], drawn[:, 0] = x, own
                    out[f"_x_{j}"] = np.repeat(x, samples)
                    values[features[j]] = value.ravel()
                    kept[f"_z_{j}"] = (drawn == own[:, None]).astype("float64").ravel()
                yield pd.DataFrame({**out, **values, **kept})

    return run


def _pairs(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def _solve(s: np.ndarray, d: int, top: int, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, chosen features, their weights) per row of sums: w, w y, w z_j, w z_j y, w z_i z_j."""
    total, mean_y = s[:, 0], s[:, 1] / s[:, 0]
    mean_z, zy = s[:, 2 : 2 + d] / total[:, None], s[:, 2 + d : 2 + 2 * d]
    zz = np.zeros((len(s), d, d))
    for k, (i, j) in enumerate(_pairs(d)):
        zz[:, i, j] = zz[:, j, i] = s[:, 2 + 2 * d + k]
    a = zz - total[:, None, None] * mean_z[:, :, None] * mean_z[:, None, :]
    right = zy - total[:, None] * mean_z * mean_y[:, None]
    first = np.linalg.solve(a + penalty * np.eye(d), right[:, :, None])[:, :, 0]
    pick = np.argsort(-np.abs(first), axis=1, kind="stable")[:, :top]
    kept = np.take_along_axis(np.take_along_axis(a, pick[:, :, None], 1), pick[:, None, :], 2)
    weights = np.linalg.solve(kept + penalty * np.eye(pick.shape[1]), np.take_along_axis(right, pick, 1)[:, :, None])[:, :, 0]
    return mean_y - (weights * np.take_along_axis(mean_z, pick, 1)).sum(axis=1), pick, weights


#: Surrogates from trees count patterns of features that stayed in their bins; beyond this many features rows are widened.
MAX_PATTERN = 10
_STEPS = 10  # bits of a draw that a look-up takes at once


class _Draws:
    """What ``_perturb`` draws for one feature, as cells of the trees instead of values."""

    def __init__(self, spec: dict, trees: Trees, j: int):
        self.edges, self.cuts = trees.edges[j], np.asarray(spec["edges"])
        self.low, self.high = np.asarray(spec["low"]), np.asarray(spec["high"])
        # the share is the upper half of a draw: it reaches an integer bound where the whole draw does
        bounds = [math.ceil(c * 2.0**32) for c in np.cumsum(spec["share"])[:-1]]
        self.bounds = [np.uint64(u << 32) for u in bounds if u < 1 << 32]
        steps = np.arange(1 << _STEPS, dtype="uint64") << np.uint64(32 - _STEPS)
        bins = np.arange(len(self.low))[:, None]
        first = self.cell(bins, steps[None, :])
        last = self.cell(bins, steps[None, :] + np.uint64((1 << (32 - _STEPS)) - 1))
        unsure = first != last  # values rise with the draw, so equal ends mean one cell
        self.offsets = [offsets[j] for offsets, _ in trees.tables]
        self.tables = [np.where(unsure, -1, o[first]).ravel() for o in self.offsets]

    def cell(self, drawn: np.ndarray, inside: np.ndarray) -> np.ndarray:
        share = inside.astype("float64") / 2.0**32
        return np.searchsorted(self.edges, self.low[drawn] + share * (self.high[drawn] - self.low[drawn]), side="left")

    def bins(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(h.shape, dtype="uint8")
        for bound in self.bounds:
            out += (h >= bound).view("uint8")
        return out

    def add_offsets(self, h: np.ndarray, drawn: np.ndarray, own: np.ndarray, at: list[np.ndarray]) -> None:
        """Add to ``at``, per table, where the drawn values lie in it; the first sample's is the row's own cell."""
        step = h >> np.uint64(32 - _STEPS)
        step &= np.uint64((1 << _STEPS) - 1)
        step = step.view("int64")
        high = drawn.astype("int64")
        high <<= _STEPS
        step += high
        unsure = None
        for place, table, offsets in zip(at, self.tables, self.offsets):
            found = table.take(step, mode="clip")  # never out of range; clipping is the fastest mode
            if unsure is None:
                unsure = np.flatnonzero(found < 0)
                cells = self.cell(drawn.ravel()[unsure], h.ravel()[unsure] & np.uint64(0xFFFFFFFF))
            found.ravel()[unsure] = offsets[cells]
            found[:, 0] = offsets[own]
            place += found


def _mix_in_place(h: np.ndarray, spare: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(h, np.uint64(shift), out=spare)
        np.bitwise_xor(h, spare, out=h)
        if factor:
            np.multiply(h, np.uint64(factor), out=h)
    return h


def _tree_solver(bins: list[dict], trees: Trees, samples: int, top: int, penalty: float) -> Callable:
    """The draws, scores, weights and normal equations of ``local_surrogates`` for a batch of rows.

    Takes the rows' seeds, values and cells; gives predictions, intercepts, chosen features and their weights.
    """
    d = len(bins)
    draws = [_Draws(spec, trees, j) for j, spec in enumerate(bins)]
    z = ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype("float64")
    w = np.sqrt(np.exp(-(d - z.sum(axis=1)) / (0.75 * 0.75 * d)))
    counted = np.column_stack([w, w[:, None] * z, *[w * z[:, i] * z[:, k] for i, k in _pairs(d)]])
    valued = counted[:, : 1 + d]
    start = np.arange(samples, dtype="uint64")[None, :] * np.uint64(0x9E3779B97F4A7C15)
    step = max(1, 32_768 // samples)

    def solve(seeds: np.ndarray, x: Sequence[np.ndarray], cells: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
        own = [np.searchsorted(draw.cuts, v, side="left") for draw, v in zip(draws, x)]
        sums, predicted = np.empty((len(seeds), 2 + 2 * d + len(_pairs(d)))), np.empty(len(seeds))
        for low in range(0, len(seeds), step):
            rows = slice(low, min(low + step, len(seeds)))
            n = rows.stop - low
            base = seeds[rows, None] + start
            h, spare = np.empty_like(base), np.empty_like(base)
            _mix_in_place(base, spare)
            at = [np.zeros(base.shape, dtype="int64") for _ in trees.tables]
            code = np.zeros(base.shape, dtype="uint16")
            for j, draw in enumerate(draws):
                np.add(base, np.uint64(j + 1), out=h)
                _mix_in_place(h, spare)
                drawn = draw.bins(h)
                kept = drawn == own[j][rows, None].astype("uint8")
                kept[:, 0] = True
                code += kept * np.uint16(1 << j)
                if len(draw.edges):
                    draw.add_offsets(h, drawn, cells[j][rows], at)
            y = sum((values.take(place, mode="clip") for place, (_, values) in zip(at, trees.tables)), 0.0) / trees.divisor
            pattern = code + (np.arange(n) << d)[:, None]
            number = np.bincount(pattern.ravel(), minlength=n << d).reshape(n, -1)
            value = np.bincount(pattern.ravel(), y.ravel(), minlength=n << d).reshape(n, -1)
            c, v = number @ counted, value @ valued
            sums[rows] = np.concatenate([c[:, :1], v[:, :1], c[:, 1 : 1 + d], v[:, 1:], c[:, 1 + d :]], axis=1)
            predicted[rows] = y[:, 0]
        return predicted, *_solve(sums, d, top, penalty)

    return solve


def _seeds(batch: pd.DataFrame) -> np.ndarray:
    return batch["_seed"].to_numpy().astype("int64").view("uint64")


def _tree_surrogates(bins: list[dict], trees: Trees, samples: int, top: int, penalty: float):
    """Surrogates in one pass per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solve = _tree_solver(bins, trees, samples, top, penalty)
        for batch in batches:
            x = _own_values(batch, len(bins))
            if len(batch):
                predicted, intercept, pick, weights = solve(_seeds(batch), x, trees.cells(x))
                out = batch.drop(columns="_seed").assign(prediction=predicted, intercept=intercept)
                for k in range(pick.shape[1]):
                    out[f"_chosen_{k}"], out[f"_weight_{k}"] = pick[:, k].astype("int32"), weights[:, k]
                yield out

    return run


def local_surrogates(
    df: DataFrame, key: str, features: Sequence[str], scorer: Scorer, training: DataFrame,
    samples: int = 1000, top: int = 10, seed: int = 42, penalty: float = 1.0,
) -> DataFrame:
    """A weighted ridge regression around every row, on whether each feature stays in its quartile bin.

    (key, feature, rule, weight, intercept, local_prediction, prediction), the
    ``top`` heaviest features per row. Perturbed rows only live inside their
    task: what leaves it are the sums of the normal equations. A ``TreeScorer`` of up to
    MAX_PATTERN features draws, scores and solves the same in one map.
    """
    bins, d = quartile_bins(training, features), len(features)
    own = [F.col(f).cast("double").alias(f"_x_{j}") for j, f in enumerate(features)]
    rows = _spread(df, key, F.xxhash64(key, F.lit(seed)).alias("_seed"), *own)
    ship(rows.sparkSession)
    xs = [f"_x_{j}" for j in range(d)]
    trees = _trees(scorer, features) if d <= MAX_PATTERN else None
    if trees is not None:
        most = min(top, d)
        columns = [f"{c} double" for c in (*xs, "prediction", "intercept")] + [f"_chosen_{k} int, _weight_{k} double" for k in range(most)]
        mapped = rows.mapInPandas(
            _tree_surrogates([bins[f] for f in features], trees, samples, top, penalty),
            f"`{key}` {rows.dtypes[0][1]}, " + ", ".join(columns),
        )
        chosen, weights = (F.array(*[F.col(f"{c}_{k}") for k in range(most)]).alias(name) for c, name in (("_chosen", "chosen"), ("_weight", "weights")))
        solved = mapped.select(key, *xs, "prediction", F.struct("intercept", chosen, weights).alias("s"))
    else:
        solved = _widened_surrogates(rows, key, features, scorer, bins, samples, top, penalty)
    rules = F.array(*[_rule(f, _bin(F.col(x), bins[f]["edges"]), bins[f]["edges"]) for x, f in zip(xs, features)])
    names = F.array(*[F.lit(f) for f in features])
    local = F.col("s.intercept") + F.aggregate("s.weights", F.lit(0.0), lambda acc, v: acc + v)
    return (
        solved.select(key, "prediction", F.col("s.intercept").alias("intercept"), local.alias("local_prediction"), rules.alias("_rules"),
                      F.explode(F.arrays_zip(F.col("s.chosen").alias("chosen"), F.col("s.weights").alias("weights"))).alias("c"))
        .select(
            key,
            F.element_at(names, F.col("c.chosen") + 1).alias("feature"),
            F.element_at("_rules", F.col("c.chosen") + 1).alias("rule"),
            F.col("c.weights").alias("weight"),
            "intercept",
            "local_prediction",
            "prediction",
        )
    )


def _widened_surrogates(
    rows: DataFrame, key: str, features: Sequence[str], scorer: Scorer, bins: dict[str, dict], samples: int, top: int, penalty: float
) -> DataFrame:
    """Neighbours as rows, for any scorer; what is left per row are the sums of the normal equations."""
    d = len(features)
    width2 = 0.75 * 0.75 * d
    perturbed = rows.mapInPandas(_perturb([bins[f] for f in features], list(features), samples, key), _perturbed_schema(rows, features))
    scored = scorer(perturbed)
    z = [F.col(f"_z_{j}") for j in range(d)]
    moved = F.lit(float(d)) - sum(z, F.lit(0.0))
    weighted = scored.withColumn("_w", F.sqrt(F.exp(-moved / width2)))
    w, y = F.col("_w"), F.col("prediction")
    sums = weighted.groupBy(key).agg(
        *[F.any_value(f"_x_{j}").alias(f"_x_{j}") for j in range(d)],
        F.max(F.when(F.col("_sample") == 0, y)).alias("prediction"),
        F.array(F.sum(w), F.sum(w * y), *[F.sum(w * c) for c in z], *[F.sum(w * c * y) for c in z], *[F.sum(w * z[i] * z[j]) for i, j in _pairs(d)]).alias("_sums"),
    )

    @F.pandas_udf("intercept double, chosen array<int>, weights array<double>")
    def solve(batch: pd.Series) -> pd.DataFrame:
        if batch.empty:
            return pd.DataFrame({"intercept": [], "chosen": [], "weights": []})
        intercept, pick, weights = _solve(np.stack(batch.to_numpy()), d, top, penalty)
        return pd.DataFrame({"intercept": intercept, "chosen": pick.astype("int32").tolist(), "weights": weights.tolist()})

    return sums.select(key, *[f"_x_{j}" for j in range(d)], "prediction", solve("_sums").alias("s"))


# -- compositions -----------------------------------------------------------------


def explain_rows(attributed: DataFrame, surrogates: DataFrame, key: str) -> DataFrame:
    """Attribution and surrogate rule of every (row, feature) side by side."""
    return attributed.join(surrogates.select(key, "feature", "rule", "weight"), [key, "feature"], "left")


def explain_table(
    df: DataFrame, key: str, features: Sequence[str], scorer: Scorer, background: DataFrame, training: DataFrame,
    samples: int = 1000, top: int = 10, seed: int = 42, penalty: float = 1.0,
) -> DataFrame:
    """``explain_rows`` of ``attributions`` and ``local_surrogates`` of a whole table.

    A ``TreeScorer`` of up to MAX_PATTERN features gives both in one map over the rows, so that no
    (row, feature) table is joined with another; other scorers join them. ``key`` must be unique.
    """
    trees, d = _trees(scorer, features) if len(features) <= MAX_PATTERN else None, len(features)
    if trees is None:
        surrogates = local_surrogates(df, key, features, scorer, training, samples, top, seed, penalty)
        return explain_rows(attributions(df, key, features, scorer, background), surrogates, key)
    shapley = trees.shapley(np.array(background_rows(background, features)))
    bins = quartile_bins(training, features)
    specs = [bins[f] for f in features]
    own = [F.col(f).cast("double").alias(f"_x_{j}") for j, f in enumerate(features)]
    rows = _spread(df, key, F.xxhash64(key, F.lit(seed)).alias("_seed"), *own)
    ship(rows.sparkSession)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solve = _tree_solver(specs, shapley.trees, samples, top, penalty)
        for batch in batches:
            x = _own_values(batch, d)
            if len(batch):
                cells = shapley.trees.cells(x)
                _, _, pick, chosen = solve(_seeds(batch), x, cells)
                weights, ruled = np.zeros((len(batch), d)), np.zeros((len(batch), d), dtype=bool)
                np.put_along_axis(weights, pick, chosen, axis=1)
                np.put_along_axis(ruled, pick, True, axis=1)
                out = batch.drop(columns="_seed").assign(base_value=shapley.base, prediction=shapley.trees.score(cells))
                for j, share in enumerate(shapley(cells)):
                    out[f"_c_{j}"], out[f"_weight_{j}"], out[f"_ruled_{j}"] = share, weights[:, j], ruled[:, j]
                yield out

    added = ["base_value double", "prediction double", *[f"_c_{j} double, _weight_{j} double, _ruled_{j} boolean" for j in range(d)]]
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes if c != "_seed"] + added)
    index = {f: j for j, f in enumerate(features)}

    def surrogate(f: str) -> list[Column]:
        edges, ruled = bins[f]["edges"], F.col(f"_ruled_{index[f]}")
        rule = _rule(f, _bin(F.col(f"_x_{index[f]}"), edges), edges)
        return [F.when(ruled, rule).alias("rule"), F.when(ruled, F.col(f"_weight_{index[f]}")).alias("weight")]

    long = _long(
        rows.mapInPandas(explain, schema), key, features, lambda f: F.col(f"_x_{index[f]}"), lambda f: F.col(f"_c_{index[f]}"),
        "base_value", "prediction", more=surrogate,
    )
    return long.select(key, "feature", "base_value", "prediction", "feature_value", "contribution", "rule", "weight")


def explain_model(attributed: DataFrame, importances: Sequence[tuple[str, float]]) -> DataFrame:
    """Mean absolute attribution next to the model's own importance."""
    own = attributed.sparkSession.createDataFrame(list(importances), "feature string, model_importance double")
    return global_importance(attributed).join(F.broadcast(own), "feature", "left")  # one row per feature


def explanation_report(
    rows: DataFrame, key: str, attributed: DataFrame, surrogates_of: Callable[[DataFrame], DataFrame], n_train: int,
    local_samples: int = 5, top: int = 4,
) -> DataFrame:
    """Global ranking, a few local samples, the top features and row counts as one long table.

    Attributions cover all ``rows`` and are computed once; surrogates are only
    fitted for the local samples.
    """
    attributed = cut(attributed)
    picked = sample_rows(rows, key, local_samples)
    local = explain_rows(attributed.join(F.broadcast(picked.select(key)), key, "left_semi"), surrogates_of(picked), key)
    ranked = global_importance(attributed)
    none = F.lit(None).cast("string").alias("row_key")
    row_key = F.col(key).cast("string").alias("row_key")
    n_test = attributed.agg(F.count_distinct(key).cast("double").alias("value"))
    n_rows = n_test.select(F.lit("test_samples").alias("feature"), "value").unionByName(
        n_test.select(F.lit("training_samples").alias("feature"), F.lit(float(n_train)).alias("value"))
    )
    return (
        ranked.select(F.lit("global").alias("section"), none, "feature", F.col("importance").alias("value"))
        .unionByName(ranked.limit(top).select(F.lit("top_features").alias("section"), none, "feature", F.col("importance").alias("value")))
        .unionByName(local.select(F.lit("local_attribution").alias("section"), row_key, "feature", F.col("contribution").alias("value")))
        .unionByName(local.filter("rule is not null").select(F.lit("local_rule").alias("section"), row_key, F.col("rule").alias("feature"), F.col("weight").alias("value")))
        .unionByName(n_rows.select(F.lit("metadata").alias("section"), none, "feature", "value"))
    )
