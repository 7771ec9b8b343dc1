"""Drift from histograms on the bins of a reference table.

A histogram is one row per (column, bin) with a count, a sum, a least and a greatest
value. Counts and sums add up, extremes combine, so histograms of batches, days or
micro-batches merge; rows are combined map-side and what is shuffled is bins x columns
rows, whatever the table's size. An edge is a bin by itself, so a value that many rows
hold, which quantiles find, does not blur its neighbours. Null and NaN have bins too.

Distances come with the error that the bins leave open: the exact value over all rows
lies in [value, value + error]. The distribution functions are known at the edges and
constant outside a bin's extremes; between them the integral of their difference is
known from the sums, and its sign is only open where the bounds of the bin allow both.
A column whose bins hold one value each has errors of 0. PSI is that of its own,
coarser bins. Infinite values make Wasserstein distances NaN.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.lineage import cut

NULL_BIN = -1
NAN_BIN = -2
FLOOR = 1e-6
MIN_STD = 0.001
#: Ranks of the fitted edges are off by at most rows / ACCURACY.
ACCURACY = 10_000


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def _known(column: str) -> Column:
    return F.nanvl(_number(column), F.lit(None))


def _rising(edges: Sequence[float]) -> tuple[float, ...]:
    return tuple(sorted({float(e) for e in edges if math.isfinite(e)}))


@dataclass(frozen=True)
class Bins:
    """Bins of a reference table: rising inner edges, those that PSI uses, and the spread, per column."""

    edges: Mapping[str, tuple[float, ...]]
    coarse: Mapping[str, tuple[float, ...]]
    spread: Mapping[str, float]

    @classmethod
    def fit(cls, reference: DataFrame, columns: Sequence[str], bins: int = 100, coarse: int = 10) -> Bins:
        """Edges at approximate quantiles of the reference; ``coarse`` divides ``bins``. One scan, one row out."""
        if bins % coarse:
            raise ValueError(f"{coarse} coarse bins do not divide {bins}")
        wanted = [i / bins for i in range(1, bins)]
        found = reference.agg(
            *[F.percentile_approx(_known(c), wanted, ACCURACY).alias(f"e{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(_known(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        edges, fewer = {}, {}
        for i, c in enumerate(columns):
            all_edges = found[f"e{i}"] or []
            edges[c] = _rising(all_edges)
            fewer[c] = _rising(all_edges[bins // coarse - 1 :: bins // coarse])
        return cls(edges, fewer, {c: found[f"s{i}"] for i, c in enumerate(columns)})

    @classmethod
    def on_edges(cls, reference: DataFrame, edges: Mapping[str, Sequence[float]]) -> Bins:
        """Bins on stated edges, which PSI uses too; the reference gives the spread."""
        rising = {c: _rising(e) for c, e in edges.items()}
        found = reference.agg(*[F.stddev_pop(_known(c)).alias(f"s{i}") for i, c in enumerate(rising)]).first()
        return cls(rising, rising, {c: found[f"s{i}"] for i, c in enumerate(rising)})

    def origin(self, column: str) -> float:
        """What sums are taken from, so that they stay small."""
        edges = self.edges[column]
        return edges[len(edges) // 2] if edges else 0.0

    def grid(self, spark: SparkSession) -> DataFrame:
        """(column, bin, left, right, psi_bin, spread): every bin, edges counted from the origin, open ends null."""
        rows = []
        for c, edges in self.edges.items():
            zero, coarse = self.origin(c), self.coarse[c]
            shifted = [e - zero for e in edges]
            for i in range(len(edges) + 1):
                # the coarse edges are among the fine ones, and belong to the bin below
                psi_bin = sum(e < edges[i] for e in coarse) if i < len(edges) else len(coarse)
                rows.append((c, 2 * i, shifted[i - 1] if i else None, shifted[i] if i < len(edges) else None, psi_bin, self.spread[c]))
                if i < len(edges):
                    rows.append((c, 2 * i + 1, shifted[i], shifted[i], psi_bin, self.spread[c]))
        return spark.createDataFrame(rows, "column string, bin int, left double, right double, psi_bin int, spread double")


def cells(df: DataFrame, bins: Bins, kept: Sequence[str] = ()) -> DataFrame:
    """(kept..., column, bin, _x), a row per cell; ``_x`` is counted from the origin.

    Bin 2 i lies below edge i, bin 2 i + 1 is the edge; found by binary search in the JVM.
    """
    columns = list(bins.edges)
    rows = df.select(*kept, *[_number(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    searched = [i for i, c in enumerate(columns) if bins.edges[c]]
    if searched:
        splits = [[-math.inf, *bins.edges[columns[i]], math.inf] for i in searched]
        names = [[f"{what}{i}" for i in searched] for what in ("_v", "_upto")]
        rows = Bucketizer(splitsArray=splits, inputCols=names[0], outputCols=names[1], handleInvalid="keep").transform(rows)
    found = []
    for i, c in enumerate(columns):
        value, place = F.col(f"_v{i}"), F.lit(0)
        if bins.edges[c]:
            upto = F.col(f"_upto{i}").cast("int")
            place = 2 * upto - (value == F.element_at(F.lit(list(bins.edges[c])), F.greatest(upto, F.lit(1)))).cast("int")
        place = F.when(value.isNull(), NULL_BIN).when(F.isnan(value), NAN_BIN).otherwise(place)
        x = F.nanvl(value, F.lit(None)) - F.lit(bins.origin(c))
        found.append(F.struct(F.lit(c).alias("column"), place.alias("bin"), x.alias("_x")))
    return rows.select(*kept, F.inline(F.array(*found)))


def state() -> list[Column]:
    """Aggregates of ``cells`` rows into a histogram."""
    return [F.count(F.lit(1)).alias("n"), F.sum("_x").alias("total"), F.min("_x").alias("low"), F.max("_x").alias("high")]


def histogram(df: DataFrame, bins: Bins, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, bin, n, total, low, high); empty bins have no row."""
    return cells(df, bins, by).groupBy(*by, "column", "bin").agg(*state())


def merged(histograms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One histogram out of several on the same bins."""
    return histograms.groupBy(*by, "column", "bin").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _sizes(histograms: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Rows and values per histogram."""
    values = F.coalesce(F.sum(F.when(F.col("bin") >= 0, F.col("n"))), F.lit(0))
    return histograms.groupBy(*keys).agg(F.sum("n").alias(f"rows_{side}"), values.alias(f"values_{side}"))


def _present(histograms: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    return histograms.filter("bin >= 0").select(*keys, "bin", *[F.col(c).alias(f"{c}_{side}") for c in ("n", "total", "low", "high")])


def histogram_drift(reference: DataFrame, current: DataFrame, bins: Bins, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, ks, ks_error, wasserstein, wasserstein_error, psi, missing_ref, missing_cur).

    ``reference`` and ``current`` are histograms on ``bins``; ``current`` may hold many, told
    apart by ``by``. Wasserstein is over the reference's std. A column that has values on one
    side only has distances of 1, on neither side of 0; a side without rows counts as missing.
    Without ``by`` every column has a row; with it, the columns of each group's histogram.
    """
    keys = [*by, "column"]
    grid = bins.grid(current.sparkSession)
    sizes = _sizes(current, keys, "cur")
    if not by:
        sizes = grid.select("column").distinct().join(sizes, "column", "left")
    sizes = sizes.join(F.broadcast(_sizes(reference, ["column"], "ref")), "column", "left")
    counts = [f"{what}_{side}" for what in ("rows", "values") for side in ("ref", "cur")]
    every = sizes.fillna(0, counts).join(F.broadcast(grid), "column")
    found = every.join(F.broadcast(_present(reference, ["column"], "ref")), ["column", "bin"], "left")
    found = found.join(_present(current, keys, "cur"), [*keys, "bin"], "left").fillna(0, ["n_ref", "n_cur"]).fillna(0.0, ["total_ref", "total_cur"])

    upto = Window.partitionBy(*keys).orderBy("bin")
    for side in ("ref", "cur"):
        size = F.col(f"values_{side}").cast("double")
        after = F.sum(f"n_{side}").over(upto)
        found = found.withColumns({f"after_{side}": F.try_divide(after, size), f"before_{side}": F.try_divide(after - F.col(f"n_{side}"), size)})
    # lowest and highest value of the bin on either side; an empty bin is one stretch up to its right edge
    lowest = F.coalesce(F.least("low_ref", "low_cur"), "right", "left")
    highest = F.coalesce(F.greatest("high_ref", "high_cur"), "right", "left")
    found = found.withColumns({"lowest": lowest, "highest": highest})
    found = found.withColumns({"left": F.coalesce("left", "lowest"), "right": F.coalesce("right", "highest")})

    def below(side: str) -> Column:
        """Integral over the bin's values of what the side's distribution function gains there."""
        return F.try_divide(F.col(f"n_{side}") * F.col("highest") - F.col(f"total_{side}"), F.col(f"values_{side}").cast("double"))

    before, after = F.col("before_ref") - F.col("before_cur"), F.col("after_ref") - F.col("after_cur")
    width = F.col("highest") - F.col("lowest")
    integral = before * width + below("ref") - below("cur")
    least, most = F.col("before_ref") - F.col("after_cur"), F.col("after_ref") - F.col("before_cur")
    widest = F.try_divide(integral * (most + least) - 2 * width * least * most, most - least)
    unsettled = (least < 0) & (most > 0) & (width > 0)
    found = found.withColumns(
        {
            "_sure": F.abs(before) * (F.col("lowest") - F.col("left")) + F.abs(integral) + F.abs(after) * (F.col("right") - F.col("highest")),
            "_open": F.when(unsettled, F.greatest(widest - F.abs(integral), F.lit(0.0))).otherwise(0.0),
            "_gap": F.abs(after),
            "_gap_most": F.when(width > 0, F.greatest(most, -least)).otherwise(F.abs(after)),
        }
    )
    coarse = found.groupBy(*keys, "psi_bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"), *[F.max(c).alias(c) for c in (*counts, "spread")],
        F.max("_gap").alias("_gap"), F.max("_gap_most").alias("_gap_most"), F.sum("_sure").alias("_sure"), F.sum("_open").alias("_open"),
    )
    p, q = (F.greatest(F.try_divide(F.col(f"n_{s}").cast("double"), F.col(f"values_{s}")), F.lit(FLOOR)) for s in ("ref", "cur"))
    sides = F.lit(0)
    for side in ("ref", "cur"):
        sides = sides + F.max((F.col(f"values_{side}") > 0).cast("int"))
    scale = F.greatest(F.max("spread"), F.lit(MIN_STD))
    distances = {
        "ks": F.max("_gap"),
        "ks_error": F.greatest(F.max("_gap_most") - F.max("_gap"), F.lit(0.0)),
        "wasserstein": F.sum("_sure") / scale,
        "wasserstein_error": F.sum("_open") / scale,
        "psi": F.sum((q - p) * F.log(q / p)),
    }

    def settled(name: str, value: Column) -> Column:
        return F.when(sides == 2, value).otherwise(F.lit(0.0) if name.endswith("_error") else sides.cast("double")).alias(name)

    def missing(side: str) -> Column:
        rows, values = F.max(f"rows_{side}"), F.max(f"values_{side}")
        return F.coalesce(F.try_divide((rows - values).cast("double"), rows), F.lit(1.0)).alias(f"missing_{side}")

    return coarse.groupBy(*keys).agg(*[settled(n, v) for n, v in distances.items()], missing("ref"), missing("cur"))


def binned_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: Bins | None = None) -> DataFrame:
    """``histogram_drift`` of two tables on the reference's bins, fitted unless given.

    Both tables are counted by one aggregation; after it there are at most two rows per bin.
    """
    if bins is None:
        bins = Bins.fit(ref, columns)
    wanted = Bins(*({c: part[c] for c in columns} for part in (bins.edges, bins.coarse, bins.spread)))
    picked = [F.col(c).cast("double").alias(c) for c in columns]
    both = ref.select(*picked, F.lit(True).alias("_ref")).unionByName(cur.select(*picked, F.lit(False).alias("_ref")))
    counted = cut(histogram(both, wanted, ["_ref"]))
    return histogram_drift(counted.filter("_ref").drop("_ref"), counted.filter("not _ref").drop("_ref"), wanted)
