"""Exact quantiles with linear interpolation, by bracketed selection.

A first scan builds one mergeable quantile sketch per group and column, which brackets
every wanted rank. A second scan keeps values inside the brackets; those between two
brackets become one count. Both scans combine map-side, so what is shuffled is sketches
and a few thousandths of the values, not the values. The counts are exact and a wanted
rank never falls between brackets, which is checked; so the numbers are those of all
values.

Groups with few values left go through ``percentile`` with frequencies, whose counters
must fit one task; groups with more are ranked across tasks. With more than
``FEW_GROUPS`` groups brackets are not broadcast and values are counted in full, as they
are if a sketch should ever miss its bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import cut
from tabwright.operators.joins import null_safe_join
from tabwright.operators.ranking import running_totals

MAX_COUNTERS = 1_000_000
FEW_GROUPS = 100_000
#: Ranks of the sketch are off by at most rows / ACCURACY.
ACCURACY = 2_000


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), max_counters: int = MAX_COUNTERS
) -> DataFrame:
    """(by..., column, prob, value) for every column and probability; null and NaN are ignored."""
    groups = [*by, "column"]
    counts = _bracketed_counts(df, columns, probs, by)
    if counts is None:
        counts = cut(_value_counts(df, columns, by))
    largest = counts.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    return (_by_counters if largest <= max_counters else _by_ranks)(counts, groups, probs)


def _known(column: str) -> Column:
    """A column's numbers: null where missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per group: ``_n<i>`` values of column i, and ``_low<i>_<j>``, ``_high<i>_<j>`` around its rank for probability j.

    The slack of 3 / ACCURACY covers the sketch's error and, from ACCURACY values on, two
    ranks more for the neighbours that interpolation reads. Smaller groups are kept whole.
    """
    slack = 3 / ACCURACY
    wanted = [x for p in probs for x in (max(0.0, p - slack), min(1.0, p + slack))]
    sketches = []
    for i, c in enumerate(columns):
        sketches += [F.count(_known(c)).alias(f"_n{i}"), F.percentile_approx(_known(c), wanted, ACCURACY).alias(f"_q{i}")]
    found = df.groupBy(*by).agg(*sketches)
    edges = []
    for i in range(len(columns)):
        small = F.col(f"_n{i}") < ACCURACY
        edges.append(F.col(f"_n{i}"))
        for j, p in enumerate(probs):
            low = F.lit(-math.inf) if p <= slack else F.when(small, -math.inf).otherwise(F.col(f"_q{i}")[2 * j])
            high = F.lit(math.inf) if p >= 1 - slack else F.when(small, math.inf).otherwise(F.col(f"_q{i}")[2 * j + 1])
            edges += [low.alias(f"_low{i}_{j}"), high.alias(f"_high{i}_{j}")]
    return found.select(*by, *edges)


def _bracketed_counts(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame | None:
    """Value counts where values between brackets count for an edge; None where brackets do not serve."""
    brackets = cut(_brackets(df, columns, probs, by))
    if not _few_groups(brackets):
        return None
    # brackets travel as arrays, so that one expression serves all columns: one per column and
    # bracket is more code than the JVM compiles
    edges = [F.array(*[F.col(f"_{side}{i}_{j}") for j in range(len(probs))]).alias(f"_{side}s{i}") for i in range(len(columns)) for side in ("low", "high")]
    around = null_safe_join(df.select(*by, *(_known(c).alias(f"_x{i}") for i, c in enumerate(columns))), brackets.select(*by, *edges), by, broadcast=True)
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"_x{i}").alias("_x"), F.col(f"_lows{i}").alias("_lows"), F.col(f"_highs{i}").alias("_highs"))
        for i, c in enumerate(columns)
    ]
    x = F.col("_x")
    lows, highs = ([F.col(side)[j] for j in range(len(probs))] for side in ("_lows", "_highs"))
    inside = reduce(Column.__or__, [x.between(low, high) for low, high in zip(lows, highs)])
    # the nearest edge below, or the lowest edge for what lies below all brackets
    passed = _most(F.greatest, [F.when(x > high, high) for high in highs])
    edge = F.when(inside, x).when(passed.isNotNull(), passed).otherwise(_most(F.least, lows))
    side = F.when(inside, 0).when(passed.isNotNull(), 1).otherwise(-1)
    values = around.select(*by, F.inline(F.array(*pairs))).filter("_x is not null").select(*by, "column", edge.alias("_v"), side.alias("_side"))
    sided = cut(values.groupBy(*by, "column", "_v", "_side").agg(F.count(F.lit(1)).alias("n")))
    if not _covered(sided, brackets, columns, probs, by):
        return None
    return sided.groupBy(*by, "column", "_v").agg(F.sum("n").alias("n"))


def _most(pick: Callable[..., Column], values: list[Column]) -> Column:
    """``greatest`` or ``least``, which want two columns or more."""
    return pick(*values) if len(values) > 1 else values[0]


def _covered(sided: DataFrame, brackets: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> bool:
    """Whether every wanted rank and its upper neighbour lie inside their bracket, by exact counts."""
    missed = []
    rows = null_safe_join(sided, brackets, by, broadcast=True)
    for i, c in enumerate(columns):
        mine = F.col("column") == c
        last = F.col(f"_n{i}") - 1
        for j, p in enumerate(probs):
            low, high = F.col(f"_low{i}_{j}"), F.col(f"_high{i}_{j}")
            before = (F.col("_v") < low) | ((F.col("_v") == low) & (F.col("_side") == -1))
            upto = (F.col("_v") < high) | ((F.col("_v") == high) & (F.col("_side") < 1))
            at = F.floor(F.first(last) * F.lit(float(p)))
            wrong = (F.coalesce(F.sum(F.when(mine & before, F.col("n"))), F.lit(0)) > at) | (
                F.coalesce(F.sum(F.when(mine & upto, F.col("n"))), F.lit(0)) <= F.least(at + 1, F.first(last))
            )
            missed.append(F.when(F.first(last) >= 0, wrong).otherwise(False))
    found = rows.groupBy(*by).agg(reduce(Column.__or__, missed).alias("_missed"))
    return not found.filter("_missed").head(1)


def _value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in columns])
    values = df.select(*by, F.inline(pairs)).filter("_v is not null and not isnan(_v)")
    return values.groupBy(*by, "column", "_v").agg(F.count(F.lit(1)).alias("n"))


def _by_counters(counts: DataFrame, groups: list[str], probs: Sequence[float]) -> DataFrame:
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    found = counts.groupBy(*groups).agg(F.percentile("_v", wanted, F.col("n")).alias("_q"))
    rows = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.element_at("_q", j + 1).alias("value")) for j, p in enumerate(probs)])
    return found.select(*groups, F.inline(rows))


def _by_ranks(counts: DataFrame, groups: list[str], probs: Sequence[float]) -> DataFrame:
    ranked = running_totals(counts, groups, "_v", ["n"])
    sizes = counts.groupBy(*groups).agg(F.sum("n").alias("_total"))
    targets = (
        sizes.select(*groups, "_total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
        .withColumn("_at", (F.col("_total") - 1) * F.col("prob"))
        .withColumn("_low", F.floor("_at"))
    )
    # A value owns the zero-based positions [upto_n - n, upto_n - 1]; the upper neighbour is itself or ``next``.
    hit = null_safe_join(ranked, targets, groups, broadcast=_few_groups(sizes)).filter(
        (F.col("_low") >= F.col("upto_n") - F.col("n")) & (F.col("_low") < F.col("upto_n"))
    )
    upper = F.when(F.col("_low") + 1 < F.col("upto_n"), F.col("_v")).otherwise(F.coalesce("next", "_v"))
    value = F.col("_v") + (F.col("_at") - F.col("_low")) * (upper - F.col("_v"))
    return hit.select(*groups, "prob", value.alias("value"))


def _few_groups(sizes: DataFrame, limit: int = FEW_GROUPS) -> bool:
    return sizes.limit(limit + 1).count() <= limit


def quantile_literals(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of whole columns on the driver: columns x probs numbers."""
    found = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, columns, probs).collect()}
    return {c: [found.get((c, float(p)), math.nan) for p in probs] for c in columns}


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """One row per group with columns ``<column>_q<percent>``, such as ``value_q50``."""
    long = quantiles(df, columns, probs, by)
    return long.groupBy(*by).agg(
        *[
            F.max(F.when((F.col("column") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(f"{c}_q{100 * p:g}")
            for c in columns
            for p in probs
        ]
    )
