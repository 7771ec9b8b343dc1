"""Outliers: clip to the interquartile fence, or keep rows within a z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import clip
from tabwright.operators.quantiles import quantile_literals


def iqr_fences(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> dict[str, tuple[float, float]]:
    """[Q1 - t*IQR, Q3 + t*IQR] per column, all quartiles from one aggregation."""
    quartiles = quantile_literals(df, columns, [0.25, 0.75])
    return {c: (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)) for c, (q1, q3) in quartiles.items()}


def clip_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> DataFrame:
    fences = iqr_fences(df, columns, threshold)
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in fences.items()})


def drop_by_zscore(df: DataFrame, columns: Sequence[str], threshold: float = 1.5, simultaneous: bool = False) -> DataFrame:
    """Keep |x - mean| / std < threshold (sample std).

    Columns act one after the other, each on the survivors of the ones before;
    ``simultaneous`` measures all columns on the input in one pass instead. Rows
    with a missing value, and all rows of a constant column, go.
    """
    steps = [list(columns)] if simultaneous else [[c] for c in columns]
    for step in steps:
        moments = df.agg(*[f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(step) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
        for i, c in enumerate(step):
            mean, std = moments[f"m{i}"], moments[f"s{i}"]
            if not std or std != std:
                return df.limit(0)
            df = df.filter((F.abs(F.col(c) - F.lit(mean)) / F.lit(std) < F.lit(float(threshold))) & ~F.isnan(F.col(c).cast("double")))
    return df


def handle_outliers(df: DataFrame, columns: Sequence[str], method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    if method == "iqr":
        return clip_outliers(df, columns, threshold)
    if method == "zscore":
        return drop_by_zscore(df, columns, threshold)
    raise ValueError(f"Unknown outlier handling method: {method}")
