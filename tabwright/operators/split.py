"""Train / validation / test labels, folds and reproducible samples.

Membership is a function of a row's key and a seed, so it needs no shuffle and
does not change with the partitioning.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.operators.quantiles import quantile_literals
from tabwright.operators.ranking import hashed_rank

STRATEGIES = ("kfold", "stratified", "timeseries", "group", "repeated")


def split_label(unit: Column, train: float = 0.8, val: float = 0.1) -> Column:
    return F.when(unit < train, "train").when(unit < train + val, "val").otherwise("test")


def split_rows(
    df: DataFrame, key: str, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42,
    exact: bool = False, portable: bool = False,
) -> DataFrame:
    """Add ``split``.

    By default shares hold in expectation and nothing is shuffled. ``exact``
    takes the first rows in hash order instead, with held-out sizes rounded up.
    """
    unit = unit_hash(F.col(key), seed, portable)
    if not exact:
        return df.withColumn("split", split_label(unit, train, val))
    n = df.count()
    held_out = _ceil(n * (val + test))
    n_test = _ceil(held_out * (1 - val / (val + test)))
    ranked = hashed_rank(df, unit, [key], name="_rank")
    label = (
        F.when(F.col("_rank") <= n - held_out, "train").when(F.col("_rank") <= n - n_test, "val").otherwise("test")
    )
    return ranked.withColumn("split", label).drop("_rank")


def _ceil(x: float) -> int:
    """Round up, forgiving the last bits of a product of decimals."""
    nearest = round(x)
    return nearest if abs(x - nearest) < 1e-9 * max(1.0, abs(x)) else int(-(-x // 1))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, portable: bool = False) -> DataFrame:
    """The ``n`` rows with the smallest hash: the same rows whatever the partitioning."""
    unit = unit_hash(F.col(key), seed, portable)
    return df.withColumn("_u", unit).orderBy("_u", key).limit(n).drop("_u")


def fold_of(key: Column, k: int = 5, seed: int = 42, portable: bool = False) -> Column:
    return F.floor(unit_hash(key, seed, portable) * k).cast("int")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, portable: bool = False) -> DataFrame:
    return df.withColumn("fold", fold_of(F.col(key), k, seed, portable))


def repeated_kfold(df: DataFrame, key: str, k: int = 5, repeats: int = 3, seed: int = 42, portable: bool = False) -> DataFrame:
    """One ``fold_<r>`` column per repeat."""
    return df.withColumns({f"fold_{r}": fold_of(F.col(key), k, seed + r, portable) for r in range(repeats)})


def group_kfold(df: DataFrame, group: str, k: int = 5, seed: int = 42, portable: bool = False) -> DataFrame:
    """All rows of a group share a fold."""
    return df.withColumn("fold", fold_of(F.col(group), k, seed, portable))


def stratified_kfold(df: DataFrame, key: str, stratum: str, k: int = 5, seed: int = 42, portable: bool = False) -> DataFrame:
    """Deal the rows of every stratum to the folds in turn, in hash order."""
    ranked = hashed_rank(df, unit_hash(F.col(key), seed, portable), [key], by=[stratum], name="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def binned_target(df: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """Add ``stratum``, the quantile bin of a continuous target."""
    edges = quantile_literals(df, [target], [i / bins for i in range(1, bins)])[target]
    stratum = sum(((F.col(target) > F.lit(e)).cast("int") for e in edges), F.lit(0))
    return df.withColumn("stratum", stratum)


def time_blocks(df: DataFrame, time: str, k: int = 5) -> DataFrame:
    """Add ``block`` 0..k: consecutive stretches of time with about equal row counts.

    Fold i of a time-series split trains on blocks <= i and tests on block i + 1;
    rows of the same instant never straddle a boundary.
    """
    as_number = F.col(time).cast("timestamp").cast("double") if _is_time(df, time) else F.col(time).cast("double")
    df = df.withColumn("_t", as_number)
    edges = quantile_literals(df, ["_t"], [i / (k + 1) for i in range(1, k + 1)])["_t"]
    block = sum(((F.col("_t") > F.lit(e)).cast("int") for e in edges), F.lit(0))
    return df.withColumn("block", block).drop("_t")


def _is_time(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column].startswith(("timestamp", "date"))


def fold_frames(df: DataFrame, k: int = 5, strategy: str = "kfold") -> list[tuple[DataFrame, DataFrame]]:
    """(train, test) per fold from a ``fold`` or ``block`` column, or from the ``fold_<r>`` columns of all repeats."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown CV strategy: {strategy}")
    if strategy == "timeseries":
        return [(df.filter(F.col("block") <= i), df.filter(F.col("block") == i + 1)) for i in range(k)]
    if strategy == "repeated":
        names = sorted((c for c in df.columns if re.fullmatch(r"fold_\d+", c)), key=lambda c: int(c[5:]))
        return [(df.filter(F.col(c) != i), df.filter(F.col(c) == i)) for c in names for i in range(k)]
    return [(df.filter(F.col("fold") != i), df.filter(F.col("fold") == i)) for i in range(k)]


def with_folds(
    df: DataFrame, strategy: str, key: str, k: int = 5, seed: int = 42, by: str | None = None, portable: bool = False
) -> DataFrame:
    """Fold column by strategy name; ``by`` is the stratum, the time or the group."""
    if strategy == "kfold":
        return kfold(df, key, k, seed, portable)
    if strategy == "stratified":
        return stratified_kfold(df, key, _needed(by, strategy), k, seed, portable)
    if strategy == "timeseries":
        return time_blocks(df, _needed(by, strategy), k)
    if strategy == "group":
        return group_kfold(df, _needed(by, strategy), k, seed, portable)
    if strategy == "repeated":
        return repeated_kfold(df, key, k, seed=seed, portable=portable)
    raise ValueError(f"Unknown CV strategy: {strategy}")


def _needed(by: str | None, strategy: str) -> str:
    if by is None:
        raise ValueError(f"Strategy {strategy} needs a column")
    return by


def subset_sizes(df: DataFrame, key: str, fractions: Sequence[float], seed: int = 42, portable: bool = False) -> DataFrame:
    """Rows in each nested training subset of a learning curve: (fraction, n)."""
    unit = unit_hash(F.col(key), seed, portable)
    counts = df.agg(*[F.count_if(unit < F.lit(float(f))).alias(f"n{i}") for i, f in enumerate(fractions)])
    rows = [F.struct(F.lit(float(f)).alias("fraction"), F.col(f"n{i}").alias("n")) for i, f in enumerate(fractions)]
    return counts.select(F.inline(F.array(*rows)))
