"""Joins that keep rows whose key is null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Join on equal names where null equals null; the key columns come from ``left``.

    A struct of the keys is the key, so the join stays an ordinary equi-join.
    """
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row of whole-table statistics
    values = [c for c in right.columns if c not in keys]
    keyed = right.select(F.struct(*keys).alias("_key"), *values)
    joined = left.withColumn("_key", F.struct(*keys)).join(F.broadcast(keyed) if broadcast else keyed, "_key", how)
    return joined.drop("_key")


#: Keys with at least this share of the rows are joined without a shuffle; there are at most 1 / HEAVY of them.
HEAVY = 0.001


def spread_join(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join on ``key`` that no frequent key can crowd into one task.

    ``right`` has each key once, with ``count`` of its rows in ``left``. Frequent keys
    (null too) reach ``left`` by a broadcast of at most 1 / HEAVY rows; the rest is an
    ordinary join.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    keyed = right.withColumn("_key", F.struct(key)).drop(key)
    rows = left.withColumn("_key", F.struct(key))
    heavy = F.broadcast(keyed.filter(F.col(count) >= HEAVY * total))
    light = rows.join(heavy.select("_key"), "_key", "left_anti").join(keyed.filter(F.col(count) < HEAVY * total), "_key")
    return rows.join(heavy, "_key").unionByName(light).drop("_key")
