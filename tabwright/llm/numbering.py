"""Gapless numbers within a few groups, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets that each group is dealt into; a bucket is numbered in one task.
BUCKETS = 1024


def numbered(df: DataFrame, group: str, order: list[Column], name: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with 0, 1, 2, ... within every value of ``group``, as column ``name``.

    Rows are dealt by a hash of ``order`` to buckets, numbered inside their bucket, and
    shifted by the sizes of the buckets before it, so a group that holds most of the
    rows spreads over many tasks. Rows equal in ``order`` are numbered in any way.
    ``group`` must have few values: the table of bucket sizes, at most
    groups x ``buckets`` rows, is broadcast.
    """
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order))
    return (
        dealt.withColumn("__inside", inside)
        .join(F.broadcast(starts), [group, "__bucket"])
        .withColumn(name, F.col("__start") + F.col("__inside") - 1)
        .drop("__bucket", "__inside", "__start")
    )
