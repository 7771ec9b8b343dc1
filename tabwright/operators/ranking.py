"""Exact ranks and running totals without a window over all rows.

A window without (or with a coarse) ``partitionBy`` puts a whole group into one
task. Here rows first fall into ordered buckets; ranks are taken per bucket and
shifted by the size of the buckets before. Bucket sizes come from one partial
aggregation, so the offsets stay as small as groups x buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.lineage import cut
from tabwright.operators.joins import null_safe_join


def bucket_count(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """1-based rank in ``by`` for rows that carry an ordered ``_bucket``."""
    grouped = df.withColumn("_by", F.struct(*by)) if by else df.withColumn("_by", F.struct(F.lit(0).alias("all")))
    before = Window.partitionBy("_by").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        grouped.groupBy("_by", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_by", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_by", "_bucket").orderBy(*order)
    ranked = grouped.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(offsets, ["_by", "_bucket"])
        .withColumn(name, (F.col("_inside") + F.col("_before")).cast("bigint"))
        .drop("_by", "_bucket", "_inside", "_before")
    )


def hashed_rank(
    df: DataFrame, unit: Column, tie: Sequence[str], by: Sequence[str] = (), name: str = "rank", buckets: int | None = None
) -> DataFrame:
    """Rank by a number that is uniform in [0, 1), within ``by``; a huge group spreads over all buckets.

    Rows without a number come first.
    """
    n = buckets or bucket_count(df)
    bucket = F.coalesce(F.floor(F.col("_unit") * n).cast("int"), F.lit(-1))
    df = df.withColumn("_unit", unit).withColumn("_bucket", bucket)
    return _rank(df, by, [F.col("_unit"), *map(F.col, tie)], name).drop("_unit")


def ordered_rank(df: DataFrame, key: str, name: str = "rank", buckets: int | None = None) -> DataFrame:
    """Rank by a unique numeric or time column; buckets end at its approximate quantiles."""
    n = buckets or bucket_count(df)
    as_number = F.col(key).cast("timestamp").cast("double") if "timestamp" in dict(df.dtypes)[key] else F.col(key).cast("double")
    df = df.withColumn("_number", as_number)
    edges = sorted(set(df.approxQuantile("_number", [i / n for i in range(1, n)], 0.1 / n)))
    splits = [float("-inf"), *edges, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_number", outputCol="_bucket", handleInvalid="keep")
    if len(splits) < 3:
        bucketed = df.withColumn("_bucket", F.lit(0.0))
    else:
        bucketed = bucketizer.transform(df.filter("_number is not null")).unionByName(
            df.filter("_number is null").withColumn("_bucket", F.lit(-1.0))
        )
    return _rank(bucketed.drop("_number"), (), [F.col(key)], name)


def running_totals(df: DataFrame, by: Sequence[str], order: str, totals: Sequence[str], parts: int | None = None) -> DataFrame:
    """Inclusive running sums of ``totals`` in ``order`` within ``by``, and the ``next`` order value.

    ``df`` holds one row per (by, order) value, so range partitioning cannot meet
    a hot key. It is checkpointed once, which pins the partition numbers.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *by, order).withColumn("_part", F.spark_partition_id())
    placed = cut(placed)
    per_part = placed.groupBy(*by, "_part").agg(*[F.sum(t).alias(f"_t_{t}") for t in totals], F.min(order).alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy(*by).orderBy("_part")
    shift = per_part.select(
        *by,
        "_part",
        *[F.coalesce(F.sum(f"_t_{t}").over(earlier), F.lit(0)).alias(f"_b_{t}") for t in totals],
        F.lead("_first").over(following).alias("_next_first"),
    )
    inside = Window.partitionBy(*by, "_part").orderBy(order)
    to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select(
        "*",
        *[F.sum(t).over(to_here).alias(f"_r_{t}") for t in totals],
        F.lead(order).over(inside).alias("_next_inside"),
    )
    return null_safe_join(running, shift, [*by, "_part"]).select(
        *df.columns,
        *[(F.col(f"_r_{t}") + F.col(f"_b_{t}")).alias(f"upto_{t}") for t in totals],
        F.coalesce("_next_inside", "_next_first").alias("next"),
    )
