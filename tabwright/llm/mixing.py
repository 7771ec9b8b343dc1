"""Sources mixed to target weights, in DataFrame functions only.

1. Documents are reduced to *units*: copies that share source, id and size, at most
   ``COPIES`` in one. A unit's key is the md5 of these and of its number: random, but the
   same in every run.
2. Sources, one row each, are numbered by code point (null last) and weigh 1, 2, 3 in
   turn. The common level per weight that spends all words is found by rounds of one small
   aggregation: sources whose share exceeds ``MOST_EPOCHS`` times their size stop there,
   and the rest is shared again.
3. Within a source, units are sorted by key: the key's leading bits are its bucket, a
   bucket holds some ``BUCKET_UNITS`` units whatever the source's size, and prefix sums of
   words run inside a bucket and over the buckets before it. No task holds a source.
4. A source's budget is its target, rounded down. It takes as many whole epochs as fit,
   and of one more epoch the prefix up to the exact budget; the document that the cut
   falls into gives the words before it.

What a source knows reaches its units by a broadcast for sources with at least ``HEAVY``
of all units (no more than ``1 / HEAVY`` of them), by an ordinary join for the others.

A null text has no words. Null and repeated ids are rows like others; copies that share
source, id and size are told apart only by which of them the cut falls into. An empty
table, or one without any word, takes nothing. Columns besides doc_id, source and text
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.lineage import stored

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = 3
MOST_EPOCHS = 3
COPIES = 1000
BUCKET_UNITS = 50_000
HEAVY = 0.001


def units(docs: DataFrame) -> DataFrame:
    """source, doc_id, size, chunk, copies and the hash-random key, written once without texts."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select("source", "doc_id", words.alias("size"))
    groups = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    chunks = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {COPIES}").cast("int"))))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"), F.col("chunk"))
    return stored(
        chunks.select(
            "source", "doc_id", "size", "chunk",
            F.least(F.col("n") - F.col("chunk") * COPIES, F.lit(COPIES)).cast("int").alias("copies"),
            F.md5(name).alias("key"),
        ),
        "mix-units",
    )


def weighted_sources(parts: DataFrame) -> DataFrame:
    """source, its number by code point (null last), weight, source_size and units."""
    sizes = parts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    order = F.col("source").asc_nulls_last()
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(sizes.repartitionByRange(n, order).withColumn("part", F.spark_partition_id()), "mix-placed-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )  # one row per partition
    number = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    numbered = placed.join(F.broadcast(starts), "part").withColumn("number", number)
    return stored(
        numbered.select("source", "number", (F.col("number") % WEIGHTS + 1).alias("weight"), "source_size", "units"), "mix-sources"
    )


def above(level: float) -> Column:
    return F.lit(level) * F.col("weight") > MOST_EPOCHS * F.col("source_size")


def common_level(sources: DataFrame) -> float:
    """Words per weight, such that targets (stopped at their limit) spend all words."""
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if not whole["size"]:
        return 0.0
    level, stopped = whole["size"] / whole["weight"], -1
    while True:
        now = sources.agg(
            F.count(F.when(above(level), 1)).alias("n"),
            F.coalesce(F.sum(F.when(above(level), MOST_EPOCHS * F.col("source_size"))), F.lit(0)).alias("size"),
            F.sum(F.when(~above(level), F.col("weight"))).alias("weight"),
        ).first()
        if now["n"] == stopped:
            return level
        stopped, level = now["n"], (whole["size"] - now["size"]) / now["weight"]


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` with target, whole epochs, the rest of the budget, and buckets."""
    level = common_level(sources)
    target = F.when(above(level), (MOST_EPOCHS * F.col("source_size")).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    known = sources.withColumn("target", target).withColumn("budget", F.floor("target"))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    return known.withColumn("epochs", epochs).select(
        "source", "number", "source_size", "units", "target", "epochs",
        (F.col("budget") - F.col("epochs") * F.col("source_size")).alias("rest"),
        F.ceil(F.col("units") / BUCKET_UNITS).alias("buckets"),
    )


def with_sources(parts: DataFrame, known: DataFrame) -> DataFrame:
    """Units with what their source knows."""
    total = known.agg(F.sum("units")).first()[0] or 0
    keyed = known.withColumn("of", F.struct("source")).drop("source")
    heavy = keyed.filter(F.col("units") >= HEAVY * total)
    rows = parts.withColumn("of", F.struct("source")).drop("source")
    rest = rows.join(F.broadcast(heavy.select("of")), "of", "left_anti")
    light = keyed.filter(F.col("units") < HEAVY * total)
    return rows.join(F.broadcast(heavy), "of").unionByName(rest.join(light, "of")).drop("of")


def mixed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    parts = units(docs)
    rows = with_sources(parts, targets(weighted_sources(parts)))
    unit = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    rows = rows.withColumn("bucket", F.floor(unit * F.col("buckets")).cast("long"))
    words = F.col("size") * F.col("copies")
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("number", "bucket").agg(F.sum(words).alias("words")).select(
        "number", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("number", "bucket").orderBy("key", "doc_id", "size", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(starts, ["number", "bucket"])
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    left = F.col("rest") - F.col("start") - F.col("inside") - F.col("copy") * F.col("size")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return summed.select("*", copy).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
