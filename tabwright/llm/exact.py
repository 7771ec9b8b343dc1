"""Exact duplicates with a split for heavy hitters, in DataFrame functions only.

1. Each row becomes a digest of its normalised text (A-Z lower-cased), once, in a
   written table without texts.
2. A Misra-Gries summary of the digests (``DataFrame.freqItems``: counters that
   partitions fill and merge) names every digest held by more than ``support`` of
   the rows, and perhaps others. It never has more than ``1 / support`` entries.
3. Those candidates are counted exactly, with partial sums before the shuffle.
   The table of their winners has at most ``1 / support`` rows, so it is broadcast
   and heavy groups are resolved where their rows lie.
4. All other digests are shuffled; no group of theirs exceeds ``support`` of the rows.

A group is all rows of equal normalised text; null counts as empty. The row with
the largest ``doc_id`` stays; of repeated rows with that id, one. A null id is
smaller than any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm.tables import lower_ascii

SUPPORT = 0.001


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, a row number and the digest of the normalised text, written once."""
    normalised = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.sha2(normalised, 256).alias("digest")
    ).withColumn("row", F.monotonically_increasing_id())
    return stored(rows, "digests")


def heavy_candidates(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digests that may be held by more than ``support`` of the rows: a superset of those that are."""
    return rows.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))


def winners(rows: DataFrame) -> DataFrame:
    """The row that stays and the size, per digest."""
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def duplicate_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(docs)
    candidates = stored(heavy_candidates(rows, support), "heavy-candidates")
    heavy = stored(
        winners(rows.join(F.broadcast(candidates), "digest", "left_semi"))
        .filter(F.col("group_size") > 1),
        "heavy-winners",
    )
    of_heavy = rows.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    of_rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "digest", "doc_id", "row",
        F.max(F.struct("doc_id", "row")).over(group).alias("best"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    return of_heavy.select(of_rest.columns).unionByName(of_rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
