"""Shards of nearly equal bytes: the contiguous partition with the smallest largest shard.

Groups (rows of equal text) are atomic and ordered by the digest of their text. The
smallest capacity for which greedy filling needs no more than the given shards is
found by binary search; shards are cut there.

The sizes never come to the driver whole. It holds a list of *runs* of consecutive
groups, each with its total size. For a capacity, the greedy cuts are bracketed by
cutting only between runs (late bound of what fits) and by cutting anywhere (early
bound). Where the brackets leave the answer open, the runs that a cut may fall into
are read again, split sixteenfold or more, until they are single groups. A pass reads
one grouped table and returns at most ``MOST_RUNS`` rows or so.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm.numbering import numbered

SHARDS = 16
#: Hex digits of the digest that name the first runs, and how many each refinement adds.
FIRST_DIGITS, MORE_DIGITS = 3, 2
DIGITS = 64


def text_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the digest of the text, written once without the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("digest"),
    )
    return stored(rows, "text-sizes")


class Runs:
    """Consecutive runs of ordered groups: name (a prefix of digests), size, number of groups."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        rows = sorted(rows)
        self.names = [r[0] for r in rows]
        self.sizes = [r[1] for r in rows]
        self.groups = [r[2] for r in rows]
        self.ends = list(accumulate(self.sizes))
        self.total = self.ends[-1] if rows else 0

    def single(self, i: int) -> bool:
        return self.groups[i] == 1

    def cut_surely(self, start: int, capacity: int) -> int:
        """The last place between runs that a shard from ``start`` can reach."""
        i = bisect_right(self.ends, start + capacity)
        return self.ends[i - 1] if i else 0

    def cut_at_best(self, start: int, capacity: int) -> int:
        """The last place that it may reach: inside a run, unless that is one group."""
        place = start + capacity
        if place >= self.total:
            return self.total
        i = bisect_right(self.ends, place)
        if self.single(i):
            return self.ends[i - 1] if i else 0
        return place

    def cuts(self, capacity: int, shards: int, surely: bool) -> list[int]:
        step, places, at = (self.cut_surely if surely else self.cut_at_best), [], 0
        for _ in range(shards):
            at = step(at, capacity)
            places.append(at)
        return places

    def fits(self, capacity: int, shards: int, surely: bool) -> bool:
        return self.cuts(capacity, shards, surely)[-1] >= self.total

    def smallest(self, shards: int, surely: bool) -> int:
        low, high = 0, self.total
        while low < high:
            middle = (low + high) // 2
            if self.fits(middle, shards, surely):
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[str]]:
    """The smallest capacity, and the first digests of shards 1, 2, ... (fewer if some stay empty).

    ``groups``: digest and size of each atomic group, as a stored table.
    """

    def read(names: list[str] | None, digits: int) -> list[tuple[str, int, int]]:
        name = F.substring("digest", 1, digits)
        part = groups
        if names is not None:
            part = groups.filter(F.substring("digest", 1, len(names[0])).isin(names))
        rows = part.groupBy(name.alias("name")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        return [(r["name"], r["size"], r["n"]) for r in rows]

    rows = read(None, FIRST_DIGITS)
    while True:
        runs = Runs(rows)
        sure, best = runs.smallest(shards, True), runs.smallest(shards, False)
        early, late = runs.cuts(best, shards, True), runs.cuts(sure, shards, False)
        unsure: dict[int, list[str]] = {}
        for a, b in zip(early, late):
            first = bisect_left(runs.ends, a)
            for i in range(first, min(bisect_left(runs.ends, b) + 1, len(runs.ends))):
                if not runs.single(i):
                    unsure.setdefault(len(runs.names[i]), []).append(runs.names[i])
        if sure == best and not unsure or not unsure:
            break
        split: list[tuple[str, int, int]] = []
        gone: set[str] = set()
        for digits, names in unsure.items():
            names = sorted(set(names))
            gone.update(names)
            split += read(names, min(DIGITS, digits + MORE_DIGITS))
        rows = [r for r in rows if r[0] not in gone] + split
    places = runs.cuts(sure, shards, True)
    firsts = [runs.names[bisect_right(runs.ends, p)] for p in places if p < runs.total]
    return sure, sorted(set(firsts))


def shard_of(digest: Column, firsts: list[str]) -> Column:
    """The number of shards that begin at or before a digest; shard 0 begins before all."""
    label = F.lit(0)
    for k, name in enumerate(firsts, start=1):
        label = F.when(digest >= name, k).otherwise(label)
    return label.cast("int")


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Equal texts share a shard. A size is the UTF-8 bytes of the text (null: none) plus
    one. Slots count from 0 without gaps in each shard. Null and repeated ids are kept
    as they are. An empty table gives an empty result; shards that no group needs stay
    empty.
    """
    rows = text_sizes(docs)
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("size")), "text-groups")
    _, firsts = minimax_cuts(groups, shards)
    placed = rows.withColumn("shard", shard_of(F.col("digest"), firsts))
    return numbered(placed, "shard", [F.col("doc_id"), F.col("digest")], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
