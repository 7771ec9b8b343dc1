import random
import zlib

import pytest
from pyspark.sql import functions as F

from tabwright.llm import shards


def brute(sizes, k):
    """The smallest capacity for ordered sizes, trying each."""
    def needed(capacity):
        used, fill = 1, 0
        for s in sizes:
            if s > capacity:
                return k + 1
            if fill + s > capacity:
                used, fill = used + 1, 0
            fill += s
        return used
    capacity = max(sizes, default=0)
    while needed(capacity) > k:
        capacity += 1
    return capacity


@pytest.mark.parametrize("seed,n,k", [(0, 1, 4), (1, 40, 4), (2, 300, 16), (3, 900, 7), (4, 12, 16)])
def test_capacity_is_the_smallest(spark, seed, n, k, monkeypatch):
    monkeypatch.setattr(shards, "FIRST_DIGITS", 1)
    monkeypatch.setattr(shards, "MORE_DIGITS", 1)
    rng = random.Random(seed)
    rows = sorted((f"{rng.getrandbits(256):064x}", rng.choice([1, 5, 50, 700])) for _ in range(n))
    groups = spark.createDataFrame(rows, "digest string, size long")
    capacity, firsts = shards.minimax_cuts(groups, k)
    assert capacity == brute([s for _, s in rows], k)
    loads = {}
    for d, s in rows:
        at = sum(d >= f for f in firsts)
        loads[at] = loads.get(at, 0) + s
    assert max(loads.values()) == capacity and len(loads) <= k


def test_rows(documents):
    texts = ["hot"] * 300 + [None, "", "é"] + [f"text {i} " * (i % 17) for i in range(400)]
    df = documents(texts).withColumns({"digest": F.lit(1), "shard": F.lit("x"), "slot": F.lit(2)})
    rows = shards.balanced_shards(df).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by_shard, by_text = {}, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        by_shard.setdefault(r.shard, []).append(r.slot)
        by_text.setdefault(data, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert set(by_shard) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_empty_and_repeated(documents):
    assert shards.balanced_shards(documents([])).count() == 0
    rows = shards.balanced_shards(documents([(1, "a"), (1, "a"), (None, None), (None, "b")])).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4
