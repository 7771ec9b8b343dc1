import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tabwright.llm import exact


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return sorted(
        (i, max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t in rows
    )


def result(df, support=exact.SUPPORT):
    return sorted(tuple(r) for r in exact.duplicate_groups(df, support).collect())


def test_groups_equal_brute_force_with_a_hot_group(documents):
    texts = ["Hot Text"] * 200 + [f"text {i % 150}" for i in range(300)] + ["É", "é", None, "", "HOT text", "x" * 300_000]
    for support in (0.001, 0.05, 0.5):
        assert result(documents(texts), support) == brute(list(enumerate(texts)))


def test_candidates_hold_every_heavy_digest(documents):
    rows = exact.digests(documents(["a"] * 40 + ["b"] * 30 + [str(i) for i in range(130)]))
    named = {r.digest for r in exact.heavy_candidates(rows, 0.1).collect()}
    assert {hashlib.sha256(t).hexdigest() for t in (b"a", b"b")} <= named and len(named) <= 10


def test_repeated_rows_keep_one(documents):
    rows = exact.duplicate_groups(documents([(5, "a"), (5, "A"), (None, "a"), (None, "q"), (2, "a")])).collect()
    assert sum(r.kept for r in rows if r.group_size == 4) == 1
    assert {r.keep_id for r in rows if r.group_size == 4} == {5}
    assert [r.kept for r in rows if r.group_size == 1] == [True]


def test_empty_table_and_clashing_columns(documents):
    df = documents([]).withColumns({"digest": F.lit("x"), "row": F.lit(1), "best": F.lit(2)})
    assert exact.duplicate_groups(df).count() == 0
