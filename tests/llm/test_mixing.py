import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import words
from tabwright.llm import mixing

ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())])


def brute_targets(sizes):
    """Targets by literal resharing of what sources above their limit give back."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    excess, free = float(sum(sizes.values())), list(order)
    while excess > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += excess * weight[s] / total
        excess = sum(max(0.0, target[s] - 3 * sizes[s]) for s in free)
        target = {s: min(t, 3.0 * sizes[s]) for s, t in target.items()}
        free = [s for s in free if target[s] < 3 * sizes[s]]
    return target


def brute_taken(rows, target, sizes):
    """Counts of (doc_id, size, taken), walking each source's documents in key order."""
    by_source, seen, out = defaultdict(list), defaultdict(int), []
    for i, s, t in rows:
        n = len(words(t))
        copy = seen[i, s, n]
        seen[i, s, n] += 1
        name = f"{'' if i is None else i}:{n}:{copy // mixing.COPIES}"
        by_source[s].append((hashlib.md5(name.encode()).hexdigest(), i is not None, i or 0, n, copy))
    for s, docs in by_source.items():
        budget = int(target[s] + 1e-6)
        epochs, left = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for _, known, i, n, _ in sorted(docs):
            part = min(n, left)
            left -= part
            out.append((s or "", i if known else -1, n, epochs * n + part))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = mixing.mixed(df.withColumns({"key": F.lit(1), "size": F.lit("x"), "bucket": F.lit(2), "number": F.lit(3)})).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(words(t))
    target = brute_targets(sizes)
    source_of = {(-1 if i is None else i): s for i, s, _ in rows}
    assert sorted((source_of[-1 if r.doc_id is None else r.doc_id] or "", -1 if r.doc_id is None else r.doc_id, r.size, r.taken) for r in got) == brute_taken(rows, target, sizes)
    for r in got:
        s = source_of[-1 if r.doc_id is None else r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s], rel=1e-9) and r.taken <= 3 * r.size
    for s in sizes:
        taken = sum(r.taken for r in got if source_of[-1 if r.doc_id is None else r.doc_id] == s)
        assert 0 <= target[s] + 1e-6 - taken < 1 + 1e-6
    return got


def corpus(n=300):
    sources = ["hot"] * 4 + ["a", "b", "é", "\U0001f600", "￮", "zz", None]
    return [(i, sources[i % 11] if i % 37 else "tiny", "w " * (i * i % 23) if i % 19 else None) for i in range(n)]


def test_budgets_are_met_exactly(spark):
    check(spark, corpus())


def test_buckets_and_ordinary_joins(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_UNITS", 7)
    monkeypatch.setattr(mixing, "HEAVY", 0.2)
    check(spark, corpus())


def test_copies_split_into_units(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 3)
    rows = [(7, "a", "x y z")] * 50 + [(None, "b", "x y")] * 20 + [(i, "c", "w " * i) for i in range(10, 20)]
    check(spark, rows)


def test_same_result_whatever_the_partitions(spark):
    df = spark.createDataFrame(corpus(), ROWS)
    assert sorted(mixing.mixed(df.repartition(1)).collect()) == sorted(mixing.mixed(df.repartition(9)).collect())


def test_empty_tables_and_texts(spark):
    assert mixing.mixed(spark.createDataFrame([], ROWS)).count() == 0
    rows = mixing.mixed(spark.createDataFrame([(1, "a", None), (2, None, " \n"), (None, None, "")], ROWS)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 3


def test_no_python_in_the_plan(spark):
    plan = mixing.mixed(spark.createDataFrame(corpus(), ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
