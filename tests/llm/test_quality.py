import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import words
from tabwright.llm import quality


def counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    covered = {k for i, x in enumerate(windows) if seen[x] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def measured(df):
    rows = quality.measured(df.select("doc_id", "text")).select("doc_id", "__measures.*").collect()
    return {r.doc_id: tuple(r[n] for n in quality.COUNTS) for r in rows}


def test_counts_equal_brute_force(documents):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a  b\x0bc d", "x\n\nx\nx \n \n", "#|<a> #", "z" * 100_000, "😀 é"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "d\t"]) for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["one two three four five six seven eight nine " * 3, "the of " * 5000, "ab " * 8]
    assert measured(documents(texts)) == {i: counts(t) for i, t in enumerate(texts)}


def corpus():
    """Good prose, two kinds of junk, and labels for half of it."""
    rng = random.Random(5)
    texts = []
    for i in range(1200):
        body = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 90))]
        if i % 10 == 0:
            body = [w + "###" for w in body]
        elif i % 10 == 1:
            body = [w.upper() + "!!" for w in body]
        texts.append((i, " ".join(body)))
    return texts, [(i, 0 if i % 10 < 2 else 1, 0) for i in range(0, 1200) if i % 3]


def test_rules_catch_planted_junk_and_spare_the_rest(spark, documents):
    texts, labels = corpus()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = documents(texts)
    kept = {r.doc_id: r.kept for r in quality.quality_rules(df, labels).collect()}
    assert kept == {i: i % 10 > 1 for i, _ in texts}
    good = quality.good_documents(df, labels)
    assert good.columns == df.columns
    assert {r.doc_id for r in good.collect()} == {i for i in kept if kept[i]}


def test_rules_are_ordered_conditions(spark, documents):
    texts, labels = corpus()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality.measured(documents(texts))
    rules = quality.learned_rules(rows, labels)
    assert 1 <= len(rules) <= quality.MOST_RULES
    assert all(1 <= len(r.conditions) <= quality.MOST_CONDITIONS and str(r) for r in rules)
    named = quality.judged(rows, rules).groupBy("rule").count().collect()
    assert {r.rule for r in named} <= {None, *range(1, len(rules) + 1)}


def test_base_test_alone_without_labels(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    texts = ["word " * 19, " ".join(f"w{i}" for i in range(20)), None, "a b c d e f g h " * 5]
    rows = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_rules(documents(texts), empty).collect()}
    assert rows == {0: (True, False), 1: (False, True), 2: (True, False), 3: (True, False)}
    unlabelled = spark.createDataFrame([(1, None, None), (1, 1, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(documents(texts), unlabelled).filter("kept").count() == 1
    assert quality.quality_rules(documents([]), empty).count() == 0


def test_plan_is_native_and_columns_may_clash(spark, documents, capsys):
    texts, labels = corpus()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = documents(texts).withColumns({"quality": F.lit(7), "n_words": F.lit("x"), "bad": F.lit(True)})
    rows = quality.quality_rules(df, labels)
    rows.explain()
    assert "Python" not in capsys.readouterr().out
    assert rows.count() == len(texts)
