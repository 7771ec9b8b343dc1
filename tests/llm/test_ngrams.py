import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import words
from tabwright.llm import ngrams


def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Sorted (id, class, links)."""
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and ((rows[i][1] or "") == (rows[j][1] or "") or (
        sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])))] for i in range(n)]
    label = list(range(n))
    for i in range(n):
        todo = [i]
        if label[i] != i:
            continue
        seen = {i}
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[k][0] for k in seen)
        for k in seen:
            label[k] = ("class", least)
    return sorted((rows[i][0], label[i][1], len(linked[i])) for i in range(n))


def corpus(seed, copies=60):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [" ".join(fresh(rng.randrange(1, 150))) for _ in range(80)]
    for _ in range(copies):
        body = rng.choice(texts).split()
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            body[rng.randrange(len(body))] = f"x{rng.randrange(10**6)}"
        texts.append(rng.choice(["{}", "{}", " {}", "{}\n"]).format(" ".join(body)))
    rng.shuffle(texts)
    return texts


def check(df, rows):
    assert sorted(tuple(r) for r in ngrams.near_duplicates(df).collect()) == brute(rows)


@pytest.mark.parametrize("chunk,block", [(1_500_000, 1_000), (200, 2)])
def test_equal_to_brute_force(documents, monkeypatch, chunk, block):
    monkeypatch.setattr(ngrams, "CHUNK", chunk)
    monkeypatch.setattr(ngrams, "BLOCK", block)
    texts = corpus(1) + [None, "", "", " \n", "one two", "one  two", "two one", "word " * 30_000]
    check(documents(texts), list(enumerate(texts)))


def test_large_group_of_near_copies(documents):
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join(base)] * 30
    for i in range(250):
        body = list(base)
        for k in range(1 + i % 3):
            body[(i * 13 + k * 41) % 120] = f"n{i}-{k}"
        texts.append(" ".join(body))
    check(documents(texts), list(enumerate(texts)))


def test_one_of_each_class_stays(documents):
    texts = corpus(3)
    df = documents(texts).withColumns({"root": F.lit(1), "copies": F.lit("x"), "least": F.lit(2)})
    out = ngrams.one_of_each_class(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c, _ in brute(list(enumerate(texts)))})


def test_repeated_rows_null_ids_and_empty_table(documents):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (None, "g h"), (2, "q")]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngrams.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(4, 4, 2), (4, 4, 2), (None, 4, 2), (None, None, 0), (2, 2, 0)], key=str)
    assert sorted(str(r.doc_id) for r in ngrams.one_of_each_class(documents(rows)).collect()) == ["2", "4", "None"]
    assert ngrams.near_duplicates(documents([])).count() == 0


def test_banding_meets_its_recall():
    for s, recall in [(0.8, 0.9999), (0.8, 0.9), (0.5, 0.95)]:
        bands, rows = ngrams.banding(s, recall)
        assert 1 - (1 - s**rows) ** bands >= recall
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(200):  # pairs of sets at a similarity of 0.8
        shared, a, b = (rng.integers(1 << 63, size=n).astype(np.uint64) for n in (80, 10, 10))
        grams_ = np.concatenate([shared, a, shared, b])
        keys = ngrams.band_keys(grams_, np.array([0, 90, 180]), *ngrams.banding(0.8, 0.9999))
        met += bool((keys[0] == keys[1]).any())
    assert met >= 198


def test_components_of_chains_and_stars(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(100)] + [(f"s{i}", "s") for i in range(20)]
    got = {r.node: r.root for r in ngrams.components(spark.createDataFrame(edges, "node string, other string")).collect()}
    assert got == {**{f"{i:03}": "000" for i in range(101)}, **{f"s{i}": "s" for i in range(20)}, "s": "s"}
