import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import words
from tabwright.llm import substrings


def brute(rows, window=20):
    """(id, text) rows to {(id, text): (n_words, kept words)}."""
    first = {}
    documents = sorted({(-1 if i is None else i, t or "") for i, t in rows})
    for i, t in documents:
        w = words(t)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = {}
    for i, t in documents:
        w = words(t)
        cut = {k for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] < (i, s) for k in range(s, s + window)}
        out[i, t] = (len(w), [x for k, x in enumerate(w) if k not in cut])
    return out


def check(df, rows, window=20):
    want = brute(rows, window)
    got = sorted(tuple(r) for r in substrings.removal_report(df, window).collect())
    full = sorted(
        (i, n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for i, t in rows for n, kept in [want[i, t or ""]]
    )
    assert got == full


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [fresh(rng.randrange(15, 60)) for _ in range(6)]
    texts = []
    for _ in range(120):
        body = []
        for _ in range(rng.randrange(1, 5)):
            body += fresh(rng.randrange(0, 30))
            if rng.random() < 0.7:
                p = rng.choice(passages)
                a = rng.randrange(len(p) // 2)
                body += p[a : a + rng.randrange(10, 60)]
        texts.append(" ".join(body))
    for _ in range(30):  # near copies
        body = texts[rng.randrange(20)].split()
        if body:
            body[rng.randrange(len(body))] = "changed"
        texts.append("\n".join(body))
    return texts


@pytest.mark.parametrize("chunk,automaton", [(1_000_000, 5_000), (40, 5_000), (40, 2)])
def test_equal_to_brute_force(documents, monkeypatch, chunk, automaton):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    monkeypatch.setattr(substrings, "AUTOMATON", automaton)
    texts = corpus(1) + [None, "", "the of " * 60, "a " * 45, "x" * 50_000, "one two three " * 9 + "end"]
    check(documents(texts), list(enumerate(texts)))


def test_few_words_many_repeats(documents):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(150)]
    check(documents(texts), list(enumerate(texts)))


def test_a_hot_passage_and_exact_copies(documents):
    passage = " ".join(f"p{i}" for i in range(55))
    texts = [f"begin{i} {passage} end{i}" for i in range(300)] + ["same " + passage] * 50
    check(documents(texts), list(enumerate(texts)))


def test_repeated_rows_and_null_ids(documents):
    text = " ".join(f"q{i}" for i in range(30))
    rows = [(7, text), (7, text), (9, "x " + text)]
    check(documents(rows), rows)
    got = substrings.removal_report(documents([(None, text), (1, text)])).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [0, 30]
    assert substrings.removal_report(documents([])).count() == 0


def test_texts_keep_their_space_and_columns(documents):
    text = " ".join(f"q{i}" for i in range(30))
    df = documents([text, f"first line\n\n  {text}\tlast  line\n", text, "", "short"]).withColumns({"removed": F.lit(1), "start": F.lit("s")})
    out = substrings.without_repeats(df)
    assert out.schema.names == df.schema.names
    rows = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    want = {0: text, 1: "first line\n\n  last  line\n", 3: "", 4: "short"}
    assert rows == {i: (t, len(t)) for i, t in want.items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25), max_size=6), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_matching_statistics(known, query):
    automaton = substrings.Automaton()
    for k in known:
        automaton.add(k)
    passages = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i, len(k) + 1)}
    want = [max(n for n in range(i + 2) if n == 0 or tuple(query[i + 1 - n : i + 1]) in passages) for i in range(len(query))]
    assert automaton.matches(query) == want
