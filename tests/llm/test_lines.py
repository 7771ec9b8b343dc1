import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import words
from tabwright.llm import lines


def brute(rows):
    """(id, text) rows to {(id, text): (number of lines, kept lines)}."""
    places = sorted(
        (-1 if i is None else i, k, t or "", frozenset(words(line)))
        for i, t in {(i, t) for i, t in rows} for k, line in enumerate((t or "").split("\n"))
    )
    gone = set()
    earlier = []
    for i, k, t, s in places:
        if len(s) < lines.LEAST_WORDS:
            continue
        if any((j, m) < (i, k) and 5 * len(s & r) >= 4 * len(s | r) for j, m, r in earlier):
            gone.add((i, t, k))
        earlier.append((i, k, s))
    return {
        (-1 if i is None else i, t or ""): [x for k, x in enumerate((t or "").split("\n")) if (-1 if i is None else i, t or "", k) not in gone]
        for i, t in rows
    }


def check(df, rows):
    want = brute(rows)
    got = sorted(tuple(r) for r in lines.removal_report(df).collect())
    full = sorted(
        (i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
        for i, t in rows for n, kept in [((t or "").count("\n") + 1, want[i, t or ""])]
    )
    assert got == full


def corpus(seed, vocabulary, weights):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(3, 40))) for _ in range(40)]
    texts = []
    for _ in range(120):
        body = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                rng.shuffle(line)
            body.append(" ".join(line))
        texts.append("\n".join(body))
    return texts


@pytest.mark.parametrize("chunk,block", [(1_500_000, 8_000), (60, 3)])
def test_equal_to_brute_force(documents, monkeypatch, chunk, block):
    monkeypatch.setattr(lines, "CHUNK", chunk)
    monkeypatch.setattr(lines, "BLOCK", block)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = corpus(1, vocabulary, [1 / (i + 1) for i in range(300)])
    texts += [None, "", "\n\n", "one two three four\none two three four", "x" * 60_000, "a b c d e\r\nb a c d e\n", "é ü ö ä ß\né ü ö ä ß"]
    check(documents(texts), list(enumerate(texts)))


@pytest.mark.parametrize("meeting", [0, 3, 40])
def test_only_frequent_words(documents, monkeypatch, meeting):
    monkeypatch.setattr(lines, "MEETING", meeting)
    monkeypatch.setattr(lines, "NEAR", 2)
    texts = corpus(2, [f"v{i}" for i in range(25)], None)
    check(documents(texts), list(enumerate(texts)))


@pytest.mark.parametrize("long,longer", [(96, 192), (6, 12)])
def test_long_lines(documents, monkeypatch, long, longer):
    monkeypatch.setattr(lines, "LONG", long)
    monkeypatch.setattr(lines, "LONGER", longer)
    rng = random.Random(7)
    texts = corpus(5, [f"v{i}" for i in range(200)], None)
    for n in (80, 110, 150, 185, 215, 300, 450):
        base = [f"l{n}-{i}" for i in range(n)]
        for changed in (0, 0.05, 0.09, 0.1, 0.11, 0.12, 0.2, 0.5):
            line = list(base)
            for k in rng.sample(range(n), round(changed * n)):
                line[k] = f"c{rng.randrange(10**9)}"
            texts.append(" ".join(line))
    rng.shuffle(texts)
    check(documents(texts), list(enumerate(texts)))


def test_hot_line_with_variants(documents):
    base = [f"w{i}" for i in range(30)]
    texts = [" ".join(base)] * 150
    for i in range(300):
        line = list(base)
        line[i % 30] = f"x{i}"
        line[(i * 7) % 30] = f"y{i}"
        line[(i * 11) % 30] = f"z{i}"
        texts.append(" ".join(line) + "\nother line number of five " + str(i))
    check(documents(texts), list(enumerate(texts)))


def test_repeated_rows_null_ids_and_empty_table(documents):
    rows = [(3, "a b c d e\nf g h i j"), (3, "a b c d e\nf g h i j"), (None, "f g h i j"), (4, "e d c b a")]
    out = sorted(tuple(r)[:3] for r in lines.removal_report(documents(rows)).fillna(-1).collect())
    assert out == [(-1, 1, 0), (3, 2, 1), (3, 2, 1), (4, 1, 1)]
    assert lines.removal_report(documents([])).count() == 0


def test_texts_and_columns(documents):
    df = documents(["a b c d e\nshort", "x y z u v\na b c d e\n", "e d c b a", "", None]).withColumns({"line": F.lit(1), "group": F.lit("s")})
    out = lines.without_repeated_lines(df)
    assert out.schema.names == df.schema.names
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        0: ("a b c d e\nshort", 15), 1: ("x y z u v\n", 10), 3: ("", 0), 4: (None, None),
    }


def test_overlaps_and_prefixes_are_the_least_that_suffice():
    for n in range(1, 60):
        for m in range(1, 60):
            need = next((k for k in range(min(n, m) + 1) if 5 * k >= 4 * (n + m - k)), 10**6)
            got = int(lines.least_overlap(np.int64(n), np.int64(m)))
            assert got == need or (need == 10**6 and got > min(n, m))
        assert lines.prefix_length(np.int64(n)) == n - -(-4 * n // 5) + 1


def test_lines_of_few_words_take_part(documents):
    texts = ["menu\nshare this page\na b c d", "menu\nthis page share\na b c d e", "a b c\nmenu menu\nb c d e", "a b\n\n \n\n", "a\nb a\n\na b c e"]
    check(documents(texts), list(enumerate(texts)))
    out = {r.doc_id: r.n_removed for r in lines.removal_report(documents(texts)).collect()}
    assert out == {0: 0, 1: 3, 2: 2, 3: 0, 4: 2}


def test_small_sets_are_told_apart_by_whole_hashes(monkeypatch):
    monkeypatch.setattr(lines.W, "span_hashes", lambda data, start, end: data[start].astype(np.uint64))  # differ in the low bits only
    sets = lines.LineSets(pa.array(["a\nb\na a"]), np.zeros(16, np.uint8))
    assert sets.size.tolist() == [1, 1, 1]
    assert sets.key[0] == sets.key[1] and sets.check[0] != sets.check[1] and sets.check[0] == sets.check[2]


def test_a_hot_line_leaves_a_chunk_once(documents):
    texts = [f"menu of the whole site\nline number {i}" for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(1000), pa.int64()), pa.array(range(1000), pa.int64())], names=["text", "__id", "__ref"])
    out = pa.Table.from_batches(lines._emitted(iter([batch]), np.zeros(16, np.uint8), (1, 2), 4)).to_pydict()
    places, gone = ([n for s, n in zip(out["shard"], out["c1"]) if s // 4 == kind] for kind in (0, 2))
    assert sum(map(len, places)) // 8 == 1001 and sum(map(len, gone)) // 8 == 999
    assert len(gone) == 4  # dealt by document
    rows = [(0, "x y z"), (0, "x y z\nq"), (1, "x y z"), (1, "q\nx y z"), (2, "p\nq\nz y x"), (2, "p\nq\nz y x")]
    check(documents(rows), rows)
