import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import words
from tabwright.llm import lm


def tokens(text):
    return [*("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)), None]


def discounts(counts):
    """As the contract of the model has it: estimates inside (0, count), else a half, one, one and a half."""
    n, out = Counter(counts), [0]
    for k, plain in ((1, 0.5), (2, 1.0), (3, 1.5)):
        d = k - (k + 1) * n[1] / (n[1] + 2 * n[2]) * n[k + 1] / n[k] if n[1] and n[k] else plain
        out.append(d if 0 < d < k else plain)
    return out


def brute(texts, training):
    """The same model with dictionaries, as the formulas say it."""
    unigrams, pairs = Counter(), Counter()
    for t in training:
        seq = tokens(t)
        unigrams.update(seq)
        pairs.update(zip(["<begin>", *seq[:-1]], seq))
    left, right, total = Counter(w for _, w in pairs), defaultdict(list), Counter()
    for (u, _), c in pairs.items():
        right[u].append(c)
        total[u] += c
    d2, d1 = discounts(pairs.values()), discounts(left.values())
    n, v = sum(unigrams.values()), len(unigrams)
    gamma = sum(d1[min(c, 3)] for c in left.values()) / len(pairs) if pairs else 1

    def p_word(w):
        return (max(left[w] - d1[min(left[w], 3)], 0) / len(pairs) if pairs else 0) + gamma / (v + 1)

    def p(u, w):
        if not total[u]:
            return p_word(w)
        c = pairs[u, w]
        return max(c - d2[min(c, 3)], 0) / total[u] + sum(d2[min(x, 3)] for x in right[u]) / total[u] * p_word(w)

    out = []
    for t in texts:
        seq = tokens(t)
        out.append((
            len(seq), sum(unigrams[w] > 0 for w in seq), n, sum(math.log10((unigrams[w] + 1) / (n + v + 1)) for w in seq),
            sum(math.log10(p(u, w)) for u, w in zip(["<begin>", *seq[:-1]], seq)),
        ))
    known = list(unigrams) + ["never seen"]
    for u in ["<begin>", *known[:3]]:
        assert not pairs or abs(sum(p(u, w) for w in known) - 1) < 1e-9
    return out


def corpus(n):
    rng = random.Random(11)
    vocabulary = [f"W{i}" for i in range(60)]
    return [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("chunk,least", [(3_000_000, 16), (200, 2), (50, 1)])
def test_scores_equal_brute_force(documents, monkeypatch, chunk, least):
    monkeypatch.setattr(lm, "LEAST_SHARDS", least)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    texts = [None, "", " \n", "É w1 W1 unknown", "w2 " * 3000, *corpus(150), *["same text here"] * 40]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    want = brute(texts, [t for t, h in zip(texts, held) if not h])
    rows = {r.doc_id: r for r in lm.held_out_scores(documents(texts)).collect()}
    assert [rows[i].held_out for i in range(len(texts))] == held
    for i, (n, known, total, base, score) in enumerate(want):
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-score / n), rel=1e-6)


def test_held_out_text_is_predicted_better_than_by_words_alone(documents):
    rng = random.Random(2)
    texts = []
    for _ in range(400):
        at, seq = rng.randrange(50), []
        for _ in range(40):
            at = (at * 7 + rng.choice([1, 2])) % 50
            seq.append(f"w{at}")
        texts.append(" ".join(seq))
    rows = lm.held_out_scores(documents(texts)).filter("held_out").collect()
    assert rows and all(r.score > 0.5 * r.base_score for r in rows)


def test_no_training_rows_empty_table_repeated_and_null_ids(documents):
    lone = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    row = lm.held_out_scores(documents([(lone[0], "a b")])).collect()[0]
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 3) and row.score == 0
    assert lm.held_out_scores(documents([])).count() == 0
    rows = lm.held_out_scores(documents([(None, "a b"), (3, "a b"), (3, "a b")])).collect()
    assert len(rows) == 3 and {r.n_tokens for r in rows} == {3}


def test_discounts_stay_within_their_counts():
    for counts in [(0, 0, 0, 0), (5, 1, 9, 9), (100, 40, 20, 12), (1, 10, 1, 1)]:
        d = lm.discounts(counts)
        assert d[0] == 0 and np.all((d[1:] > 0) & (d[1:] < [1, 2, 3]))


def test_fixed_numbers_of_copies_give_finite_scores(documents):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(12))
    texts = [t for t in (text() for _ in range(60)) for _ in range(4)] + [text() for _ in range(200)]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    want = brute(texts, [t for t, h in zip(texts, held) if not h])
    for r in lm.held_out_scores(documents(texts)).collect():
        assert math.isfinite(r.score) and r.score == pytest.approx(want[r.doc_id][4], rel=1e-9)


def test_missing_shard_is_an_error(documents):
    docs = documents(corpus(40))
    folder = lm.train(docs)
    path = next(p for k in range(16) if (p := lm._file(folder, "bigrams", k, "key")))
    os.rename(path, path + ".away")
    with pytest.raises(Exception, match="No such file"):
        lm.scores(docs, folder).collect()
