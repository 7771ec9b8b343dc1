import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabwright.llm import packing
from tabwright.llm.queries import packed_documents

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = (("<|endoftext|>", 50256),)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abeht' \n\té<|endoftext|>", max_size=120))
def test_ids_equal_the_library(text):
    encoding = packing.encoder(RANKS, public_tokenizers.PATTERN, SPECIAL)
    assert encoding.encode_to_numpy(text, allowed_special="all").tolist() == library(text)
    text = f"{text}<|endoftext|> {text}<|endoftext|>"
    assert encoding.encode_to_numpy(text, allowed_special="all").tolist() == library(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_best_fit_fills_no_bin_over(lengths):
    of_item, fills = packing.best_fit(np.array(lengths, np.int64), 50)
    assert np.bincount(of_item, weights=lengths, minlength=len(fills)).tolist() == fills.tolist()
    assert (fills <= 50).all() and len(fills) <= 11 / 9 * -(-sum(lengths) // 50) + 1 + sum(n > 25 for n in lengths)


def check(rows, texts, capacity=1024):
    """Every id of every text stands in exactly one place; returns the number of sequences."""
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids, at = [*library(text), 2], 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            data = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(data))
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


TEXTS = [None, "", "word " * 5000] + ["some words of text " * (7 * i % 260) for i in range(200)] + ["x"] * 50


def test_query_packs_tightly(documents):
    n = check(packed_documents(documents(TEXTS)).collect(), TEXTS)
    total = sum(len(library(t)) + 1 for t in TEXTS)
    assert n <= -(-total // 1024) * 1.05 + 1


def test_many_rounds(documents):
    df = documents(TEXTS).repartition(12).withColumnRenamed("n_chars", "fill")
    rows = packing.packed(df, RANKS, public_tokenizers.PATTERN, dict(SPECIAL), chunk=20).collect()
    check(rows, TEXTS)


def test_empty_and_repeated(documents):
    assert packed_documents(documents([])).count() == 0
    rows = packed_documents(documents([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1
