import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabwright.llm import heapbpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MERGES = heapbpe.load(PATH, public_tokenizers.PATTERN)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abeht' \n\t1é|<>endoftx", max_size=80))
def test_counts_equal_the_library(text):
    assert MERGES.count(text) == library(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|> a<|endoftext|><|endoftext|>", "a" * 20_000, "ab" * 9_999, "\n \n", "日本 😀 it's"])
def test_special_texts(text):
    assert MERGES.count(text) == library(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(heapbpe, "REMEMBERED", 4)
    merges = heapbpe.Merges(PATH, public_tokenizers.PATTERN)
    text = "the quick brown fox jumps over the lazy dog and the quick cat"
    assert merges.count(text) == library(text) == merges.count(text)
    assert len(merges.counts) <= 4


def test_table(documents):
    texts = [None, "", "hello world", "word " * 600, "hello world"]
    df = heapbpe.token_counts(documents(texts), PATH, public_tokenizers.PATTERN)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(i, len((t or "").encode()), library(t), library(t) > 512) for i, t in enumerate(texts)]
    assert heapbpe.token_counts(documents([]), PATH, public_tokenizers.PATTERN).count() == 0
