import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm import prefixbpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = prefixbpe.load(PATH, public_tokenizers.PATTERN)


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abeht' \n\té", max_size=120))
def test_encoding_equals_the_library_and_decodes(text):
    ids = CODEC.encode(text)
    assert ids == packed(LIBRARY.encode_ordinary(text))
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 999 + "é" * 50, "<|endoftext|>", "\n \n  x", "日本語のテキスト" * 20])
def test_special_texts(text):
    assert CODEC.encode(text) == packed(LIBRARY.encode_ordinary(text))


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=20), st.integers(0, 60), st.integers(0, 60))
def test_appends_and_edits_equal_encoding_anew(data, new, a, b):
    begin, end = sorted((min(a, len(data)), min(b, len(data))))
    table = prefixbpe.Prefixes(CODEC.vocabulary, data[:begin])
    table.append(data[begin:])
    whole = prefixbpe.Prefixes(CODEC.vocabulary, data)
    assert table.last == whole.last
    table.replace(begin, end, new)
    assert table.ids() == prefixbpe.Prefixes(CODEC.vocabulary, data[:begin] + new + data[end:]).ids()


def test_an_edit_in_a_long_text_is_local():
    data = ("thequickbrownfoxjumps" * 100).encode()
    table = prefixbpe.Prefixes(CODEC.vocabulary, data)
    assert table.replace(100, 103, b"xyz") < 300
    assert table.ids() == prefixbpe.Prefixes(CODEC.vocabulary, data[:100] + b"xyz" + data[103:]).ids()


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(prefixbpe, "REMEMBERED", 5)
    codec = prefixbpe.Codec(PATH, public_tokenizers.PATTERN)
    text = "the quick brown fox jumps over the lazy dog, the other quick cats"
    assert codec.encode(text) == packed(LIBRARY.encode_ordinary(text)) == codec.encode(text)


def test_table(documents):
    texts = [None, "", "hello world", "été " * 500, "hello world"]
    df = documents(texts)
    want = sorted(
        (i, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in enumerate(texts) for ids in [LIBRARY.encode_ordinary(t or "")]
    )
    assert sorted(map(tuple, prefixbpe.round_trips(df, PATH, public_tokenizers.PATTERN).collect())) == want
    two = prefixbpe.decoded(prefixbpe.encoded(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.decoded).decode() for r in two.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert prefixbpe.round_trips(documents([]), PATH, public_tokenizers.PATTERN).count() == 0
