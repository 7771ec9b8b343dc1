"""Byte-level BPE by dynamic programming over byte prefixes, and decoding.

Every prefix of a piece has one encoding, and of that only its last token is kept.
The last token of a prefix is the unique token ``t`` that ends the prefix such that

* the prefix before ``t`` has itself a valid last token ``s`` (or is empty), and
* ``s`` followed by ``t`` stays as it is when their bytes are merged by rank.

Reading the table from the end backwards gives the ids. Appending bytes only adds
entries, so it is exact; after an edit the entries before it stay, and those behind
it are taken over again once the tables agree for as many prefixes as the longest
token has bytes.

Whether two tokens may stand side by side is decided by undoing their merges in
rank order, and remembered.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabwright.llm.tables import by_slices

#: Remembered pieces, token pairs and prefixes per worker; longest remembered piece in characters.
REMEMBERED, LONGEST = 400_000, 48


class Vocabulary:
    """Ranks by bytes, with each token's parts, and the neighbours and prefixes met so far."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.longest = max(map(len, self.ids))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.last: dict[bytes, int] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.parts:
            whole, found = self.bytes[token], None
            for k in range(1, len(whole)):
                a, b = self.ids.get(whole[:k]), self.ids.get(whole[k:])
                if a is not None and b is not None and a < token and b < token and self.stays(a, b, token):
                    found = (a, b)
                    break
            self.parts[token] = found
        return self.parts[token]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether ``left`` then ``right`` is the encoding of their joined bytes."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            known = self.stays(left, right, len(self.bytes))
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def stays(self, a: int, b: int, before: int) -> bool:
        """Whether no merge of a rank under ``before`` crosses the seam between ``a`` and ``b``.

        Undoes the merges beside the seam, youngest first. A pair across the seam that
        ranks before the merge undone last would have been merged instead of it; at the
        same rank the left one comes first.
        """
        ids, text = self.ids, self.bytes
        while True:
            joined = ids.get(text[a] + text[b])
            if joined is not None and joined < before:
                return False
            left, right = self.split(a), self.split(b)
            if left and (a > b or not right):
                before, a = a, left[1]
            elif right:
                before, b = b + 1, right[0]
            else:
                return True

    def encode(self, data: bytes) -> list[int]:
        """Ids of a short piece; prefixes shared with earlier pieces are not computed again."""
        last, get, pairs, longest = self.last, self.ids.get, self.pairs.get, self.longest
        if len(last) > REMEMBERED:
            last.clear()
        size = len(data)
        known = size
        while known and data[:known] not in last:
            known -= 1
        for end in range(known + 1, size + 1):
            for begin in range(end - longest if end > longest else 0, end):  # longest first: most often the one
                token = get(data[begin:end])
                if token is None:
                    continue
                if begin:
                    previous = last[data[:begin]]
                    fits = pairs(previous << 32 | token)
                    if not (self.adjacent(previous, token) if fits is None else fits):
                        continue
                last[data[:end]] = token
                break
            else:
                raise ValueError(f"no token ends with byte {data[end - 1]}")
        out = []
        while size:
            token = last[data[:size]]
            out.append(token)
            size -= len(self.bytes[token])
        out.reverse()
        return out


class Prefixes:
    """The last tokens of all prefixes of one byte string, which can be appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        begin = len(self.data)
        self.data += more
        for end in range(begin + 1, len(self.data) + 1):
            self.last.append(self._last(end))

    def _last(self, end: int) -> int:
        v, data, last = self.vocabulary, self.data, self.last
        get, sizes, adjacent = v.ids.get, v.bytes, v.adjacent
        for begin in range(max(0, end - v.longest), end):  # longest first: most often the one
            token = get(bytes(data[begin:end]))
            if token is not None and (begin == 0 or adjacent(last[begin - 1], token)):
                return token
        raise ValueError(f"no token ends with byte {data[end - 1]}")

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes ``begin`` to ``end``; returns how many prefixes were computed anew."""
        tail_bytes, tail_last = bytes(self.data[end:]), self.last[end:]
        del self.data[begin:], self.last[begin:]
        self.append(new)
        done, agreed = len(new), 0
        for k, b in enumerate(tail_bytes):
            if agreed >= self.vocabulary.longest:
                self.data += tail_bytes[k:]
                self.last += tail_last[k:]
                break
            self.append(bytes((b,)))
            done += 1
            agreed = agreed + 1 if self.last[-1] == tail_last[k] and k >= self.vocabulary.longest - 1 else 0
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes[token])
        return out[::-1]


class Codec:
    """Encodes texts piece by piece; ids are little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        data = text.encode()
        ids = self.vocabulary.encode(data) if len(data) <= 2 * LONGEST else Prefixes(self.vocabulary, data).ids()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        pieces, known = self.pieces(text), self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        for old in list(known)[: REMEMBERED // 2]:
                            del known[old]
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _keyed(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of the whole text, as packed 32-bit integers; null text counts as empty."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        codec = load(path, pattern)
        ids = [codec.encode(t or "") for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return by_slices(docs.select("doc_id", "text"), work, f"{_keyed(docs)}, ids binary")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, the ids and the bytes they stand for; null ids count as none."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        codec = load(path, pattern)
        data = [codec.decode(t or b"") for t in part.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("ids"), pa.array(data, pa.binary())], names=["doc_id", "ids", "decoded"]
        )

    return by_slices(tokens.select("doc_id", "ids"), work, f"{_keyed(tokens)}, ids binary, decoded binary", column="ids")


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them, in one pass without a shuffle."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        codec = load(path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for text in part.column("text").to_pylist():
            ids = codec.encode(text or "")
            counts.append(len(ids) // 4)
            of_ids.append(hashlib.sha256(ids).hexdigest())
            of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = f"{_keyed(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_slices(docs.select("doc_id", "text"), work, schema)
