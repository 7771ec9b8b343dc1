"""Token counts by byte-pair merging with a heap and a linked list, without making ids.

A piece starts as one symbol per byte. The heap holds every adjacent pair that can
merge, lowest rank first and leftmost among equals; the list links what is left.
Each pop of a still valid pair takes one symbol away, so the count of a piece is its
bytes minus its merges.

Texts are cut into pieces by the tokenizer's own pattern. The count of a short piece
is remembered per worker (a bounded table); the rest are merged again when met.
Null and empty texts have no token. A text of any length is merged piece by piece; a
piece of n bytes takes O(n log n) steps.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabwright.llm.tables import by_slices

#: Remembered pieces per worker, and the longest of them in characters.
REMEMBERED, LONGEST = 400_000, 48


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves; the others take the code points
    from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + k)
    return out


class Merges:
    """Ranks of a byte-level BPE vocabulary, over small integers instead of strings."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        characters = byte_characters()
        vocabulary = model["model"]["vocab"]
        self.byte_id = [vocabulary[c] for c in characters]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        #: left id << 32 | right id -> (rank, merged id)
        self.rank: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.rank.setdefault(vocabulary[a] << 32 | vocabulary[b], (rank, vocabulary[a + b]))
        added = sorted((t["content"] for t in model.get("added_tokens", ())), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(pattern).findall
        self.counts: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        if n < 2:
            return n
        get = self.rank.get
        symbol = [self.byte_id[b] for b in piece]
        heap = []
        for i in range(n - 1):
            found = get(symbol[i] << 32 | symbol[i + 1])
            if found:
                heap.append((found[0], i, i + 1, found[1]))
        if not heap:
            return n
        heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # a merged symbol stays at its left place; the right place dies (symbol -1).
        left = n
        rank_of = self.rank
        while heap:
            rank, i, j, new = heappop(heap)
            if symbol[i] < 0 or after[i] != j or j >= n:
                continue
            if rank_of.get(symbol[i] << 32 | symbol[j], (-1,))[0] != rank:
                continue
            symbol[i], symbol[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = get(new << 32 | symbol[k])
                if found:
                    heappush(heap, (found[0], i, k, found[1]))
            h = before[i]
            if h >= 0:
                found = get(symbol[h] << 32 | new)
                if found:
                    heappush(heap, (found[0], h, i, found[1]))
        return left

    def plain_count(self, text: str) -> int:
        pieces, counts = self.pieces(text), self.counts
        total = 0
        try:
            for p in pieces:
                total += counts[p]
            return total
        except KeyError:
            pass
        total = 0
        for p in pieces:
            n = counts.get(p)
            if n is None:
                n = self.merged(p.encode())
                if len(p) <= LONGEST:
                    if len(counts) >= REMEMBERED:
                        # the older half goes: dictionaries keep the order of insertion
                        for old in list(counts)[: REMEMBERED // 2]:
                            del counts[old]
                    counts[p] = n
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; the vocabulary's added tokens, where they stand in it, count one each."""
        if self.added is None or not self.added.search(text):
            return self.plain_count(text)
        parts = self.added.split(text)
        return sum(map(self.plain_count, parts)) + len(parts) - 1


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Merges:
    return Merges(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether that is over ``limit``, for every row; no shuffle."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        merges = load(path, pattern)
        texts = [t or "" for t in part.column("text").to_pylist()]
        tokens = np.fromiter(map(merges.count, texts), np.int64, len(texts))
        sizes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_slices(docs.select("doc_id", "text"), work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
