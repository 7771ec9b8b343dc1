"""Interpolated modified Kneser-Ney bigram model: counted in Spark, scored from mapped arrays.

Counting. Every partition reduces its training texts to sorted arrays of distinct
bigrams with counts, cut by the leading bits of the bigram's hash into shards; a row
holds one such array. One task merges a shard, writes it as sorted arrays (hash, count)
to the shared folder, and passes on sums per word: tokens, distinct left neighbours,
and distinct right neighbours seen once, twice, more often. Those sums are sharded by
word and merged the same way. All of it is additive, so no word or context, however
common, meets in one place before it is summed.

Scoring. Workers map the files and look up each batch's sorted distinct bigrams and
words; no text is shuffled and no model is loaded whole.

    p(w | u) = max(c(uw) - D(c(uw)), 0) / c(u.) + gamma(u) * p(w)
    p(w)     = max(n(.w) - D'(n(.w)), 0) / n(..) + gamma' / (V + 1)

``n(.w)`` counts distinct left neighbours; the three discounts of each level come from
the counts of counts. A text starts after a begin mark and ends with an end token. The
order is two: the arrays of a longer order would outgrow the disk that is allowed here
(see README).

The model folder must be a path that every executor mounts; by default it lies in
``spark.checkpoint.dir``. Files are written under another name and renamed, with the
same content each time, so repeated tasks do no harm.

Null text counts as empty: one end token. A null id counts as the empty string when
rows are held out. Without any training row each token has probability 1 / (V + 1) = 1.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.lineage import new_path
from tabwright.llm import words as W
from tabwright.llm.tables import give_back, map_arrow, slices
from tabwright.shipping import ship

_U = np.uint64
BEGIN, END = _U(0xB5AD4ECEDA1CE2A9), _U(0x1B56C4E9A7D3F035)
_STEP = _U(0x9FB21C651E98DF25)
#: Training tokens that one task turns into arrays at a time.
CHUNK_TOKENS = 2_500_000
#: Text bytes per shard, and fewest shards.
SHARD_BYTES, LEAST_SHARDS = 24 << 20, 16
HELD_OUT_OF, HELD_OUT = 7, 2


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == HELD_OUT


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, each row closed by END, and the bounds of the rows."""
    data, offsets = W.text_bytes(column)
    data = W.lowered(data)
    start, end, first = W.word_spans(data, offsets)
    bounds = first + np.arange(len(first))
    out = np.full(bounds[-1], END, _U)
    out[W.ranges(bounds[:-1], np.diff(first))] = W.span_hashes(data, start, end)
    return out, bounds


def contexts(token: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each, BEGIN at the start of a row."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[bounds[:-1]] = BEGIN
    return before


def bigrams(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return W.mixed(u * _STEP + w)


def shard_of(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


def summed(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of the columns."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(c[order], first, dtype=np.int64) if len(first) else c[:0] for c in columns)


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())


def _narrow(a: np.ndarray) -> np.ndarray:
    """Counts in four bytes where they fit; the file says which."""
    return a.astype(np.uint32) if not len(a) or a.max() < 1 << 32 else a.astype(_U)


def _write(path: str, array: np.ndarray) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    unfinished = f"{path}.{uuid.uuid4().hex}"
    with open(unfinished, "wb") as f:
        np.save(f, array)
    os.replace(unfinished, path)


def _file(folder: str, level: str, shard: int, column: str) -> str:
    return f"{folder}/{level}/{shard >> 10}/{shard}-{column}.npy"


@dataclass(frozen=True)
class Totals:
    """What holds for the whole model: token and type counts, and counts of counts 1 to 4 of both levels."""

    bits: int
    tokens: int
    types: int
    bigrams: int
    bigram_counts: tuple[int, ...]
    word_counts: tuple[int, ...]

    def save(self, folder: str) -> None:
        _write_text(f"{folder}/totals.json", json.dumps(asdict(self)))


def _write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


#: Discounts for counts 1, 2, and 3 or more where the counts of counts give no usable ones.
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)


def discounts(counts: tuple[int, ...]) -> np.ndarray:
    """Discounts for counts 0, 1, 2, and 3 or more, each strictly between 0 and its count.

    An estimate that leaves that range, or whose counts of counts have gaps, as in a
    corpus of texts that occur a fixed number of times, gives way to ``PLAIN_DISCOUNTS``:
    a discount of 0 would leave a context nothing for words unseen after it.
    """
    n1, n2, n3, n4 = counts
    out = [0.0]
    for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)):
        estimate = k - (k + 1) * (n1 / (n1 + 2 * n2)) * b / a if n1 and a else 0.0
        out.append(estimate if 0.0 < estimate < k else PLAIN_DISCOUNTS[k - 1])
    return np.array(out)


def _count_batches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, u, n, w, c): distinct contexts, how many words follow each, the words, their counts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        u, w = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        held.clear()
        give_back()
        key = bigrams(u, w)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key))).astype(np.uint32)
        key, order = key[first], order[first]
        u, w = u[order], w[order]
        cuts = np.searchsorted(shard_of(key, bits), np.arange((1 << bits) + 1))
        rows: list[list] = [[], [], [], [], []]
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a == b:
                continue
            by_context = np.argsort(u[a:b], kind="stable")
            us = u[a:b][by_context]
            heads = np.flatnonzero(np.concatenate([[True], us[1:] != us[:-1]]))
            runs = np.diff(np.append(heads, len(us))).astype(np.uint32)
            for column, value in zip(rows, (shard, us[heads], runs, w[a:b][by_context], count[a:b][by_context])):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *map(_binary, rows[1:])], names=["shard", "u", "n", "w", "c"])

    for batch in batches:
        for part in slices(batch):
            token, bounds = tokens(part.column("text"))
            held.append((contexts(token, bounds), token))
            if sum(len(h[0]) for h in held) >= CHUNK_TOKENS:
                yield flush()
    if sum(len(h[0]) for h in held):
        yield flush()


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), dtype) for v in column])


_WORD_COLUMNS = ("tokens", "left", "once", "twice", "more")


_WORD_ROWS = pa.schema([("shard", pa.int32()), ("totals", pa.string()), ("word", pa.binary()), *((c, pa.binary()) for c in _WORD_COLUMNS)])
_TOTALS = ["tokens", "types", "bigrams", *(f"{level}{k}" for level in "bw" for k in range(1, 5))]


def _merge_bigrams(table: pa.Table, folder: str, bits: int) -> pa.Table:
    """Write one shard of bigrams; give (word shard, word sums) and the counts of counts."""
    shard = table.column("shard")[0].as_py()
    u = np.repeat(_joined(table.column("u"), _U), _joined(table.column("n"), np.uint32))
    w, c = _joined(table.column("w"), _U), _joined(table.column("c"), np.uint32)
    if not len(w):
        for name in ("key", "count"):
            _write(_file(folder, "bigrams", shard, name), np.zeros(0, _U))
        return _WORD_ROWS.empty_table()
    key = bigrams(u, w)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.add.reduceat(c[order], first, dtype=np.int64)
    key, order = key[first], order[first]
    u, w = u[order], w[order]
    del c, order
    _write(_file(folder, "bigrams", shard, "key"), key)
    _write(_file(folder, "bigrams", shard, "count"), _narrow(count))
    del key
    # each side is summed by itself, which keeps the arrays short; then both are laid over the words of either
    right, *of_right = summed(w, count, np.ones(len(w), np.int32))
    left, *of_left = summed(u, *(hit.astype(np.int32) for hit in (count == 1, count == 2, count > 2)))
    del u, w
    word = np.union1d(right, left)
    sums = [np.zeros(len(word), np.int64) for _ in _WORD_COLUMNS]
    for side, parts, into in ((right, of_right, sums[:2]), (left, of_left, sums[2:])):
        at = np.searchsorted(word, side)
        for part, column in zip(parts, into):
            column[at] = part
    give_back()
    seen = [int((count == k).sum()) for k in range(1, 5)]
    cuts = np.searchsorted(shard_of(word, bits), np.arange((1 << bits) + 1))
    pieces = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
    totals = [json.dumps({"bigrams": len(first), "counts": seen}) if k == 0 else None for k in range(len(pieces))]
    arrays = [pa.array([i for i, _, _ in pieces], pa.int32()), pa.array(totals, pa.string()), _binary([word[a:b] for _, a, b in pieces])]
    arrays += [_binary([_narrow(s[a:b]) for _, a, b in pieces]) for s in sums]
    return pa.Table.from_arrays(arrays, names=["shard", "totals", "word", *_WORD_COLUMNS])


def _merge_words(table: pa.Table, folder: str) -> pa.Table:
    """Write one shard of words; give its totals and those of the bigrams."""
    shard = table.column("shard")[0].as_py()
    words = table.column("word")
    if not sum(map(len, map(pa.BinaryScalar.as_buffer, words))):
        for name in ("key", *_WORD_COLUMNS):
            _write(_file(folder, "words", shard, name), np.zeros(0, _U))
        return pa.table({n: pa.array([0], pa.int64()) for n in _TOTALS})

    def counts(name: str) -> np.ndarray:
        parts = []
        for v, of in zip(table.column(name), words):
            wide = len(v.as_buffer()) == len(of.as_buffer())
            parts.append(np.frombuffer(v.as_buffer(), _U if wide else np.uint32).astype(np.int64))
        return np.concatenate(parts)

    word, *sums = summed(_joined(words, _U), *map(counts, _WORD_COLUMNS))
    _write(_file(folder, "words", shard, "key"), word)
    for name, column in zip(_WORD_COLUMNS, sums):
        _write(_file(folder, "words", shard, name), _narrow(column))
    token, left = sums[0], sums[1]
    found = [json.loads(t.as_py()) for t in table.column("totals") if t.is_valid]
    row = {
        "tokens": [int(token.sum())], "types": [int((token > 0).sum())], "bigrams": [sum(f["bigrams"] for f in found)],
        **{f"b{k}": [sum(f["counts"][k - 1] for f in found)] for k in range(1, 5)},
        **{f"w{k}": [int((left == k).sum())] for k in range(1, 5)},
    }
    return pa.table({k: pa.array(v, pa.int64()) for k, v in row.items()})


def model_folder(spark: SparkSession) -> str:
    """A new folder for a model under the shared one, as a path of the file system."""
    path = new_path(spark, "bigram-model")
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        raise ValueError(f"name a model folder that all executors mount; {path} is none")
    return path


def train(docs: DataFrame, folder: str | None = None) -> str:
    """Count the ``text`` of all rows and write the model; returns its folder."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or model_folder(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_SHARDS, -(-size // SHARD_BYTES) - 1).bit_length() if size > LEAST_SHARDS * SHARD_BYTES else LEAST_SHARDS.bit_length() - 1
    counted = map_arrow(
        docs.select("text"), lambda batches: _count_batches(batches, bits), "shard int, u binary, n binary, w binary, c binary"
    )
    sums = ", ".join(f"{c} binary" for c in _WORD_COLUMNS)
    # a row without content per shard: each is written, so a file that is not there is an error
    every = spark.range(1 << bits).select(F.col("id").cast("int").alias("shard"))
    empty = F.lit(b"")
    counted = counted.unionByName(every.select("shard", *(empty.alias(c) for c in "unwc")))
    by_word = counted.repartition(1 << bits, "shard").groupBy("shard").applyInArrow(
        lambda table: _merge_bigrams(table, folder, bits), f"shard int, totals string, word binary, {sums}"
    )
    by_word = by_word.unionByName(every.select("shard", F.lit(None).cast("string").alias("totals"), empty.alias("word"), *(empty.alias(c) for c in _WORD_COLUMNS)))
    merged = by_word.repartition(1 << bits, "shard").groupBy("shard").applyInArrow(lambda table: _merge_words(table, folder), ", ".join(f"{n} long" for n in _TOTALS))
    total = merged.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _TOTALS)).first()
    counts = {level: tuple(total[f"{level}{k}"] for k in range(1, 5)) for level in "bw"}
    Totals(bits, total["tokens"], total["types"], total["bigrams"], counts["b"], counts["w"]).save(folder)
    return folder


class Model:
    """The mapped files of a model."""

    def __init__(self, folder: str):
        with open(f"{folder}/totals.json") as f:
            found = json.load(f)
        self.totals = Totals(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})
        self.folder = folder
        self.mapped: dict[str, np.ndarray] = {}
        self.bigram_discount = discounts(self.totals.bigram_counts)
        self.word_discount = discounts(self.totals.word_counts)
        ones, twos = self.totals.word_counts[:2]
        # n(..) and the mass that the words' discounts free, over all words with a left neighbour
        more = self.totals.types - ones - twos
        freed = float(np.dot(self.word_discount[1:], [ones, twos, more]))
        self.rest = freed / self.totals.bigrams if self.totals.bigrams else 1.0

    def column(self, level: str, shard: int, name: str) -> np.ndarray:
        path = _file(self.folder, level, shard, name)
        if path not in self.mapped:
            self.mapped[path] = np.load(path, mmap_mode="r")
        return self.mapped[path]

    def look_up(self, level: str, keys: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
        """The columns of sorted keys; 0 for keys that the model does not hold."""
        out = [np.zeros(len(keys), np.int64) for _ in names]
        shards = shard_of(keys, self.totals.bits)
        for shard in np.unique(shards).tolist():
            known = self.column(level, shard, "key")
            if not len(known):
                continue
            a, b = np.searchsorted(shards, (shard, shard + 1))
            at = np.searchsorted(known, keys[a:b])
            at[at == len(known)] = 0
            hit = np.flatnonzero(known[at] == keys[a:b])
            for column, name in zip(out, names):
                column[a + hit] = self.column(level, shard, name)[at[hit]]
        return out

    def score(self, token: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """Per row: n_tokens, n_known, base_score, score."""
        t = self.totals
        before = contexts(token, bounds)
        types, place = np.unique(np.concatenate([token, before]), return_inverse=True)
        count, left, once, twice, more = self.look_up("words", types, _WORD_COLUMNS)
        # every token but the end has one right neighbour; the begin mark has as many as there are ends
        follows = count.copy()
        at_begin = np.searchsorted(types, BEGIN)
        if at_begin < len(types) and types[at_begin] == BEGIN:
            follows[at_begin] = self.look_up("words", np.array([END]), ("tokens",))[0][0]
        d = self.word_discount
        p_word = np.full(len(types), self.rest / (t.types + 1))
        if t.bigrams:
            p_word += np.maximum(left - d[np.minimum(left, 3)], 0) / t.bigrams
        d = self.bigram_discount
        gamma = np.ones(len(types))
        seen = follows > 0
        gamma[seen] = (d[1] * once[seen] + d[2] * twice[seen] + d[3] * more[seen]) / follows[seen]
        base = np.log10((count + 1) / (t.tokens + t.types + 1))
        w, u = place[: len(token)], place[len(token) :]
        pairs, of_pair = np.unique(bigrams(before, token), return_inverse=True)
        pair = self.look_up("bigrams", pairs, ("count",))[0][of_pair]
        direct = np.maximum(pair - d[np.minimum(pair, 3)], 0) / np.maximum(follows[u], 1)
        p = np.log10(direct + gamma[u] * p_word[w])
        rows = bounds[:-1]
        return {
            "n_tokens": np.diff(bounds),
            "n_known": np.add.reduceat((count[w] > 0).astype(np.int64), rows),
            "base_score": np.add.reduceat(base[w], rows),
            "score": np.add.reduceat(p, rows),
        }


@lru_cache(maxsize=2)
def mapped(folder: str) -> Model:
    return Model(folder)


def scores(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = mapped(folder)
        for batch in batches:
            for part in slices(batch):
                found = model.score(*tokens(part.column("text")))
                n = part.num_rows
                perplexity = 10 ** np.minimum(-found["score"] / found["n_tokens"], 300)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(found["n_tokens"]), pa.array(found["n_known"]),
                        pa.array(np.full(n, model.totals.tokens)), pa.array(found["base_score"]), pa.array(found["score"]), pa.array(perplexity),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = f"doc_id {key}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return map_arrow(rows, run, schema)


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out, score all."""
    return scores(docs, train(docs.filter(~held_out(F.col("doc_id")))))
