"""Best-fit packing of tokenised texts into sequences, by hierarchical rounds.

* Round 0: every partition tokenises its documents, cuts those longer than a sequence,
  and packs its pieces best-fit, longest first. Bins whose free room is at most
  ``SLACK`` tokens are finished.
* Later rounds: the underfull bins of many partitions meet in fewer ones, and are
  packed again as items (their pieces stay together). The tree ends when one task
  holds all that are left, or when a round no longer saves bins.

A bin travels as one row with the list of its pieces, at most as many as it has tokens,
so no round joins anything. Each round is a written table; what a lost executor held is
computed again from the table before it.

The ids are those of the vocabulary file's library; the ranks file of the same
vocabulary gives them several times faster, and its special string is made the same
one id (tests compare both).
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm.tables import map_arrow

CAPACITY = 1024
#: Free tokens up to which a bin counts as full before the last round.
SLACK = 2
#: Items packed together in one task.
CHUNK = 100_000
#: A round that saves fewer than this share of the underfull bins is the last.
LEAST_GAIN = 0.01
END_OF_TEXT = 2
FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and the fill of each bin; items go longest first to the tightest bin."""
    of_item = np.empty(len(lengths), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free room
    rooms = 0  # bit r: some open bin has r tokens free
    order = np.argsort(-lengths, kind="stable")
    for item, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
            fills[at] += length
        else:
            room, at = capacity, len(fills)
            fills.append(length)
        left = room - length
        if left:
            open_bins[left].append(at)
            rooms |= 1 << left
        of_item[item] = at
    return of_item, np.array(fills, np.int64)


class _Bins:
    """Rows of bins from items with their pieces; gives finished bins their sequence ids."""

    def __init__(self, round_no: int, capacity: int, slack: int, last: bool):
        self.capacity, self.slack, self.last = capacity, slack, last
        self.next = round_no << 52 | TaskContext.get().partitionId() << 24

    def rows(self, of_item: np.ndarray, fills: np.ndarray, pieces: pa.StructArray, per_item: np.ndarray) -> pa.RecordBatch:
        """``pieces`` in the order of items, ``per_item`` of them for each."""
        of_piece = np.repeat(of_item, per_item)
        order = np.argsort(of_piece, kind="stable")
        counts = np.bincount(of_piece, minlength=len(fills))
        done = (fills >= self.capacity - self.slack) | self.last
        ids = self.next + np.arange(len(fills))
        self.next += len(fills)
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        placed = pieces.take(pa.array(order))
        columns = [placed.field(name) for name in FIELDS]
        lengths = placed.field("length").to_numpy()
        offsets = np.cumsum(lengths) - lengths - np.repeat(np.cumsum(fills) - fills, counts)
        placed = pa.StructArray.from_arrays([*columns, pa.array(offsets)], names=[*FIELDS, "offset"])
        return pa.RecordBatch.from_arrays(
            [pa.array(done), pa.array(ids), pa.array(fills.astype(np.int32)), pa.ListArray.from_arrays(pa.array(bounds), placed)],
            names=["done", "sequence_id", "fill", "pieces"],
        )


def _tokenise(batches: Iterator[pa.RecordBatch], encoding: tiktoken.Encoding, capacity: int, end_id: int) -> Iterator[tuple]:
    """Per piece: (doc_id scalar's position, piece, start, length, crc) with the doc_id column of its batch."""
    for batch in batches:
        of, number, start, length, crc = [], [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            ids = np.append(encoding.encode_to_numpy(text or "", allowed_special="all").astype("<u4"), np.uint32(end_id))
            data = ids.tobytes()
            first = (len(ids) - 1) % capacity + 1
            begin = 0
            for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                of.append(row)
                number.append(k)
                start.append(begin)
                length.append(end - begin)
                crc.append(zlib.crc32(data[4 * begin : 4 * end]))
                begin = end
        if of:
            yield (
                batch.column("doc_id").take(pa.array(of, pa.int32())), np.array(number, np.int32), np.array(start, np.int64),
                np.array(length, np.int64), np.array(crc, np.int64),
            )


def _pieces(parts: list[tuple]) -> tuple[pa.StructArray, np.ndarray]:
    ids = pa.chunked_array([p[0] for p in parts]).combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.chunk(0)
    number, start, length, crc = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
    fields = [ids, pa.array(number), pa.array(start), pa.array(length), pa.array(crc)]
    return pa.StructArray.from_arrays(fields, names=FIELDS), length


def packed(
    docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int],
    capacity: int = CAPACITY, end_id: int = END_OF_TEXT, slack: int = SLACK, chunk: int = CHUNK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with ``end_id``. Longer ones than ``capacity`` are cut so that
    only the first piece is shorter. Null text counts as empty: one piece of one token.
    Every row of ``docs`` is packed, repeated rows and null ids too. An empty table gives
    an empty result.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    piece = f"struct<doc_id:{key},piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>"
    schema = f"done boolean, sequence_id bigint, fill int, pieces array<{piece}>"
    special_items = tuple(special.items())

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, bins = encoder(ranks_path, pattern, special_items), _Bins(0, capacity, slack, False)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            pieces, lengths = _pieces(held)
            held.clear()
            return bins.rows(*best_fit(lengths, capacity), pieces, np.ones(len(lengths), np.int64))

        for part in _tokenise(batches, encoding, capacity, end_id):
            held.append(part)
            if sum(len(p[1]) for p in held) >= chunk:
                yield flush()
        if held:
            yield flush()

    def later_round(round_no: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = _Bins(round_no, capacity, slack, last)
            held: list[pa.RecordBatch] = []

            def flush() -> pa.RecordBatch:
                fills = np.concatenate([b.column("fill").to_numpy() for b in held]).astype(np.int64)
                lists = pa.concat_arrays([b.column("pieces") for b in held])
                held.clear()
                return bins.rows(*best_fit(fills, capacity), lists.flatten(), np.diff(lists.offsets.to_numpy()))

            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= 2 * chunk:
                    yield flush()
            if held:
                yield flush()

        return run

    tables = [stored(map_arrow(docs.select("doc_id", "text"), first_round, schema), "packing")]
    left, before = tables[0].filter(~F.col("done")).count(), None
    while left:
        tasks = -(-left // chunk)
        last = tasks == 1 or (before is not None and left > before * (1 - LEAST_GAIN))
        under = tables[-1].filter(~F.col("done")).select("fill", "pieces")
        under = under.coalesce(1) if tasks == 1 else under.repartition(tasks)
        tables.append(stored(map_arrow(under, later_round(len(tables), last), schema), "packing"))
        before, left = left, 0 if last else tables[-1].filter(~F.col("done")).count()
    out = None
    for table in tables:
        done = table.filter("done").select("sequence_id", "pieces")
        out = done if out is None else out.unionByName(done)
    pieces = out.select("sequence_id", F.explode("pieces").alias("p"))
    return pieces.select(*(f"p.{name}" for name in FIELDS), "sequence_id", "p.offset")
