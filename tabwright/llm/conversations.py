"""Cheapest repairs of damaged conversations by a checkpointed dynamic programme.

A repaired conversation's role initials read ``(s?(ua)+)?``. The states of a walk are
*start* (nothing kept), *s*, *u* and *a*; kept rows, rows given another role, deletions
and inserted empty rows move between them, and an edit's letter decides the next state.

1. Identical rows become one row with a count. A row is its text's first in the
   conversation if it has the least turn; these firsts are found by one aggregation of
   digests and travel as small marks beside the rows, so no join moves texts.
2. Rows and marks are range-partitioned by (conversation, turn, role, digest), so that a
   conversation of any size spreads over partitions. A partition streams its rows in
   order; a conversation that lies inside it and fits one block is solved at once.
3. Others are cut into blocks of ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` bytes. A block
   keeps the least cost from each state to each state, and which exit reads least. Small
   rows of these run backward over the blocks (cost vectors at block ends) and forward
   (the state each block starts in); then every block is solved on its own, and its
   letters and lines are joined in order.

Within a block, backward cost vectors are kept at every square root of its length only;
the walk computes one stretch again at a time and takes the least letter among edits
that keep the cost tight. SHA-256 can not be split, so the bytes of one repaired
conversation pass through one task, a block at a time; nothing else does.

Order and cases. Rows go by turn (null first), then role, then md5 of role and text: ties
in turn are settled by content. Null roles and texts are one space, in a conversation's
damage null ids too. A null ``conv_id`` is a conversation. Roles other than those that
begin with s, u or a can not be kept. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm.tables import map_arrow

#: What separates words, what ends a sentence, costs of edits.
SPACES = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

BLOCK_ROWS = 2048
BLOCK_BYTES = 4 << 20

#: States of a walk, and where an inserted or renamed row leads.
START, S, U, A = range(4)
TURN = (U, U, A, U)
FAR = 1 << 60
#: Cost of ending in each state: a is inserted after u, u and a after s.
END = (0, 2 * INSERT, INSERT, 0)

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage; a dropped row stays with ``copies`` 0 and no content."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), hit.alias("hit"))
    gone = F.col("hit") == 0
    text = F.when(gone, F.lit(None)).when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, F.lit(None)).when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("hit") == 3, 2).otherwise(1).alias("copies"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows and marks of firsts, range-partitioned and sorted."""
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    full = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"))
    firsts = rows.filter("copies > 0").groupBy("conv_id", digest.alias("digest")).agg(F.min(F.struct("turn", "role")).alias("at"))
    marks = firsts.select("conv_id", "at.turn", "at.role", "digest", F.lit(None).cast("string").alias("text"), F.lit(-1).cast("long").alias("copies"))
    both = full.select("conv_id", "turn", "role", digest.alias("digest"), "text", "copies").unionByName(marks)
    keys = ["conv_id", "turn", "role", "digest"]
    placed = both.repartitionByRange(*keys).sortWithinPartitions(*keys, "copies")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    return placed.select(
        "conv_id", "turn", "role", "digest", "text", "copies", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(ENDS)).alias("truncated")
    )


def _before(row: tuple, v: tuple) -> tuple:
    """Costs from each state before a row, given those after it."""
    kind, late, more, _, _ = row
    v0, v1, v2, v3 = v
    w0, w1, w2, w3 = DELETE + v0, DELETE + v1, DELETE + v2, DELETE + v3
    if kind != "-":
        renamed, kept = REROLE + late + v2, late + v2 if kind == "u" else FAR
        least = min(renamed, kept)
        w0, w1, w3 = min(w0, least, late + v1 if kind == "s" else FAR), min(w1, least), min(w3, least)
        w2 = min(w2, late + v3 + (0 if kind == "a" else REROLE))
    w2 = min(w2, INSERT + w3)
    rest = DELETE * more
    return min(w0, INSERT + w2) + rest, min(w1, INSERT + w2) + rest, w2 + rest, min(w3, INSERT + w2) + rest


def _walk(rows: list[tuple], vectors: list[tuple], state: int, lines: list[str] | None) -> tuple[str, int]:
    """Least letters of tight edits, from ``state``; ``vectors[i]`` holds costs before row i."""
    out = []
    for i, (kind, late, more, role, text) in enumerate(rows):
        here, after, rest = vectors[i], vectors[i + 1], DELETE * more
        while True:
            cost, to = here[state], TURN[state]
            if DELETE + rest + after[state] == cost:
                out.append("D")
                break
            if INSERT + here[to] == cost:
                out.append("I")
                state = to
                if lines is not None:
                    lines.append("user:" if to == U else "assistant:")
                continue
            own = S if kind == "s" and state == START else to if kind == ("u" if to == U else "a") else None
            if own is not None and late + rest + after[own] == cost:
                out.append("K")
                state = own
            else:
                out.append("R")
                state, role = to, "user" if to == U else "assistant"
            if lines is not None:
                lines.append(f"{role}:{text}")
            break
        out.append("D" * more)
    return "".join(out), state


def solve(rows: list[tuple], end: tuple, starts: list[int], lines: list[str] | None = None) -> dict[int, tuple[int, str, int]]:
    """Per start state: cost (with what ``end`` says comes after), letters and exit state.

    Cost vectors stay only at every square root of the rows; ``lines`` collects repaired
    lines and is for one start.
    """
    n = len(rows)
    step = max(1, isqrt(n))
    checkpoints = {n: end}
    v = end
    for i in range(n - 1, -1, -1):
        v = _before(rows[i], v)
        if i % step == 0:
            checkpoints[i] = v
    costs, letters, state = checkpoints[0], {q: [] for q in starts}, {q: q for q in starts}
    for a in range(0, n, step):
        b = min(a + step, n)
        vectors = [checkpoints[b]]
        for i in range(b - 1, a - 1, -1):
            vectors.append(_before(rows[i], vectors[-1]))
        vectors.reverse()
        for q in starts:
            if costs[q] < FAR:
                found, state[q] = _walk(rows[a:b], vectors, state[q], lines)
                letters[q].append(found)
    return {q: (costs[q], "".join(letters[q]), state[q]) for q in starts if costs[q] < FAR}


def _closing(state: int, lines: list[str]) -> str:
    """What is inserted at a conversation's end."""
    roles = {START: [], A: [], U: ["assistant:"], S: ["user:", "assistant:"]}[state]
    lines.extend(roles)
    return "I" * len(roles)


class Block:
    """Consecutive rows of one conversation: (kind, late, forced deletions after, role, text), and their counts."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.bytes = 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.least = self.most = None

    def add(self, turn, role: str, text: str, copies: int, blank: bool, truncated: bool, first: bool) -> None:
        initial = role[:1]
        c = self.counts
        if self.last is not None:
            c["illegal"] += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        c["illegal"] += copies - 1
        if turn is not None and turn != self.most:
            c["turns"] += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        if blank:
            c["blank"] += copies
        else:
            c["duplicate"] += copies - first
            c["truncated"] += truncated and first
        if blank or not first:
            self.rows.append(("-", 0, copies - 1, "", ""))
        else:
            self.rows.append((initial if initial in ("s", "u", "a") else "?", TRUNCATED * truncated, copies - 1, role, text))
            self.bytes += len(role) + len(text)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES

    def edges(self) -> dict:
        return {**self.counts, "first": self.first, "last": self.last, "least": self.least, "most": self.most}


class Whole:
    """A conversation put together from its blocks in order."""

    def __init__(self, conv):
        self.conv, self.cost, self.audit, self.hash, self.begun = conv, 0, [], hashlib.sha256(), False
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.last = self.least = self.most = None

    def add(self, edges: dict, cost: int, letters: str, text: str | None) -> None:
        """``text``: the block's repaired lines, None if there are none."""
        for k in _COUNTS:
            self.counts[k] += edges[k]
        if edges["first"] is not None:
            if self.last is not None:
                self.counts["illegal"] += self.last + edges["first"] not in ("su", "ua", "au")
            self.last = edges["last"]
        if edges["least"] is not None:
            self.counts["turns"] -= edges["least"] == self.most
            self.least = edges["least"] if self.least is None else self.least
            self.most = edges["most"]
        self.cost += cost
        self.audit.append(letters)
        if text is not None:
            self.hash.update(("\n" if self.begun else "").encode() + text.encode())
            self.begun = True

    def row(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.counts["turns"]
        return {
            "conv_id": self.conv, "gaps": gaps, **{k: self.counts[k] for k in _COUNTS[:4]},
            "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EDGES = "turns long, first string, last string, least long, most long"
_ROWS = "rows array<struct<kind: string, late: long, more: long, role: string, text: string>>"


def _finished(conv, block: Block) -> dict:
    lines: list[str] = []
    cost, letters, state = solve(block.rows, END, [START], lines)[START]
    letters += _closing(state, lines)
    whole = Whole(conv)
    whole.add(block.edges(), cost, letters, "\n".join(lines) if lines else None)
    return whole.row()


def _opened(conv, block: Block, number: int) -> dict:
    """A block with least costs from state to state, and the places of its exits among equal costs."""
    costs, ranks = [FAR] * 16, [0] * 16
    found = {r: solve(block.rows, tuple(0 if q == r else FAR for q in range(4)), list(range(4))) for r in range(4)}
    for q in range(4):
        reached = sorted((found[r][q][1], r) for r in range(4) if q in found[r] and found[r][q][0] < FAR)
        for place, (_, r) in enumerate(reached):
            costs[4 * q + r], ranks[4 * q + r] = found[r][q][0], place
    named = ("kind", "late", "more", "role", "text")
    return {"conv_id": conv, "block": number, **block.edges(), "costs": costs, "ranks": ranks, "rows": [dict(zip(named, r)) for r in block.rows]}


def _in_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations inside this partition, finished; stretches at its ends and long ones, in blocks."""
    out: list[dict] = []
    number = TaskContext.get().partitionId() << 40
    conv = block = mark = None
    split = True  # the first stretch may go on from the partition before
    held = 0

    def close(last: bool) -> None:
        nonlocal number, held
        held += block.bytes + 64 * len(block.rows)
        if split or last:
            out.append(_opened(conv, block, number))
            number += 1
        else:
            out.append(_finished(conv, block))

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(8))):
            if block is None or row[0] != conv:
                if block is not None:
                    close(False)
                    split = False
                conv, block = row[0], Block()
            if held > BLOCK_BYTES or len(out) >= BLOCK_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
            _, turn, role, digest, text, copies, blank, truncated = row
            if copies < 0:
                mark = (turn, digest)
            elif copies:
                if block.full():
                    split = True
                    close(True)
                    block = Block()
                block.add(turn, role, text, copies, blank, truncated, mark == (turn, digest))
        # marks belong to the row that follows
    if block is not None:
        close(True)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _total(costs: list[int], q: int, r: int, v: list[int]) -> int:
    return costs[4 * q + r] + v[r]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from last to first: the cost vector after each; the last one's is the end's, marked by ``final``."""
    conv, v, seen = None, END, False
    for batch in batches:
        ends, final = [], []
        for c, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
            final.append(not seen or c != conv)
            if final[-1]:
                conv, v, seen = c, END, True
            ends.append(list(v))
            v = [min(_total(costs, q, r, v) for r in range(4)) for q in range(4)]
        yield pa.RecordBatch.from_arrays([
            *batch.columns, pa.array(ends, pa.list_(pa.int64())), pa.array(final)
        ], names=["conv_id", "block", "costs", "ranks", "end", "final"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from first to last: the state each starts in."""
    state, fresh = START, True
    for batch in batches:
        starts = []
        for row in batch.to_pylist():
            if fresh:
                state = START
            starts.append(state)
            costs, ranks, v = row["costs"], row["ranks"], row["end"]
            state = min(range(4), key=lambda r: (_total(costs, state, r, v), ranks[4 * state + r]))
            fresh = row["final"]
        yield pa.RecordBatch.from_arrays([
            batch.column("block"), pa.array(starts, pa.int32()), batch.column("end"), batch.column("final")
        ], names=["at", "start", "end", "final"])


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Letters, cost and repaired lines of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            rows = [tuple(r.values()) for r in row["rows"]]
            lines: list[str] = []
            cost, letters, state = solve(rows, tuple(row["end"]), [row["start"]], lines)[row["start"]]
            cost -= row["end"][state]
            if row["final"]:
                letters += _closing(state, lines)
                cost += END[state]
            found = {"cost": cost, "audit": letters, "lines": "\n".join(lines) if lines else None}
            yield pa.RecordBatch.from_pylist([{n: found.get(n, row.get(n)) for n in schema.names}], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks in order, one row per conversation."""
    whole = None
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if whole is None:
                whole = Whole(row["conv_id"])
            whole.add(row, row["cost"], row["audit"], row["lines"])
            if row["final"]:
                yield pa.RecordBatch.from_pylist([whole.row()], schema=schema)
                whole = None


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the least cost of a repair, the edits and the repaired rows' hash.

    ``rows``: conv_id, turn long, role, text (not null) and copies long; a row of 0
    copies only says that the conversation is there.
    """
    key = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    found = f"{key}, block long, {_REPORT}, {_EDGES}, costs array<long>, ranks array<long>, {_ROWS}"
    schema = _arrow(rows, found)
    blocks = stored(map_arrow(_ordered(rows), lambda b: _in_blocks(b, schema), found), "conversation-blocks")

    opened = blocks.filter("block is not null")
    small = opened.select("conv_id", "block", "costs", "ranks").repartition("conv_id")
    vector = f"{key}, block long, costs array<long>, ranks array<long>, end array<long>, final boolean"
    ends = map_arrow(small.sortWithinPartitions("conv_id", F.desc("block")), _ends, vector)
    starts = map_arrow(
        ends.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _starts, "at long, start int, end array<long>, final boolean"
    )
    ready = opened.drop("gaps", "cost", "audit", "repaired_sha256", "costs", "ranks").join(starts, F.col("block") == F.col("at")).drop("at")
    piece = f"{key}, block long, blank long, duplicate long, truncated long, illegal long, {_EDGES}, final boolean, cost long, audit string, lines string"
    piece_schema = _arrow(rows, piece)
    pieces = map_arrow(ready, lambda b: _pieces(b, piece_schema), piece)
    report = f"{key}, {_REPORT}"
    report_schema = _arrow(rows, report)
    joined = map_arrow(
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block"), lambda b: _joined(b, report_schema), report
    )
    whole = blocks.filter("block is null").select("conv_id", *(c.split()[0] for c in _REPORT.split(", ")))
    return whole.unionByName(joined)


def damage_repairs(conversations: DataFrame) -> DataFrame:
    """``repairs`` of the damaged conversations."""
    return repairs(damaged(conversations))
