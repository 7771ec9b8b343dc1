"""Removal of lines that nearly repeat an earlier line: an exact set-similarity join.

A line is the set of its distinct words. Of two lines whose Jaccard similarity is
``SIMILARITY`` or more, the later one (larger id, or further down) goes; lines are judged
on the input. Every line that has a word takes part; lines without one stay.

1. *Rarity.* All words are counted in a table of ``CELLS`` cells by hash, of fixed size
   whatever the corpus. A word's order is its cell's count, then its hash: one order
   for all lines, rarest first, which is what the filters need to be exact.
2. *Equal sets* are settled by hash: only the first line of each stays in the join. Each
   task's chunk sends on its own first and lets the later ones go at once, dealt by
   document, so that a line with a third of all places gathers one place per chunk. Sets
   of fewer than ``LEAST_JOINED`` words are similar to equal ones only, and end here.
3. *Prefixes.* Similar sets share a word among the first ``n - ceil(0.8 n) + 1`` of each,
   and two or three words if the prefix is one or two words longer. Lines meet by their
   first shared word where it is rare; where it is more frequent, by it and the next; and
   where it is very frequent, by it and the next two. So the number that meets by chance
   stays about ``MEETING``, and no common word gathers all lines that hold it.
4. *Filters.* Of lines that meet, a pair stays only if lengths, positions and a parity
   signature (its differing bits never exceed the differing words) allow the similarity.
   What leaves is the membership of the groups in which pairs are left, not the pairs;
   groups with the same members are one. A very large group is cut into blocks.
5. *Verification.* The lines of a group meet in one task with their words, in order of
   place. Each is compared with those before it until one is similar enough.
6. *Removal.* Each document meets the numbers of its lines that go.

Documents are told apart as in ``substrings``; in the order of lines the id comes first,
then the line number. A null id comes before all others; a null text is one empty line.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm import words as W
from tabwright.llm.substrings import identified
from tabwright.llm.tables import map_arrow, slices
from tabwright.shipping import ship

_U = np.uint64
#: Jaccard similarity as a fraction, words a line needs to take part, and words from which sets that differ can be similar.
SIMILARITY = (4, 5)
LEAST_WORDS, LEAST_JOINED = 1, 4
#: Cells of the table of word counts; lines that should meet by one key at most, short of being similar.
CELLS, MEETING = 1 << 21, 512
#: Prefix entries that leave a task at a time; text bytes per shard; fewest shards.
CHUNK, SHARD_BYTES, LEAST_SHARDS = 700_000, 16 << 20, 16
#: Largest group that is searched for pairs, and that meets in one task.
BLOCK = 8_000


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> _U(32)).astype(np.int64) & (cells - 1)


def _words(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, offsets = W.text_bytes(column)
    start, end, _ = W.word_spans(data, offsets)
    return data, offsets, start, W.span_hashes(data, start, end)


def word_counts(docs: DataFrame, cells: int = CELLS) -> np.ndarray:
    """How many words of the whole corpus fall into each cell; 8 bytes a cell reach the driver."""
    parts = 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(_cell(_words(part.column("text"))[3], cells), minlength=cells)
        packed = [pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in np.split(total, parts)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(cells // parts, np.int64)
        for v in table.column("counts"):
            total += np.frombuffer(pa.decompress(v.as_buffer(), 8 * len(total), codec="zstd"), np.int64)
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    counted = map_arrow(docs.select("text"), count, "part int, counts binary")
    rows = counted.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    out = np.zeros((parts, cells // parts), np.int64)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def rarity_classes(counts: np.ndarray) -> tuple[np.ndarray, tuple[int, int]]:
    """A class from 0 to 255 per cell, rising with its count, and the first classes that meet by two and by three words."""
    def of(x: np.ndarray | float) -> np.ndarray:
        return np.minimum(np.floor(4 * np.log2(np.asarray(x) + 1.0)), 255).astype(np.uint8)

    lines = max(1.0, counts.sum() / 32)
    return of(counts), (int(of(MEETING)) + 1, int(of(max(MEETING, math.sqrt(MEETING * lines)))) + 1)


def prefix_length(n: np.ndarray) -> np.ndarray:
    a, b = SIMILARITY
    return n - (a * n + b - 1) // b + 1


def least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Shared words that sets of these sizes need: the similarity times their union, rounded up."""
    a, b = SIMILARITY
    return (a * (n + m) + a + b - 1) // (a + b)


class LineSets:
    """The sets of the lines of one slice: distinct words in order of rarity.

    A token is a word's rarity class (8 bits) before 40 bits of its hash. These tell sets
    apart where there are several; of sets below ``LEAST_JOINED``, whole hashes are checked.
    """

    def __init__(self, column: pa.Array, classes: np.ndarray):
        data, offsets, start, hashes = _words(column)
        begin, _, first = W.line_spans(data, offsets)
        line = np.searchsorted(begin, start, side="right") - 1
        enough = np.bincount(line, minlength=len(begin)) >= LEAST_WORDS
        taken = enough[line]
        line = (np.cumsum(enough) - 1)[line[taken]]
        hashes = hashes[taken]
        every = line
        token = classes[_cell(hashes, len(classes))].astype(_U) << _U(40) | hashes >> _U(24)
        if enough.sum() <= 1 << 16:  # both fit one integer, which sorts fastest
            both = np.sort(line.astype(_U) << _U(48) | token)
            both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
            line, token = (both >> _U(48)).astype(np.int64), both & _U((1 << 48) - 1)
        else:
            order = np.lexsort((token, line))
            line, token = line[order], token[order]
            new = np.ones(len(line), bool)
            new[1:] = (line[1:] != line[:-1]) | (token[1:] != token[:-1])
            line, token = line[new], token[new]
        size = np.bincount(line, minlength=int(enough.sum()))
        large = size >= LEAST_WORDS
        self.token = token[large[line]]
        self.number = np.flatnonzero(enough)[large]  # among all lines of the slice
        self.size = size[large]
        self.head = np.cumsum(self.size) - self.size
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))[self.number]
        self.row, self.line = row, self.number - first[row]
        if len(self.size):
            self.key = W.mixed(np.add.reduceat(W.mixed(self.token), self.head) + self.size.astype(_U))
            self.check = W.mixed(np.add.reduceat(W.mixed(self.token ^ _U(0xA5A5A5A55A5A5A5A)), self.head))
            few = large & (size < LEAST_JOINED)
            self._check_whole(few[large], every[few[every]], hashes[few[every]])
            bit, quarter = _U(1) << (self.token & _U(63)), self.token >> _U(6) & _U(3)
            self.parity = np.stack([np.bitwise_xor.reduceat(np.where(quarter == _U(k), bit, _U(0)), self.head) for k in range(4)])
        else:
            self.key = self.check = np.zeros(0, _U)
            self.parity = np.zeros((4, 0), _U)

    def _check_whole(self, few: np.ndarray, line: np.ndarray, hashes: np.ndarray) -> None:
        """Check the sets ``few`` by whole hashes: ``line`` and ``hashes`` are of all their words."""
        if not len(line):
            return
        order = np.lexsort((hashes, line))
        line, hashes = line[order], hashes[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
        line, hashes = line[new], hashes[new]
        head = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        self.check[few] = W.mixed(np.add.reduceat(W.mixed(hashes ^ _U(0xA5A5A5A55A5A5A5A)), head))

    def prefixes(self, chosen: np.ndarray, frequent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the chosen sets: (set, meeting key, position) of every prefix word, pair and triple that they meet by."""
        size, head = self.size[chosen], self.head[chosen]
        length = prefix_length(size)
        at = W.ranges(head, length)
        of = np.repeat(np.arange(len(chosen)), length)
        first = self.token[at] >> _U(40)
        # a word, with how many of the words behind it in the prefix that is one longer, or two
        behind = [np.minimum(length + more, size)[of] - (at - head[of]) - 1 for more in (1, 2)]
        rare = first < _U(frequent[0])
        words = [(of[rare], at[rare], W.mixed(self.token[at[rare]]))]
        step = _U(0x9FB21C651E98DF25)
        two = ~rare & (first < _U(frequent[1]))
        a = np.repeat(at[two], behind[0][two])
        b = W.ranges(at[two] + 1, behind[0][two])
        words.append((np.repeat(of[two], behind[0][two]), a, W.mixed(self.token[a] * step + self.token[b])))
        three = first >= _U(frequent[1])
        a = np.repeat(at[three], behind[1][three])
        b = W.ranges(at[three] + 1, behind[1][three])
        left = np.repeat(at[three] + behind[1][three], behind[1][three]) - b  # words behind the second
        a, b, c = np.repeat(a, left), np.repeat(b, left), W.ranges(b + 1, left)
        owner = np.repeat(np.repeat(of[three], behind[1][three]), left)
        words.append((owner, a, W.mixed((self.token[a] * step + self.token[b]) * _U(0xD6E8FEB86659FD93) + self.token[c])))
        owner, at, key = (np.concatenate([w[k] for w in words]) for k in range(3))
        return chosen[owner], key, at - head[owner]


_PLACES = {"set": _U, "check": _U, "id": np.int64, "ref": np.int64, "line": np.int32}
_GONE = {"line": np.int32, "ref": np.int64, "id": np.int64}
_ENTRIES = {"key": np.uint32, "set": _U, "parity": _U, "size": np.uint32, "position": np.uint32}
_COLUMNS = [f"c{k}" for k in range(7)]
#: Words from which a signature has 128 bits and 256 bits; of so many words, shorter ones tell nothing.
LONG, LONGER = 96, 192


def _sharded(
    kind: int, shards: int, by: np.ndarray, columns: list[np.ndarray], rows: list[list], only: list[np.ndarray | None] | None = None
) -> None:
    """Append a row of packed columns per shard; ``only`` tells which entries a column is sent for."""
    only = only or [None] * len(columns)
    shard = (by % _U(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            at = order[a:b]
            rows[0].append(kind * shards + s)
            for out, column, sent in zip(rows[1:], columns, only):
                out.append(column[at if sent is None else at[sent[at]]].tobytes())
            for out in rows[1 + len(columns) :]:
                out.append(b"")


def _firsts(set_: np.ndarray, check: np.ndarray, ids: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by set and place; in it: the first of each set, and those at another place than the first."""
    order = np.lexsort((line, ids, check, set_))
    s, c, i, n = set_[order], check[order], ids[order], line[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    head = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(s))))
    return order, new, (i != i[head]) | (n != n[head])


def _distinct(refs: np.ndarray, new: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """In the order of ``_firsts``: one of each document at the first place of a set; repeated ids put several there."""
    out = ~repeat
    several = np.flatnonzero(out & ~new)
    if len(several):
        at = np.flatnonzero(out)
        of, ref = np.cumsum(new)[at], refs[at]
        out[at] = False
        order = np.lexsort((ref, of))
        of, ref = of[order], ref[order]
        first = np.concatenate([[True], (of[1:] != of[:-1]) | (ref[1:] != ref[:-1])])
        out[at[order[first]]] = True
    return out


def _emitted(batches: Iterator[pa.RecordBatch], classes: np.ndarray, frequent: tuple[int, int], shards: int) -> Iterator[pa.RecordBatch]:
    """Places of sets (kind 0), prefix entries (kind 1) and places that go (kind 2), in arrays per shard; one set each per task's chunk."""
    held: list[tuple] = []
    entries: list[tuple] = []

    def flush() -> pa.RecordBatch:
        rows: list[list] = [[] for _ in range(1 + len(_COLUMNS))]
        places = [np.concatenate([h[k] for h in held]).astype(d) for k, d in enumerate(_PLACES.values())]
        order, new, repeat = _firsts(places[0], places[1], places[2], places[4])
        leaving = order[_distinct(places[3][order], new, repeat)]
        _sharded(0, shards, places[0][leaving], [p[leaving] for p in places], rows)
        gone = order[repeat]
        _sharded(2, shards, places[3][gone].view(_U), [places[k][gone] for k in (4, 3, 2)], rows)
        found = [np.concatenate([e[k] for e in entries], axis=-1) for k in range(5)]
        # a set that several slices of this chunk hold is entered once
        order = np.lexsort((found[1], found[0]))
        k, s = found[0][order], found[1][order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        found = [f[..., order[new]] for f in found]
        # the 256 bits fold into 128 and 64: what is sent beyond 64 are the words that unfold them
        wide = found[2]
        long, longer = found[3] >= LONG, found[3] >= LONGER
        folded = wide[0] ^ wide[1] ^ wide[2] ^ wide[3]
        more = [wide[1] ^ wide[3], np.ascontiguousarray(wide[2:].T)]
        # Within a shard half a key tells keys apart well enough: a mix-up only brings lines together that need not meet.
        columns = [(found[0] >> _U(32)).astype(np.uint32), found[1], folded, *map(_narrow, found[3:]), *more]
        _sharded(1, shards, found[0], columns, rows, [None] * 5 + [long, longer])
        held.clear()
        entries.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])], names=["shard", *_COLUMNS])

    for batch in batches:
        for part in slices(batch):
            sets = LineSets(part.column("text"), classes)
            if not len(sets.size):
                continue
            ids, refs = part.column("__id").to_numpy(), part.column("__ref").to_numpy()
            held.append((sets.key, sets.check, ids[sets.row], refs[sets.row], sets.line))
            _, once = np.unique(sets.key, return_index=True)
            once = once[sets.size[once] >= LEAST_JOINED]
            of, key, position = sets.prefixes(once, frequent)
            entries.append((key, sets.key[of], sets.parity[:, of], sets.size[of], position))
            if max(sum(len(e[0]) for e in entries), sum(len(h[0]) for h in held)) >= CHUNK:
                yield flush()
    if held:
        yield flush()


#: Neighbours in a group that entries are held against before the rest of it.
NEAR = 16


def _narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint16 if not len(a) or a.max() < 1 << 16 else np.uint32)


def _read(column: pa.ChunkedArray, dtype, counts: list[int]) -> np.ndarray:
    """The values of packed arrays of ``counts`` values each, which ``_narrow`` may have made."""
    parts = []
    for v, n in zip(column, counts):
        data = v.as_buffer()
        parts.append(np.frombuffer(data, np.uint16 if len(data) == 2 * n else dtype))
    return np.concatenate(parts)


def _near(parity: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A first, cheap look at the parities of entries i and j: lets every similar pair through."""
    a, b = SIMILARITY
    differ = np.bitwise_count(parity[i] ^ parity[j]).astype(np.int32)
    return differ * (a + b) <= (size[i] + size[j]) * (b - a)


def possible(a: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether entries i and j, which share a key, may be similar by length, position and parity."""
    n, m = a["size"][i], a["size"][j]
    need = least_overlap(n, m)
    reach = np.minimum(n - a["position"][i], m - a["position"][j])  # the shared word and what lies behind it
    most = n + m - 2 * need
    fits = (need <= np.minimum(n, m)) & (reach >= need) & (np.bitwise_count(a["parity"][i] ^ a["parity"][j]) <= most)
    both = np.flatnonzero(fits & (np.minimum(n, m) >= LONG))
    if len(both):
        i, j, most = i[both], j[both], most[both]
        differ = np.bitwise_count(a["half"][i] ^ a["half"][j]) + np.bitwise_count(a["parity"][i] ^ a["half"][i] ^ a["parity"][j] ^ a["half"][j])
        far = differ > most
        at = np.flatnonzero(~far & (np.minimum(a["size"][i], a["size"][j]) >= LONGER))
        if len(at):
            far[at] = np.bitwise_count(a["quarters"][i[at]] ^ a["quarters"][j[at]]).sum(axis=1, dtype=np.int64) > most[at]
        fits[both[far]] = False
    return fits


def _paired(a: dict[str, np.ndarray], head: np.ndarray, size: np.ndarray) -> np.ndarray:
    """True for entries that have a possible partner in their group; groups over ``BLOCK`` count as all true."""
    live = np.repeat(size > BLOCK, size)
    left = np.repeat(size - 1, size) - W.ranges(np.zeros(len(size), np.int64), size)  # entries behind in the group
    at, step = np.flatnonzero((left > 0) & ~live), 1
    while len(at) and step <= NEAR:
        open_ = at[~(live[at] & live[at + step])]
        open_ = open_[_near(a["parity"], a["size"], open_, open_ + step)]
        hit = open_[possible(a, open_, open_ + step)]
        live[hit] = live[hit + step] = True
        step += 1
        at = at[left[at] >= step]
    # what is still alone in a larger group is held against all of it, some rows of a matrix at a time
    for h, n in zip(head[size > NEAR + 1].tolist(), size[size > NEAR + 1].tolist()):
        alone = h + np.flatnonzero(~live[h : h + n])
        every = np.arange(h, h + n)
        for k in range(0, len(alone), max(1, 1_000_000 // n)):
            some = alone[k : k + max(1, 1_000_000 // n)]
            i, j = np.nonzero(_near(a["parity"], a["size"], some[:, None], every[None, :]))
            i, j = some[i], every[j]
            i, j = i[i != j], j[i != j]
            live[i[possible(a, i, j)]] = True
    return live


def _shard(table: pa.Table, shards: int) -> pa.Table:
    """Kind 0: the first place of each set (``gone`` false), later ones (true). Kind 1: (group, set) where pairs may be. Kind 2: places that go."""
    kind = table.column("shard")[0].as_py() // shards
    fields = (_PLACES, _ENTRIES, _GONE)[kind]
    counts = [len(v.as_buffer()) // 8 for v in table.column(_COLUMNS[1])]  # the second column is of 8 bytes in every kind
    a = {n: _read(table.column(c), d, counts) for c, (n, d) in zip(_COLUMNS, fields.items())}
    if kind == 0:
        order, new, repeat = _firsts(a["set"], a["check"], a["id"], a["line"])
        at = np.concatenate([order[new], order[repeat]])
        gone = np.repeat([False, True], [new.sum(), repeat.sum()])
        nothing = pa.nulls(len(at), pa.int64())
        return pa.table({
            "group": nothing, "set": a["set"][at].view(np.int64), "id": a["id"][at], "ref": a["ref"][at], "line": a["line"][at], "gone": gone,
        })
    if kind == 2:
        nothing = pa.nulls(len(a["ref"]), pa.int64())
        return pa.table({
            "group": nothing, "set": nothing, "id": a["id"], "ref": a["ref"], "line": a["line"], "gone": np.ones(len(a["ref"]), bool),
        })
    long, longer = a["size"] >= LONG, a["size"] >= LONGER
    a["half"] = np.zeros(len(long), _U)
    a["half"][long] = np.concatenate([np.frombuffer(v.as_buffer(), _U) for v in table.column("c5")])
    a["quarters"] = np.zeros((len(long), 4), _U)
    two = np.concatenate([np.frombuffer(v.as_buffer(), _U) for v in table.column("c6")]).reshape(-1, 2)
    half = a["half"][longer]
    a["quarters"][longer] = np.column_stack([a["parity"][longer] ^ half ^ two[:, 0], half ^ two[:, 1], two[:, 0], two[:, 1]])
    order = np.lexsort((a["set"], a["key"]))
    a = {n: v[order].astype(np.int64 if n in ("size", "position") else v.dtype) for n, v in a.items()}
    new = np.ones(len(order), bool)
    new[1:] = (a["key"][1:] != a["key"][:-1]) | (a["set"][1:] != a["set"][:-1])
    a = {n: v[new] for n, v in a.items()}
    head = np.flatnonzero(np.concatenate([[True], a["key"][1:] != a["key"][:-1]]))
    size = np.diff(np.append(head, len(a["key"])))
    several = np.repeat(size > 1, size)
    a = {n: v[several] for n, v in a.items()}
    size = size[size > 1]
    head = np.cumsum(size) - size
    live = _paired(a, head, size)
    of = np.repeat(np.arange(len(size)), size)[live]
    sets = a["set"][live]
    groups: list[np.ndarray] = []
    members: list[np.ndarray] = []
    if len(sets):
        head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        size = np.diff(np.append(head, len(of)))
        name = W.mixed(np.add.reduceat(W.mixed(sets), head) + size.astype(_U))  # the same for the same members
        whole = np.repeat(size <= 2 * BLOCK, size)
        groups.append(np.repeat(name, size)[whole])
        members.append(sets[whole])
        for h, n, g in zip(head[size > 2 * BLOCK].tolist(), size[size > 2 * BLOCK].tolist(), name[size > 2 * BLOCK]):
            blocks = np.array_split(sets[h : h + n], -(-n // BLOCK))
            for i, j in combinations(range(len(blocks)), 2):
                both = np.concatenate([blocks[i], blocks[j]])
                groups.append(np.full(len(both), W.mixed(np.array([g + _U(i * len(blocks) + j)]))[0]))
                members.append(both)
    group = np.concatenate(groups) if groups else np.zeros(0, _U)
    member = np.concatenate(members) if members else np.zeros(0, _U)
    nothing = pa.nulls(len(group), pa.int64())
    return pa.table({
        "group": group.view(np.int64), "set": member.view(np.int64), "id": nothing, "ref": nothing,
        "line": pa.nulls(len(group), pa.int32()), "gone": pa.nulls(len(group), pa.bool_()),
    })


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked lines with their words, once per group that they belong to."""
    names = ["group", "id", "line", "ref", "words"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    for part in (p for batch in batches for p in slices(batch)):
        rows: list[tuple] = []
        for i, ref, text, asked in zip(*(part.column(c).to_pylist() for c in ("__id", "__ref", "text", "asked"))):
            lines = text.encode().split(b"\n")
            for x in asked:
                rows += [(g, i, x["line"], ref, lines[x["line"]]) for g in x["groups"]]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def similar(a: frozenset, b: frozenset) -> bool:
    p, q = SIMILARITY
    shared = len(a & b)
    return q * shared >= p * (len(a) + len(b) - shared)


class _Seen:
    """The earlier lines of a group."""

    def __init__(self) -> None:
        self.words: dict[bytes, bytes] = {}  # one object per word, which the lines of a group largely share
        self.sets: list[frozenset] = []
        self.sizes: dict[int, list[int]] = {}

    def hold(self, line: bytes) -> bool:
        """Whether an earlier line is similar; the line counts as earlier from now on."""
        a, b = SIMILARITY
        words = frozenset([self.words.setdefault(w, w) for w in line.split()])
        n = len(words)
        found = False
        for size in range(-(-a * n // b), b * n // a + 1):
            if any(similar(words, self.sets[k]) for k in self.sizes.get(size, ())):
                found = True
                break
        self.sizes.setdefault(n, []).append(len(self.sets))
        self.sets.append(words)
        return found


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines sorted by group and place: those with a similar line before them."""
    group = place = None
    seen = _Seen()
    for batch in batches:
        rows: list[tuple] = []
        for g, i, line, ref, data in zip(*(batch.column(c).to_pylist() for c in ("group", "id", "line", "ref", "words"))):
            if g != group:
                group, seen, place = g, _Seen(), None
            before, place = place, (i, line, ref)
            if before != place and seen.hold(data):
                rows.append((i, ref, line))
        columns = list(zip(*rows)) or [()] * 3
        kinds = (pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["id", "ref", "line"])


def joined_groups(rows: DataFrame) -> DataFrame:
    """(set, groups) from (group, set), with groups that overlap joined, so that a set is in few.

    A group takes the smallest name that any of its members meets elsewhere. Members of one
    group still meet, and close variants of one line, whose groups differ by a member or
    two, meet in one place instead of ten. Where that would gather too many, groups keep
    their own names.
    """
    by_set = rows.groupBy("set").agg(F.collect_set("group").alias("groups"), F.min("group").alias("home"))
    members = by_set.select("set", "home", F.explode("groups").alias("group"))
    names = members.groupBy("group").agg(F.min("home").alias("joined"))
    named = stored(members.join(names, "group").groupBy("joined", "set").agg(F.collect_set("group").alias("groups")), "line-groups")
    sizes = named.groupBy("joined").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") <= 2 * BLOCK, F.array("joined")).otherwise(F.col("groups"))
    return named.join(sizes, "joined").groupBy("set").agg(F.array_distinct(F.flatten(F.collect_list(own))).alias("groups"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """__id, __ref and ``__removed``: the numbers of the lines that go, from 0. Stored."""
    ship(docs.sparkSession)
    rows = identified(docs.select("doc_id", "text")).select("__id", "__ref", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    classes, frequent = rarity_classes(word_counts(docs))
    columns = ", ".join(f"{c} binary" for c in _COLUMNS)
    met = map_arrow(rows, lambda b: _emitted(b, classes, frequent, shards), f"shard int, {columns}")
    schema = "group bigint, set bigint, id bigint, ref bigint, line int, gone boolean"
    settled = stored(met.repartition(3 * shards, "shard").groupBy("shard").applyInArrow(lambda t: _shard(t, shards), schema), "line-sets")
    groups = joined_groups(settled.filter("group is not null").select("group", "set"))
    firsts = settled.filter("not gone").select("set", "id", "ref", "line")
    asked = (
        firsts.join(groups, "set").groupBy(F.col("id").alias("__id"), F.col("ref").alias("__ref"))
        .agg(F.collect_list(F.struct("line", "groups")).alias("asked"))
    )
    lines = map_arrow(
        rows.join(asked, ["__id", "__ref"]).select("__id", "__ref", "text", "asked"),
        _fetched, "group bigint, id bigint, line int, ref bigint, words binary",
    )
    in_order = lines.repartition("group").sortWithinPartitions("group", "id", "line", "ref")
    later = map_arrow(in_order, _verified, "id bigint, ref bigint, line int")
    gone = settled.filter("gone").select("id", "ref", "line").unionByName(later)
    by_document = gone.groupBy(F.col("id").alias("__id"), F.col("ref").alias("__ref"))
    return stored(by_document.agg(F.collect_set("line").alias("__removed")), "removed-lines")


def _with_removed(docs: DataFrame) -> DataFrame:
    return identified(docs).join(removed_lines(docs), ["__id", "__ref"], "left")


def kept_lines(text: str, removed: list[int] | None) -> str:
    if not removed:
        return text
    gone = set(removed)
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)


def removal_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, kept_sha256 of the kept lines joined by line feeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, digests = [], [], []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column("__removed").to_pylist()):
                text = text or ""
                totals.append(text.count("\n") + 1)
                gone.append(len(removed or ()))
                digests.append(hashlib.sha256(kept_lines(text, removed).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_lines", "n_removed", "kept_sha256"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_removed(docs.select("doc_id", "text")).select("doc_id", "text", "__removed")
    return map_arrow(rows, run, f"doc_id {key}, n_lines long, n_removed long, kept_sha256 string")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go cut from ``text`` and, where there is one, ``n_chars`` counted anew.

    Documents of which no word is left go; those that had none stay as they are.
    """
    text, gone = F.col("text"), F.col("__removed")
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda line, k: ~F.array_contains(gone, k)), "\n")
    rows = _with_removed(docs).withColumn("__kept", F.when(gone.isNotNull(), kept).otherwise(text))
    has_word = F.col("__kept").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.filter(gone.isNull() | has_word)
    new = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("__kept").cast(docs.schema["n_chars"].dataType)
    return rows.withColumns(new).select(docs.columns)
