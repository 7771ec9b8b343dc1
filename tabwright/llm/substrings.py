"""Removal of repeated passages: 20-word windows that also start earlier in the corpus.

A window is removed if the same words start at an earlier place (smaller id, or the
same document and an earlier start); what goes is every word that a removed window
covers. Windows are judged on the input.

1. *Anchors.* A window's anchor is its leftmost smallest 6-word hash. Equal windows
   have equal anchors at the same place in them, so only stretches round equal anchors
   need to meet. A stretch is a run of windows with one anchor: some 27 words, one for
   every eight words of text. Stretches travel as arrays of numbers, not words.
2. *Equal stretches* are settled by their hashes, first within the task that reads
   them, then within the anchor's shard: all but the earliest go entirely. A passage
   held by a third of all documents is one entry per task after that.
3. *Reference shards.* Where an anchor has several different stretches, their words are
   fetched, and meet in one task in order of place: each is streamed through a suffix
   automaton of those before it, and its matching statistics (longest match ending at
   each word) of ``WINDOW`` or more mark the windows that started earlier. Then it is
   added to the automaton. An anchor with very many stretches is dealt out window by
   window.
4. *Removal.* Each document meets the places of its removed windows.

The automata are routed to the tasks that stream the stretches they can match, instead
of every automaton being broadcast to every document: the reference is the corpus
itself, and its automata times its documents would grow with the square (see README).

A document is known by its id and a hash of its text. Repeated rows with the same id
and text count as one document and fare alike; rows with the same id and other text are
ordered by that hash. A null id comes before all others; a null text has no words. Ids
must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm import words as W
from tabwright.llm.tables import map_arrow, slices
from tabwright.shipping import ship

_U = np.uint64
WINDOW, GRAM = 20, 6
#: Stretches that one task settles among themselves before they leave it.
CHUNK = 1_000_000
#: Text bytes per shard of anchors, and fewest shards.
SHARD_BYTES, LEAST_SHARDS = 24 << 20, 16
#: Different stretches that one automaton takes.
AUTOMATON = 5_000

_FIELDS = {"anchor": _U, "content": _U, "id": np.int64, "ref": np.int64, "start": np.int32, "count": np.int32}
_NO_ID = -(1 << 63)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__id`` and ``__ref``, which tell documents apart."""
    return docs.withColumns({
        "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
        "__ref": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
    })


def smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive values, where the leftmost smallest stands."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    at, best, span = np.arange(len(values)), values, 1
    while span < width:
        step = min(span, width - span)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, best[step:], best[:-step])
        span += step
    return at


def stretches(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per run of windows with one anchor: row, first window, number of windows, anchor hash, content hash."""
    total = len(hashes)
    width = window - gram + 1
    grams = W.gram_hashes(hashes, gram)
    anchor_at = smallest_in_window(grams, width)
    sizes = np.diff(first)
    per_row = np.maximum(sizes - window + 1, 0)
    start = W.ranges(first[:-1], per_row)
    row = np.repeat(np.arange(len(sizes)), per_row)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(_U), none.astype(_U)
    at = anchor_at[start]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    count = np.diff(np.append(new, len(start)))
    begin, row = start[new], row[new]
    content, words = np.zeros(len(new), _U), count + window - 1
    step = _U(0x9FB21C651E98DF25)
    for k in range(width + window - 1):
        live = k < words
        content = np.where(live, content * step + hashes[np.minimum(begin + k, total - 1)], content)
    return row, begin - first[row], count, grams[at[new]], W.mixed(content + words.astype(_U))


def _first_places(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key and place, and in it: is it the first of its key, is it at another place than the first."""
    order = np.lexsort((place, key))
    k, p = key[order], place[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    heads = np.flatnonzero(first)
    of_head = np.repeat(p[heads], np.diff(np.append(heads, len(k))))
    return order, first, p != of_head


def _places(ids: np.ndarray, refs: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Numbers in the order of (id, ref, start); equal places get equal numbers."""
    order = np.lexsort((start, refs, ids))
    a, b, c = ids[order], refs[order], start[order]
    step = np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def _settled(batches: Iterator[pa.RecordBatch], shards: int, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, done, arrays): the earliest of equal stretches in this task, and runs of windows that go."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> pa.RecordBatch:
        ids, refs, start, count, anchor, content = (np.concatenate([h[k] for h in held]) for k in range(6))
        held.clear()
        place = _places(ids, refs, start)
        key = W.mixed(anchor * _U(0x9E3779B97F4A7C15) + content)
        order, first, repeat = _first_places(key, place)
        rows: list[list] = [[], [], *([] for _ in _FIELDS)]

        def add(shard: int, done: bool, at: np.ndarray, **other: np.ndarray) -> None:
            values = {"anchor": anchor, "content": content, "id": ids, "ref": refs, "start": start, "count": count}
            rows[0].append(shard)
            rows[1].append(done)
            for column, (name, dtype) in zip(rows[2:], _FIELDS.items()):
                column.append(other.get(name, values[name][at]).astype(dtype).tobytes())

        leaving = order[first]
        shard = (anchor[leaving] % _U(shards)).astype(np.int64)
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                add(s, False, leaving[by_shard[a:b]])
        gone = order[repeat]
        if len(gone):
            gone = gone[np.lexsort((start[gone], refs[gone], ids[gone]))]
            i, r, s, n = ids[gone], refs[gone], start[gone], count[gone]
            new = np.concatenate([[True], (i[1:] != i[:-1]) | (r[1:] != r[:-1]) | (s[1:] != s[:-1] + n[:-1])])
            heads = np.flatnonzero(new)
            runs = np.add.reduceat(n, heads)
            for s in range(0, len(heads), 1 << 16):  # dealt to the shards by what they hold
                part = slice(s, s + (1 << 16))
                add(int(refs[gone[heads[s]]] % shards), True, gone[heads[part]], count=runs[part])
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.bool_()), *(pa.array(c, pa.binary()) for c in rows[2:])],
            names=["shard", "done", *_FIELDS],
        )

    for batch in batches:
        for part in slices(batch):
            data, offsets = W.text_bytes(part.column("text"))
            start, end, first = W.word_spans(data, offsets)
            row, begin, count, anchor, content = stretches(W.span_hashes(data, start, end), first, window, gram)
            ids, refs = part.column("__id").to_numpy(), part.column("__ref").to_numpy()
            held.append((ids[row], refs[row], begin, count, anchor, content))
            if sum(len(h[0]) for h in held) >= CHUNK:
                yield flush()
    if sum(len(h[0]) for h in held):
        yield flush()


_PLACE = "id bigint, ref bigint, start int, count int"


def _shard(table: pa.Table) -> pa.Table:
    """Settle equal stretches of a shard; ``split`` > 0 asks for the words of those that differ round one anchor."""

    def read(done: bool) -> dict[str, np.ndarray]:
        part = table.filter(pa.array(np.asarray(table.column("done")) == done))
        return {n: np.concatenate([np.zeros(0, d), *(np.frombuffer(v.as_buffer(), d) for v in part.column(n))]) for n, d in _FIELDS.items()}

    x, gone = read(False), read(True)
    out = [(gone["id"], gone["ref"], gone["start"], gone["count"], np.zeros(len(gone["id"]), _U), np.zeros(len(gone["id"]), np.int32))]
    if len(x["anchor"]):
        place = _places(x["id"], x["ref"], x["start"])
        order = np.lexsort((place, x["content"], x["anchor"]))
        a, c, p = x["anchor"][order], x["content"][order], place[order]
        new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
        heads = np.flatnonzero(new)
        repeat = p != np.repeat(p[heads], np.diff(np.append(heads, len(p))))
        kinds = np.bincount(np.cumsum(new_anchor)[heads] - 1)  # different stretches per anchor
        of_anchor = kinds[np.cumsum(new_anchor) - 1]
        for at, split in ((order[repeat], False), (order[new & (of_anchor > 1)], True)):
            parts = -(-of_anchor[new & (of_anchor > 1)] // AUTOMATON) if split else np.zeros(len(at))
            out.append((x["id"][at], x["ref"][at], x["start"][at], x["count"][at], x["anchor"][at], parts.astype(np.int32)))
    ids, refs, start, count, anchor, split = (np.concatenate([o[k] for o in out]) for k in range(6))
    return pa.table({"id": ids, "ref": refs, "start": start, "count": count, "anchor": anchor.view(np.int64), "split": split})


def _fetched(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of asked stretches, joined by one space; window by window where they are dealt out."""
    for part in (p for batch in batches for p in slices(batch)):
        rows: list[tuple] = []
        for i, ref, text, asked in zip(*(part.column(c).to_pylist() for c in ("__id", "__ref", "text", "asked"))):
            words = text.encode().split()
            for x in asked:
                start, count, anchor, split = x["start"], x["count"], x["anchor"], x["split"]
                if split == 1:
                    rows.append((anchor, 0, i, ref, start, count, b" ".join(words[start : start + count + window - 1])))
                    continue
                for s in range(start, start + count):
                    passage = b" ".join(words[s : s + window])
                    dealt = int.from_bytes(hashlib.blake2b(passage, digest_size=8).digest(), "little") % split
                    rows.append((anchor, dealt, i, ref, s, 1, passage))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        columns = list(zip(*rows)) or [()] * 7
        names = ["anchor", "part", "id", "ref", "start", "count", "words"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _clone(self, state: int, parent: int, word: bytes) -> int:
        """Split the ending of ``state`` that ``parent`` reaches by ``word`` off as a state of its own."""
        goes, link, size = self.next, self.link, self.size
        made = len(goes)
        goes.append(goes[state].copy())
        link.append(link[state])
        size.append(size[parent] + 1)
        link[state] = made
        while parent >= 0 and goes[parent].get(word) == state:
            goes[parent][word] = made
            parent = link[parent]
        return made

    def add(self, words: list[bytes]) -> None:
        goes, link, size = self.next, self.link, self.size
        last = 0
        for word in words:
            at = goes[last].get(word)
            if at is not None:
                last = at if size[at] == size[last] + 1 else self._clone(at, last, word)
                continue
            made = len(goes)
            goes.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and word not in goes[p]:
                goes[p][word] = made
                p = link[p]
            if p >= 0:
                q = goes[p][word]
                link[made] = q if size[q] == size[p] + 1 else self._clone(q, p, word)
            last = made

    def matches(self, words: list[bytes]) -> list[int]:
        """Matching statistics: the length of the longest known passage ending at each word."""
        goes, link, size = self.next, self.link, self.size
        out, state, length = [], 0, 0
        for word in words:
            while state and word not in goes[state]:
                state = link[state]
                length = size[state]
            at = goes[state].get(word)
            if at is None:
                length = 0
            else:
                state, length = at, length + 1
            out.append(length)
        return out


def _streamed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by anchor and place, each against those before it: bits of the windows that go."""
    shard = place = None
    automaton = Automaton()
    waiting: list[bytes] | None = None  # the last stretch is added when another follows
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("anchor", "part", "id", "ref", "start", "count", "words"))
        rows: list[tuple] = []
        for anchor, part, i, ref, start, count, passage in zip(*columns):
            before, place = place, (anchor, part, i, ref, start)
            if place == before:  # a repeated row
                continue
            words = passage.split(b" ")
            if (anchor, part) != shard:
                shard, automaton, waiting = (anchor, part), Automaton(), words
                continue
            if waiting is not None:
                automaton.add(waiting)
            bits = 0
            for k, length in enumerate(automaton.matches(words)[window - 1 :]):
                if length >= window:
                    bits |= 1 << k
            waiting = None if bits == (1 << count) - 1 else words
            if bits:
                rows.append((i, ref, start, count, bits))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["id", "ref", "start", "count", "bits"])


def removed_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """__id, __ref and ``__removed``: runs (start, count, bits; null bits: all) of windows that go. Stored."""
    ship(docs.sparkSession)
    rows = identified(docs.select("doc_id", "text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    binary = ", ".join(f"{n} binary" for n in _FIELDS)
    met = map_arrow(
        rows.select("__id", "__ref", "text"), lambda batches: _settled(batches, shards, window, gram), f"shard int, done boolean, {binary}"
    )
    settled = stored(met.groupBy("shard").applyInArrow(_shard, f"{_PLACE}, anchor bigint, split int"), "stretches")
    asked = (
        settled.filter("split > 0").groupBy(F.col("id").alias("__id"), F.col("ref").alias("__ref"))
        .agg(F.collect_list(F.struct("start", "count", "anchor", "split")).alias("asked"))
    )
    one_each = rows.join(asked, ["__id", "__ref"]).select("__id", "__ref", "text", "asked")
    passages = map_arrow(one_each, lambda b: _fetched(b, window), f"anchor bigint, part int, {_PLACE}, words binary")
    sorted_passages = passages.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "id", "ref", "start")
    partly = map_arrow(sorted_passages, lambda b: _streamed(b, window), f"{_PLACE}, bits bigint")
    every = settled.filter("split = 0").select("id", "ref", "start", "count", F.lit(None).cast("bigint").alias("bits"))
    runs = every.unionByName(partly).groupBy(F.col("id").alias("__id"), F.col("ref").alias("__ref"))
    return stored(runs.agg(F.collect_list(F.struct("start", "count", "bits")).alias("__removed")), "removed-windows")


def covered_words(n_words: int, runs: list[dict] | None, window: int) -> np.ndarray:
    """True for every word that a removed window covers."""
    edges = np.zeros(n_words + 1, np.int64)
    for r in runs or ():
        start, bits = r["start"], r["bits"]
        if bits is None:
            edges[start] += 1
            edges[start + r["count"] + window - 1] -= 1
            continue
        for k in range(r["count"]):
            if bits >> k & 1:
                edges[start + k] += 1
                edges[start + k + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def _with_removed(docs: DataFrame, window: int) -> DataFrame:
    return identified(docs).join(removed_windows(docs, window), ["__id", "__ref"], "left")


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, digests = [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("__removed").to_pylist()):
                words = (text or "").encode().split()
                totals.append(len(words))
                if runs:
                    cut = covered_words(len(words), runs, window)
                    words = [w for w, c in zip(words, cut.tolist()) if not c]
                gone.append(totals[-1] - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_removed(docs.select("doc_id", "text"), window).select("doc_id", "text", "__removed")
    return map_arrow(rows, run, f"doc_id {key}, n_words long, n_removed long, kept_sha256 string")


def cut_text(text: str, runs: list[dict], window: int = WINDOW) -> str:
    """The text without its covered words and the space behind them; other space stays."""
    data = np.frombuffer(text.encode(), np.uint8)
    start, end, _ = W.word_spans(data, np.array([0, len(data)]))
    cut = covered_words(len(start), runs, window)
    follows = np.append(start[1:], len(data))
    keep = np.ones(len(data), bool)
    gone = np.flatnonzero(cut)
    keep[W.ranges(start[gone], follows[gone] - start[gone])] = False
    left = data[keep].tobytes().decode()
    return left.rstrip(" \t\n\r\v\f") if len(gone) and gone[-1] == len(start) - 1 else left


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and, where there is one, ``n_chars`` counted anew.

    Documents of which no word is left go; those that had none stay as they are.
    """
    columns = docs.columns
    rows = _with_removed(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [
                    cut_text(t, runs, window) if runs else t
                    for t, runs in zip(part.column("text").to_pylist(), part.column("__removed").to_pylist())
                ]
                arrays = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in columns]
                emptied = [bool(runs) and not t.encode().split() for t, runs in zip(texts, part.column("__removed").to_pylist())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(emptied, pa.bool_())], names=[*columns, "__emptied"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_arrow(rows.select(*columns, "__removed"), run, f"{schema}, __emptied boolean").filter(~F.col("__emptied")).select(columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
