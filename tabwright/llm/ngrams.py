"""Near-duplicate documents: a Jaccard join on word 5-grams by MinHash bands.

1. *Signatures.* Each text's 5-gram set is reduced to minima of hash functions; ``rows``
   of them make a band, and ``bands`` bands are as many as the target recall needs at
   the similarity threshold (``banding``).
2. *Bands.* Texts meet by band hash. What leaves a shard is the membership of the groups
   of two and more different texts, not their pairs; groups with the same members, as
   close copies make in many bands, are one. A very large group is cut into blocks.
3. *Verification.* The texts of a group meet in one task with their whole 5-gram sets.
   Shared 5-grams of all pairs come from one matrix product; a pair that meets in several
   groups counts in the first. Out come the number of links per text and, instead of the
   links, a spanning forest of them.
4. *Classes.* Connected components of the forests, by alternating large and small stars.

Equal texts are one node throughout, with the number of their rows, so copies are never
paired. A text of one to four words has one gram, all its words; a text without words has
none, and is linked to equal texts only. Null counts as empty. Words are compared as they
are written.

The class of a document is the smallest id in it. A null id is never that while others
are there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import cut, stored
from tabwright.llm import words as W
from tabwright.llm.tables import map_arrow, slices
from tabwright.shipping import ship

_U = np.uint64
GRAM = 5
#: Jaccard similarity as a fraction; share of pairs at just that similarity that must meet; most bands.
SIMILARITY = (4, 5)
RECALL, MOST_BANDS = 0.9999, 24
#: Band entries that leave a task at a time; text bytes per shard; fewest shards.
CHUNK, SHARD_BYTES, LEAST_SHARDS = 1_500_000, 24 << 20, 16
#: Texts of a block; a group of more than two blocks is compared block by block.
BLOCK = 1_000
_PART = 1 << 15  # grams hashed at a time, so that they stay in a core's cache
_COLUMNS = 4096  # grams per matrix product


def banding(similarity: float, recall: float, most_bands: int = MOST_BANDS) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false meetings, whose recall needs at most ``most_bands``."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands <= most_bands:
            best = (bands, rows)
    return best


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__node``, the digest of the text."""
    return docs.withColumn("__node", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def gram_sets(column: pa.Array, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams of every row, repeats included, and the bounds of the rows."""
    data, offsets = W.text_bytes(column)
    start, end, first = W.word_spans(data, offsets)
    hashes = W.span_hashes(data, start, end)
    n = np.diff(first)
    grams = W.gram_hashes(hashes, gram)
    counts = np.where(n >= gram, n - gram + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(bounds[-1], _U)
    whole = np.flatnonzero(n >= gram)
    out[W.ranges(bounds[whole], counts[whole])] = grams[W.ranges(first[whole], counts[whole])]
    for r in np.flatnonzero((n > 0) & (n < gram)).tolist():
        own = hashes[first[r] : first[r + 1]]
        out[bounds[r]] = W.gram_hashes(own, len(own), seed=len(own))[0]
    return out, bounds


def band_keys(grams: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key per row and band; rows without grams must not be asked for."""
    factors = W.mixed(np.arange(1, bands * rows + 1, dtype=_U)) | _U(1)
    minima = np.empty((bands * rows, len(bounds) - 1), _U)
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + _PART, side="right")) - 1)
        part, heads = grams[bounds[i] : bounds[j]], bounds[i:j] - bounds[i]
        scratch = np.empty_like(part)
        for k, factor in enumerate(factors):
            np.multiply(part, factor, out=scratch)
            minima[k, i:j] = np.minimum.reduceat(scratch, heads)
        i = j
    keys = np.empty((len(bounds) - 1, bands), _U)
    for b in range(bands):
        total = np.full(len(bounds) - 1, b + 1, _U)
        for k in range(b * rows, (b + 1) * rows):
            total = W.mixed(total * _U(0x9FB21C651E98DF25) + minima[k])
        keys[:, b] = total
    return keys


def _signed(batches: Iterator[pa.RecordBatch], bands: int, rows: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Band keys with their texts, in arrays per shard."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> pa.RecordBatch:
        key, high, low = (np.concatenate([h[k] for h in held]) for k in range(3))
        held.clear()
        order = np.lexsort((low, high, key))
        key, high, low = key[order], high[order], low[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        key, high, low = key[new], high[new], low[new]
        shard = (key % _U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        pieces = [(s, order[a:b]) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        arrays = [pa.array([x[at].tobytes() for _, at in pieces], pa.binary()) for x in (key, high, low)]
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in pieces], pa.int32()), *arrays], names=["shard", "key", "high", "low"])

    for batch in batches:
        for part in slices(batch):
            grams, bounds = gram_sets(part.column("text"))
            some = np.flatnonzero(np.diff(bounds) > 0)
            if not len(some):
                continue
            digest = np.frombuffer(bytes.fromhex("".join(part.column("__node").to_pylist())), ">u8").astype(_U).reshape(-1, 2)[some]
            keys = band_keys(grams, np.append(bounds[some], bounds[-1]), bands, rows)
            held.append((keys.ravel(), np.repeat(digest[:, 0], bands), np.repeat(digest[:, 1], bands)))
            if sum(len(h[0]) for h in held) >= CHUNK:
                yield flush()
    if held:
        yield flush()


def _hex(high: np.ndarray, low: np.ndarray) -> list[str]:
    text = np.column_stack([high, low]).astype(">u8").tobytes().hex()
    return [text[k : k + 32] for k in range(0, len(text), 32)]


def _groups(table: pa.Table) -> pa.Table:
    """(group, node) for every key that several texts have."""
    key, high, low = (np.concatenate([np.frombuffer(v.as_buffer(), _U) for v in table.column(c)]) for c in ("key", "high", "low"))
    order = np.lexsort((low, high, key))
    key, high, low = key[order], high[order], low[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    key, high, low = key[new], high[new], low[new]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(head, len(key)))
    several = np.repeat(size > 1, size)
    high, low, size = high[several], low[several], size[size > 1]
    head = np.cumsum(size) - size
    groups: list[np.ndarray] = []
    at: list[np.ndarray] = []
    if len(size):
        name = W.mixed(np.add.reduceat(W.mixed(high ^ W.mixed(low)), head) + size.astype(_U))  # the same for the same members
        _, kept = np.unique(name, return_index=True)
        head, size, name = head[kept], size[kept], name[kept]
        small = size <= 2 * BLOCK
        groups.append(np.repeat(name[small], size[small]))
        at.append(W.ranges(head[small], size[small]))
        for h, n, g in zip(head[~small].tolist(), size[~small].tolist(), name[~small]):
            blocks = np.array_split(np.arange(h, h + n), -(-n // BLOCK))
            for i, j in combinations(range(len(blocks)), 2):
                at.append(np.concatenate([blocks[i], blocks[j]]))
                groups.append(np.full(len(at[-1]), W.mixed(np.array([g + _U(i * len(blocks) + j)]))[0]))
    group = np.concatenate(groups) if groups else np.zeros(0, _U)
    rows = np.concatenate(at) if at else np.zeros(0, np.int64)
    return pa.table({"group": group.view(np.int64), "node": pa.array(_hex(high[rows], low[rows]), pa.string())})


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct grams of each asked text, once per group that it belongs to."""
    for part in (p for batch in batches for p in slices(batch, most=1 << 20)):
        grams, bounds = gram_sets(part.column("text"))
        rows: list[tuple] = []
        for k, (node, copies, groups) in enumerate(zip(*(part.column(c).to_pylist() for c in ("__node", "copies", "groups")))):
            own = np.unique(grams[bounds[k] : bounds[k + 1]]).tobytes()
            all_groups = np.sort(np.array(groups, np.int64)).tobytes()
            rows += [(g, node, copies, all_groups, own) for g in groups]
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["group", "node", "copies", "groups", "grams"]
        )


def shared_counts(lists: list[np.ndarray]) -> np.ndarray:
    """How many values every two of the lists share; the values of one list are distinct."""
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values, place = np.unique(np.concatenate(lists), return_inverse=True)
    often = np.bincount(place, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    used = often[place]
    of, column = of[used], column[place[used]]
    total = np.zeros((len(lists), len(lists)), np.float32)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for first in range(0, int(often.sum()), _COLUMNS):
        a, b = np.searchsorted(column, (first, first + _COLUMNS))
        part = np.zeros((len(lists), _COLUMNS), np.float32)
        part[of[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges to the first of each connected component."""
    out, left = [], np.ones(len(linked), bool)
    for root in range(len(linked)):
        if not left[root]:
            continue
        reached = np.zeros(len(linked), bool)
        reached[root] = True
        edge = reached.copy()
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reached
            reached |= edge
        left &= ~reached
        out += [(k, root) for k in np.flatnonzero(reached).tolist() if k != root]
    return out


def verified(group: int, nodes: list[str], copies: list[int], groups: list[np.ndarray], grams: list[np.ndarray]) -> tuple[np.ndarray, list]:
    """Links per text that count in this group, weighted by copies, and the edges of a spanning forest."""
    p, q = SIMILARITY
    size = np.array([len(g) for g in grams], np.float64)
    linked = (p + q) * shared_counts(grams).astype(np.float64) >= p * (size[:, None] + size[None, :])
    np.fill_diagonal(linked, False)
    forest = _forest(linked)
    earlier = [g[g < group] for g in groups]
    if linked.any() and any(map(len, earlier)):
        linked &= shared_counts(earlier) == 0
    return linked @ np.array(copies, np.float64), forest


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: (node, links, null) and (node, 0, other node) of the forest."""
    group: int | None = None
    held: dict[str, tuple] = {}

    def close() -> list[tuple]:
        if len(held) < 2:
            return []
        nodes = list(held)
        copies, groups, grams = (list(c) for c in zip(*held.values()))
        links, forest = verified(group, nodes, copies, groups, grams)
        rows = [(node, int(n), None) for node, n in zip(nodes, links) if n]
        return rows + [(max(nodes[a], nodes[b]), 0, min(nodes[a], nodes[b])) for a, b in forest]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 3
        kinds = (pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["node", "links", "other"])

    for batch in batches:
        rows: list[tuple] = []
        groups, grams = batch.column("groups"), batch.column("grams")
        for k, (g, node, copies) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("group", "node", "copies")))):
            if g != group:
                rows += close()
                group, held = g, {}
            held[node] = (copies, np.frombuffer(groups[k].as_py(), np.int64), np.frombuffer(grams[k].as_py(), _U))
        yield batch_of(rows)
    yield batch_of(close())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (node, other), the root being the smallest of its component.

    Alternates large stars (each larger neighbour goes to the smallest of the neighbourhood) and
    small stars (each smaller neighbour does) until the edges are stars, which takes a number of
    rounds that grows with the logarithm of the component, not with its diameter.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = cut(edges.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).filter("u <> v").distinct())
    before = None
    while before != (now := state(pairs)):
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        found = large.join(smallest(large), "u")
        small = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        pairs = cut(small.filter("u <> v").distinct())
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def classes(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): doc_id and __node per row; per node its class (``root``), class_id, copies and links."""
    ship(docs.sparkSession)
    bands, per_band = banding(similarity[0] / similarity[1], recall)
    keyed = identified(docs.select("doc_id", "text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    rows = stored(keyed.select("doc_id", "__node"), "text-nodes")
    texts = rows.groupBy("__node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    signed = map_arrow(
        keyed.select("__node", "text"), lambda b: _signed(b, bands, per_band, shards), "shard int, key binary, high binary, low binary"
    )
    groups = stored(signed.groupBy("shard").applyInArrow(_groups, "group bigint, node string"), "band-groups")
    asked = groups.groupBy(F.col("node").alias("__node")).agg(F.collect_set("group").alias("groups")).join(texts, "__node")
    # one row of each asked text: that of its least id (any of several rows with it: they are the same)
    found = keyed.join(asked, "__node").filter(F.col("doc_id").eqNullSafe(F.col("least")))
    fetched = map_arrow(
        found.select("__node", "text", "copies", "groups"), _fetched,
        "group bigint, node string, copies bigint, groups binary, grams binary",
    )
    linked = stored(map_arrow(fetched.repartition("group").sortWithinPartitions("group"), _linked, "node string, links bigint, other string"), "links")
    links = linked.filter("other is null").groupBy(F.col("node").alias("__node")).agg(F.sum("links").alias("links"))
    roots = components(linked.filter("other is not null").select("node", "other"))
    nodes = (
        texts.join(links, "__node", "left").join(roots.withColumnRenamed("node", "__node"), "__node", "left")
        .select("__node", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "__node").alias("root"))
    )
    heads = stored(nodes, "nodes")
    # classes of several texts only; every other text is its own class
    several = heads.join(roots.select(F.col("root")).distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("class_id"))
    return rows, heads.join(several, "root", "left").withColumn("class_id", F.coalesce("class_id", "least"))


def near_duplicates(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, and n_links, the other rows that are as similar as asked."""
    rows, nodes = classes(docs, similarity, recall)
    return rows.join(nodes, "__node").select("doc_id", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))


def one_of_each_class(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class; of repeated rows, one."""
    _, nodes = classes(docs, similarity, recall)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "__node"))
    kept = nodes.groupBy("root").agg(first.alias("first")).select(F.col("first.least").alias("__least"), "first.__node")
    found = identified(docs).join(kept, "__node").filter(F.col("doc_id").eqNullSafe(F.col("__least")))
    return found.dropDuplicates(["__node"]).select(docs.columns)
