"""Self-join of documents on the Jaccard similarity of their word n-grams.

T-occurrence search: two sets at or above the threshold share at least
T = ceil(threshold * size) elements, so a document's partners are those that occur
at least T times in the inverted lists of its elements. DivideSkip merges the
short lists and looks the candidates up in the long ones by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.graph import components, written
from tilldeck.llm.words import (
    Words,
    batch_of,
    blobs,
    chunks,
    column,
    groups,
    mix,
    packed,
    planes,
    slices,
    table_of,
    unplaned,
    whole_texts,
)

SHINGLE = 5
PERCENT = 80
# Documents of one search index; a larger cell is cut into tiles of this size.
TILE = 1000
# Documents every tile of a cell shares, so that tiles of one group connect.
PIVOTS = 32
# Weight of a merge step against a binary probe, as DivideSkip's authors found it.
MU = 0.0085
_POSTINGS = "bucket int, chunk long, doc binary, key binary, id binary, size binary"
_FREQUENT = "chunk long, doc binary, key binary, times binary, id binary, size binary"
_SETS = "node long, size long, keys binary, rarest array<long>, same binary"
_LINKS = "a long, b long"


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, one after another, and their counts.

    A text of fewer words is one n-gram of all its words."""
    words = Words.of(texts, lower=True)
    hashes, at = words.windows(size)
    cuts = np.searchsorted(at, words.first)
    own, counts = [], np.zeros(len(texts), dtype=np.int64)
    for i, n in enumerate(words.counts):
        if n >= size:
            found = np.unique(hashes[cuts[i] : cuts[i + 1]])
        elif n:
            found = np.array([n], dtype=np.uint64)
            for h in words.hashes()[words.first[i] : words.first[i + 1]]:
                found = mix(found * np.uint64(3) ^ h)
        else:
            continue
        own.append(found)
        counts[i] = len(found)
    return (np.concatenate(own) if own else np.empty(0, dtype=np.uint64)), counts


def _postings(size: int, buckets: int):
    """Every element of every set, in packed lists by chunk of documents and
    bucket of hashes. A chunk's first row also carries its ids and set sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for part in chunks(batches, "text"):
            chunk += 1
            ids = column(part, "node")
            keys, counts = shingle_sets(column(part, "text"), size)
            listed = np.array([i is not None for i in ids])
            doc = np.repeat(np.arange(len(ids)), counts)
            order, cuts = slices(keys % np.uint64(buckets), buckets)
            rows = []
            # Ids may be null, so they travel with a flag.
            head = (
                np.array([i or 0 for i in ids], dtype=np.int64).tobytes(),
                np.where(listed, counts, -1 - counts).astype(np.int64).tobytes(),
            )
            start = chunk % buckets
            for b in [start, *(b for b in range(buckets) if b != start)]:
                cut = order[cuts[b] : cuts[b + 1]]
                cut = cut[listed[doc[cut]]]
                if len(cut) or b == start:
                    steps = np.diff(doc[cut], prepend=0)
                    rows.append((b, chunk, planes(steps), keys[cut].tobytes(), *(head if b == start else (b"", b""))))
            yield batch_of(rows, _POSTINGS)

    return run


def _frequent(table: pa.Table) -> pa.Table:
    """Elements that occur in two documents or more, sent back to their chunks
    with the number of documents that hold them."""
    lists = packed(table, "key", np.uint64)
    _, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    times = times[place]
    rows, at = [], 0
    for chunk, steps, keys, ids, sizes in zip(
        column(table, "chunk"), column(table, "doc"), lists, column(table, "id"), column(table, "size"), strict=True
    ):
        count = times[at : at + len(keys)]
        at += len(keys)
        more = count > 1
        if more.any() or ids:
            doc = np.cumsum(unplaned(steps), dtype=np.int64)[more]
            rows.append(
                (chunk, planes(np.diff(doc, prepend=0)), keys[more].tobytes(), planes(count[more]), ids, sizes)
            )
    return table_of(rows, _FREQUENT)


def _sets(percent: int):
    """One row per document. Where enough elements are shared with others to
    reach the threshold: those elements, rarest first, and the rarest ones of
    which any partner must hold one too."""

    def run(table: pa.Table) -> pa.Table:
        ids, sizes = blobs(table, "id", np.int64), blobs(table, "size", np.int64)
        doc = np.concatenate([np.cumsum(unplaned(b), dtype=np.int64) for b in column(table, "doc")])
        times = np.concatenate([unplaned(b).astype(np.int64) for b in column(table, "times")])
        keys = blobs(table, "key", np.uint64)
        order = np.lexsort((keys, times, doc))
        keys, cuts = keys[order], np.searchsorted(doc[order], np.arange(len(ids) + 1))
        out = {name: [] for name in ("node", "size", "keys", "rarest", "same")}
        for i, (node, size) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
            shared = keys[cuts[i] : cuts[i + 1]]
            null, size = size < 0, size if size >= 0 else -1 - size
            needed = -(-size * percent // 100)
            reach = not null and size > 0 and len(shared) >= needed
            out["node"].append(None if null else node)
            out["size"].append(size)
            out["keys"].append(shared.tobytes() if reach else None)
            out["rarest"].append(shared[: len(shared) - needed + 1].view(np.int64).tolist() if reach else None)
            whole = reach and len(shared) == size
            out["same"].append(hashlib.blake2b(np.sort(shared).tobytes(), digest_size=16).digest() if whole else None)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
        return pa.table({n: pa.array(v, type=k) for (n, v), k in zip(out.items(), kinds, strict=True)})

    return run


class _Links:
    """Links found in one task, kept as a forest: a pair already joined through
    others needs no comparison."""

    def __init__(self, count: int) -> None:
        self.root = np.arange(count)

    def join(self, query: int, found: np.ndarray) -> None:
        for other in found.tolist():
            if self.root[other] != self.root[query]:
                self.root[self.root == self.root[other]] = self.root[query]

    def stars(self, nodes: list[int]) -> list[tuple[int, int]]:
        """Each node with the smallest one joined with it."""
        low: dict[int, int] = {}
        for node, root in zip(nodes, self.root.tolist(), strict=True):
            low[root] = min(node, low.get(root, node))
        return [(n, low[r]) for n, r in zip(nodes, self.root.tolist(), strict=True) if n != low[r]]


def divide_skip(
    index: list[np.ndarray], index_sizes: np.ndarray, queries: list[tuple[int, np.ndarray, int]], links: _Links,
    percent: int,
) -> None:
    """Adds to ``links`` each pair of a query and an indexed set whose
    intersection is ``percent`` of their union or more, unless already joined.

    ``queries`` are (place among the index, elements, set size).
    """
    count = len(index)
    keys = np.concatenate(index)
    holder = np.repeat(np.arange(count), [len(k) for k in index])
    order = np.lexsort((holder, keys))
    terms, first, lengths = np.unique(keys[order], return_index=True, return_counts=True)
    holder = holder[order]
    # Postings as one sorted array of list and holder: a probe is a search in it.
    postings = np.repeat(np.arange(len(terms)), lengths) * count + holder
    for query, own, size in queries:
        other = links.root != links.root[query]
        if not other.any():
            continue
        place = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
        lists = place[terms[place] == own]
        needed = -(-size * percent // 100)
        if len(lists) < needed:
            continue
        lists = lists[np.argsort(-lengths[lists], kind="stable")]
        longest = int(lengths[lists[0]])
        skip = min(int(needed / (MU * np.log2(longest + 1) + 1)), needed - 1)
        long, short = lists[:skip], lists[skip:]
        counted = np.zeros(count, dtype=np.int64)
        reach = lengths[short]
        at = np.repeat(first[short] - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
        counted += np.bincount(holder[at], minlength=count)
        found = np.flatnonzero((counted >= needed - len(long)) & other)
        if len(found) and len(long):
            probe = (long[:, None] * count + found[None, :]).ravel()
            hit = np.searchsorted(postings, probe)
            hit = postings[np.minimum(hit, len(postings) - 1)] == probe
            counted[found] += hit.reshape(len(long), len(found)).sum(axis=0)
        both = counted[found]
        close = 100 * both >= percent * (size + index_sizes[found] - both)
        links.join(query, found[close])


def _arrays(table: pa.Table) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    return column(table, "node"), np.array(column(table, "size"), dtype=np.int64), packed(table, "keys", np.uint64)


def _within(percent: int):
    """Links inside one tile, enough of them to connect what is connected."""

    def run(table: pa.Table) -> pa.Table:
        nodes, sizes, keys = _arrays(table)
        links = _Links(len(nodes))
        divide_skip(keys, sizes, list(zip(range(len(nodes)), keys, sizes.tolist(), strict=True)), links, percent)
        return table_of(links.stars(nodes), _LINKS)

    return run


def _across(percent: int):
    """Links between a block of leftover documents and a tile."""

    def run(tile: pa.Table, block: pa.Table) -> pa.Table:
        if not tile.num_rows or not block.num_rows:
            return table_of([], _LINKS)
        nodes, sizes, keys = _arrays(tile)
        more, more_sizes, more_keys = _arrays(block)
        links = _Links(len(nodes) + len(more))
        # What the first round joined needs no look.
        label = np.array(column(tile, "component") + column(block, "component"), dtype=np.int64)
        links.root = np.unique(label, return_inverse=True)[1]
        every = nodes + more
        queries = [(len(nodes) + i, k, int(s)) for i, (k, s) in enumerate(zip(more_keys, more_sizes, strict=True))]
        none = np.empty(0, dtype=np.uint64)
        divide_skip([*keys, *[none] * len(more)], np.concatenate((sizes, more_sizes)), queries, links, percent)
        return table_of(links.stars(every), _LINKS)

    return run


def _cells(sets: DataFrame) -> DataFrame:
    """``node``, ``cell``: documents that may be linked, through others even, lie
    in one cell. Two partners share one of their rarest elements; of an element's
    documents each is tied to the smallest, so its list is never paired out."""
    rare = sets.select("node", F.explode("rarest").alias("element"))
    least = rare.groupBy("element").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    ties = rare.join(least.where("least != most"), "element").select("node", "least").where("node != least")
    return components(ties, "node", "least").withColumnRenamed("component", "cell")


def _search(sets: DataFrame, percent: int, tile: int, pivots: int) -> DataFrame:
    """Links that connect all documents of different sets that are connected."""
    cells = written(_cells(sets), "cells")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("docs"))
    where = F.xxhash64("node")
    placed = (
        sets.drop("rarest", "same")
        .join(cells, "node")
        .join(sizes, "cell")
        .withColumn("tiles", F.ceil(F.col("docs") / tile).cast("int"))
        .withColumn("own", F.pmod(where, F.col("tiles")).cast("int"))
    )
    placed = written(placed, "placed")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    pivot = F.pmod(F.xxhash64("node", F.lit(1)), F.col("docs")) < pivots
    first = (
        placed.withColumn("tile", F.explode(F.when(pivot, every).otherwise(F.array("own"))))
        .select("cell", "tile", "node", "size", "keys")
        .groupBy("cell", "tile")
        .applyInArrow(_within(percent), _LINKS)
    )
    first = written(first, "links-within")
    cut = placed.where("tiles > 1")
    if cut.isEmpty():
        return first
    # Cells of several tiles: all but the cell's largest component are compared
    # with every tile; documents of that component are connected already.
    labels = components(first, "a", "b")
    cut = cut.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    cut = written(cut, "labelled")
    largest = (
        cut.groupBy("cell", "component").agg(F.count("*").alias("n"))
        .groupBy("cell").agg(F.max_by("component", F.struct("n", "component")).alias("giant"))
    )
    left = cut.join(largest, "cell").where("component != giant")
    blocks = left.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    columns = ("cell", "tile", "block", "node", "size", "keys", "component")
    tiles = (
        cut.join(blocks, "cell")
        .withColumn("tile", F.col("own"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*(F.col(c).alias(c) for c in columns))
    )
    asked = (
        left.join(blocks, "cell")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
        .withColumn("tile", F.explode(every))
        .select(*(F.col(c).alias(c) for c in columns))
    )
    keys = ("cell", "tile", "block")
    second = tiles.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_across(percent), _LINKS)
    return first.union(written(second, "links-across"))


def near_duplicate_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    tile: int = TILE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds
    the distinct ``shingle``-grams of a whole text, or all its words as one if
    there are fewer. Documents link when 100 * intersection >= ``percent`` * union;
    ``component_id`` is the smallest id that links lead to, the own one included.

    Null, empty and blank texts have an empty set and no link. A row with a null
    id has no link and a null component. Rows that repeat an id are one node.
    Other columns of ``docs`` are not looked at. Sets are compared by 64-bit
    hashes of their elements. ``docs`` should be a table scan, so that a task that
    runs again cuts the same chunks.

    Elements of only one document cannot link anything, so documents whose
    repeated elements fall short of the threshold leave the search at once, and
    equal sets are searched as one. What remains is cut into cells by rare
    elements, and large cells into tiles: no list is ever expanded into pairs.
    """
    buckets = groups(docs)
    sets = written(
        whole_texts(docs).select(F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("binary").alias("text"))
        .mapInArrow(_postings(shingle, buckets), _POSTINGS)
        .groupBy("bucket")
        .applyInArrow(_frequent, _FREQUENT)
        .groupBy("chunk")
        .applyInArrow(_sets(percent), _SETS),
        "sets",
    )
    reach = sets.where(F.col("keys").isNotNull())
    leaders = reach.where(F.col("same").isNotNull()).groupBy("same").agg(F.min("node").alias("leader"))
    led = written(reach.join(leaders, "same", "left"), "led")
    searched = led.where("leader is null or node = leader").drop("leader").dropDuplicates(["node", "keys"])
    links = _search(searched, percent, tile, pivots)
    links = links.union(led.where("node != leader").select("node", "leader"))
    found = written(components(links, "a", "b"), "classes")
    return (
        sets.select("node", F.col("size").alias("n_shingles"))
        .join(found, "node", "left")
        .select(
            F.col("node").alias(id_column), "n_shingles", F.coalesce("component", "node").alias("component_id")
        )
    )
