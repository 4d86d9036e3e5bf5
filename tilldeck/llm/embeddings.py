"""Near-duplicate embeddings by cosine, exact, on int8 tile products.

Vectors are normalised and quantised to int8. The rounding error of each vector is
measured, so the product of two quantised vectors bounds their cosine from both
sides. Only pairs whose bounds enclose the threshold are computed in double
precision. The products are sums of integers below 2^24, which float32 matrix
products give exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.graph import components, written
from tilldeck.llm.words import column, table_of

THRESHOLD = 0.9
BLOCK = 4096
# Rows of a tile multiplied at once.
STRIPE = 512
# Components of pairs held as doubles at once.
_WIDENED = 2_000_000
# Far above what double precision loses in norms, products and bounds.
_SLACK = 1e-9
_BLOCKS = "dims int, block int, ids binary, copies binary, vectors binary, codes binary, scales binary, errors binary"
_FOUND = "node long, links long, other long"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales and the length of what rounding
    took away."""
    scales = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scales[:, None]).astype(np.int8)
    errors = np.linalg.norm(vectors - codes * scales[:, None], axis=1)
    return codes, scales, errors + _SLACK


def _unit(vectors: np.ndarray) -> np.ndarray:
    # By the largest component first: squares of tiny or huge ones are no numbers.
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _pack(table: pa.Table) -> pa.Table:
    dims, block = table.column("dims")[0].as_py(), table.column("block")[0].as_py()
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(-1, dims)
    codes, scales, errors = quantised(_unit(vectors.astype(np.float64)))
    arrays = (column(table, "node"), column(table, "copies"))
    ids, copies = (np.array(a, dtype=np.int64).tobytes() for a in arrays)
    row = (dims, block, ids, copies, vectors.astype("<f8").tobytes(), codes.tobytes(), scales.tobytes(), errors.tobytes())
    return table_of([row], _BLOCKS)


class _Block:
    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.copies = np.frombuffer(row["copies"], dtype=np.int64)
        self.unit = _unit(np.frombuffer(row["vectors"], dtype="<f8").reshape(-1, row["dims"]))
        self.codes = np.frombuffer(row["codes"], dtype=np.int8).reshape(-1, row["dims"]).astype(np.float32)
        self.scales = np.frombuffer(row["scales"], dtype=np.float64)
        self.errors = np.frombuffer(row["errors"], dtype=np.float64)
        self.links = np.zeros(len(self.ids), dtype=np.int64)


def _linked(a: _Block, b: _Block, low: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of a stripe of ``a`` with ``b``, as places in each."""
    high = min(low + STRIPE, len(a.ids))
    rows = slice(low, high)
    whole = a.codes[rows] @ b.codes.T
    worst = a.errors[rows].max() + b.errors.max()
    worst += a.errors[rows].max() * b.errors.max() * 3
    # A float32 product by a scale may be off by a few units in the last place.
    whole *= a.scales[rows].astype(np.float32)[:, None]
    i, j = np.nonzero(whole >= ((threshold - worst - 1e-5) / b.scales).astype(np.float32)[None, :])
    i += low
    if a is b:
        i, j = i[i < j], j[i < j]
    about = np.empty(len(i))
    # In slices: a dense stripe may hold millions of pairs.
    most = max(1, _WIDENED // a.codes.shape[1])
    for low in range(0, len(i), most):
        at = slice(low, low + most)
        about[at] = np.einsum("ij,ij->i", a.codes[i[at]], b.codes[j[at]], dtype=np.float64)
    about *= a.scales[i] * b.scales[j]
    # u.w = (u' + du).(w' + dw), and a rounded vector is no longer than 1 + error.
    eu, ew = a.errors[i], b.errors[j]
    bound = (1 + eu) * ew + (1 + ew) * eu + eu * ew
    near = about + bound >= threshold
    i, j, about, bound = i[near], j[near], about[near], bound[near]
    sure = about - bound >= threshold
    doubt = np.flatnonzero(~sure)
    for low in range(0, len(doubt), most):
        at = doubt[low : low + most]
        sure[at] = np.einsum("ij,ij->i", a.unit[i[at]], b.unit[j[at]]) >= threshold
    return i[sure], j[sure]


def _tile(threshold: float):
    """Number of links of each vector inside a tile, and links enough to connect
    what is connected there: each vector with the smallest id it links to."""

    def run(table: pa.Table) -> pa.Table:
        blocks = [_Block(row) for row in sorted(table.to_pylist(), key=lambda r: r["block"])]
        a, b = blocks[0], blocks[-1]
        pairs: set[tuple[int, int]] = set()
        for low in range(0, len(a.ids), STRIPE):
            i, j = _linked(a, b, low, threshold)
            if not len(i):
                continue
            np.add.at(a.links, i, b.copies[j])
            np.add.at(b.links, j, a.copies[i])
            pairs |= _forest(a.ids[i], b.ids[j])
        rows = [(int(n), int(k), None) for x in {id(x): x for x in blocks}.values() for n, k in zip(x.ids, x.links, strict=True) if k]
        return table_of(rows + [(u, 0, v) for u, v in pairs], _FOUND)

    return run


def _forest(u: np.ndarray, v: np.ndarray) -> set[tuple[int, int]]:
    """Few pairs that connect what the given ones connect."""
    names, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(names))
    while True:
        low = root.copy()
        np.minimum.at(low, u, root[v])
        np.minimum.at(low, v, root[u])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return {(int(names[i]), int(names[r])) for i, r in enumerate(root) if i != r}


def near_duplicate_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors link when their cosine in double precision is ``threshold`` or more.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest id reachable by links, ``kept`` says that it is the own one.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing, nor do vectors of different length. A row with a null id
    has no link, a null component and is not kept. Rows that repeat an id and its
    vector are one vector. Other columns are not looked at.

    Equal vectors are compared as one and counted as many, so a group of copies
    costs one comparison. Blocks meet pairwise, as the method asks: work grows
    with the square of the number of different vectors.
    """
    valid = F.expr(
        f"{vector_column} is not null and size({vector_column}) > 0 and {id_column} is not null"
        f" and forall({vector_column}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        f" and exists({vector_column}, x -> x <> 0)"
    )
    rows = vectors.select(
        F.col(id_column).cast("long").alias("node"),
        F.when(F.coalesce(valid, F.lit(False)), F.col(vector_column)).alias("embedding"),
    )
    groups = written(
        rows.where("embedding is not null")
        .groupBy("embedding")
        .agg(F.min("node").alias("leader"), F.count_distinct("node").alias("copies")),
        "vectors",
    )
    blocks = max(1, math.ceil(groups.count() / block))
    packed = (
        groups.select(F.col("leader").alias("node"), "copies", "embedding")
        .withColumn("dims", F.size("embedding"))
        .withColumn("block", F.pmod(F.xxhash64("embedding"), F.lit(blocks)).cast("int"))
        .groupBy("dims", "block")
        .applyInArrow(_pack, _BLOCKS)
    )
    packed = written(packed, "blocks")
    tiles = packed.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    present = packed.select("dims", F.col("block").alias("with"))
    found = (
        tiles.join(present, ["dims", "with"])
        .withColumn("low", F.least("block", "with"))
        .withColumn("high", F.greatest("block", "with"))
        .drop("with")
        .groupBy("dims", "low", "high")
        .applyInArrow(_tile(threshold), _FOUND)
    )
    found = written(found, "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("other is not null"), "node", "other")
    classes = classes.withColumnRenamed("component", "component_id")
    # Vectors join as text of their values; copies of one vector form one group.
    members = rows.join(groups, "embedding", "left").select(
        "node", "leader", F.coalesce(F.col("copies") - 1, F.lit(0)).alias("own")
    )
    whole = (
        members.join(counts.withColumnRenamed("node", "leader"), "leader", "left")
        .join(classes.withColumnRenamed("node", "leader"), "leader", "left")
        .withColumn("n_links", F.col("own") + F.coalesce("links", F.lit(0)))
        .withColumn("component_id", F.coalesce("component_id", "leader", "node"))
    )
    return whole.select(
        F.col("node").alias(id_column),
        "n_links",
        "component_id",
        F.coalesce(F.col("node") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
