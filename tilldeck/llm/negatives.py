"""Hard negatives: near rows of another label, in windows below each positive's score.

Candidate rows lie along a Hilbert curve through their main directions, label by label,
and are stored in that order as blocks of a Parquet table. Each block carries a zone
map, the least and greatest value of every dimension. With it interval arithmetic
bounds the inner product of an anchor with every row of the block, from above and
below, so an anchor reads only blocks whose bounds meet a window it still needs:

1. The anchor's own block gives a score that its last positive reaches at least.
2. Blocks of its label that may reach that score give the positives, exactly.
3. Blocks of other labels whose bounds meet a window give the negatives.

Anchors and zone maps meet in groups of bounded size, as do anchors and the blocks they
need, so no task holds all anchors or all candidates. Scores are exact integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilldeck.llm.graph import written
from tilldeck.llm.words import column

# Components become floor(SCALE * x); a negative scores LOW to HIGH hundredths of the
# positive's score.
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
# Rows of a block, blocks of a super-block, anchors of a group, zone maps of a group.
BLOCK, SUPER, ANCHORS, ZONES = 512, 32, 4096, 2048
# Rows that the directions of the curve are fitted on, its directions and their bits.
SAMPLE, AXES, BITS = 4_000, 7, 9
_LEAST = np.iinfo(np.int64).min
_KEYED = "dims int, label long, key long, id long, anchor boolean, codes binary"
_BLOCKS = (
    "block long, super long, dims int, label long, ids binary, codes binary, low binary, high binary, "
    "anchors int, anchor binary, floors binary"
)
_GROUPS = "g long, dims int, labels binary, ids binary, codes binary, floors binary"
_NEEDED = f"super long, {_GROUPS}, least binary, most binary, blocks array<long>, need binary"
_FOUND = "g long, i int, place int, anchor_id long, id long, score long"
# Groups of anchors, 16 bytes each, that are sent to every executor; more are joined by shuffle.
MOST_BROADCAST = 1_000_000


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid points, one a row, of ``bits`` bits a
    coordinate (Skilling's transform); all bits together must fit into 63."""
    x = points.T.astype(np.uint64)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        flag, below = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(len(x)):
            invert = (x[i] & flag) != 0
            swap = np.where(invert, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(invert, below, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(b)) & one)
    return key.astype(np.int64)


def _narrow(values: np.ndarray) -> bytes:
    """Integers as 16-bit ones where all fit, else as 64-bit ones, a mark in front."""
    small = not values.size or -32768 <= values.min() and values.max() <= 32767
    return (b"\x02" if small else b"\x08") + values.astype("<i2" if small else "<i8").tobytes()


def _wide(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, dtype="<i2" if blob[:1] == b"\x02" else "<i8", offset=1).astype(np.int64).reshape(-1, dims)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: in doubles where these hold every sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector of each box."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _products(plus, low) + _products(minus, high), _products(plus, high) + _products(minus, low)


@dataclass(frozen=True)
class _Curve:
    """Vectors of ``dims`` numbers along ``directions``, counted from ``least`` in
    widths; all numbers are divided by ``scale`` first."""

    dims: int
    scale: float
    directions: np.ndarray
    least: np.ndarray
    width: np.ndarray

    @classmethod
    def fitted(cls, sample: list[list[int]]) -> _Curve:
        """Main directions of the vectors of the sample's most frequent length."""
        lengths = Counter(map(len, sample))
        dims = max(lengths, key=lambda n: (lengths[n], n), default=0)
        points = np.array([v for v in sample if len(v) == dims], dtype=np.float64).reshape(lengths[dims], dims)
        scale = max(1.0, np.abs(points).max(initial=0))
        points = points / scale
        directions = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)[2][:AXES].T if dims else points.T
        along = points @ directions
        width = np.ptp(along, axis=0) if dims else np.ones(0)
        return cls(dims, scale, directions, along.min(axis=0, initial=0), np.where(width > 0, width, 1.0))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        along = (vectors / self.scale @ self.directions - self.least) / self.width * (1 << BITS)
        return hilbert_key(np.clip(along, 0, (1 << BITS) - 1).astype(np.int64), BITS)


def _keyed(curve: _Curve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("codes"))
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            begins = np.cumsum(sizes) - sizes
            key = np.zeros(len(sizes), dtype=np.int64)
            known = np.flatnonzero(sizes == curve.dims)
            if len(known):
                key[known] = curve.keys(flat[begins[known][:, None] + np.arange(curve.dims)])
            codes = [_narrow(flat[b : b + s]) for b, s in zip(begins, sizes, strict=True)]
            kept = {name: batch.column(batch.schema.get_field_index(name)) for name in ("label", "id", "anchor")}
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), kept["label"], pa.array(key), kept["id"], kept["anchor"], pa.array(codes, pa.binary())],
                names=["dims", "label", "key", "id", "anchor", "codes"],
            )

    return run


def _blocks(block: int, positives: int):
    """Blocks of consecutive rows of one label, from rows in the order of the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        last = None
        for batch in batches:
            for row in zip(*(column(batch, n) for n in ("dims", "label", "id", "anchor", "codes")), strict=True):
                if last and (*row[:3], row[4]) == (*last[:3], last[4]):
                    continue  # a repeated row is one row
                if waiting and (len(waiting) == block or row[:2] != last[:2]):
                    yield _block(waiting, number, positives)
                    number, waiting = number + 1, []
                waiting.append(row)
                last = row
        if waiting:
            yield _block(waiting, number, positives)

    return run


def _block(rows: list[tuple], number: int, positives: int) -> pa.RecordBatch:
    dims, label = rows[0][:2]
    ids = np.array([r[2] for r in rows], dtype=np.int64)
    codes = np.concatenate([_wide(r[4], dims) for r in rows])
    at = np.flatnonzero([r[3] for r in rows])
    floors = np.full(len(at), _LEAST)
    if len(at):
        scores = np.where(ids[None, :] == ids[at][:, None], _LEAST, _products(codes[at], codes))
        if len(rows) > positives:
            floors = np.partition(scores, len(rows) - positives, axis=1)[:, len(rows) - positives]
    # Super-blocks never reach beyond their task's blocks.
    values = [number, number >> 32 << 32 | (number & 0xFFFFFFFF) // SUPER, dims, label]
    values += [ids.tobytes(), _narrow(codes), _narrow(codes.min(axis=0)), _narrow(codes.max(axis=0))]
    values += [len(at), at.astype("<i4").tobytes(), floors.tobytes()]
    return _row(values, _BLOCKS)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _row(values: list, schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array([v], type=_KINDS[kind]) for v, (_, kind) in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _table(batches: list[pa.RecordBatch], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_batches(batches, schema=pa.schema([(name, _KINDS[kind]) for name, kind in fields]))


def _grouped(size: int):
    """Anchors of consecutive blocks in groups of one number of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        count = 0
        for batch in batches:
            for row in batch.to_pylist():
                at = np.frombuffer(row["anchor"], dtype="<i4")
                if waiting and (count + len(at) > size or row["dims"] != waiting[0][0]):
                    yield _group(waiting, number)
                    number, waiting, count = number + 1, [], 0
                ids = np.frombuffer(row["ids"], dtype=np.int64)[at]
                codes = _wide(row["codes"], row["dims"])[at]
                floors = np.frombuffer(row["floors"], dtype=np.int64)
                waiting.append((row["dims"], np.full(len(at), row["label"], dtype=np.int64), ids, codes, floors))
                count += len(at)
        if waiting:
            yield _group(waiting, number)

    return run


def _group(parts: list[tuple], number: int) -> pa.RecordBatch:
    labels, ids, codes, floors = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4))
    return _row([number, parts[0][0], labels.tobytes(), ids.tobytes(), _narrow(codes), floors.tobytes()], _GROUPS)


def _longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def _selected(other: bool):
    """Which blocks each anchor of a group must read, by super-block: those of its own
    label that may reach its floor or, if ``other``, those of other labels whose bounds
    meet one of its windows."""

    def run(key: tuple, anchors: pa.Table, zones: pa.Table) -> pa.Table:
        if not anchors.num_rows or not zones.num_rows:
            return _table([], _NEEDED)
        group, rows = anchors.to_pylist()[0], zones.to_pylist()
        rows = [r for r in rows if r["dims"] == group["dims"]]
        if not rows:
            return _table([], _NEEDED)
        rows.sort(key=lambda r: (r["super"], r["block"]))
        low, high = (np.concatenate([_wide(r[k], r["dims"]) for r in rows]) for k in ("low", "high"))
        least, most = bounds(_wide(group["codes"], group["dims"]), low, high)
        same = _longs(group["labels"])[:, None] == np.array([r["label"] for r in rows])[None, :]
        if other:
            need = np.zeros(same.shape, dtype=bool)
            tops, ends = (_longs(group[k]).reshape(len(same), -1) for k in ("least", "most"))
            for p in range(tops.shape[1]):
                need |= (most >= tops[:, p, None]) & (least <= ends[:, p, None])
            need &= ~same
        else:
            need = same & (most >= _longs(group["floors"])[:, None])
        supers = np.array([r["super"] for r in rows])
        blocks = np.array([r["block"] for r in rows])
        out = []
        for s in np.unique(supers):
            part = np.flatnonzero((supers == s) & need.any(axis=0))
            if len(part):
                asked = np.packbits(need[:, part].T, axis=1)
                values = [group[n] for n in ("g", "dims", "labels", "ids", "codes", "floors", "least", "most")]
                out.append(_row([int(s), *values, blocks[part].tolist(), asked.tobytes()], _NEEDED))
        return _table(out, _NEEDED)

    return run


class _Best:
    """The best few rows of each slot, by score, then smaller id."""

    def __init__(self, slots: int, size: int) -> None:
        self.size, self.floor = size, np.full(slots, _LEAST)
        self.slot, self.score, self.id = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = rank == self.size - 1
        self.floor[slot[last]] = score[last]
        kept = rank < self.size
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]


def _read(other: bool, size: int):
    """The best rows of a group's anchors in the blocks they need of a super-block."""

    def run(key: tuple, blocks: pa.Table, needed: pa.Table) -> pa.Table:
        if not blocks.num_rows or not needed.num_rows:
            return _table([], _FOUND)
        by_number = {r["block"]: r for r in blocks.to_pylist()}
        group = needed.to_pylist()[0]
        ids, codes = _longs(group["ids"]), _wide(group["codes"], group["dims"])
        count = len(ids)
        places = len(_longs(group["least"])) // count if other else 1
        best = _Best(count * places, size)
        if other:
            tops, ends = (_longs(group[k]).reshape(count, places) for k in ("least", "most"))
        else:
            tops = _longs(group["floors"]).reshape(count, 1)
        asked = np.frombuffer(group["need"], dtype=np.uint8).reshape(-1, -(-count // 8))
        for number, bits in zip(group["blocks"], asked, strict=True):
            row = by_number[number]
            who = np.flatnonzero(np.unpackbits(bits, count=count))
            there = _longs(row["ids"])
            scores = _products(codes[who], _wide(row["codes"], row["dims"]))
            for p in range(places):
                slots = who * places + p
                fits = scores >= np.maximum(tops[who, p], best.floor[slots])[:, None]
                fits &= scores <= ends[who, p][:, None] if other else there[None, :] != ids[who][:, None]
                i, j = np.nonzero(fits)
                if len(i):
                    best.add(slots[i], scores[i, j], there[j])
        slot = best.slot
        i = slot // places
        arrays = [np.full(len(slot), group["g"]), i, slot % places, ids[i], best.id, best.score]
        fields = [f.split() for f in _FOUND.split(", ")]
        return pa.table({n: pa.array(v, type=_KINDS[k]) for v, (n, k) in zip(arrays, fields, strict=True)})

    return run


def _windows(low: int, high: int, positives: int):
    """A group's anchors with the windows that their positives open; an empty one where
    there is no positive."""

    def run(key: tuple, anchors: pa.Table, found: pa.Table) -> pa.Table:
        schema = f"{_GROUPS}, least binary, most binary"
        if not anchors.num_rows:
            return _table([], schema)
        group = anchors.to_pylist()[0]
        count = len(_longs(group["ids"]))
        tops = np.full((count, positives), np.iinfo(np.int64).max)
        ends = np.full((count, positives), _LEAST)
        if found.num_rows:
            i, place = (np.array(column(found, n)) for n in ("i", "place"))
            # Python integers: no product of a score may overflow.
            scores = column(found, "score")
            tops[i, place] = [-(-low * s // 100) for s in scores]
            ends[i, place] = [high * s // 100 for s in scores]
        return _table([_row([*group.values(), tops.tobytes(), ends.tobytes()], schema)], schema)

    return run


def _first(found: DataFrame, size: int) -> DataFrame:
    """``found`` with a ``rank`` from 1 inside anchor and place, no more than ``size``."""
    own = Window.partitionBy("g", "i", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= size)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, a score is the inner product of these
    integers, higher ones come first and equal ones by smaller id. Anchors are the rows
    that ``anchor`` holds for. Its first ``positives`` rows of the same label and
    another id are an anchor's positives; for each of them the first ``negatives`` rows
    of another label that score from ``low`` to ``high`` hundredths of the positive's
    score are returned, ranked from 1. All are returned where there are fewer, none for
    a negative positive score.

    Rows with a null id, label or vector, an empty one, or a null or non-finite
    component take no part, nor do those so large that scores would leave 64 bits.
    Equal rows are one row; rows that share an id but differ are rows of their own, and
    no positive of each other. Vectors of different length are not compared. A null
    ``anchor`` is false. Other columns are not looked at. Labels are whole numbers.

    Blocks are pruned only where the data lies in clusters; results are exact either
    way. The curve's directions come from about ``SAMPLE`` rows, every row is indexed.
    """
    v = f"`{vector_column}`"
    valid = F.expr(
        f"{v} is not null and size({v}) > 0 and forall({v}, x -> x is not null and abs(x) < double('infinity'))"
        f" and size({v}) * pow(array_max(transform({v}, x -> abs(double(x)))) * {scale} + 1, 2) < 9e18"
    )
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.when(F.coalesce(valid, F.lit(False)), F.col(vector_column)).alias("vector"),
    ).where("id is not null and label is not null and vector is not null")
    rows = rows.select("id", "label", "anchor", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)).alias("codes"))
    share = min(1.0, SAMPLE / max(1, rows.count()))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000).select("codes").collect()
    curve = _Curve.fitted(sorted(r["codes"] for r in sample))
    ordered = rows.mapInArrow(_keyed(curve), _KEYED).repartitionByRange("dims", "label", "key", "id")
    ordered = ordered.sortWithinPartitions("dims", "label", "key", "id", "codes", F.desc("anchor"))
    stored = written(ordered.mapInArrow(_blocks(block, positives), _BLOCKS), "hilbert-blocks")
    sizes = stored.agg(F.count("*").alias("blocks"), F.sum("anchors").alias("anchors")).first()
    groups = stored.where("anchors > 0").repartitionByRange(max(1, math.ceil((sizes["anchors"] or 0) / ANCHORS)), "block")
    groups = written(groups.sortWithinPartitions("block").mapInArrow(_grouped(ANCHORS), _GROUPS), "anchors")
    few = groups.count() <= MOST_BROADCAST
    zone_groups = max(1, math.ceil(sizes["blocks"] / ZONES))

    def found(asking: DataFrame, other: bool, size: int) -> DataFrame:
        zones = stored.select(
            F.pmod(F.xxhash64("super"), F.lit(zone_groups)).cast("int").alias("z"), "block", "super", "dims", "label", "low", "high"
        )
        # Every group of anchors meets every group of zone maps of its dimensions.
        names = asking.select(F.col("g").alias("with"), F.col("dims").alias("of"))
        zones = zones.join(F.broadcast(names) if few else names, F.expr("dims = of")).drop("of")
        asking = asking.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(zone_groups - 1))))
        needed = asking.groupBy("z", "g").cogroup(zones.groupBy("z", "with")).applyInArrow(_selected(other), _NEEDED)
        needed = written(needed, "needed-blocks")
        asked = needed.select(F.col("super").alias("part"), F.col("g").alias("by"), F.explode("blocks").alias("asked"))
        read = stored.select("block", "dims", "ids", "codes").join(asked, F.col("block") == F.col("asked"))
        out = read.groupBy("part", "by").cogroup(needed.groupBy("super", "g")).applyInArrow(_read(other, size), _FOUND)
        return _first(out, size)

    none = F.lit(b"")
    own = written(found(groups.withColumn("least", none).withColumn("most", none), False, positives).withColumn("place", F.col("rank") - 1), "positives")
    schema = f"{_GROUPS}, least binary, most binary"
    asking = groups.groupBy("g").cogroup(own.withColumnRenamed("g", "of").groupBy("of")).applyInArrow(_windows(low, high, positives), schema)
    asking = written(asking, "windows")
    chosen = own.select("g", "i", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found(asking, True, negatives)
        .join(chosen, ["g", "i", "place"])
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
