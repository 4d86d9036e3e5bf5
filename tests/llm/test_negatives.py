from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilldeck.llm import negatives as module
from tilldeck.llm.negatives import _BLOCKS, _block, _Curve, _products, _selected, bounds, hard_negatives, hilbert_key

SCHEMA = "vec_id long, embedding array<double>, label int, score long, g long, rank string, key string"


def brute_force(rows, anchors, positives=5, negatives=5, scale=256):
    usable = {
        (i, tuple(math.floor(scale * x) for x in v), label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, v, label in usable:
        if i not in anchors:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, k) for j, w, k in usable if len(w) == len(v)]
        same = sorted((s, j) for s, j, k in scored if k == label and j != i)[:positives]
        for top, j in same:
            fits = sorted((s, n) for s, n, k in scored if k != label and 80 * -top <= 100 * -s <= 100 * -top)
            out += [(i, j, rank, n, -top, -s) for rank, (s, n) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchors, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id").isin(list(anchors)), **options).collect())


def clustered(seed, count, dims=8, clusters=6):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(clusters, dims))
    which = dice.integers(0, clusters, size=count)
    vectors = centres[which] + dice.normal(size=(count, dims)) * 0.2
    return [(i, vectors[i].tolist(), int(dice.integers(0, 3))) for i in range(count)]


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_the_grid(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    keys = hilbert_key(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_enclose_every_product():
    dice = np.random.default_rng(5)
    points = dice.integers(-300, 300, size=(64, 12))
    low, high = points.reshape(8, 8, 12).min(axis=1), points.reshape(8, 8, 12).max(axis=1)
    anchors = dice.integers(-300, 300, size=(20, 12))
    least, most = bounds(anchors, low, high)
    products = (anchors @ points.T).reshape(20, 8, 8)
    assert (least <= products.min(axis=2)).all() and (most >= products.max(axis=2)).all()
    big = np.full((2, 4), 1 << 28)
    assert _products(big, big).tolist() == [[1 << 58] * 2] * 2


def test_only_blocks_that_can_hold_a_result_are_asked_for():
    near = [(2, 0, i, i == 0, b"\x02" + np.array([100 + i, i], "<i2").tobytes()) for i in range(10)]
    far = [(2, 0, 50 + i, False, b"\x02" + np.array([-100 - i, i], "<i2").tobytes()) for i in range(10)]
    blocks = pa.Table.from_batches([_block(near, 0, 5), _block(far, 1, 5)])
    assert blocks.schema.names == [f.split()[0] for f in _BLOCKS.split(", ")]
    group = pa.table({**module._group([(2, np.array([0]), np.array([0]), np.array([[100, 0]]), np.frombuffer(blocks["floors"][0].as_py(), dtype=np.int64))], 0).to_pydict(), "least": [b""], "most": [b""]})
    needed = _selected(False)((0,), group, blocks).to_pylist()
    assert [r["blocks"] for r in needed] == [[0]]


@pytest.mark.parametrize("seed, block", [(1, 16), (2, 512), (3, 3)])
def test_same_as_brute_force(spark, seed, block):
    rows, anchors = clustered(seed, 160), set(range(0, 160, 7))
    assert mined(spark, rows, anchors, block=block) == brute_force(rows, anchors)


def test_groups_of_bounded_size_change_nothing(spark, monkeypatch):
    for name, value in (("ANCHORS", 4), ("ZONES", 3), ("SUPER", 2), ("MOST_BROADCAST", 0)):
        monkeypatch.setattr(module, name, value)
    rows, anchors = clustered(4, 120), set(range(0, 120, 5))
    assert mined(spark, rows, anchors, block=8, positives=2, negatives=3) == brute_force(rows, anchors, 2, 3)


def test_nulls_odd_vectors_ties_copies_and_repeated_rows(spark):
    rows = clustered(6, 60)
    rows += [(1000 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(40)]  # ties
    rows += [(2000 + i, rows[i % 3][1], (rows[i % 3][2] + 1) % 3) for i in range(20)]
    rows += rows[:10] + [(3, rows[9][1], 1), (7, rows[8][1], 2)]  # repeated rows, shared ids
    rows += [(None, rows[0][1], 0), (70, None, 0), (77, rows[0][1], None), (84, [], 0), (91, [0.0] * 8, 1)]
    rows += [(98, [1.0, None] + [0.0] * 6, 1), (105, [math.nan] * 8, 0), (112, [math.inf] * 8, 0)]
    rows += [(119, [1.0, 2.0], 0), (120, [1.0, 1.9], 0), (121, [1.0, 1.5], 1), (122, [300.0] * 8, 1), (126, [-3e5] * 8, 2)]
    anchors = {*range(0, 130, 7), 1000, 2003}
    got = mined(spark, rows, anchors, block=7)
    assert got == brute_force(rows, anchors) and {r[0] for r in got} >= {0, 119, 1000}


def test_vectors_beyond_64_bits_take_no_part(spark):
    rows = clustered(7, 40)
    assert mined(spark, [*rows, (40, [1e9] * 8, 0), (42, [-1e30] * 8, 1)], {0, 7, 42}) == brute_force(rows, {0, 7})


def test_empty_table_and_no_anchors(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(df, F.col("vec_id") == 0).collect() == []
    assert mined(spark, clustered(8, 20), {-1}) == []
    assert mined(spark, [(0, [1.0], 0)], {0}) == []


def test_curve_of_nothing_and_of_equal_vectors():
    assert _Curve.fitted([]).dims == 0
    assert _Curve.fitted([[1, 2, 3]] * 5).keys(np.array([[1, 2, 3], [9, 9, 9]])).shape == (2,)
