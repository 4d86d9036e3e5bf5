from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from tilldeck.llm import embeddings as module
from tilldeck.llm.embeddings import _Block, _forest, _linked, _unit, near_duplicate_vectors, quantised


def brute_force(rows, threshold=0.9):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, dtype=np.float64))
    ids = sorted({i for i, _ in rows if i is not None})
    links = {i: set() for i in ids}
    for i in good:
        for j in good:
            if i != j:
                for a in good[i]:
                    for b in good[j]:
                        a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                        if len(a) == len(b) and a1 @ b1 / np.linalg.norm(a1) / np.linalg.norm(b1) >= threshold:
                            links[i].add(j)
    root = {i: i for i in ids}
    for _ in ids:
        for i in ids:
            root[i] = min([root[i], *(root[j] for j in links[i])])
    return {i: (len(links[i]), root[i], root[i] == i) for i in ids}


@pytest.mark.parametrize("block", [4096, 7])
def test_same_as_brute_force(spark, block):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(12, 16))
    rows = [(100 - i, (base[i % 12] + rng.normal(size=16) * 0.12 * (i % 5)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(200 + i, base[0].tolist()) for i in range(5)] + [(206, (base[0] * 1e-20).tolist()), (207, (-base[0]).tolist())]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] * 16), (304, [float("nan")] * 16), (305, [float("inf")] * 16)]
    rows += [(306, [1.0, 2.0]), (307, [2.0, 4.0]), (200, base[0].tolist()), (None, base[0].tolist())]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = brute_force(single)
    got = near_duplicate_vectors(df, block=block).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id, r.kept) == expected[r.vec_id], r.vec_id


def test_quantisation_error_is_a_bound():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(200, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    codes, scales, errors = quantised(vectors)
    about = (codes.astype(np.int64) @ codes.astype(np.int64).T) * scales[:, None] * scales[None, :]
    bound = (1 + errors[:, None]) * errors[None, :] + (1 + errors[None, :]) * errors[:, None] + errors[:, None] * errors[None, :]
    assert (np.abs(about - vectors @ vectors.T) <= bound).all() and errors.max() < 0.05


def test_forest_connects_what_pairs_connect():
    got = _forest(np.array([5, 3, 9, 20]), np.array([3, 8, 8, 21]))
    assert got == {(5, 3), (8, 3), (9, 3), (21, 20)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(df).collect() == []


def test_a_dense_tile_is_held_in_slices(monkeypatch):
    dice = np.random.default_rng(4)
    unit = _unit(dice.normal(size=64) + dice.normal(size=(600, 64)) * 0.03)
    codes, scales, errors = quantised(unit)
    row = {
        "dims": 64, "ids": np.arange(600).tobytes(), "copies": np.ones(600, dtype=np.int64).tobytes(), "vectors": unit.tobytes(),
        "codes": codes.tobytes(), "scales": scales.tobytes(), "errors": errors.tobytes(),
    }
    monkeypatch.setattr(module, "_WIDENED", 64 * 1000)
    a, b = _Block(row), _Block(row)
    tracemalloc.start()
    i, j = _linked(a, b, 0, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    exact = np.argwhere(a.unit[:512] @ b.unit.T >= 0.9)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, exact.tolist()))
    assert len(i) > 250_000 and peak < 150 * len(i)
