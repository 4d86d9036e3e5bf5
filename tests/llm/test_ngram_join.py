from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from tilldeck.llm.graph import components
from tilldeck.llm.ngram_join import _Links, divide_skip, near_duplicate_classes


def sets_of(rows, size=5):
    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) >= size:
            grams = {tuple(words[p : p + size]) for p in range(len(words) - size + 1)}
        else:
            grams = {tuple(words)} if words else set()
        out.append((i, grams))
    return out


def classes(sets):
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations([s for s in sets if s[0] is not None], 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: find(i) for i in root}


@pytest.mark.parametrize(("tile", "pivots"), [(1000, 32), (2, 1), (1, 0)])
def test_same_as_brute_force(spark, documents, texts, sentence, tile, pivots):
    """With small tiles the leftover round does most of the work."""
    long = sentence(70, 200).split()
    chain = [(100 + k, " ".join(long[4 * k : 4 * k + 150])) for k in range(9)]
    rows = texts + chain
    more = spark.createDataFrame(chain, "doc_id long, text string")
    docs = documents.select("doc_id", "text").union(more)
    sets = sets_of(rows)
    expected = classes(sets)
    got = near_duplicate_classes(docs, tile=tile, pivots=pivots).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(
        ((i, len(s), expected[i] if i is not None else None) for i, s in sets), key=repr
    )
    assert len({c for i, c in expected.items() if i is not None and i >= 100}) == 1


def test_divide_skip_finds_all_pairs_of_random_sets():
    rng = np.random.default_rng(5)
    base = rng.choice(1 << 40, 60, replace=False)
    sets = []
    for _ in range(60):
        own = set(base.tolist()) if rng.random() < 0.7 else set()
        own -= set(rng.choice(base, int(rng.integers(0, 14))).tolist())
        own |= set(rng.choice(1 << 40, int(rng.integers(1, 12))).tolist())
        sets.append(np.array(sorted(own), dtype=np.uint64))
    links = _Links(len(sets))
    sizes = np.array([len(s) for s in sets])
    divide_skip(sets, sizes, [(i, s, len(s)) for i, s in enumerate(sets)], links, 80)
    expected = classes([(i, set(s.tolist())) for i, s in enumerate(sets)])
    got = dict(links.stars(list(range(len(sets)))))
    assert {i: got.get(i, i) for i in range(len(sets))} == expected


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(7, 7), (None, 4), (300, 250)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 300, *range(200, 260))}}


def test_empty_table(documents):
    assert near_duplicate_classes(documents.where("false")).collect() == []
