from __future__ import annotations

import re

import numpy as np
import pytest

import tilldeck.llm.decontaminate as module
from tilldeck.llm.decontaminate import benchmark_matches

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(rows, items, window=10):
    phrases = {}
    for item, text in items:
        own = words(text)
        size = min(len(own), window)
        for p in range(len(own) - size + 1) if size and item is not None else ():
            phrases.setdefault(tuple(own[p : p + size]), set()).add(str(item))
    out = []
    for i, text in rows:
        own, hit, found = words(text), set(), set()
        for size in {len(k) for k in phrases}:
            for p in range(len(own) - size + 1):
                names = phrases.get(tuple(own[p : p + size]))
                if names:
                    found |= names
                    hit |= set(range(p, p + size))
        out.append((i, len(own), len(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def items(spark, sentence):
    rows = [
        (5, sentence(1, 35).upper()),
        (40, f"{sentence(3, 30)[:60]}"),
        (12, "Three, short! words."),
        (7, "naïve"),
        (8, ""),
        (9, None),
        (None, sentence(2, 20)),
        (13, "three short words"),
        (14, sentence(99, 25)),
        (14, sentence(2, 12)),
    ]
    return spark.createDataFrame([(i, t, 1, 1) for i, t in rows], "item_id long, text string, n_hit long, block int")


@pytest.mark.parametrize("per_block", [20_000, 2])
def test_same_as_brute_force(documents, texts, items, monkeypatch, per_block):
    monkeypatch.setattr(module, "ITEMS_PER_BLOCK", per_block)
    rows = [(r.item_id, r.text) for r in items.collect()]
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in benchmark_matches(documents, items).collect()]
    assert sorted(got, key=repr) == sorted(brute_force(texts, rows), key=repr)


def test_spans_name_the_item(spark, items, sentence):
    df = spark.createDataFrame([(1, f"a b {sentence(1, 10)} c")], "doc_id long, text string")
    row = benchmark_matches(df, items).first()
    assert [(s.item, s.start, s.stop) for s in row.spans] == [("5", 2, 12)] and row["items"] == ["5"]


def test_proximity(spark):
    df = spark.createDataFrame([(1, "alpha beta x gamma"), (2, "alpha x y beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    assert not benchmark_matches(df, items).where("n_hit > 0").collect()
    assert [r.doc_id for r in benchmark_matches(df, items, slack=1).where("n_hit > 0").collect()] == [1]


def test_lists_of_a_phrase_that_crosses_documents_do_not_match():
    words_ = module._words([b"a b", b"c d"])
    order = np.argsort(words_.hashes(), kind="stable")
    assert len(order) == 4 and words_.first.tolist() == [0, 2, 4]


@pytest.mark.parametrize("empty", ["documents", "items", "both"])
def test_empty_tables(documents, items, empty):
    docs = documents.where("false") if empty != "items" else documents
    asked = items.where("false") if empty != "documents" else items
    rows = benchmark_matches(docs, asked).collect()
    assert len(rows) == docs.count() and not any(r.n_hit for r in rows)
