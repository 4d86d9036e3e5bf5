from __future__ import annotations

import pytest

from tilldeck.llm.substring import remove_repeats


def brute_force(rows, window):
    """Kept words by row; rows in id order, null ids apart."""
    seen: dict[tuple, tuple] = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for p in range(len(words) - window + 1):
                key = tuple(words[p : p + window])
                seen[key] = min(seen.get(key, (i, p)), (i, p))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1) if i is not None else ():
            if seen[tuple(words[p : p + window])] < (i, p):
                gone[p : p + window] = [True] * window
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("window", [20, 6])
def test_same_as_brute_force(documents, texts, window):
    out = remove_repeats(documents, window=window)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(brute_force(texts, window), key=repr)


def test_spans_are_maximal_and_carried_columns_come_along(documents):
    out = remove_repeats(documents, carry=("lang",))
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[4].lang == "en"
    assert [(s.start, s.stop) for s in rows[4].spans] == [(0, 120)]
    assert [(s.start, s.stop) for s in rows[17].spans] == [(1, 400)]
    assert rows[8].spans == [] and rows[9].kept_text == ""


def test_same_id_with_other_text_is_judged_by_its_own_places(spark, sentence):
    a, b = sentence(50, 40), sentence(51, 40)
    df = spark.createDataFrame([(1, a), (2, a), (2, f"new words here {b}"), (3, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(df).collect())
    assert got == [(1, 0), (2, 0), (2, 40), (3, 40)]


def test_empty_table(documents):
    assert remove_repeats(documents.where("false")).collect() == []
