from __future__ import annotations

import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilldeck.llm.periodic import _runs, lag_classes, periodic_runs
from tilldeck.llm.queries import op13_periodic_runs, planted_runs
from tilldeck.llm.words import Words


def brute_force(w, least=6, exponent=4):
    """(start, length, period) of all runs, every lag tried at every place."""
    found = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            stretch = w[i : j + q]
            if j > i and len(stretch) >= max(least, exponent * q):
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


@st.composite
def texts_with_runs(draw):
    out = []
    for _ in range(draw(st.integers(1, 3))):
        unit = draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=9))
        out += unit * draw(st.integers(1, 7)) + draw(st.lists(st.sampled_from("abcd"), max_size=6))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(texts_with_runs(), min_size=1, max_size=3), st.sampled_from([(6, 4), (6, 3), (1, 3), (20, 5)]))
def test_runs_of_a_chunk_are_those_of_brute_force(docs, limits):
    document, start, length, period = _runs(Words.of([" ".join(d).encode() for d in docs]), *limits)
    got = list(zip(document.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert got == [(i, *run) for i, d in enumerate(docs) for run in brute_force(d, *limits)]


@pytest.mark.parametrize("limits", [(6, 4), (1, 3), (100, 3), (9, 7)])
def test_classes_of_lags_meet_and_their_grams_hold_two_periods(limits):
    least, exponent = limits
    expected = 1
    for first, last, k in lag_classes(5000, least, exponent):
        assert first == expected and last >= first
        assert all(2 * q - 2 <= k <= max(least - q, (exponent - 1) * q) for q in range(first, last + 1))
        expected = last + 1
    assert expected > 5000


def test_documents_with_nulls_copies_and_clashing_columns(documents, texts):
    got = periodic_runs(documents.withColumnRenamed("n_words", "runs")).collect()
    by_id = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in by_id] == [i for i, _ in texts]
    for row in got:
        own = [words_of(t) for i, t in texts if i == row.doc_id]
        ours = [(r.start, r.length, r.period) for r in row.runs]
        assert any(ours == brute_force(w) and row.collapsed_text == collapsed(w, ours) for w in own)
    one = next(r for r in got if r.doc_id == 17)
    assert [tuple(r) for r in one.runs] == [(0, 400, 1)] and one.collapsed_text == "same"
    assert next(r for r in got if r.doc_id == 9).n_words == 0


def test_very_long_period_and_very_long_run(spark, sentence):
    long = sentence(1, 3000)
    df = spark.createDataFrame([(1, f"x {long} {long} {long} {long} y"), (2, "a b " * 200_000), (3, f"{long} {long}")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], len(r.collapsed_text.split())) for r in periodic_runs(df).collect()}
    assert got == {1: ([(1, 12_000, 3000)], 3002), 2: ([(0, 400_000, 2)], 2), 3: ([], 6000)}


def test_carried_columns_may_not_be_named_like_results(documents):
    with pytest.raises(ValueError, match="n_words"):
        periodic_runs(documents, carry=("doc_id", "n_words"))
    with pytest.raises(ValueError, match="exponent"):
        periodic_runs(documents, exponent=2)


def test_empty_table(documents):
    assert periodic_runs(documents.where("false")).collect() == []


def test_planted_words(documents, texts):
    got = sorted(((r.doc_id, r.text) for r in planted_runs(documents).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for i, text in texts:
        h = None if i is None else zlib.crc32(str(i).encode())
        w = words_of(text)
        if h is not None and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            text = " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))
        expected.append((i, text))
    assert got == sorted(expected, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_query_over_null_and_empty_texts(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(1, None), (2, ""), (None, "a a a a a a")], "doc_id long, text string").write.parquet(path)
    rows = {r.doc_id: r for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert rows[1].n_runs == 0 and rows[1].start is None and rows[1].runs_sha256 == rows[2].collapsed_sha256
    assert (rows[None].start, rows[None].length, rows[None].period, rows[None].exponent_milli) == (0, 6, 1, 6000)
