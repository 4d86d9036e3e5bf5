from __future__ import annotations

import zlib

import numpy as np
import pytest

from tilldeck.llm.language import UNKNOWN, Model, _expected, fit, language, marginals, words_of
from tilldeck.llm.queries import op12_language_id

FOLDER = "/root/testdata/sf0.001"


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def one_chain(scores, transitions, first):
    """Forward-backward in logarithms, position by position."""
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = first + scores[0]
    for t in range(1, len(scores)):
        ahead[t] = _log_sum(ahead[t - 1][:, None] + transitions, 0) + scores[t]
    for t in range(len(scores) - 2, -1, -1):
        behind[t] = _log_sum(transitions + (scores[t + 1] + behind[t + 1])[None], 1)
    both = np.exp(ahead + behind - (ahead + behind).max(axis=1, keepdims=True))
    return both / both.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(6))
def test_chains_end_to_end_are_those_of_each_alone(seed):
    dice = np.random.default_rng(seed)
    lengths, labels = dice.integers(1, [3, 40, 700, 2000, 300, 1][seed] + 1, size=7), seed % 4 + 1
    scores = dice.normal(size=(lengths.sum(), labels)) * [1, 3, 10, 40, 200, 5][seed]
    transitions, first = dice.normal(size=(labels, labels)) * 2, dice.normal(size=labels)
    begins = np.zeros(len(scores), dtype=bool)
    begins[np.cumsum(lengths) - lengths] = True
    got = marginals(scores, begins, transitions, first)
    chains = [one_chain(part, transitions, first) for part in np.split(scores, np.cumsum(lengths)[:-1])]
    assert np.allclose(got, np.concatenate(chains), atol=1e-8)


def test_expected_transitions_are_those_of_all_paths():
    dice = np.random.default_rng(3)
    scores, transitions, first = dice.normal(size=(2, 4, 3)), dice.normal(size=(3, 3)), dice.normal(size=3)
    single, double = _expected(scores, transitions, first)
    expected = np.zeros((3, 3))
    for chain in scores:
        paths = np.stack(np.meshgrid(*[range(3)] * 4, indexing="ij"), -1).reshape(-1, 4)
        weight = first[paths[:, 0]] + chain[np.arange(4), paths].sum(axis=1) + transitions[paths[:, :-1], paths[:, 1:]].sum(axis=1)
        share = np.exp(weight) / np.exp(weight).sum()
        for t in range(3):
            np.add.at(expected, (paths[:, t], paths[:, t + 1]), share)
    assert np.allclose(double, expected) and np.allclose(single[1], one_chain(scores[1], transitions, first))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(given):
    return fit(given.where("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2"))


def test_languages_of_rows_not_learned_from(given, model):
    rows = language(given, model, carry=("doc_id", "lang")).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == 1000 and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_switches_are_found_word_by_word(spark, given, model):
    texts = {r.lang: words_of(r.text)[:30] for r in given.where("n_chars > 600").orderBy("doc_id").collect()}
    mixed = texts["de"] + texts["fr"] + texts["en"]
    row = language(spark.createDataFrame([(1, " ".join(mixed))], "doc_id long, text string"), model).first()
    assert row.n_words == 90 and row.spans[0].start == 0 and row.spans[-1].stop == 90
    labels = [s.lang for s in row.spans for _ in range(s.start, s.stop)]
    right = sum(a == b for a, b in zip(labels, ["de"] * 30 + ["fr"] * 30 + ["en"] * 30, strict=True))
    assert right >= 80


def test_texts_without_letters_nulls_ties_and_repeated_rows(spark, model, documents):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !? _"), (None, "the the"), (4, "the the")], "doc_id long, text string")
    rows = {r.doc_id: r for r in language(df, model).collect()}
    assert all(rows[i].lang_pred == UNKNOWN and rows[i].score == 0 and rows[i].spans == [] for i in (1, 2, 3))
    assert rows[None][1:] == rows[4][1:]
    rows = language(documents, model).collect()
    assert len(rows) == 24 and len({str(r) for r in rows if r.doc_id == 20}) == 1
    tie = Model(("b", "c"), np.zeros_like(model.weights[:, :2]), np.zeros((2, 2)), np.zeros(2), {})
    assert language(df, tie).where("doc_id = 4").first()[1:3] == ("b", 0.5)


def test_very_long_text_is_labelled_whole(spark, given, model):
    text = given.where("lang = 'fr'").orderBy("n_chars", ascending=False).first().text
    row = language(spark.createDataFrame([(1, f"{text} " * (3_000_000 // len(text)))], "doc_id long, text string"), model).first()
    assert row.lang_pred == "fr" and row.n_words > 300_000


def test_languages_learned_from(spark, documents):
    nothing = fit(documents.where("false"))
    assert nothing.languages == () and language(documents, nothing).where("lang_pred != 'und' or score != 0").count() == 0
    odd = spark.createDataFrame([(1, None, "de"), (2, "abc def", None), (3, "12 34", "xx"), (4, "vier worte sind hier", "de")], "doc_id long, text string, lang string")
    only = fit(odd.withColumn("share", odd.doc_id).withColumn("places", odd.doc_id).withColumn("id", odd.lang))
    assert only.languages == ("de",)
    assert language(odd, only).where("doc_id = 2").first()[1:3] == ("de", 1.0)
    assert language(documents.where("false"), only).collect() == []


def test_carried_columns_may_not_be_named_like_results(documents, model):
    with pytest.raises(ValueError, match="spans"):
        language(documents, model, carry=("doc_id", "spans"))


def test_labels_of_held_out_rows_change_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz', lang) as lang", "source", "n_chars")
    other.write.parquet(f"{tmp_path}/documents.parquet")
    a, b = (sorted(map(tuple, op12_language_id(spark, f).collect())) for f in (FOLDER, str(tmp_path)))
    assert a == b
