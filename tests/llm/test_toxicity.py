from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilldeck.llm import toxicity as module
from tilldeck.llm.queries import QUERIES, held_out
from tilldeck.llm.toxicity import THRESHOLD, Model, fit, toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learned(spark, sentence):
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = sentence(1000 + i, 40)
        if bad:
            at = 5 * (i % 7)
            text = f"{text[:at * 7]} {('loser', 'idiot', 'scum')[i % 3]} {text[at * 7 :]}"
        rows.append((i, text))
        labels.append((i, int(bad), 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5000, None, 1)], "doc_id long, toxic int, quality int")


def test_learned_words_and_calibration(spark, learned, documents):
    model = fit(*learned)
    docs = spark.createDataFrame(
        [(1, "you LOSER, you"), (2, "nothing of it"), (3, None), (4, ""), (None, "an idiot"), (1, "you LOSER, you")],
        "doc_id long, text string",
    )
    rows = toxicity(docs, model).collect()
    assert [(r.doc_id, r.hits, r.score >= THRESHOLD) for r in rows] == [
        (1, 1, True), (2, 0, False), (3, 0, False), (4, 0, False), (None, 1, True), (1, 1, True),
    ]
    assert all(0 <= r.score <= 1 for r in rows) and list(model.shares) == sorted(model.shares)
    found = toxicity(documents, model, carry=("doc_id", "n_words")).where("hits > 0").collect()
    assert [r.doc_id for r in found] == [18]


def test_words_of_copies_are_not_suspicious(spark, learned, sentence):
    docs, labels = learned
    copy = sentence(77_000, 30)
    more = spark.createDataFrame([(1000 + i, copy) for i in range(30)], "doc_id long, text string")
    marks = spark.createDataFrame([(1000 + i, 1, 9) for i in range(30)], "doc_id long, toxic int, quality int")
    model = fit(docs.union(more), labels.union(marks))
    clean = spark.createDataFrame([(1, copy.split()[3])], "doc_id long, text string")
    assert toxicity(clean, model).first().hits == 0


@pytest.mark.parametrize("part", ["documents", "labels", "toxic"])
def test_nothing_to_learn(spark, learned, part):
    docs, labels = learned
    model = fit(docs.where("false") if part == "documents" else docs, labels.where({"labels": "false", "toxic": "toxic = 0"}.get(part, "true")))
    rows = toxicity(spark.createDataFrame([(1, "a loser")], "doc_id long, text string"), model).collect()
    assert rows[0].hits == 0 and 0 <= rows[0].score <= 1


def test_empty_table_and_empty_model(documents):
    assert toxicity(documents.where("false"), Model(b"", b"", (0.5,) * 5)).collect() == []


def test_held_out_rows(spark):
    rows = spark.range(200).select("id", held_out("id").alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, FOLDER).where("held_out").collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    judged = [(r.toxic, rows[r.doc_id].predicted) for r in labels if r.doc_id in rows]
    recall = sum(p for t, p in judged if t) / sum(t for t, _ in judged)
    alarms = sum(p for t, p in judged if not t) / sum(1 - t for t, _ in judged)
    assert recall >= 0.8 and alarms <= 0.01


def test_forms_never_seen_share_bytes(spark, sentence):
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = sentence(9000 + i, 40)
        rows.append((i, f"{text[:90]} schwachkopf{'qwrtzpsdfghjklyxcvbnm'[i % 21]}{i} {text[90:]}" if bad else text))
        labels.append((i, int(bad)))
    model = fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    row = toxicity(spark.createDataFrame([(1, "du Schwachkopfige")], "doc_id long, text string"), model).first()
    assert row.hits == 1 and row.score >= THRESHOLD


def test_hits_count_against_length(spark, learned, sentence):
    model = fit(*learned)
    clean = sentence(123_456, 20_000).split()
    for i in range(9):
        clean[1_000 + 2_000 * i] = "idiot"
    stretch = sentence(123_457, 4_000) + " loser scum idiot" * 40
    docs = spark.createDataFrame([(1, " ".join(clean)), (2, stretch), (3, "what an idiot")], "doc_id long, text string")
    rows = toxicity(docs, model).collect()
    assert rows[0].hits >= 9 and [r.score >= THRESHOLD for r in rows] == [False, True, True]


def test_documents_with_columns_named_like_those_of_the_labels(spark, documents):
    docs = documents.withColumn("toxic", F.lit(9)).withColumn("labelled", F.lit("x")).withColumn("choosing", F.lit(True))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 16)] + [(None, 1), (2, 7)], "doc_id long, toxic int")
    rows = toxicity(docs, fit(docs, labels), carry=("doc_id", "toxic")).collect()
    assert len(rows) == docs.count() and {r.toxic for r in rows} == {9}


def _sample(seed, count, words, special=""):
    draw = np.random.default_rng(seed)
    known = ["".join("bdglmnprst"[k % 10] + "aeiou"[k // 10 % 5] for k in draw.integers(0, 50, 3)) for _ in range(400)]
    texts = [" ".join(known[k] for k in draw.zipf(1.3, words) % 400) for _ in range(count)]
    return [f"{t} {known[i % 40]} {special}{i % 9} {t[:20]}".encode() for i, t in enumerate(texts)]


@pytest.mark.parametrize("most_places", [1 << 20, 50])
def test_telling_sequences_by_brute_force(monkeypatch, most_places):
    monkeypatch.setattr(module, "_MOST_PLACES", most_places)
    monkeypatch.setattr(module, "_COUNTERS", 1 << 9)
    own, other = _sample(1, 110, 60, "schwachkopf"), _sample(1, 120, 80, "freundlich")

    def places(texts):
        """Text, sequence and the eight bytes before the word's space, place by place."""
        data = b"".join(bytes(8) + b" " + b" ".join(t.split()) + b" " for t in texts) + bytes(8)
        space = 0
        for i in range(len(data) - 8):
            space = i if data[i] == 32 else space
            yield data, i, data[i : i + 6], data[max(space - 8, 0) : max(space - 8, 0) + 8]

    def contexts(texts):
        out = defaultdict(set)
        for _, _, found, before in places(texts):
            if 0 not in found:
                out[found].add(before)
        return out

    mine, theirs = contexts(own), contexts(other)
    total, rest = sum(map(len, own)), sum(map(len, other))
    least = max(5, np.log(1e-4) / np.log(total / (total + rest)))
    good = {s for s, c in mine.items() if len(c) >= least and len(theirs[s]) * total <= 0.05 * len(c) * rest}
    runs, start = Counter(), None
    for data, i, found, _ in places(own):
        if found in good:
            start = i if start is None else start
        elif start is not None:
            runs[data[start : i + 5]] += 1
            start = None
    expected = sorted(runs, key=lambda r: (-runs[r], r))[::-1]
    assert good and module._telling(own, other) == b"\n".join(expected)


def test_memory_of_the_choice_does_not_follow_the_sample():
    def peak(count):
        own, other = _sample(2, count, 150, "schwachkopf"), _sample(3, count, 150)
        tracemalloc.start()
        module._telling(own, other)
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    peak(10)
    assert peak(2_000) < 1.3 * peak(500) + 1_000_000
