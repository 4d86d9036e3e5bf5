"""Each stage of the corpus pipeline against a plain computation on its input."""

from __future__ import annotations

import pytest
from test_decontaminate import brute_force as leaks
from test_ngram_join import classes, sets_of
from test_substring import brute_force as cut
from test_tokens import NAMES, whole

import corpus_pipeline as pipeline
from tilldeck.llm.queries import held_out
from tilldeck.llm.toxicity import THRESHOLD, fit, toxicity


@pytest.fixture(scope="module")
def folder(spark, sentence, documents, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    learn = [(1000 + i, f"{sentence(300 + i, 30)} {('loser', 'scum')[i % 2] if i % 3 == 0 else 'fine'} {sentence(700 + i, 9)}") for i in range(150)]
    more = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in learn], "doc_id long, text string, lang string, source string, n_chars long")
    docs = documents.select(*more.columns).union(more)
    docs.withColumn("hits", docs.doc_id).coalesce(2).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i % 3 == 1), 1) for i, _ in learn]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{root}/labels.parquet")
    items = [(1, sentence(1, 12)), (2, sentence(7, 19)), (3, None), (4, "no such words in any text at all or so")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = rows_of(docs)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out())
    scored = toxicity(docs, fit(docs, labels), carry=("doc_id", "text")).where(f"score < {THRESHOLD}")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert tuple(out.columns) == pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = rows_of(docs)
        if name == "toxicity":
            assert after == rows_of(scored) and 0 < len(before) - len(after) < 70
            assert not any("loser" in (t or "") or "scum" in (t or "") for _, t in after)
        elif name == "ngram jaccard join":
            low = classes(sets_of(before))
            assert after == [(i, t) for i, t in before if i is None or low[i] == i]
        elif name == "substring dedup":
            assert after == sorted(((i, t) for i, _, _, t in cut(before, 20)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            dirty = {i for i, _, n, _ in leaks(before, items) if n and i is not None}
            assert dirty and after == [(i, t) for i, t in before if i not in dirty]
        before = after
    packed = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    sizes = {i: len(ids) + 1 for (i, _), ids in zip(before, whole(NAMES[1], [t for _, t in before]), strict=True)}
    found: dict = {}
    for r in packed:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes
    again: dict = {}
    for r in pipeline.run(spark, folder).collect():
        again[r.doc_id] = again.get(r.doc_id, 0) + r.length
    assert again == sizes


def test_empty_tables(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
