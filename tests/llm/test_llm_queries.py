"""Registered queries over whole given tables: SQL where it exists, and shape."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tilldeck.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_html_text": {"page_id", "url", "text", "n_chars"},
    "op3_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op5_ngram_jaccard": {"doc_id", "n_shingles", "component_id"},
    "op6_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op7_token_counts": {"part", "ordinal", "start", "n_tokens", "closed"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted", "hits"},
    "op12_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
}


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), QUERIES[name], ORACLE[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_row_of_the_table(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert set(df.columns) == COLUMNS[name]
    table, key = ("pages", "page_id") if "page_id" in df.columns else ("documents", "doc_id")
    expected = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    rows = df.collect()
    if name == "op7_token_counts":
        assert len(rows) == expected.count()
    else:
        assert {r[key] for r in rows} == {r[key] for r in expected.select(key).collect()}


@pytest.mark.parametrize("name", ["op3_url_filter"])
def test_native_query_runs_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
