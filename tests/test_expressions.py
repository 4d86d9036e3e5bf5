from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilldeck.functions import expressions as E


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_safe_div(spark):
    data = [(80.0, 100.0), (1.0, 0.0), (1.0, None), (None, 2.0)]
    got = values(spark, data, "n double, d double", E.safe_div(F.col("n"), F.col("d")))
    assert got == [(0.8,), (0.0,), (None,), (None,)]


def test_score_segment_rules(spark):
    data = [(5, 5, 5), (4, 3, 2), (1, 5, 5), (3, 2, 2), (4, 4, 3), (4, 2, 5)]
    got = values(spark, data, "r int, f int, m int", E.score_segment(F.col("r"), F.col("f"), F.col("m")))
    assert [g for (g,) in got] == [E.HIGH_VALUE, E.PROMISING, E.CHURN_RISK, E.ORDINARY, E.PROMISING, E.ORDINARY]


@pytest.mark.parametrize(
    "score, cases",
    [
        (E.recency_score, {-1: 5, 7: 5, 8: 4, 30: 4, 31: 3, 60: 3, 61: 2, 90: 2, 91: 1}),
        (E.frequency_score, {10: 5, 9: 4, 5: 4, 4: 3, 3: 3, 2: 2, 1: 1}),
        (E.monetary_score, {10000: 5, 9999: 4, 5000: 4, 2000: 3, 500: 2, 499: 1}),
    ],
)
def test_score_bounds_are_inclusive(spark, score, cases):
    got = values(spark, [(v,) for v in cases], "v int", score(F.col("v")))
    assert [g for (g,) in got] == list(cases.values())


def test_age_group_of_null_is_the_rest(spark):
    got = values(spark, [(None,), (17,), (25,), (34,), (45,)], "age int", E.age_group(F.col("age")))
    assert [g for (g,) in got] == ["45+", "18-24", "25-34", "25-34", "45+"]


def test_threshold_segment(spark):
    data = [(7, 10, 10000.0), (7, 10, 9999.0), (61, 1, 1.0), (45, 1, 1.0)]
    got = values(
        spark, data, "d int, o int, a double", E.threshold_segment(F.col("d"), F.col("o"), F.col("a"))
    )
    assert [g for (g,) in got] == [E.HIGH_VALUE, E.PROMISING, E.CHURN_RISK, E.ORDINARY]


def test_query_hash_keeps_null_and_hashes_empty(spark):
    got = values(spark, [(None,), ("",)], "q string", E.query_hash(F.col("q")))
    assert got == [(None,), (hashlib.sha256(b"").hexdigest(),)]


def test_content_event_id(spark):
    df = spark.sql(
        "select 'd' ds, 's' src, 7L client, timestamp_ntz'2024-01-02 03:04:05.9' t, 9L sku, "
        "cast(null as bigint) url, cast(null as string) h"
    )
    got = df.select(E.content_event_id(*(F.col(c) for c in ("ds", "src", "client", "t", "sku", "url", "h"))))
    expected = hashlib.sha256("d||s||7||2024-01-02 03:04:05||9||||".encode()).hexdigest()
    assert got.collect()[0][0] == expected


def test_clean_value(spark):
    data = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (1 / 3,), (-2.5,)]
    got = values(spark, data, "v double", E.clean_value(F.col("v")))
    assert [g for (g,) in got] == [None, None, None, None, 0.333333, -2.5]


def test_missing_any(spark):
    data = [("a", 1), ("  ", 1), (None, 1), ("a", None)]
    got = values(spark, data, "k string, n int", E.missing_any(["k", "n"]))
    assert [g for (g,) in got] == [False, True, True, True]


def test_lenient_cast(spark):
    data = [("17",), ("17.0",), ("x",), (None,), ("",)]
    got = values(spark, data, "v string", E.lenient_cast(F.col("v"), "string", "int"))
    assert [g for (g,) in got] == [17, 17, None, None, None]
    got = values(spark, [("12.345",), ("bad",)], "v string", E.lenient_cast(F.col("v"), "string", "decimal(18,2)"))
    assert [None if g is None else str(g) for (g,) in got] == ["12.35", None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" aBcÄ", max_size=6), min_size=1, max_size=8))
def test_clean_text_is_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(E.clean_text("t").alias("once"))
    assert all(r.once == r.twice for r in df.select("once", E.clean_text("once").alias("twice")).collect())
