from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tilldeck.operators import reporting as R


@pytest.fixture(scope="module")
def daily(spark):
    data = [
        ("2024-01-01", 100, 10, 40, 20, 5, 3, 0.5),
        ("2024-01-02", 50, 8, 30, 10, 5, 2, 0.25),
        ("2024-01-03", 9, 2, 0, 0, 0, 0, None),
    ]
    return spark.createDataFrame(
        data,
        "dt string, event_count long, active_user_count long, view_event_count long, search_event_count long, "
        "cart_event_count long, pay_event_count long, view_to_pay_rate double",
    )


def test_latest_days(spark, daily):
    assert R.latest_dt(daily, daily.where("dt < '2024-01-02'")).first()[0] == "2024-01-03"
    assert R.latest_non_sparse_dt(daily).first()[0] == "2024-01-02"
    empty = daily.withColumn("event_count", F.lit(0).cast("long"))
    assert R.latest_non_sparse_dt(empty).first()[0] == "2024-01-03"
    assert R.on_day(daily, R.latest_non_sparse_dt(daily)).first().event_count == 50


def test_recent_days(daily, rows):
    assert rows(R.recent_days(daily, keep=2), "dt") == [("2024-01-02",), ("2024-01-03",)]
    assert rows(R.recent_days(daily, end="2024-01-02", keep=1), "dt") == [("2024-01-02",)]
    # Nothing in the range: all days count.
    assert R.recent_days(daily, start="2030-01-01", keep=9).count() == 3


def test_funnel(daily):
    got = {(r.dt, r.step): (r.step_no, r.event_count, r.share) for r in R.funnel_steps(daily).collect()}
    assert got[("2024-01-01", "search")] == (2, 20, 0.5)
    assert got[("2024-01-03", "pay")] == (4, 0, 0.0)


def test_heatmap_fills_absent_cells(spark):
    df = spark.createDataFrame(
        [("d1", "view", 16), ("d1", "pay", 4), ("d2", "view", 1)], "dt string, event_type string, event_count long"
    )
    got = {(r.dt, r.event_type): (r.event_count, r.intensity) for r in R.event_heatmap(df).collect()}
    assert len(got) == 10
    assert got[("d1", "pay")] == (4, 0.5) and got[("d2", "cart")] == (0, 0.0) and got[("d2", "view")] == (1, 0.25)


def test_lift_and_scatter(daily):
    lift = {r.dt: r for r in R.conversion_lift(daily).collect()}
    assert lift["2024-01-01"].window_mean == 0.25
    assert (lift["2024-01-01"].lift, lift["2024-01-02"].lift, lift["2024-01-03"].lift) == (1.0, 0.0, -1.0)
    zero = daily.withColumn("view_to_pay_rate", F.lit(0.0))
    assert {r.lift for r in R.conversion_lift(zero).collect()} == {0.0}
    scatter = {r.dt: r for r in R.conversion_scatter(daily).collect()}
    assert tuple(scatter["2024-01-02"])[1:] == (0.8, 0.5, 0.5)


def test_day_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("d", "b", 1.0), ("d", "a", 1.0), ("c", "z", 9.0)], "dt string, k string, v double")
    got = R.day_top(df, R.latest_dt(df), "s", "v", ["k"], keep=1).collect()
    assert [tuple(r) for r in got] == [("s", "d", "a", 1.0)]


def test_period_kpis(spark):
    trade = spark.createDataFrame(
        [("d1", 100.0, 60.0, 6.0, 4, 2, 1), ("d2", 50.0, 30.0, 0.0, 2, 1, 1)],
        "dt string, gmv double, pay_amount double, refund_amount double, order_count long, pay_order_count long, "
        "pay_user_count long",
    )
    assert tuple(R.period_kpis(trade).first()) == (150.0, 90.0, 0.5, 30.0, 0.3333, 0.0667)
    nothing = R.period_kpis(trade.where("false")).first()
    assert tuple(nothing) == (0.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def test_payload_is_clean_and_in_order(spark):
    df = spark.createDataFrame(
        [("a", float("nan"), 1), ("b", 1 / 3, 7), (None, 2.0, 7), ("c", None, None)], "k string, x double, n int"
    )
    sections = {"s": R.Section(df, ("-n", "k")), "one": R.Section(df.where("k = 'a'")), "none": R.Section(df.where("false"))}
    payload = R.payload(sections)
    rows = sorted((r.section, r.position, json.loads(r.record)) for r in payload.collect())
    assert rows == [
        ("one", 1, {"k": "a", "n": 1}),
        ("s", 1, {"k": "b", "x": 0.333333, "n": 7}),
        ("s", 2, {"x": 2.0, "n": 7}),
        ("s", 3, {"k": "a", "n": 1}),
        ("s", 4, {"k": "c"}),
    ]
    values = {tuple(r) for r in R.payload_values(payload).where("section = 's' and position = 2").collect()}
    assert values == {("s", 2, "k", None, None), ("s", 2, "x", None, 2.0), ("s", 2, "n", None, 7.0)}
    with pytest.raises(ValueError, match="only numbers"):
        R.payload({"s": R.Section(df, ("-k",))})


def test_segment_rollup_keeps_null(spark, rows):
    df = spark.createDataFrame([("u1", "x", 1.0), ("u2", None, 2.0)], "user_id string, user_segment string, monetary double")
    assert rows(R.segment_rollup(df)) == [("x", 1, 1.0), (None, 1, 2.0)]
