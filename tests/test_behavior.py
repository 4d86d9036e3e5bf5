from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tilldeck.operators import behavior as B
from tilldeck.operators import landing
from tilldeck.sources.files import choose

EVENTS = {
    "page_visit": ("url string", [("1", "2024-01-01 10:00:00", "7"), ("2", "broken", "8"), (None, "2024-01-01", "9")]),
    "search_query": (
        "query string",
        [("1", "2024-01-01 11:00:00", "shoes"), ("1", "2024-01-02 11:00:00", ""), ("2", "2024-01-02 11:00:00", None)],
    ),
    "add_to_cart": (
        "sku string",
        [
            ("1", "2024-01-01 12:00:00", "10"),
            ("1", "2024-01-01 12:00:00", "10"),
            ("2", "2024-01-02 12:00:00", "99"),
            ("2", "2024-01-02 13:00:00", None),
        ],
    ),
    "remove_from_cart": ("sku string", [("1", "2024-01-01 13:00:00", "10")]),
    "product_buy": ("sku string", [("1", "2024-01-02 14:00:00", "10"), ("3", "2024-01-02 14:00:00", "11")]),
}


@pytest.fixture(scope="module")
def landed(spark):
    return {
        name: landing.land_behavior(
            spark.createDataFrame(data, f"client_id string, timestamp string, {value}"),
            landing.BEHAVIOR_SOURCES[name],
        )
        for name, (value, data) in EVENTS.items()
    }


@pytest.fixture(scope="module")
def properties(spark):
    data = [("10", "5", "2.5", "pen"), ("10", "6", "3.5", "pin"), ("11", "5", "1.0", "cup"), (None, "5", "1.0", "x")]
    raw = spark.createDataFrame(data, "sku string, category string, price string, name string")
    return landing.land_product_properties(raw, "2024-01-31")


@pytest.fixture(scope="module")
def detail(landed, properties):
    return B.behavior_detail(landed, properties)


def test_unreadable_times_are_dropped(landed):
    assert landed["page_visit"].count() == 2
    assert landed["page_visit"].where("dt = '2024-01-01'").count() == 2


def test_detail_keeps_every_row_once(detail, landed):
    # All landed rows but the one without a client.
    assert detail.count() == sum(df.count() for df in landed.values()) - 1
    assert len(detail.columns) == 16
    cart = detail.where("sku = 10 and event_type = 'cart'").collect()
    assert {(r.category_id, r.product_name, r.product_id, r.user_id) for r in cart} == {
        (5, "pen", "syn_sku_10", "syn_u_1")
    }
    unknown = detail.where("sku = 99").first()
    assert unknown.product_name is None and unknown.product_id == "syn_sku_99"


def test_search_rows(detail):
    searches = {r.query_text: r for r in detail.where("event_type = 'search'").collect()}
    assert searches[None].query_hash is None
    assert searches[""].query_hash == hashlib.sha256(b"").hexdigest()
    assert searches["shoes"].sku is None and searches["shoes"].product_id is None


def test_deduplicate_merges_equal_payloads(landed, properties, detail):
    assert B.behavior_detail(landed, properties, deduplicate=True).count() == detail.count() - 1


def test_subset_and_unknown_source(landed, properties):
    names = choose("add_to_cart , product_buy", tuple(landing.BEHAVIOR_SOURCES))
    subset = B.behavior_detail({n: landed[n] for n in names}, properties)
    assert {r.event_type for r in subset.select("event_type").distinct().collect()} == {"cart", "pay"}
    with pytest.raises(ValueError, match="nope"):
        choose("page_visit,nope", tuple(landing.BEHAVIOR_SOURCES))
    with pytest.raises(ValueError, match="no table"):
        choose("", tuple(landing.BEHAVIOR_SOURCES))


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_broadcast_flag_changes_no_result(monkeypatch, rows, landed, properties, detail, limit):
    monkeypatch.setattr(B, "BROADCAST_BYTES", limit)
    flagged = B.behavior_detail(landed, properties, broadcast_products=True)
    assert rows(flagged, "event_id", "category_id", "dt") == rows(detail, "event_id", "category_id", "dt")


def test_only_sku_sources_are_shuffled_for_the_join(spark, detail):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = detail._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    union = plan.index("Union")
    assert plan.index("Join LeftOuter") > union


def test_daily_funnel(detail, rows):
    got = {r.dt: r for r in B.behavior_daily(detail).collect()}
    day = got["2024-01-01"]
    assert (day.event_count, day.active_user_count, day.view_user_count, day.cart_user_count) == (5, 1, 1, 1)
    assert (day.cart_event_count, day.remove_cart_event_count, day.view_to_pay_rate) == (2, 1, 0.0)
    other = got["2024-01-02"]
    assert (other.view_user_count, other.view_to_cart_rate, other.cart_to_pay_rate) == (0, 0.0, 2.0)


def test_exact_funnel_equals_plain_distinct_counts(detail):
    plain = detail.groupBy("dt").agg(
        F.countDistinct("client_id").alias("active_user_count"),
        *(
            F.countDistinct(F.when(F.col("event_type") == s, F.col("client_id"))).alias(f"{s}_user_count")
            for s in B.STEPS
        ),
    )
    columns = plain.columns
    assert sorted(map(tuple, B.behavior_daily(detail).select(columns).collect())) == sorted(
        map(tuple, plain.collect())
    )


def test_sketches_match_on_small_data(detail, rows):
    for build in (
        B.behavior_daily,
        B.behavior_event_type_daily,
        B.behavior_product_daily,
        B.behavior_category_daily,
    ):
        exact, sketch = build(detail), build(detail, approx=True)
        assert rows(exact, *sorted(exact.columns)) == rows(sketch, *sorted(exact.columns))


def test_event_types_add_up_to_the_day(detail, rows):
    types = B.behavior_event_type_daily(detail)
    per_day = types.groupBy("dt").agg(F.sum("event_count").alias("event_count"))
    assert rows(per_day, "dt", "event_count") == rows(B.behavior_daily(detail), "dt", "event_count")
    assert types.where("event_type = 'search'").agg(F.max("active_sku_count")).first()[0] == 0


def test_sku_and_category_days(detail):
    skus = {(r.dt, r.sku): r for r in B.behavior_product_daily(detail).collect()}
    row = skus[("2024-01-01", 10)]
    assert (row.event_count, row.cart_event_count, row.remove_cart_event_count, row.avg_product_price) == (3, 2, 1, 2.5)
    assert skus[("2024-01-02", 99)].avg_product_price is None
    categories = {(r.dt, r.category_id): r for r in B.behavior_category_daily(detail).collect()}
    assert categories[("2024-01-02", 5)].active_sku_count == 2
    assert categories[("2024-01-02", None)].event_count == 1


def test_sampling(spark):
    df = spark.range(2000)
    kept = landing.sample_rows(df, 0.25)
    assert 400 < kept.count() < 600
    assert sorted(r.id for r in kept.collect()) == sorted(
        r.id for r in landing.sample_rows(df.repartition(7), 0.25).collect()
    )
    assert kept.join(landing.sample_rows(df, 0.25, seed=1), "id").count() < kept.count()
    assert landing.sample_rows(df, 0.0).count() == 2000 == landing.sample_rows(df, 1.0).count()
    assert 0 < landing.sample_rows(spark.range(200_000), 0.00005).count() < 40
    assert landing.limit_rows(df, 0).count() == 2000
    assert [r.id for r in landing.limit_rows(df, 3).collect()] == [0, 1, 2]


def test_topn(detail):
    top = B.behavior_product_topn(B.behavior_product_daily(detail), keep=1).collect()
    assert {(r.dt, r.sku, r.rank_no) for r in top} == {("2024-01-01", 10, 1), ("2024-01-02", 10, 1)}


def test_sketches_of_days_merge_to_users_of_ranges(spark):
    events = spark.range(60_000).selectExpr(
        "id % 20000 as client_id",
        "cast(date_add(date'2024-01-01', cast(id div 20000 as int)) as string) as dt",
        "if(id % 10 = 0, 'pay', 'view') as event_type",
    ).unionAll(spark.sql("select 77777L, '2024-01-04', 'view'"))
    ranges = spark.createDataFrame([("2024-01-01", "2024-01-03"), ("2024-01-03", "2024-01-09")], "first_dt string, last_dt string")
    sketches = B.user_sketches(events)
    assert sketches.count() == 4
    got = {r.first_dt: r for r in B.users_of_ranges(sketches, ranges).collect()}
    for first, users, payers in (("2024-01-01", 20_000, 2_000), ("2024-01-03", 20_001, 2_000)):
        assert abs(got[first].active_user_count - users) < 0.05 * users
        assert abs(got[first].pay_user_count - payers) < 0.05 * payers
        assert got[first].cart_user_count == 0
