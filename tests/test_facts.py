from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tables import landed, raw_table

from tilldeck.operators import dimensions, facts
from tilldeck.operators.landing import land, normalize_names
from tilldeck.sources.layers import conform


def by_key(df, key):
    found = df.collect()
    keys = [r[key] for r in found]
    assert len(keys) == len(set(keys))
    return {r[key]: r for r in found}


def test_landing_names_days_and_audit(spark):
    df = raw_table(spark, "orders").limit(1).toDF(*(f" {c.upper()} " for c in raw_table(spark, "orders").columns))
    assert normalize_names(df).columns[0] == "order_id"
    row = land(df, "orders", "2000-01-01").first()
    assert (row.dt, row.source_table) == ("2025-01-01", "orders") and row.ods_load_time is not None
    assert land(raw_table(spark, "users"), "users", "2025-01-03").first().dt == "2025-01-03"
    odd = spark.createDataFrame([("2025-1-5",), ("nonsense",)], "dt string")
    assert [r.dt for r in land(odd, "t", "x").collect()] == ["2025-01-05", None]


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="dt"):
        conform(raw_table(spark, "users"), "ods_users")
    with pytest.raises(ValueError, match="unknown layer table"):
        conform(raw_table(spark, "users"), "nothing")


def test_trade_order_detail(spark):
    detail = facts.trade_order_detail(*(landed(spark, t) for t in ("orders", "order_items", "products")))
    got = by_key(detail, "order_item_id")
    # Dropped: no quantity, unreadable quantity, unknown order, order without a user.
    assert set(got) == {"I1", "I2", "I3", "I4"}
    assert got["I1"].product_id == "P1"  # the first of two copies in column order
    assert (got["I1"].category_name, got["I2"].category_name) == ("office", "unknown")
    assert (got["I1"].order_status, got["I1"].item_amount) == ("paid", Decimal("60.0000"))
    assert got["I1"].dt == "2025-01-01" and got["I4"].dt == "2025-01-02"
    assert got["I1"].shop_id == "S1" and got["I3"].shop_id == "S2"


def test_sql_reading_keeps_copies_and_leaves_gaps(spark):
    detail = facts.trade_order_detail_sql(*(landed(spark, t) for t in ("orders", "order_items", "products")))
    found = detail.collect()
    # Order O1 arrives twice and so does line I1.
    assert sum(r.order_item_id == "I1" for r in found) == 4
    assert {r.category_name for r in found if r.order_item_id == "I2"} == {None}
    assert any(r.order_id == "O4" for r in found)


def test_payment_detail(spark):
    got = by_key(facts.payment_detail(landed(spark, "payments"), landed(spark, "orders")), "payment_id")
    assert set(got) == {"Y1", "Y2", "Y3", "Y4"}
    assert got["Y1"].pay_status == "success" and got["Y1"].shop_id == "S1"
    assert got["Y3"].order_payable_amount == Decimal("70.00")


def test_refund_detail_finds_unclean_success(spark):
    got = by_key(facts.refund_detail(landed(spark, "refunds"), landed(spark, "payments")), "refund_id")
    assert got["R1"].paid_payment_id == "Y1" and got["R1"].refund_status == "approved"
    assert got["R3"].paid_payment_id is None


def test_refund_of_an_order_paid_twice_stays_one_row(spark):
    payments = landed(spark, "payments")
    twice = payments.unionAll(
        payments.where("payment_id = 'Y1'").withColumn("payment_id", payments.order_id).withColumn("dt", payments.dt)
    )
    assert facts.refund_detail(landed(spark, "refunds"), twice).count() == 3


def test_user_behavior_detail(spark):
    got = by_key(facts.user_behavior_detail(landed(spark, "user_events")), "event_id")
    assert set(got) == {"E1", "E2", "E3", "E5"} and got["E2"].event_type == "cart"


def test_inventory_detail(spark):
    got = by_key(facts.inventory_detail(landed(spark, "inventory_logs")), "inventory_log_id")
    assert set(got) == {"L1", "L2", "L3", "L5"} and got["L2"].change_type == "purchase_in"


def test_dimensions(spark, rows):
    dt = "2025-01-03"
    users = by_key(dimensions.dim_user(landed(spark, "users"), dt), "user_id")
    assert (users["U1"].age_group, users["U2"].age_group) == ("18-24", "45+")
    assert users["U2"].register_time is None and users["U1"].dt == dt
    products = dimensions.dim_product(landed(spark, "products"), dt)
    assert by_key(products, "product_id")["P1"].list_price == 30.0
    assert by_key(dimensions.dim_shop(landed(spark, "shops"), dt), "shop_id")["S2"].score is None
    assert rows(dimensions.dim_category(products, dt)) == [(1, "office", 1, dt), (2, "cooking", 1, dt)]
    assert dimensions.dim_category_distinct_pair(products, dt).count() == 3


def test_latest_snapshot_wins(spark):
    old = landed(spark, "shops", "2025-01-01")
    new = landed(spark, "shops", "2025-01-02").replace("one", "renamed")
    got = by_key(dimensions.dim_shop(old.unionAll(new), "x"), "shop_id")
    assert got["S1"].shop_name == "renamed"


def test_category_without_id(spark, rows):
    products = landed(spark, "products").withColumn("category_id", F.lit(None).cast("int"))
    assert dimensions.dim_category(products, "d").count() == 1
    assert dimensions.dim_category_distinct_pair(products, "d").count() == 0


def test_calendar(spark):
    got = by_key(dimensions.dim_date(dimensions.date_range(spark, "2024-12-28", "2025-01-01")), "date_id")
    assert len(got) == 5
    assert [got[f"2024-12-{d}"].is_weekend for d in (28, 29, 30)] == [1, 1, 0]
    assert (got["2024-12-30"].week_of_year, got["2025-01-01"].year) == (1, 2025)
