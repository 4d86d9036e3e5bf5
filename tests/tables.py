"""Small hand-written raw retail tables: text columns, as read from CSV."""

from __future__ import annotations

ORDERS = (
    "order_id user_id shop_id order_time order_status total_amount discount_amount payable_amount province city dt",
    [
        ("O1", "U1", "S1", "2025-01-01 10:00:00", " PAID ", "100.00", "10.00", "90.00", "P", "C", "2025-01-01"),
        ("O1", "U1", "S1", "2025-01-01 10:00:00", " PAID ", "100.00", "10.00", "90.00", "P", "C", "2025-01-01"),
        ("O2", "U1", "S2", "2025-01-01 11:00:00", "paid", "50.00", "0.00", "50.00", "P", "C", "2025-01-01"),
        ("O3", "U2", "S1", "2025-01-02 09:00:00", "created", "70.00", "0.00", "70.00", "P", "C", "2025-01-02"),
        ("O4", None, "S1", "2025-01-02 09:00:00", "created", "70.00", "0.00", "70.00", "P", "C", "2025-01-02"),
        ("O5", "U3", "S1", "2025-01-02 09:00:00", "created", "-1.00", "0.00", "-1.00", "P", "C", "2025-01-02"),
        (None, "U3", "S1", "2025-01-02 09:00:00", "created", "1.00", "0.00", "1.00", "P", "C", "2025-01-02"),
    ],
)
ORDER_ITEMS = (
    "order_item_id order_id product_id category_id sku_id quantity sale_price item_amount dt",
    [
        ("I1", "O1", "P1", "1", "K1", "2", "30.00", "60.00", "2025-01-01"),
        ("I1", "O1", "P2", "2", "K2", "2", "30.00", "60.00", "2025-01-01"),
        ("I2", "O1", "P9", "9", "K9", "1", "30.00", "30.00", "2025-01-01"),
        ("I3", "O2", "P1", "1", "K1", "5", "10.00", "50.00", "2025-01-01"),
        ("I4", "O3", "P2", "2", "K2", "7", "10.00", "70.00", "2025-01-02"),
        ("I5", "O3", "P2", "2", "K2", "0", "10.00", "0.00", "2025-01-02"),
        ("I6", "O3", "P2", "2", "K2", "bad", "10.00", "1.00", "2025-01-02"),
        ("I7", "OX", "P2", "2", "K2", "1", "10.00", "10.00", "2025-01-02"),
        ("I8", "O4", "P2", "2", "K2", "1", "10.00", "10.00", "2025-01-02"),
    ],
)
PAYMENTS = (
    "payment_id order_id user_id pay_time pay_method pay_amount pay_status dt",
    [
        ("Y1", "O1", "U1", "2025-01-01 10:05:00", "card", "90.00", "  SUCCESS ", "2025-01-01"),
        ("Y2", "O2", "U1", "2025-01-01 11:05:00", "card", "50.00", "success", "2025-01-01"),
        ("Y2", "O2", "U1", "2025-01-01 11:05:00", "card", "50.00", "success", "2025-01-01"),
        ("Y3", "O3", "U2", "2025-01-03 11:05:00", "card", "68.00", "success", "2025-01-03"),
        ("Y4", "O3", "U2", "2025-01-02 11:05:00", "card", "20.00", "failed", "2025-01-02"),
        ("Y5", "O7", "U2", "not a time", "card", "-5.00", "success", "2025-01-02"),
    ],
)
REFUNDS = (
    "refund_id order_id user_id refund_time refund_amount refund_reason refund_status dt",
    [
        ("R1", "O1", "U1", "2025-01-02 10:00:00", "30.00", "damaged", "APPROVED", "2025-01-02"),
        ("R2", "O2", "U1", "2025-01-02 10:00:00", "60.00", "damaged", "pending", "2025-01-02"),
        ("R3", "O9", "U1", "2025-01-02 10:00:00", "10.00", None, "approved", "2025-01-02"),
    ],
)
USER_EVENTS = (
    "event_id user_id product_id shop_id event_type event_time session_id device_type source_channel dt",
    [
        ("E1", "U1", "P1", "S1", "view", "2025-01-01 10:00:00", "s", "app", "ad", "2025-01-01"),
        ("E1", "U1", "P1", "S1", "view", "2025-01-01 10:00:00", "s", "app", "ad", "2025-01-01"),
        ("E2", "U1", "P1", "S1", " Cart ", "2025-01-02 10:00:00", "s", "app", "ad", "2025-01-02"),
        ("E3", "U4", "P1", "S1", "pay", "2025-01-01 10:00:00", "s", "app", "ad", "2025-01-01"),
        ("E4", "U4", "P1", "S1", "hover", "2025-01-02 10:00:00", "s", "app", "ad", "2025-01-02"),
        ("E5", "U5", "P1", "S1", "view", "2025-01-03 10:00:00", "s", "app", "ad", "2025-01-03"),
        ("E6", "U5", "P1", "S1", None, "2025-01-03 10:00:00", "s", "app", "ad", "2025-01-03"),
    ],
)
INVENTORY_LOGS = (
    "inventory_log_id product_id shop_id change_type change_quantity before_quantity after_quantity change_time dt",
    [
        ("L1", "P1", "S1", "sale_out", "-7", "100", "93", "2025-01-01 10:00:00", "2025-01-01"),
        ("L2", "P1", "S1", "Purchase_In", "20", "93", "113", "2025-01-01 12:00:00", "2025-01-01"),
        ("L3", "P1", "S1", "sale_out", "-1", "113", "112", "2025-01-01 12:00:00", "2025-01-01"),
        ("L4", "P2", "S1", "sale_out", "-9", "5", "-4", "2025-01-01 12:00:00", "2025-01-01"),
        ("L5", "P2", "S2", "adjustment", "0", "0", "0", "2025-01-02 12:00:00", "2025-01-02"),
    ],
)
USERS = (
    "user_id register_time gender age city user_level channel is_member",
    [
        ("U1", "2024-01-01 00:00:00", "F", "24", "C", "gold", "ad", "1"),
        ("U2", "bad time", "M", None, "C", "gold", "ad", "0"),
    ],
)
SHOPS = (
    "shop_id shop_name shop_type city open_time score",
    [("S1", "one", "brand", "C", "2020-01-01 00:00:00", "4.5"), ("S2", "two", "brand", "C", "bad", "x")],
)
PRODUCTS = (
    "product_id product_name category_id category_name brand shop_id list_price cost_price create_time status",
    [
        ("P1", "pen", "1", "office", "B1", "S1", "30.00", "10.00", "2020-01-01 00:00:00", "active"),
        ("P2", "cup", "2", "kitchen", "B2", "S1", "10.00", "4.00", "2020-01-01 00:00:00", "active"),
        ("P3", "pan", "2", "cooking", "B2", "S1", "10.00", "4.00", "2020-01-01 00:00:00", "active"),
    ],
)
RAW = {
    "users": USERS,
    "shops": SHOPS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "refunds": REFUNDS,
    "user_events": USER_EVENTS,
    "inventory_logs": INVENTORY_LOGS,
}


def raw_table(spark, name):
    columns, data = RAW[name]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns.split()))


def landed(spark, name, load_dt="2025-01-03"):
    """The table as its landed layer holds it."""
    from tilldeck.operators.landing import land
    from tilldeck.schemas import RAW_TABLES
    from tilldeck.sources.layers import conform

    return conform(land(raw_table(spark, name), name, load_dt), RAW_TABLES[name])
