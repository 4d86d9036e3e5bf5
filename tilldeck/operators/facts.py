"""Landed retail tables to cleaned fact details.

Filters run before de-duplication: they reach the scan, and of several copies
of a key a valid one is kept. Joins are plain equi-joins: the runtime splits a
partition that a hot key, or the rows without one, make too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilldeck.functions.casts import as_time, typed
from tilldeck.functions.expressions import UNKNOWN_CATEGORY, VALID_EVENT_TYPES, clean_text
from tilldeck.functions.frames import keep_one
from tilldeck.schemas import column_names

_LANDING_COLUMNS = ("dt", "ods_load_time", "source_table")


def _contract(table: str) -> list[str]:
    """The columns of a layer table, without those that landing adds."""
    return [name for name in column_names(table) if name not in _LANDING_COLUMNS[1:]]


def _cleaned(
    rows: DataFrame, table: str, texts: Sequence[str] = (), times: Sequence[str] = (), whole: Sequence[str] = ()
) -> DataFrame:
    """The contract's columns: ``texts`` trimmed and in lower case, ``times`` read as
    times, ``whole`` as whole numbers, all others as they are."""
    shapes = {name: clean_text(name) for name in texts}
    shapes |= {name: as_time(rows, name) for name in times}
    shapes |= {name: typed(rows, name, "int") for name in whole}
    return rows.select(*(shapes.get(name, F.col(name)).alias(name) for name in _contract(table)))


def _valid(rows: DataFrame, filled: Sequence[str], positive: Sequence[str] = ()) -> DataFrame:
    """Rows with every ``filled`` column and no negative or null ``positive`` one."""
    for name in filled:
        rows = rows.where(F.col(name).isNotNull())
    for name in positive:
        rows = rows.where(F.col(name) >= 0)
    return rows


def clean_orders(orders: DataFrame) -> DataFrame:
    """One valid header per order, its day as ``dt``."""
    shaped = _cleaned(orders, "ods_orders", ["order_status"], ["order_time"])
    return keep_one(_valid(shaped, ["order_id", "user_id"], ["total_amount", "payable_amount"]), ["order_id"])


def _valid_items(items: DataFrame) -> DataFrame:
    valid = _valid(items, ["order_item_id", "order_id"], ["sale_price", "item_amount"])
    return valid.where(F.col("quantity") > 0).drop(*_LANDING_COLUMNS)


def clean_items(items: DataFrame) -> DataFrame:
    """One valid row per order line."""
    return keep_one(_valid_items(items), ["order_item_id"])


def product_attributes(products: DataFrame) -> DataFrame:
    return keep_one(products.select("product_id", "category_id", "category_name", "brand"), ["product_id"])


def with_product_attributes(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Few rows by product, such as top lists or a day, with the product columns lines get."""
    named = rows.join(product_attributes(products), "product_id", "left")
    return named.withColumn("category_name", F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY)))


def raw_order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines as they are given with their order's header columns and day.

    The shop is the order's; a line may bring its own where orders have none.
    """
    own_shop = "shop_id" in items.columns
    if own_shop:
        orders = orders.withColumnRenamed("shop_id", "order_shop_id")
    lines = items.join(orders, "order_id")
    if own_shop:
        shop = F.coalesce("order_shop_id", "shop_id")
        lines = lines.withColumn("shop_id", shop).drop("order_shop_id")
    return lines


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Cleaned lines of cleaned orders, without product columns."""
    return raw_order_lines(clean_items(items), clean_orders(orders))


def with_order(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Columns known once per order, joined to rows as they arrive."""
    return rows.join(orders, "order_id", "left")


def _with_product(lines: DataFrame, products: DataFrame, category_name: Column) -> DataFrame:
    """Product columns by left join. Spark broadcasts the products only when
    their measured size allows it."""
    products = products.withColumnRenamed("category_id", "product_category_id")
    category_id = F.col("product_category_id")
    if "category_id" in lines.columns:
        category_id = F.coalesce("category_id", category_id)
    sku = F.col("sku_id") if "sku_id" in lines.columns else F.lit(None).cast("string")
    known = {"category_id": category_id, "category_name": category_name, "sku_id": sku}
    return lines.join(products, "product_id", "left").withColumns(known).select(*_contract("dwd_trade_order_detail"))


def trade_order_detail(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with header and product columns; grain: order item."""
    return detail_of_clean_items(orders, clean_items(items), products)


def detail_of_clean_items(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """As ``trade_order_detail``, for lines that ``clean_items`` gave."""
    return _with_product(
        raw_order_lines(items, clean_orders(orders)),
        product_attributes(products),
        F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY)),
    )


def trade_order_detail_sql(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The looser reading: no de-duplication, no fill, fewer filters."""
    lines = items.where(
        F.col("order_item_id").isNotNull() & (F.col("quantity") > 0) & (F.col("item_amount") >= 0)
    ).drop(*_LANDING_COLUMNS)
    headers = orders.where(F.col("order_id").isNotNull() & (F.col("payable_amount") >= 0)).select(
        "order_id",
        "user_id",
        "shop_id",
        as_time(orders, "order_time").alias("order_time"),
        F.lower("order_status").alias("order_status"),
        "total_amount",
        "discount_amount",
        "payable_amount",
        "province",
        "city",
        "dt",
    )
    return _with_product(
        raw_order_lines(lines, headers),
        products.select("product_id", "category_id", "category_name", "brand"),
        F.col("category_name"),
    )


def payment_detail(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments with their order's shop, time and payable; grain: payment."""
    headers = keep_one(
        orders.where(F.col("order_id").isNotNull()).select(
            "order_id",
            "shop_id",
            as_time(orders, "order_time").alias("order_time"),
            F.col("payable_amount").alias("order_payable_amount"),
        ),
        ["order_id"],
    )
    joined = clean_payments(payments).join(headers, "order_id", "left")
    return joined.select(*_contract("dwd_trade_payment_detail"))


def clean_payments(payments: DataFrame) -> DataFrame:
    """The payment columns the daily summaries need, without the order join."""
    shaped = _cleaned(payments, "ods_payments", ["pay_status"], ["pay_time"])
    return keep_one(_valid(shaped, ["payment_id", "order_id"], ["pay_amount"]), ["payment_id"])


def clean_refunds(refunds: DataFrame) -> DataFrame:
    """One valid row per refund."""
    shaped = _cleaned(refunds, "ods_refunds", ["refund_status"], ["refund_time"])
    return keep_one(_valid(shaped, ["refund_id", "order_id"], ["refund_amount"]), ["refund_id"])


def paid_orders(payments: DataFrame) -> DataFrame:
    """The latest successful payment of every order."""
    success = payments.where(
        (clean_text("pay_status") == "success") & F.col("order_id").isNotNull()
    ).select(
        "order_id",
        as_time(payments, "pay_time").alias("pay_time"),
        F.col("payment_id").alias("paid_payment_id"),
        F.col("pay_amount").alias("paid_amount"),
    )
    return keep_one(
        success, ["order_id"], [F.col("pay_time").desc_nulls_last(), F.col("paid_payment_id").desc_nulls_last()]
    )


def refund_detail(refunds: DataFrame, payments: DataFrame) -> DataFrame:
    """Refunds with the payment they reverse; grain: refund."""
    joined = clean_refunds(refunds).join(paid_orders(payments), "order_id", "left")
    return joined.select(*_contract("dwd_trade_refund_detail"))


def user_behavior_detail(events: DataFrame) -> DataFrame:
    """Events of the six valid types; grain: event."""
    shaped = _cleaned(events, "dwd_user_behavior_detail", ["event_type"], ["event_time"])
    known = F.col("event_type").isin(*VALID_EVENT_TYPES)
    return keep_one(_valid(shaped, ["event_id", "user_id"]).where(known), ["event_id"])


def inventory_detail(logs: DataFrame) -> DataFrame:
    """Stock movements with non-negative stock; grain: log entry."""
    counts = ["before_quantity", "after_quantity"]
    shaped = _cleaned(logs, "dwd_inventory_change_detail", ["change_type"], ["change_time"], ["change_quantity", *counts])
    return keep_one(_valid(shaped, ["inventory_log_id", "product_id"], counts), ["inventory_log_id"])
