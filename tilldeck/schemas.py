"""Column contracts of every layer table, in write order, ``dt`` last.

Fixed values: table and column names are the data model users query. Money is
decimal in the landed and fact layers and double in finished summaries.
"""

from __future__ import annotations

from pyspark.sql import types as T

AUDIT_DDL = "ods_load_time TIMESTAMP, source_table STRING, dt STRING"
BEHAVIOR_AUDIT_DDL = "source_dataset STRING, " + AUDIT_DDL

ODS = {
    "ods_users": "user_id STRING, register_time TIMESTAMP_NTZ, gender STRING, age INT, city STRING, "
    "user_level STRING, channel STRING, is_member INT, " + AUDIT_DDL,
    "ods_shops": "shop_id STRING, shop_name STRING, shop_type STRING, city STRING, open_time TIMESTAMP_NTZ, "
    "score DOUBLE, " + AUDIT_DDL,
    "ods_products": "product_id STRING, product_name STRING, category_id INT, category_name STRING, "
    "brand STRING, shop_id STRING, list_price DECIMAL(18,2), cost_price DECIMAL(18,2), "
    "create_time TIMESTAMP_NTZ, status STRING, " + AUDIT_DDL,
    "ods_orders": "order_id STRING, user_id STRING, shop_id STRING, order_time TIMESTAMP_NTZ, "
    "order_status STRING, total_amount DECIMAL(18,2), discount_amount DECIMAL(18,2), "
    "payable_amount DECIMAL(18,2), province STRING, city STRING, " + AUDIT_DDL,
    "ods_order_items": "order_item_id STRING, order_id STRING, product_id STRING, shop_id STRING, "
    "category_id INT, sku_id STRING, quantity INT, sale_price DOUBLE, item_amount DECIMAL(18,4), " + AUDIT_DDL,
    "ods_payments": "payment_id STRING, order_id STRING, user_id STRING, pay_time TIMESTAMP_NTZ, "
    "pay_method STRING, pay_amount DECIMAL(18,2), pay_status STRING, " + AUDIT_DDL,
    "ods_refunds": "refund_id STRING, order_id STRING, user_id STRING, refund_time TIMESTAMP_NTZ, "
    "refund_amount DECIMAL(18,4), refund_reason STRING, refund_status STRING, " + AUDIT_DDL,
    "ods_user_events": "event_id STRING, user_id STRING, product_id STRING, shop_id STRING, event_type STRING, "
    "event_time TIMESTAMP_NTZ, session_id STRING, device_type STRING, source_channel STRING, " + AUDIT_DDL,
    "ods_inventory_logs": "inventory_log_id STRING, product_id STRING, shop_id STRING, change_type STRING, "
    "change_quantity INT, before_quantity INT, after_quantity INT, change_time TIMESTAMP_NTZ, " + AUDIT_DDL,
}

BEHAVIOR_ODS = {
    "ods_synerise_page_visit": "client_id BIGINT, raw_timestamp STRING, event_time TIMESTAMP_NTZ, url BIGINT, "
    + BEHAVIOR_AUDIT_DDL,
    "ods_synerise_search_query": "client_id BIGINT, raw_timestamp STRING, event_time TIMESTAMP_NTZ, "
    "query STRING, " + BEHAVIOR_AUDIT_DDL,
    "ods_synerise_add_to_cart": "client_id BIGINT, raw_timestamp STRING, event_time TIMESTAMP_NTZ, sku BIGINT, "
    + BEHAVIOR_AUDIT_DDL,
    "ods_synerise_remove_from_cart": "client_id BIGINT, raw_timestamp STRING, event_time TIMESTAMP_NTZ, "
    "sku BIGINT, " + BEHAVIOR_AUDIT_DDL,
    "ods_synerise_product_buy": "client_id BIGINT, raw_timestamp STRING, event_time TIMESTAMP_NTZ, sku BIGINT, "
    + BEHAVIOR_AUDIT_DDL,
    "ods_synerise_product_properties": "sku BIGINT, category_id BIGINT, price DOUBLE, product_name STRING, "
    + BEHAVIOR_AUDIT_DDL,
}

DIM = {
    "dim_user": "user_id STRING, register_time TIMESTAMP_NTZ, gender STRING, age INT, age_group STRING, "
    "city STRING, user_level STRING, channel STRING, is_member INT, dt STRING",
    "dim_product": "product_id STRING, product_name STRING, category_id INT, category_name STRING, "
    "brand STRING, shop_id STRING, list_price DOUBLE, cost_price DOUBLE, create_time TIMESTAMP_NTZ, "
    "status STRING, dt STRING",
    "dim_shop": "shop_id STRING, shop_name STRING, shop_type STRING, city STRING, open_time TIMESTAMP_NTZ, "
    "score DOUBLE, dt STRING",
    "dim_category": "category_id INT, category_name STRING, category_level INT, dt STRING",
    "dim_date": "date_id STRING, year INT, month INT, day INT, week_of_year INT, is_weekend INT, dt STRING",
}

DWD = {
    "dwd_trade_order_detail": "order_item_id STRING, order_id STRING, user_id STRING, shop_id STRING, "
    "product_id STRING, category_id INT, category_name STRING, brand STRING, sku_id STRING, quantity INT, "
    "sale_price DOUBLE, item_amount DECIMAL(18,4), total_amount DECIMAL(18,2), discount_amount DECIMAL(18,2), "
    "payable_amount DECIMAL(18,2), order_status STRING, order_time TIMESTAMP_NTZ, province STRING, city STRING, "
    "dt STRING",
    "dwd_trade_payment_detail": "payment_id STRING, order_id STRING, user_id STRING, shop_id STRING, "
    "pay_time TIMESTAMP_NTZ, order_time TIMESTAMP_NTZ, pay_method STRING, pay_amount DECIMAL(18,2), "
    "order_payable_amount DECIMAL(18,2), pay_status STRING, dt STRING",
    "dwd_trade_refund_detail": "refund_id STRING, order_id STRING, user_id STRING, refund_time TIMESTAMP_NTZ, "
    "refund_amount DECIMAL(18,4), refund_reason STRING, refund_status STRING, paid_payment_id STRING, "
    "paid_amount DECIMAL(18,2), pay_time TIMESTAMP_NTZ, dt STRING",
    "dwd_user_behavior_detail": "event_id STRING, user_id STRING, product_id STRING, shop_id STRING, "
    "event_type STRING, event_time TIMESTAMP_NTZ, session_id STRING, device_type STRING, "
    "source_channel STRING, dt STRING",
    "dwd_inventory_change_detail": "inventory_log_id STRING, product_id STRING, shop_id STRING, "
    "change_type STRING, change_quantity INT, before_quantity INT, after_quantity INT, "
    "change_time TIMESTAMP_NTZ, dt STRING",
    "dwd_synerise_user_behavior_detail": "event_id STRING, client_id BIGINT, user_id STRING, event_type STRING, "
    "source_event_type STRING, event_time TIMESTAMP_NTZ, sku BIGINT, product_id STRING, category_id BIGINT, "
    "product_price DOUBLE, product_name STRING, url_id BIGINT, query_hash STRING, query_text STRING, "
    "source_dataset STRING, dt STRING",
}

_SALES = "sales_quantity BIGINT, sales_amount DOUBLE, order_count BIGINT, buyer_count BIGINT"
_TRADE = (
    "gmv DOUBLE, order_count BIGINT, order_user_count BIGINT, pay_order_count BIGINT, pay_user_count BIGINT, "
    "pay_amount DOUBLE, pay_conversion_rate DOUBLE, avg_order_value DOUBLE, refund_order_count BIGINT, "
    "refund_amount DOUBLE, refund_rate DOUBLE"
)
_STEP_EVENTS = "cart_event_count BIGINT, remove_cart_event_count BIGINT, pay_event_count BIGINT"
_BEHAVIOR_DAY = (
    "event_count BIGINT, active_user_count BIGINT, view_user_count BIGINT, search_user_count BIGINT, "
    "cart_user_count BIGINT, remove_cart_user_count BIGINT, pay_user_count BIGINT, view_event_count BIGINT, "
    "search_event_count BIGINT, " + _STEP_EVENTS + ", view_to_cart_rate DOUBLE, cart_to_pay_rate DOUBLE, "
    "view_to_pay_rate DOUBLE"
)
_EVENT_TYPE_DAY = "event_type STRING, event_count BIGINT, active_user_count BIGINT, active_sku_count BIGINT"
_SKU_DAY = (
    "sku BIGINT, category_id BIGINT, product_name STRING, event_count BIGINT, " + _STEP_EVENTS + ", "
    "active_user_count BIGINT, avg_product_price DOUBLE"
)
_SKU_CATEGORY_DAY = (
    "category_id BIGINT, event_count BIGINT, " + _STEP_EVENTS + ", active_user_count BIGINT, active_sku_count BIGINT"
)
_RETENTION = "cohort_dt STRING, day_diff INT, cohort_users BIGINT, retained_users BIGINT, retention_rate DOUBLE"

DWS = {
    "dws_trade_day_summary": _TRADE + ", dt STRING",
    "dws_user_day_summary": "user_id STRING, order_count BIGINT, order_amount DOUBLE, pay_order_count BIGINT, "
    "pay_amount DOUBLE, refund_order_count BIGINT, refund_amount DOUBLE, event_count BIGINT, view_count BIGINT, "
    "cart_count BIGINT, dt STRING",
    "dws_product_day_summary": "product_id STRING, category_id INT, category_name STRING, brand STRING, "
    + _SALES + ", dt STRING",
    "dws_shop_day_summary": "shop_id STRING, " + _SALES + ", dt STRING",
    "dws_category_day_summary": "category_id INT, category_name STRING, " + _SALES + ", dt STRING",
    "dws_user_retention_summary": _RETENTION + ", dt STRING",
    "dws_inventory_day_summary": "product_id STRING, shop_id STRING, in_quantity BIGINT, out_quantity BIGINT, "
    "ending_quantity INT, avg_before_quantity DOUBLE, dt STRING",
    "dws_synerise_behavior_day_summary": _BEHAVIOR_DAY + ", dt STRING",
    "dws_synerise_event_type_day_summary": _EVENT_TYPE_DAY + ", dt STRING",
    "dws_synerise_product_day_summary": _SKU_DAY + ", dt STRING",
    "dws_synerise_category_day_summary": _SKU_CATEGORY_DAY + ", dt STRING",
}

ADS = {
    "ads_retail_dashboard_daily": _TRADE + ", repeat_purchase_rate DOUBLE, dt STRING",
    "ads_product_topn": "product_id STRING, category_id INT, category_name STRING, brand STRING, "
    + _SALES + ", product_name STRING, shop_id STRING, rank_no INT, dt STRING",
    "ads_category_topn": "category_id INT, category_name STRING, " + _SALES + ", rank_no INT, dt STRING",
    "ads_shop_rank": "shop_id STRING, " + _SALES + ", shop_name STRING, shop_type STRING, city STRING, "
    "rank_no INT, dt STRING",
    "ads_user_retention": _RETENTION + ", dt STRING",
    "ads_rfm_user_segment": "user_id STRING, recency_days INT, frequency BIGINT, monetary DOUBLE, r_score INT, "
    "f_score INT, m_score INT, user_segment STRING, dt STRING",
    "ads_refund_analysis": "refund_reason STRING, refund_status STRING, refund_count BIGINT, "
    "refund_order_count BIGINT, refund_amount DOUBLE, dt STRING",
    "ads_inventory_turnover": "product_id STRING, shop_id STRING, sales_quantity BIGINT, sales_amount DOUBLE, "
    "in_quantity BIGINT, out_quantity BIGINT, ending_quantity INT, avg_inventory DOUBLE, "
    "inventory_turnover_rate DOUBLE, dt STRING",
    "ads_synerise_behavior_dashboard_daily": _BEHAVIOR_DAY + ", dt STRING",
    "ads_synerise_event_type_trend": _EVENT_TYPE_DAY + ", dt STRING",
    "ads_synerise_product_topn": _SKU_DAY + ", rank_no INT, dt STRING",
    "ads_synerise_category_topn": _SKU_CATEGORY_DAY + ", rank_no INT, dt STRING",
}

LAYERS = {"ods": ODS | BEHAVIOR_ODS, "dim": DIM, "dwd": DWD, "dws": DWS, "ads": ADS}
TABLES = {table: ddl for layer in LAYERS.values() for table, ddl in layer.items()}

# Columns a raw file may leave out; they land as null.
OPTIONAL = {"ods_order_items": ("shop_id", "category_id", "sku_id")}

# Raw retail files and the landed tables they feed.
RAW_TABLES = {name.removeprefix("ods_"): name for name in ODS}


def layer_of(table: str) -> str:
    return next(layer for layer, tables in LAYERS.items() if table in tables)


def schema_of(table: str) -> T.StructType:
    """Schema of a layer table; an unknown name is an error."""
    if table not in TABLES:
        raise ValueError(f"unknown layer table: {table}")
    return T.StructType.fromDDL(TABLES[table])


def column_names(table: str) -> list[str]:
    return [field.split()[0] for field in TABLES[table].split(", ")]
