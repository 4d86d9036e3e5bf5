"""SQL counterparts of the queries, written apart from the Spark code.

DuckDB dialect over the given tables. ``_CTES`` are in dependency order; a
query gets those it names.
"""

from __future__ import annotations

import re

from tilldeck.operators.quality import REPORT_CLOSING, REPORT_HEADER, REPORT_TITLE, REPORT_TOTALS, RULES
from tilldeck.plans.catalog import (
    BEHAVIOR_DT,
    DASHBOARD_DT,
    EMPTIED_DT,
    GIVEN_TABLES,
    LIMIT_PER_TABLE,
    MEASURES,
    PROCESS_DT,
    RANGE,
    SAMPLE_FRACTION,
    SAMPLE_SEED,
)
from tilldeck.schemas import TABLES


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _div(n: str, d: str) -> str:
    return (
        f"CASE WHEN CAST({d} AS DOUBLE) = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"
    )


def _int(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber)"
_LINE_AMOUNT = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
)
_KEY = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"
_SALES = f"""{_int('sum(quantity)')} AS sales_quantity, {_dbl('sum(item_amount)')} AS sales_amount,
    count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS buyer_count"""

_CTES = {
    "orders_raw": f"""
        SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(NULL AS BIGINT) AS shop_id,
            o_orderdate AS order_time, lower(o_orderstatus) AS order_status,
            CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, CAST(CASE WHEN o_orderkey % 97 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS discount_amount,
            CAST(o_totalprice AS DECIMAL(18,2)) AS payable_amount, n_name AS province, n_name AS city,
            {_day('o_orderdate')} AS dt
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "items_raw": f"""
        SELECT {_LINE_ID} AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
            l_suppkey AS shop_id, CAST(l_quantity AS INTEGER) AS quantity, {_LINE_AMOUNT} AS item_amount,
            l_extendedprice / l_quantity AS sale_price
        FROM lineitem""",
    "items": """
        SELECT order_item_id, order_id, product_id, shop_id, quantity, item_amount, sale_price FROM (
            SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY order_id NULLS LAST,
                product_id NULLS LAST, shop_id NULLS LAST, quantity NULLS LAST, item_amount NULLS LAST,
                sale_price NULLS LAST) AS rn
            FROM items_raw WHERE quantity > 0 AND sale_price >= 0 AND item_amount >= 0 AND order_id IS NOT NULL)
        WHERE rn = 1""",
    "lines": """
        SELECT i.order_item_id, i.order_id, o.user_id, coalesce(o.shop_id, i.shop_id) AS shop_id, i.product_id,
            p_size AS category_id, coalesce(p_type, 'unknown') AS category_name, p_brand AS brand,
            CAST(NULL AS VARCHAR) AS sku_id, i.quantity, i.sale_price, i.item_amount, o.total_amount,
            o.discount_amount, o.payable_amount, o.order_status, o.order_time, o.province, o.city, o.dt
        FROM items i JOIN orders_raw o ON i.order_id = o.order_id LEFT JOIN part ON i.product_id = p_partkey
        WHERE o.user_id IS NOT NULL AND o.total_amount >= 0 AND o.payable_amount >= 0""",
    "order_facts": """
        SELECT order_id, user_id, order_time, order_status, dt, max(total_amount) AS total_amount,
            max(discount_amount) AS discount_amount, max(payable_amount) AS payable_amount,
            sum(quantity) AS item_quantity
        FROM lines GROUP BY order_id, user_id, order_time, order_status, dt""",
    "payments": f"""
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id,
            CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - CASE WHEN o_orderkey % 83 = 0 THEN 4 ELSE 0 END AS INTEGER) AS pay_time,
            CAST(NULL AS VARCHAR) AS pay_method, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 89 = 0 THEN 7 ELSE 0 END AS DECIMAL(18,2)) AS pay_amount,
            CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'success' ELSE 'processing' END AS pay_status,
            {_day('CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - CASE WHEN o_orderkey % 83 = 0 THEN 4 ELSE 0 END AS INTEGER)')} AS dt
        FROM orders""",
    "paid": "SELECT * FROM payments WHERE pay_status = 'success' AND pay_amount >= 0",
    "refunds_raw": f"""
        SELECT {_LINE_ID} AS refund_id, l_orderkey AS order_id, o_custkey AS user_id, l_shipdate AS refund_time,
            {_LINE_AMOUNT} AS refund_amount, o_orderpriority AS refund_reason,
            CASE l_linestatus WHEN 'F' THEN 'approved' ELSE 'pending' END AS refund_status,
            {_day('l_shipdate')} AS dt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "refunds": """
        SELECT refund_id, order_id, user_id, refund_time, refund_amount, refund_reason, refund_status, dt FROM (
            SELECT *, row_number() OVER (PARTITION BY refund_id ORDER BY order_id NULLS LAST, user_id NULLS LAST,
                refund_time NULLS LAST, refund_amount NULLS LAST, refund_reason NULLS LAST,
                refund_status NULLS LAST, dt NULLS LAST) AS rn
            FROM refunds_raw WHERE refund_amount >= 0)
        WHERE rn = 1""",
    "approved": "SELECT * FROM refunds WHERE refund_status = 'approved'",
    "user_events_raw": f"""
        SELECT event_id, user_id, {_KEY} AS product_id, CAST(NULL AS BIGINT) AS shop_id,
            CASE event_type WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'pay' WHEN 'signup' THEN 'search'
                ELSE event_type END AS event_type,
            ts AS event_time, CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS device_type,
            CAST(NULL AS VARCHAR) AS source_channel, {_day('ts')} AS dt
        FROM events""",
    "user_events": """
        SELECT * FROM user_events_raw
        WHERE event_id IS NOT NULL AND user_id IS NOT NULL
            AND event_type IN ('view', 'search', 'cart', 'favorite', 'order', 'pay')""",
    "stock_raw": f"""
        SELECT * EXCLUDE (odd), before_quantity + change_quantity + odd AS after_quantity FROM (
            SELECT CAST(l_orderkey % 101 = 0 AS INTEGER) AS odd, {_LINE_ID} AS inventory_log_id, l_partkey AS product_id, l_suppkey AS shop_id,
                CASE WHEN l_returnflag = 'R' THEN 'refund_in' ELSE 'sale_out' END AS change_type,
                CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS INTEGER) AS change_quantity,
                CAST(1000 + l_partkey % 500 AS INTEGER) AS before_quantity,
                l_shipdate AS change_time, {_day('l_shipdate')} AS dt
            FROM lineitem)""",
    "stock": """
        SELECT inventory_log_id, product_id, shop_id, change_type, change_quantity, before_quantity,
            after_quantity, change_time, dt
        FROM (
            SELECT *, row_number() OVER (PARTITION BY inventory_log_id ORDER BY product_id NULLS LAST,
                shop_id NULLS LAST, change_type NULLS LAST, change_quantity NULLS LAST,
                before_quantity NULLS LAST, after_quantity NULLS LAST, change_time NULLS LAST,
                dt NULLS LAST) AS rn
            FROM stock_raw WHERE before_quantity >= 0 AND after_quantity >= 0)
        WHERE rn = 1""",
    "stock_day": f"""
        SELECT dt, product_id, shop_id,
            {_int('sum(CASE WHEN change_quantity > 0 THEN change_quantity ELSE 0 END)')} AS in_quantity,
            {_int('sum(CASE WHEN change_quantity < 0 THEN -change_quantity ELSE 0 END)')} AS out_quantity,
            max(CASE WHEN rn = 1 THEN after_quantity END) AS ending_quantity,
            avg(before_quantity) AS avg_before_quantity
        FROM (
            SELECT *, row_number() OVER (PARTITION BY dt, product_id, shop_id
                ORDER BY change_time DESC, inventory_log_id DESC) AS rn
            FROM stock)
        GROUP BY dt, product_id, shop_id""",
    "order_days": """
        SELECT dt, count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS order_user_count,
            sum(payable_amount) AS gmv
        FROM order_facts GROUP BY dt""",
    "pay_days": """
        SELECT dt, count(DISTINCT order_id) AS pay_order_count, count(DISTINCT user_id) AS pay_user_count,
            sum(pay_amount) AS pay_amount
        FROM paid GROUP BY dt""",
    "refund_days": """
        SELECT dt, count(DISTINCT order_id) AS refund_order_count, sum(refund_amount) AS refund_amount
        FROM approved GROUP BY dt""",
    "trade": f"""
        SELECT dt, gmv, order_count, order_user_count, pay_order_count, pay_user_count, pay_amount,
            {_div('pay_order_count', 'order_count')} AS pay_conversion_rate,
            {_div('pay_amount', 'pay_order_count')} AS avg_order_value,
            refund_order_count, refund_amount, {_div('refund_amount', 'pay_amount')} AS refund_rate
        FROM (
            SELECT o.dt, {_dbl('gmv')} AS gmv, order_count, order_user_count,
                coalesce(pay_order_count, 0) AS pay_order_count, coalesce(pay_user_count, 0) AS pay_user_count,
                {_dbl('coalesce(pay_amount, 0)')} AS pay_amount,
                coalesce(refund_order_count, 0) AS refund_order_count,
                {_dbl('coalesce(refund_amount, 0)')} AS refund_amount
            FROM order_days o LEFT JOIN pay_days p ON o.dt = p.dt LEFT JOIN refund_days r ON o.dt = r.dt)""",
    "user_pay": """
        SELECT dt, user_id, count(DISTINCT order_id) AS pay_order_count, sum(pay_amount) AS pay_amount
        FROM paid GROUP BY dt, user_id""",
    "repeats": f"""
        SELECT dt, paid_users, repeat_paid_users, {_div('repeat_paid_users', 'paid_users')} AS repeat_purchase_rate
        FROM (
            SELECT dt, count(DISTINCT user_id) AS paid_users,
                count(DISTINCT CASE WHEN pay_order_count >= 2 THEN user_id END) AS repeat_paid_users
            FROM user_pay WHERE pay_order_count > 0 GROUP BY dt)""",
    "dashboards": """
        SELECT t.*, coalesce(r.repeat_purchase_rate, CAST(0 AS DOUBLE)) AS repeat_purchase_rate
        FROM trade t LEFT JOIN repeats r ON t.dt = r.dt""",
    "active": "SELECT DISTINCT user_id, CAST(dt AS DATE) AS active_on FROM user_events",
    "retention": f"""
        SELECT strftime(cohort, '%Y-%m-%d') AS cohort_dt, CAST(day_diff AS INTEGER) AS day_diff, cohort_users,
            retained_users, {_div('retained_users', 'cohort_users')} AS retention_rate,
            strftime(cohort, '%Y-%m-%d') AS dt
        FROM (
            SELECT c.active_on AS cohort, date_diff('day', c.active_on, a.active_on) AS day_diff,
                count(DISTINCT c.user_id) AS retained_users
            FROM active c JOIN active a ON c.user_id = a.user_id
            WHERE date_diff('day', c.active_on, a.active_on) IN (1, 7)
            GROUP BY c.active_on, date_diff('day', c.active_on, a.active_on)) r
        JOIN (SELECT active_on, count(DISTINCT user_id) AS cohort_users FROM active GROUP BY active_on) s
            ON r.cohort = s.active_on""",
    "product_days": f"""
        SELECT dt, product_id, category_id, category_name, brand, {_SALES}
        FROM lines GROUP BY dt, product_id, category_id, category_name, brand""",
    "shop_days": f"SELECT dt, shop_id, {_SALES} FROM lines GROUP BY dt, shop_id",
    "category_days": f"""
        SELECT dt, category_id, category_name, {_SALES} FROM lines GROUP BY dt, category_id, category_name""",
    "rfm_base": f"""
        SELECT user_id,
            CAST(date_diff('day', CAST(max(pay_time) AS DATE), DATE '{PROCESS_DT}') AS INTEGER) AS recency_days,
            count(DISTINCT order_id) AS frequency, {_dbl('sum(pay_amount)')} AS monetary
        FROM paid GROUP BY user_id""",
    "rfm": f"""
        SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN '高价值用户'
                WHEN r_score >= 4 AND f_score >= 3 THEN '潜力用户'
                WHEN r_score <= 2 THEN '流失风险用户' ELSE '一般用户' END AS user_segment,
            '{PROCESS_DT}' AS dt
        FROM (
            SELECT *,
                CASE WHEN recency_days <= 7 THEN 5 WHEN recency_days <= 30 THEN 4 WHEN recency_days <= 60 THEN 3
                    WHEN recency_days <= 90 THEN 2 ELSE 1 END AS r_score,
                CASE WHEN frequency >= 10 THEN 5 WHEN frequency >= 5 THEN 4 WHEN frequency >= 3 THEN 3
                    WHEN frequency >= 2 THEN 2 ELSE 1 END AS f_score,
                CASE WHEN monetary >= 10000 THEN 5 WHEN monetary >= 5000 THEN 4 WHEN monetary >= 2000 THEN 3
                    WHEN monetary >= 500 THEN 2 ELSE 1 END AS m_score
            FROM rfm_base)""",
    "refund_groups": f"""
        SELECT dt, refund_reason, refund_status, count(DISTINCT refund_id) AS refund_count,
            count(DISTINCT order_id) AS refund_order_count, {_dbl('sum(refund_amount)')} AS refund_amount
        FROM refunds GROUP BY dt, refund_reason, refund_status""",
    "turnover": f"""
        SELECT dt, product_id, shop_id, sales_quantity, sales_amount, in_quantity, out_quantity, ending_quantity,
            avg_inventory, {_div('sales_quantity', 'avg_inventory')} AS inventory_turnover_rate
        FROM (
            SELECT i.dt, i.product_id, i.shop_id, {_int('coalesce(s.sales_quantity, 0)')} AS sales_quantity,
                {_dbl('coalesce(s.sales_amount, 0)')} AS sales_amount, in_quantity, out_quantity, ending_quantity,
                (avg_before_quantity + ending_quantity) / 2 AS avg_inventory
            FROM stock_day i LEFT JOIN (
                SELECT dt, product_id, sum(quantity) AS sales_quantity, sum(item_amount) AS sales_amount
                FROM lines GROUP BY dt, product_id) s
            ON i.dt = s.dt AND i.product_id = s.product_id)""",
    "behavior_rows": f"""
        SELECT user_id AS client_id, ts AS event_time, 'synerise_recsys_2025' AS source_dataset,
            CASE event_type WHEN 'view' THEN 'page_visit' WHEN 'signup' THEN 'search_query'
                WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
                WHEN 'purchase' THEN 'product_buy' END AS source_event_type,
            CASE event_type WHEN 'view' THEN 'view' WHEN 'signup' THEN 'search' WHEN 'click' THEN 'cart'
                WHEN 'error' THEN 'remove_cart' WHEN 'purchase' THEN 'pay' END AS event_type,
            CASE WHEN event_type IN ('click', 'error', 'purchase') THEN {_KEY} END AS sku,
            CASE WHEN event_type = 'view' THEN {_KEY} END AS url_id,
            CASE WHEN event_type = 'signup' THEN props END AS query_text, {_day('ts')} AS dt
        FROM events WHERE event_type IN ('view', 'signup', 'click', 'error', 'purchase') AND user_id IS NOT NULL
            AND ts IS NOT NULL""",
    "behavior_ids": """
        SELECT *, sha256(concat_ws('||', source_dataset, source_event_type, CAST(client_id AS VARCHAR),
                strftime(event_time, '%Y-%m-%d %H:%M:%S'), coalesce(CAST(sku AS VARCHAR), ''),
                coalesce(CAST(url_id AS VARCHAR), ''), coalesce(query_hash, ''))) AS event_id
        FROM (SELECT *, sha256(query_text) AS query_hash FROM behavior_rows)""",
    "behavior": """
        SELECT event_id, client_id, 'syn_u_' || client_id AS user_id, event_type, source_event_type, event_time,
            sku, 'syn_sku_' || sku AS product_id, CAST(p_size AS BIGINT) AS category_id,
            p_retailprice AS product_price, p_name AS product_name, url_id, query_hash, query_text,
            source_dataset, dt
        FROM behavior_ids LEFT JOIN part ON sku = p_partkey""",
    "behavior_types": """
        SELECT dt, event_type, count(*) AS event_count, count(DISTINCT client_id) AS active_user_count,
            count(DISTINCT sku) AS active_sku_count
        FROM behavior GROUP BY dt, event_type""",
    "behavior_days": f"""
        SELECT *, {_div('cart_user_count', 'view_user_count')} AS view_to_cart_rate,
            {_div('pay_user_count', 'cart_user_count')} AS cart_to_pay_rate,
            {_div('pay_user_count', 'view_user_count')} AS view_to_pay_rate
        FROM (
            SELECT dt, count(*) AS event_count, count(DISTINCT client_id) AS active_user_count,
                {', '.join(
                    f"count(DISTINCT CASE WHEN event_type = '{s}' THEN client_id END) AS {s}_user_count"
                    for s in ('view', 'search', 'cart', 'remove_cart', 'pay'))},
                {', '.join(
                    f"count(*) FILTER (WHERE event_type = '{s}') AS {s}_event_count"
                    for s in ('view', 'search', 'cart', 'remove_cart', 'pay'))}
            FROM behavior GROUP BY dt)""",
    "sku_days": """
        SELECT dt, sku, category_id, product_name, count(*) AS event_count,
            count(*) FILTER (WHERE event_type = 'cart') AS cart_event_count,
            count(*) FILTER (WHERE event_type = 'remove_cart') AS remove_cart_event_count,
            count(*) FILTER (WHERE event_type = 'pay') AS pay_event_count,
            count(DISTINCT client_id) AS active_user_count,
            CAST(sum(CAST(product_price AS DECIMAL(28,10))) AS DOUBLE) / nullif(count(product_price), 0)
                AS avg_product_price
        FROM behavior WHERE sku IS NOT NULL GROUP BY dt, sku, category_id, product_name""",
    "sku_category_days": """
        SELECT dt, category_id, count(*) AS event_count,
            count(*) FILTER (WHERE event_type = 'cart') AS cart_event_count,
            count(*) FILTER (WHERE event_type = 'remove_cart') AS remove_cart_event_count,
            count(*) FILTER (WHERE event_type = 'pay') AS pay_event_count,
            count(DISTINCT client_id) AS active_user_count, count(DISTINCT sku) AS active_sku_count
        FROM behavior WHERE sku IS NOT NULL GROUP BY dt, category_id""",
    "dense_day": """
        SELECT max(dt) AS dt FROM behavior_days
        WHERE (SELECT max(event_count) FROM behavior_days) <= 0
            OR event_count >= (SELECT max(event_count) FROM behavior_days) * 0.1""",
    "raw_lines": """
        SELECT i.order_item_id, i.order_id, o.user_id, CASE WHEN i.order_id % 103 <> 0 THEN i.product_id END AS product_id,
            CASE WHEN i.order_id % 107 <> 0 THEN i.shop_id ELSE -1 END AS shop_id, o.dt
        FROM items_raw i JOIN orders_raw o ON i.order_id = o.order_id""",
    "raw_payments": """
        SELECT p.*, o.order_time, o.payable_amount AS order_payable_amount
        FROM payments p LEFT JOIN orders_raw o ON p.order_id = o.order_id""",
    "raw_refunds": """
        SELECT r.*, p.pay_amount AS paid_amount FROM refunds_raw r LEFT JOIN paid p ON r.order_id = p.order_id""",
}


def _blank(columns: str) -> str:
    return " OR ".join(f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''" for c in columns.split())


# Number of rows that break each rule.
_BROKEN = {
    "DQ001": "SELECT count(*) AS n FROM (SELECT order_item_id FROM items_raw JOIN orders_raw "
    "ON items_raw.order_id = orders_raw.order_id GROUP BY order_item_id HAVING count(*) > 1)",
    "DQ002": f"SELECT count(*) AS n FROM raw_lines WHERE {_blank('order_id user_id product_id shop_id dt')}",
    "DQ003": "SELECT count(*) AS n FROM orders_raw WHERE total_amount < 0 OR discount_amount < 0 "
    "OR payable_amount < 0 OR abs(total_amount - discount_amount - payable_amount) > 1",
    "DQ004": "SELECT count(*) AS n FROM raw_payments WHERE pay_status = 'success' "
    "AND abs(pay_amount - order_payable_amount) > 1",
    "DQ005": "SELECT count(*) AS n FROM raw_payments WHERE pay_time < order_time",
    "DQ006": "SELECT count(*) AS n FROM raw_refunds WHERE refund_amount > paid_amount",
    "DQ007": "SELECT count(*) AS n FROM raw_lines l WHERE NOT EXISTS (SELECT 1 FROM customer "
    "WHERE c_custkey = l.user_id) OR NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l.product_id) "
    "OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l.shop_id)",
    "DQ008": "SELECT date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) + 1 "
    "- (SELECT count(DISTINCT dt) FROM raw_lines) AS n FROM orders",
    "DQ009": "SELECT count(*) AS n FROM user_events_raw "
    "WHERE lower(event_type) NOT IN ('view', 'search', 'cart', 'favorite', 'order', 'pay')",
    "DQ010": "SELECT count(*) AS n FROM stock_raw WHERE before_quantity < 0 OR after_quantity < 0 "
    "OR before_quantity + change_quantity <> after_quantity OR abs(change_quantity) > 100000",
    "DQ011": "SELECT count(*) AS n FROM (SELECT order_id - CAST(order_id % 113 = 1 AS INTEGER) FROM payments "
    "GROUP BY 1 HAVING count(*) > 1)",
    "DQ012": "SELECT count(*) AS n FROM refunds_raw WHERE order_id % 109 = 0 OR "
    f"{_blank('refund_id order_id user_id refund_time dt')}",
}


def _rule(rule: str) -> str:
    name, table, description = RULES[rule]
    return f"""SELECT '{rule}' AS rule_id, '{name}' AS rule_name, '{table}' AS table_name,
        CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, {_int('n')} AS error_count,
        '{description}' AS description FROM ({_BROKEN[rule]})"""


_CTES["checks"] = " UNION ALL ".join(_rule(rule) for rule in RULES)

_DETAIL = f"""SELECT event_id, client_id, user_id, event_type, source_event_type, {_ts('event_time')} AS event_time,
    sku, product_id, category_id, product_price, product_name, url_id, query_hash, query_text, source_dataset, dt"""
_LINE = f"""SELECT order_item_id, order_id, user_id, shop_id, product_id, category_id, category_name, brand, sku_id,
    quantity, sale_price, {_dbl('item_amount')} AS item_amount, {_dbl('total_amount')} AS total_amount,
    {_dbl('discount_amount')} AS discount_amount, {_dbl('payable_amount')} AS payable_amount, order_status,
    {_ts('order_time')} AS order_time, province, city, dt"""
_EVENT = f"""event_id, user_id, product_id, shop_id, event_type, {_ts('event_time')} AS event_time, session_id,
    device_type, source_channel, dt"""


def _top(table: str, by: str, ties: str, keep: int, extra: str = "") -> str:
    order = ", ".join([f"{c} DESC" for c in by.split()] + [f"{c} NULLS LAST" for c in ties.split()])
    return f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY dt ORDER BY {order}) AS INTEGER)
        AS rank_no FROM {table}) WHERE rank_no <= {keep}"""


def _section(table: str, day: str, section: str, by: str, keys: str) -> str:
    names = keys.split()
    item = " || '/' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in names)
    order = ", ".join([f"{by} DESC NULLS LAST"] + [f"{k} NULLS LAST" for k in names])
    return f"""SELECT * FROM (SELECT '{section}' AS section, dt, {item} AS item,
        round(CAST({by} AS DOUBLE), 6) AS value FROM {table} WHERE dt = ({day}) ORDER BY {order} LIMIT 10)"""


_USER_DAY = f"""
    SELECT coalesce(o.dt, p.dt, r.dt, e.dt) AS dt, coalesce(o.user_id, p.user_id, r.user_id, e.user_id) AS user_id,
        coalesce(order_count, 0) AS order_count, {_dbl('coalesce(order_amount, 0)')} AS order_amount,
        coalesce(pay_order_count, 0) AS pay_order_count, {_dbl('coalesce(pay_amount, 0)')} AS pay_amount,
        coalesce(refund_order_count, 0) AS refund_order_count,
        {_dbl('coalesce(refund_amount, 0)')} AS refund_amount, coalesce(event_count, 0) AS event_count,
        coalesce(view_count, 0) AS view_count, coalesce(cart_count, 0) AS cart_count
    FROM (SELECT dt, user_id, count(DISTINCT order_id) AS order_count, sum(payable_amount) AS order_amount
            FROM order_facts GROUP BY dt, user_id) o
    FULL JOIN user_pay p ON o.dt = p.dt AND o.user_id = p.user_id
    FULL JOIN (SELECT dt, user_id, count(DISTINCT order_id) AS refund_order_count,
            sum(refund_amount) AS refund_amount FROM approved GROUP BY dt, user_id) r
        ON coalesce(o.dt, p.dt) = r.dt AND coalesce(o.user_id, p.user_id) = r.user_id
    FULL JOIN (SELECT dt, user_id, count(*) AS event_count,
            count(*) FILTER (WHERE event_type = 'view') AS view_count,
            count(*) FILTER (WHERE event_type = 'cart') AS cart_count FROM user_events GROUP BY dt, user_id) e
        ON coalesce(o.dt, p.dt, r.dt) = e.dt AND coalesce(o.user_id, p.user_id, r.user_id) = e.user_id"""

_BY_ORDER_DATE = f"""
    SELECT o.dt, count(DISTINCT o.order_id) AS order_count, count(DISTINCT o.user_id) AS order_user_count,
        {_dbl('sum(o.payable_amount)')} AS gmv, count(DISTINCT p.order_id) AS pay_order_count,
        count(DISTINCT p.user_id) AS pay_user_count, {_dbl('sum(p.pay_amount)')} AS pay_amount,
        count(DISTINCT r.order_id) AS refund_order_count, {_dbl('sum(r.refund_amount)')} AS refund_amount
    FROM order_facts o
    LEFT JOIN (SELECT order_id, max(user_id) AS user_id, sum(pay_amount) AS pay_amount FROM paid GROUP BY order_id) p
        ON o.order_id = p.order_id
    LEFT JOIN (SELECT order_id, sum(refund_amount) AS refund_amount FROM approved GROUP BY order_id) r
        ON o.order_id = r.order_id
    GROUP BY o.dt"""

_FUNNEL = " UNION ALL ".join(
    f"""SELECT dt, {n} AS step_no, '{s}' AS step, {s}_event_count AS event_count,
        {_div(f'{s}_event_count',
              'greatest(1, view_event_count, search_event_count, cart_event_count, pay_event_count)')} AS share
        FROM behavior_days"""
    for n, s in enumerate(("view", "search", "cart", "pay"), start=1)
)
_APPROX = ", ".join(
    f"{s}_user_count, TRUE AS {s}_user_count_close" for s in ("active", "view", "search", "cart", "remove_cart", "pay")
)
_EVENT_ROWS = "SELECT dt, event_type, count(*) AS event_count FROM user_events GROUP BY dt, event_type"


def _count(table: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, {_int('count(*)')} AS row_count, "
        f"{_int('count(DISTINCT dt)')} AS day_count, min(dt) AS first_dt, max(dt) AS last_dt, "
        f"round(CAST(sum(CAST({MEASURES.get(table, 'NULL')} AS DECIMAL(28,4))) AS DOUBLE), 1) AS measure_sum "
        f"FROM ({source})"
    )


_BEHAVIOR_BUILD = " UNION ALL ".join(
    [
        _count(f"ods_synerise_{source}", f"SELECT dt FROM behavior_rows WHERE source_event_type = '{source}'")
        for source in ("page_visit", "search_query", "add_to_cart", "remove_from_cart", "product_buy")
    ]
    + [
        _count("ods_synerise_product_properties", f"SELECT '{BEHAVIOR_DT}' AS dt FROM part"),
        _count("dwd_synerise_user_behavior_detail", "SELECT dt FROM behavior"),
        _count("dws_synerise_behavior_day_summary", "SELECT * FROM behavior_days"),
        _count("dws_synerise_event_type_day_summary", "SELECT * FROM behavior_types"),
        _count("dws_synerise_product_day_summary", "SELECT * FROM sku_days"),
        _count("dws_synerise_category_day_summary", "SELECT * FROM sku_category_days"),
        _count("ads_synerise_behavior_dashboard_daily", "SELECT * FROM behavior_days"),
        _count("ads_synerise_event_type_trend", "SELECT * FROM behavior_types"),
        _count(
            "ads_synerise_product_topn",
            _top("sku_days", "pay_event_count cart_event_count", "sku category_id product_name", 50),
        ),
        _count(
            "ads_synerise_category_topn",
            _top("sku_category_days", "pay_event_count cart_event_count", "category_id", 50),
        ),
    ]
)

_SQL = {
    # sources and sinks
    "src_csv_roundtrip": f"""SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(shop_id AS VARCHAR) AS shop_id, {_ts('order_time')} AS order_time, order_status,
        {_dbl('total_amount')} AS total_amount, {_dbl('discount_amount')} AS discount_amount,
        {_dbl('payable_amount')} AS payable_amount, province, city, 'orders' AS source_table, dt FROM orders_raw""",
    "src_parquet_events": f"SELECT event_id, {_ts('ts')} AS ts, user_id, event_type, value, props FROM events",
    "layer_roundtrip": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(product_id AS VARCHAR) AS product_id, CAST(shop_id AS VARCHAR) AS shop_id, event_type,
        {_ts('event_time')} AS event_time, session_id, device_type, source_channel, dt FROM user_events""",
    "layer_append": _EVENT_ROWS,
    "layer_rerun_one_day": f"SELECT * FROM ({_EVENT_ROWS}) WHERE dt <> '{EMPTIED_DT}'",
    "ods_orders": f"""SELECT order_id, user_id, shop_id, {_ts('order_time')} AS order_time, order_status,
        {_dbl('total_amount')} AS total_amount, {_dbl('discount_amount')} AS discount_amount,
        {_dbl('payable_amount')} AS payable_amount, province, city, dt, 'orders' AS source_table FROM orders_raw""",
    "events_date_range": f"SELECT {_EVENT} FROM user_events_raw WHERE dt BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'",
    "dedup_order_items": f"""SELECT order_item_id, order_id, product_id, shop_id, quantity,
        {_dbl('item_amount')} AS item_amount, sale_price FROM items""",
    "behavior_sample": f"""SELECT event_id, {_ts('ts')} AS ts, user_id, event_type, value, props FROM events
        WHERE CAST('0x' || substr(sha256('{SAMPLE_SEED}|' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)
            < {round(SAMPLE_FRACTION * 2**32)}""",
    "behavior_limit": f"""SELECT event_id, client_id, 'syn_u_' || client_id AS user_id, event_type,
        source_event_type, {_ts('event_time')} AS event_time, sku, 'syn_sku_' || sku AS product_id,
        CAST(NULL AS BIGINT) AS category_id, CAST(NULL AS DOUBLE) AS product_price,
        CAST(NULL AS VARCHAR) AS product_name, url_id, query_hash, query_text, source_dataset, dt
        FROM (SELECT *, row_number() OVER (PARTITION BY source_event_type ORDER BY client_id NULLS FIRST, event_time NULLS FIRST,
                sku NULLS FIRST, url_id NULLS FIRST, query_text NULLS FIRST) AS rn
            FROM behavior_ids) WHERE rn <= {LIMIT_PER_TABLE}""",
    # expressions
    "scalar_text_clean": "SELECT o_orderkey, lower(trim('  ' || o_orderpriority || ' ')) AS cleaned FROM orders",
    "scalar_dates": f"""SELECT o_orderkey, {_day('d')} AS order_day, CAST(year(d) AS INTEGER) AS order_year,
        CAST(date_diff('day', DATE '1995-01-01', d) AS INTEGER) AS days_since
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)""",
    "scalar_safe_div": f"""SELECT l_orderkey, l_linenumber, {_div('l_extendedprice', 'd')} AS ratio
        FROM (SELECT *, CASE WHEN l_tax > 0 THEN l_discount END AS d FROM lineitem)""",
    "scalar_clean_value": """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'click')
        THEN round(value / 3, 6) END AS cleaned FROM events""",
    # dimensions
    "dim_user": f"""SELECT user_id, CAST(NULL AS VARCHAR) AS register_time, CAST(NULL AS VARCHAR) AS gender, age,
        CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' ELSE '45+' END
            AS age_group, city, user_level, channel, is_member, '{PROCESS_DT}' AS dt
        FROM (SELECT c_custkey AS user_id, CAST(18 + c_custkey % 43 AS INTEGER) AS age, n_name AS city,
            c_mktsegment AS user_level, r_name AS channel, CAST(c_acctbal > 5000 AS INTEGER) AS is_member
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "dim_product": f"""SELECT p_partkey AS product_id, p_name AS product_name, p_size AS category_id,
        p_type AS category_name, p_brand AS brand, CAST(NULL AS BIGINT) AS shop_id,
        {_dbl('CAST(p_retailprice AS DECIMAL(18,2))')} AS list_price, CAST(NULL AS DOUBLE) AS cost_price,
        CAST(NULL AS VARCHAR) AS create_time, 'active' AS status, '{PROCESS_DT}' AS dt FROM part""",
    "dim_shop": f"""SELECT s_suppkey AS shop_id, s_name AS shop_name, 'marketplace' AS shop_type, n_name AS city,
        CAST(NULL AS VARCHAR) AS open_time, s_acctbal AS score, '{PROCESS_DT}' AS dt
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "dim_category": f"""SELECT p_size AS category_id, min(p_type) AS category_name, 1 AS category_level,
        '{PROCESS_DT}' AS dt FROM part GROUP BY p_size""",
    "dim_category_distinct_pair": f"""SELECT DISTINCT p_size AS category_id, p_type AS category_name,
        1 AS category_level, '{PROCESS_DT}' AS dt FROM part WHERE p_size IS NOT NULL""",
    "dim_date": f"""SELECT {_day('d')} AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(dayofweek(d) IN (0, 6) AS INTEGER) AS is_weekend, {_day('d')} AS dt
        FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
            INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    # facts
    "trade_order_detail": f"{_LINE} FROM lines",
    "trade_order_detail_sql": f"""{_LINE} FROM (
        SELECT i.order_item_id, i.order_id, o.user_id, coalesce(o.shop_id, i.shop_id) AS shop_id, i.product_id,
            p_size AS category_id, p_type AS category_name, p_brand AS brand, CAST(NULL AS VARCHAR) AS sku_id,
            i.quantity, i.sale_price, i.item_amount, o.total_amount, o.discount_amount, o.payable_amount,
            o.order_status, o.order_time, o.province, o.city, o.dt
        FROM items_raw i JOIN orders_raw o ON i.order_id = o.order_id LEFT JOIN part ON i.product_id = p_partkey
        WHERE i.quantity > 0 AND i.item_amount >= 0 AND o.payable_amount >= 0)""",
    "payment_detail": f"""SELECT p.payment_id, p.order_id, p.user_id, o.shop_id, {_ts('p.pay_time')} AS pay_time,
        {_ts('o.order_time')} AS order_time, p.pay_method, {_dbl('p.pay_amount')} AS pay_amount,
        {_dbl('o.payable_amount')} AS order_payable_amount, p.pay_status, p.dt
        FROM payments p LEFT JOIN orders_raw o ON p.order_id = o.order_id WHERE p.pay_amount >= 0""",
    "refund_detail": f"""SELECT r.refund_id, r.order_id, r.user_id, {_ts('r.refund_time')} AS refund_time,
        {_dbl('r.refund_amount')} AS refund_amount, r.refund_reason, r.refund_status,
        p.payment_id AS paid_payment_id, {_dbl('p.pay_amount')} AS paid_amount, {_ts('p.pay_time')} AS pay_time, r.dt
        FROM refunds r LEFT JOIN paid p ON r.order_id = p.order_id""",
    "user_behavior_detail": f"SELECT {_EVENT} FROM user_events",
    "inventory_detail": f"""SELECT inventory_log_id, product_id, shop_id, change_type, change_quantity,
        before_quantity, after_quantity, {_ts('change_time')} AS change_time, dt FROM stock""",
    # retail summaries
    "order_fact": f"""SELECT order_id, user_id, {_ts('order_time')} AS order_time, order_status, dt,
        {_dbl('total_amount')} AS total_amount, {_dbl('discount_amount')} AS discount_amount,
        {_dbl('payable_amount')} AS payable_amount, {_int('item_quantity')} AS item_quantity FROM order_facts""",
    "trade_daily": "SELECT * FROM trade",
    "trade_by_order_date": _BY_ORDER_DATE,
    "user_daily": _USER_DAY,
    "product_daily": "SELECT * FROM product_days",
    "shop_daily": "SELECT * FROM shop_days",
    "category_daily": "SELECT * FROM category_days",
    "user_retention": "SELECT * FROM retention",
    "inventory_daily": "SELECT * FROM stock_day",
    # retail metrics
    **{
        f"metric_{m}": f"SELECT dt, {cast(f'sum({m})')} AS {m} FROM trade GROUP BY dt"
        for m, cast in {
            "gmv": _dbl,
            "order_count": _int,
            "order_user_count": _int,
            "pay_order_count": _int,
            "pay_user_count": _int,
            "pay_amount": _dbl,
        }.items()
    },
    "metric_pay_conversion_rate": "SELECT dt, pay_order_count, order_count, pay_conversion_rate FROM trade",
    "metric_avg_order_value": "SELECT dt, pay_amount, pay_order_count, avg_order_value FROM trade",
    "metric_refund_rate": "SELECT dt, refund_amount, pay_amount, refund_rate FROM trade",
    "metric_order_refund_rate": f"""SELECT dt, refund_order_count, pay_order_count,
        {_div('refund_order_count', 'pay_order_count')} AS order_refund_rate FROM trade""",
    "repeat_purchase_rate": "SELECT * FROM repeats",
    "metric_next_day_retention": """SELECT cohort_dt, cohort_users, retained_users AS next_day_retained_users,
        retention_rate AS next_day_retention_rate, dt FROM retention WHERE day_diff = 1""",
    "metric_seven_day_retention": """SELECT cohort_dt, cohort_users, retained_users AS seven_day_retained_users,
        retention_rate AS seven_day_retention_rate, dt FROM retention WHERE day_diff = 7""",
    "retail_dashboard": "SELECT * FROM dashboards",
    "product_topn": f"""SELECT t.*, p_name AS product_name, CAST(NULL AS BIGINT) AS shop_id
        FROM ({_top('product_days', 'sales_amount sales_quantity', 'product_id category_id category_name brand', 20)}) t
        LEFT JOIN part ON t.product_id = p_partkey""",
    "category_topn": _top("category_days", "sales_amount", "category_id category_name", 20),
    "shop_rank": f"""SELECT t.*, s_name AS shop_name, 'marketplace' AS shop_type, n_name AS city
        FROM ({_top('shop_days', 'sales_amount', 'shop_id', 100)}) t
        LEFT JOIN supplier ON t.shop_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "rfm_segment": "SELECT * FROM rfm",
    "rfm_segment_threshold": f"""SELECT *, CASE
        WHEN recency_days <= 7 AND frequency >= 10 AND monetary >= 10000 THEN '高价值用户'
        WHEN recency_days <= 30 AND frequency >= 3 THEN '潜力用户'
        WHEN recency_days > 60 THEN '流失风险用户' ELSE '一般用户' END AS user_segment,
        '{PROCESS_DT}' AS dt FROM rfm_base""",
    "refund_analysis": "SELECT * FROM refund_groups",
    "inventory_turnover": "SELECT * FROM turnover",
    # behaviour
    "behavior_ods_page_visit": f"""SELECT user_id AS client_id, CAST(ts AS VARCHAR) AS raw_timestamp,
        {_ts('ts')} AS event_time, {_KEY} AS url, {_day('ts')} AS dt,
        'synerise_recsys_2025' AS source_dataset, 'page_visit' AS source_table
        FROM events WHERE event_type = 'view' AND ts IS NOT NULL""",
    "behavior_product_properties": f"""SELECT p_partkey AS sku, CAST(p_size AS BIGINT) AS category_id,
        p_retailprice AS price, p_name AS product_name, '{BEHAVIOR_DT}' AS dt,
        'synerise_recsys_2025' AS source_dataset, 'product_properties' AS source_table FROM part""",
    "behavior_detail": f"{_DETAIL} FROM behavior",
    "behavior_detail_dedup": f"""{_DETAIL} FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY event_time) AS rn FROM behavior) WHERE rn = 1""",
    "behavior_subset_sku_only": f"""{_DETAIL} FROM behavior
        WHERE source_event_type IN ('add_to_cart', 'remove_from_cart', 'product_buy')""",
    "behavior_event_id": f"""SELECT client_id, source_event_type, {_ts('event_time')} AS event_time, event_id,
        query_hash FROM behavior_ids""",
    "behavior_event_type_daily": "SELECT * FROM behavior_types",
    "behavior_daily": "SELECT * FROM behavior_days",
    "behavior_daily_approx": f"SELECT dt, {_APPROX} FROM behavior_days",
    "behavior_users_of_ranges": """SELECT strftime(CAST(d.dt AS DATE) - 6, '%Y-%m-%d') AS first_dt, d.dt AS last_dt,
        count(DISTINCT b.client_id) AS active_users,
        count(DISTINCT b.client_id) FILTER (WHERE b.event_type = 'pay') AS pay_users,
        true AS active_estimate_near, true AS pay_estimate_near
        FROM behavior_days d JOIN behavior b ON CAST(b.dt AS DATE) BETWEEN CAST(d.dt AS DATE) - 6 AND CAST(d.dt AS DATE)
        GROUP BY d.dt""",
    "metric_tables_by_name": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, dt, count(*) AS row_count, {_int('sum(event_count)')} AS event_count "
        f"FROM ({source}) GROUP BY dt"
        for table, source in {
            "ads_synerise_behavior_dashboard_daily": "SELECT * FROM behavior_days",
            "ads_synerise_event_type_trend": "SELECT * FROM behavior_types",
            "ads_synerise_product_topn": _top(
                "sku_days", "pay_event_count cart_event_count", "sku category_id product_name", 50
            ),
            "ads_synerise_category_topn": _top(
                "sku_category_days", "pay_event_count cart_event_count", "category_id", 50
            ),
        }.items()
    ),
    "behavior_product_daily": "SELECT * FROM sku_days",
    "behavior_category_daily": "SELECT * FROM sku_category_days",
    "behavior_product_topn": _top(
        "sku_days", "pay_event_count cart_event_count", "sku category_id product_name", 50
    ),
    "behavior_category_topn": _top("sku_category_days", "pay_event_count cart_event_count", "category_id", 50),
    # quality
    "dq001_dup_order_item": _rule("DQ001"),
    "dq002_null_order_keys": _rule("DQ002"),
    "dq003_order_amount": _rule("DQ003"),
    "dq004_pay_amount": _rule("DQ004"),
    "dq005_pay_before_order": _rule("DQ005"),
    "dq006_refund_over_paid": _rule("DQ006"),
    "dq007_dim_missing": _rule("DQ007"),
    "dq008_missing_days": _rule("DQ008"),
    "dq009_bad_event_type": _rule("DQ009"),
    "dq010_inventory": _rule("DQ010"),
    "dq011_dup_payment": _rule("DQ011"),
    "dq012_null_refund_keys": _rule("DQ012"),
    "dq_checks": "SELECT * FROM checks",
    "dq_summary": """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS passed,
        count(*) FILTER (WHERE status <> 'PASS') AS failed FROM checks""",
    "dq_report": f"""SELECT 0 AS line_no, '{REPORT_TITLE}' AS line UNION ALL SELECT 1, ''
        UNION ALL SELECT 2, replace('{REPORT_TOTALS[0]}', '{{}}', CAST(count(*) AS VARCHAR)) FROM checks
        UNION ALL SELECT 3, replace('{REPORT_TOTALS[1]}', '{{}}',
            CAST(count(*) FILTER (WHERE status = 'PASS') AS VARCHAR)) FROM checks
        UNION ALL SELECT 4, replace('{REPORT_TOTALS[2]}', '{{}}',
            CAST(count(*) FILTER (WHERE status <> 'PASS') AS VARCHAR)) FROM checks
        UNION ALL SELECT 5, '' UNION ALL SELECT 6, '{REPORT_HEADER[0]}' UNION ALL SELECT 7, '{REPORT_HEADER[1]}'
        UNION ALL SELECT CAST(7 + CAST(substr(rule_id, 3, 3) AS INTEGER) AS INTEGER), '| ' || rule_id || ' | ' || rule_name || ' | `'
            || table_name || '` | ' || status || ' | ' || error_count || ' | ' || description || ' |' FROM checks
        UNION ALL SELECT 20, '' UNION ALL SELECT 21, '{REPORT_CLOSING[0]}' UNION ALL SELECT 22, ''
        UNION ALL SELECT 23, '{REPORT_CLOSING[1]}'""",
    # reports
    "latest_dt": """SELECT greatest((SELECT max(dt) FROM lines), (SELECT max(dt) FROM retention),
        (SELECT max(dt) FROM refunds), (SELECT max(dt) FROM stock)) AS latest_dt""",
    "latest_non_sparse_dt": "SELECT dt AS latest_dt FROM dense_day",
    "latest_kpis": "SELECT * FROM dashboards WHERE dt = (SELECT max(dt) FROM dashboards)",
    "latest_behavior_kpis": "SELECT * FROM behavior_days WHERE dt = (SELECT dt FROM dense_day)",
    "latest_day_topn": " UNION ALL ".join(
        [
            _section(
                "product_days", "SELECT max(dt) FROM order_days", "products", "sales_amount", "product_id category_id"
            ),
            _section(
                "category_days",
                "SELECT max(dt) FROM order_days",
                "categories",
                "sales_amount",
                "category_id category_name",
            ),
            _section("shop_days", "SELECT max(dt) FROM order_days", "shops", "sales_amount", "shop_id"),
            _section(
                "refund_groups",
                "SELECT max(dt) FROM refund_groups",
                "refunds",
                "refund_amount",
                "refund_reason refund_status",
            ),
            _section(
                "turnover",
                "SELECT max(dt) FROM turnover",
                "turnover",
                "inventory_turnover_rate",
                "product_id shop_id",
            ),
            _section("sku_days", "SELECT dt FROM dense_day", "skus", "pay_event_count", "sku category_id"),
        ]
    ),
    "latest_retention": """SELECT * FROM retention WHERE dt = (SELECT max(dt) FROM retention)
        ORDER BY cohort_dt, day_diff LIMIT 20""",
    "rfm_segment_rollup": f"""SELECT user_segment, count(user_id) AS user_count, {_dbl('sum(m)')} AS monetary
        FROM (SELECT r.user_segment, r.user_id, p.m FROM rfm r JOIN (
            SELECT user_id, sum(pay_amount) AS m FROM paid GROUP BY user_id) p ON r.user_id = p.user_id)
        GROUP BY user_segment""",
    "period_kpis": """SELECT round(g, 2) AS gmv, round(p, 2) AS pay_amount,
        round(po / greatest(o, 1), 4) AS pay_conversion_rate, round(p / greatest(po, 1), 2) AS avg_order_value,
        round(1 - pu / greatest(po, 1), 4) AS repeat_purchase_rate, round(r / greatest(p, 1), 4) AS refund_rate
        FROM (SELECT CAST(sum(gmv) AS DOUBLE) AS g, CAST(sum(order_count) AS DOUBLE) AS o,
                CAST(sum(p.pay_amount) AS DOUBLE) AS p, CAST(sum(p.pay_order_count) AS DOUBLE) AS po,
                CAST(sum(p.pay_user_count) AS DOUBLE) AS pu, CAST(sum(r.refund_amount) AS DOUBLE) AS r
            FROM order_days d LEFT JOIN pay_days p ON d.dt = p.dt LEFT JOIN refund_days r ON d.dt = r.dt)""",
    "recent_days_window": f"""SELECT dt, order_count, order_user_count, {_dbl('gmv')} AS gmv FROM order_days
        WHERE dt IN (SELECT dt FROM order_days WHERE dt <= '2000-12-31' ORDER BY dt DESC LIMIT 42)""",
    "funnel_steps": _FUNNEL,
    "event_heatmap": """SELECT d.dt, t.event_type, coalesce(b.event_count, 0) AS event_count,
        round(sqrt(coalesce(b.event_count, 0) / greatest(1, (SELECT max(event_count) FROM behavior_types))), 6)
            AS intensity
        FROM (SELECT DISTINCT dt FROM behavior_types) d,
            (VALUES ('view'), ('search'), ('cart'), ('remove_cart'), ('pay')) t(event_type)
        LEFT JOIN behavior_types b ON b.dt = d.dt AND b.event_type = t.event_type""",
    "conversion_lift": f"""SELECT dt, round(coalesce(view_to_pay_rate, 0), 6) AS view_to_pay_rate,
        round(m, 6) AS window_mean, round({_div('coalesce(view_to_pay_rate, 0) - m', 'm')}, 6) AS lift
        FROM behavior_days, (SELECT avg(coalesce(view_to_pay_rate, 0)) AS m FROM behavior_days)""",
    "conversion_scatter": """SELECT dt,
        round(active_user_count / greatest(1, (SELECT max(active_user_count) FROM behavior_days)), 6) AS user_scale,
        round(view_to_pay_rate / greatest(0.001, (SELECT max(view_to_pay_rate) FROM behavior_days)), 6) AS rate_scale,
        round(event_count / greatest(1, (SELECT max(event_count) FROM behavior_days)), 6) AS event_scale
        FROM behavior_days""",
    # whole builds
    "behavior_layers_build": _BEHAVIOR_BUILD,
}


# Columns of the given tables: numbers, texts, times and nested ones.
_GIVEN_COLUMNS = {
    "region": ("r_regionkey", "r_name", "", ""),
    "nation": ("n_nationkey n_regionkey", "n_name", "", ""),
    "customer": ("c_custkey c_nationkey c_acctbal", "c_name c_mktsegment", "", ""),
    "supplier": ("s_suppkey s_nationkey s_acctbal", "s_name", "", ""),
    "part": ("p_partkey p_size p_retailprice", "p_name p_brand p_type", "", ""),
    "orders": ("o_orderkey o_custkey o_totalprice", "o_orderstatus o_orderpriority", "o_orderdate", ""),
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax",
        "l_returnflag l_linestatus",
        "l_shipdate",
        "",
    ),
    "events": ("event_id user_id value", "event_type props", "ts", ""),
    "documents": ("doc_id n_chars", "text lang source", "", ""),
    "embeddings": ("vec_id label", "", "", "embedding"),
    "pages": ("page_id", "url html", "", ""),
    "benchmark": ("item_id", "text", "", ""),
    "labels": ("doc_id quality toxic", "", "", ""),
    "conversations": ("conv_id turn", "role text", "", ""),
}


def _limits(table: str, column: str, text: str = "CAST(NULL AS VARCHAR)", number: str = "CAST(NULL AS DOUBLE)") -> str:
    ends = ", ".join(
        f"{value.replace('?', f'{end}({column})')} AS {end}_{kind}"
        for kind, value in (("text", text), ("number", number))
        for end in ("min", "max")
    )
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, {ends} FROM {table}"
    )


_SQL["column_profile"] = " UNION ALL ".join(
    _limits(table, column, **shape)
    for table, kinds in _GIVEN_COLUMNS.items()
    for columns, shape in zip(
        kinds, ({"number": "CAST(? AS DOUBLE) + 0"}, {"text": "?"}, {"text": _ts("?")}, {}), strict=True
    )
    for column in columns.split()
)
_SHOWN = {
    "ads_retail_dashboard_daily": "SELECT * FROM dashboards",
    "ads_product_topn": _SQL["product_topn"],
    "ads_category_topn": _SQL["category_topn"],
    "ads_shop_rank": _SQL["shop_rank"],
    "ads_user_retention": "SELECT * FROM retention",
    "ads_rfm_user_segment": "SELECT * FROM rfm",
    "ads_refund_analysis": "SELECT * FROM refund_groups",
    "ads_inventory_turnover": "SELECT * FROM turnover",
    "ads_synerise_behavior_dashboard_daily": "SELECT * FROM behavior_days",
    "ads_synerise_event_type_trend": "SELECT * FROM behavior_types",
    "ads_synerise_product_topn": _SQL["behavior_product_topn"],
    "ads_synerise_category_topn": _SQL["behavior_category_topn"],
}
_CTES["shown_day"] = "SELECT max(dt) AS dt FROM ({}) WHERE dt <= '{}'".format(
    " UNION ALL ".join(f"SELECT dt FROM ({sql})" for table, sql in _SHOWN.items() if "synerise" not in table),
    DASHBOARD_DT,
)


def _values(section: str, source: str, order: str, columns: dict[str, bool]) -> str:
    """A section value by value; ``columns`` says which ones are numbers."""
    rows = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({source})"
    return f"WITH listed AS MATERIALIZED ({rows}) " + " UNION ALL ".join(
        f"SELECT '{section}' AS section, position, '{name}' AS key, "
        + (
            f"CAST(NULL AS VARCHAR) AS text_value, round(CAST({name} AS DOUBLE), 6) AS number_value"
            if number
            else f"CAST({name} AS VARCHAR) AS text_value, CAST(NULL AS DOUBLE) AS number_value"
        )
        + " FROM listed"
        for name, number in columns.items()
    )


def _shown(section: str, table: str, order: str, where: str = "true", keep: int | None = None) -> str:
    fields = (field.split() for field in TABLES[table].split(", "))
    columns = {name: kind != "STRING" for name, kind in fields}
    limit = f"ORDER BY {order} LIMIT {keep}" if keep else ""
    return _values(section, f"SELECT * FROM ({_SHOWN[table]}) WHERE {where} {limit}", order, columns)


def _ordered(by: str, *ties: str) -> str:
    return ", ".join([f"{by} DESC NULLS LAST", *(f"{t} NULLS LAST" for t in ties)])


_ON_DAY, _DENSE = "dt = (SELECT dt FROM shown_day)", "dt = (SELECT dt FROM dense_day)"
_RANKED = _ordered("pay_event_count", "rank_no")
_DASHBOARD = [
    _values("latest_dt", "SELECT dt AS latest_dt FROM shown_day", "1", {"latest_dt": False}),
    _shown("kpis", "ads_retail_dashboard_daily", "dt", _ON_DAY),
    _shown("daily", "ads_retail_dashboard_daily", "dt"),
    _shown("retention", "ads_user_retention", "cohort_dt, day_diff", _ON_DAY, 20),
    _values(
        "rfm_segment",
        _SQL["rfm_segment_rollup"],
        _ordered("user_count", "user_segment"),
        {"user_segment": False, "user_count": True, "monetary": True},
    ),
    _shown("product_topn", "ads_product_topn", _ordered("sales_amount", "rank_no"), _ON_DAY, 10),
    _shown("category_topn", "ads_category_topn", _ordered("sales_amount", "rank_no"), _ON_DAY, 10),
    _shown("shop_rank", "ads_shop_rank", _ordered("sales_amount", "rank_no"), _ON_DAY, 10),
    _shown("refund_analysis", "ads_refund_analysis", _ordered("refund_amount", "refund_reason", "refund_status"), _ON_DAY, 10),
    _shown(
        "inventory_turnover",
        "ads_inventory_turnover",
        _ordered("inventory_turnover_rate", "CAST(product_id AS VARCHAR)", "CAST(shop_id AS VARCHAR)"),
        _ON_DAY,
        10,
    ),
    _values("synerise_latest_dt", "SELECT dt AS latest_dt FROM dense_day", "1", {"latest_dt": False}),
    _shown("synerise_kpis", "ads_synerise_behavior_dashboard_daily", "dt", _DENSE),
    _shown("synerise_daily", "ads_synerise_behavior_dashboard_daily", "dt"),
    _shown("synerise_event_type", "ads_synerise_event_type_trend", "dt, event_type"),
    _shown("synerise_product_topn", "ads_synerise_product_topn", _RANKED, _DENSE, 10),
    _shown("synerise_category_topn", "ads_synerise_category_topn", _RANKED, _DENSE, 10),
    _shown("synerise_product_topn_all", "ads_synerise_product_topn", "dt, rank_no"),
    _shown("synerise_category_topn_all", "ads_synerise_category_topn", "dt, rank_no"),
    _values(
        "public_dataset",
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count, "
            f"(SELECT string_agg(column_name, ',') FROM (DESCRIBE {name})) AS columns"
            for name in GIVEN_TABLES
        ),
        "table_name",
        {"table_name": False, "row_count": True, "columns": False},
    ),
]
_SQL["dashboard_payload"] = " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in _DASHBOARD)

_LAYERED = dict(_CTES)
# Layer tables hold ids as text, and the fixed order among copies follows it.
_LAYERED["items"] = """
        SELECT order_item_id, order_id, product_id, shop_id, quantity, item_amount, sale_price FROM (
            SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY CAST(product_id AS VARCHAR),
                CAST(shop_id AS VARCHAR), quantity, sale_price, item_amount) AS rn
            FROM items_raw WHERE quantity > 0 AND sale_price >= 0 AND item_amount >= 0 AND order_id IS NOT NULL)
        WHERE rn = 1"""
_LAYERED["stock"] = _LAYERED["stock"].replace(
    "product_id NULLS LAST", "CAST(product_id AS VARCHAR) NULLS LAST"
).replace("shop_id NULLS LAST", "CAST(shop_id AS VARCHAR) NULLS LAST")
_RETAIL_BUILD = " UNION ALL ".join(
    _count(table, source if source.startswith("SELECT") else f"SELECT * FROM {source}")
    for table, source in {
        "ods_users": f"SELECT '{PROCESS_DT}' AS dt FROM customer",
        "ods_shops": f"SELECT '{PROCESS_DT}' AS dt FROM supplier",
        "ods_products": f"SELECT '{PROCESS_DT}' AS dt FROM part",
        "ods_orders": "orders_raw",
        "ods_order_items": "SELECT o.dt FROM items_raw i LEFT JOIN orders_raw o ON i.order_id = o.order_id",
        "ods_payments": "payments",
        "ods_refunds": "refunds_raw",
        "ods_user_events": "user_events_raw",
        "ods_inventory_logs": "stock_raw",
        "dwd_trade_order_detail": "lines",
        "dwd_trade_payment_detail": "payments",
        "dwd_trade_refund_detail": "refunds",
        "dwd_user_behavior_detail": "user_events",
        "dwd_inventory_change_detail": "stock",
        "dim_user": f"SELECT '{PROCESS_DT}' AS dt FROM customer",
        "dim_product": f"SELECT '{PROCESS_DT}' AS dt FROM part",
        "dim_shop": f"SELECT '{PROCESS_DT}' AS dt FROM supplier",
        "dim_category": f"SELECT DISTINCT p_size, '{PROCESS_DT}' AS dt FROM part",
        "dim_date": f"SELECT '{PROCESS_DT}' AS dt",
        "dws_trade_day_summary": "trade",
        "dws_user_day_summary": _USER_DAY.strip(),
        "dws_product_day_summary": "product_days",
        "dws_shop_day_summary": "shop_days",
        "dws_category_day_summary": "category_days",
        "dws_user_retention_summary": "retention",
        "dws_inventory_day_summary": "stock_day",
        "ads_retail_dashboard_daily": "dashboards",
        "ads_product_topn": _top(
            "product_days", "sales_amount sales_quantity", "product_id category_id category_name brand", 20
        ),
        "ads_category_topn": _top("category_days", "sales_amount", "category_id category_name", 20),
        "ads_shop_rank": _top("shop_days", "sales_amount", "shop_id", 100),
        "ads_user_retention": "retention",
        "ads_rfm_user_segment": "rfm",
        "ads_refund_analysis": "refund_groups",
        "ads_inventory_turnover": "turnover",
    }.items()
)


def _with_ctes(sql: str, ctes: dict[str, str] = _CTES) -> str:
    needed: list[str] = []
    text = sql
    for name in reversed(ctes):
        if re.search(rf"\b{name}\b", text):
            needed.append(name)
            text += ctes[name]
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({ctes[name]})" for name in reversed(needed)) + "\n" + sql


ORACLE = {name: _with_ctes(sql) for name, sql in _SQL.items()}
ORACLE["retail_layers_build"] = _with_ctes(_RETAIL_BUILD, _LAYERED)
