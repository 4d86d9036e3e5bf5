"""The retail layers over a date range, each stage reading the one before.

A stage ends in written tables, so a lost executor or a failed run repeats
only the stage it hit, and no lineage spans the layers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.context import RunContext
from tilldeck.functions.frames import in_date_range, keep_one, money_as_double
from tilldeck.operators import dimensions, facts, metrics, quality, summaries
from tilldeck.operators.landing import land
from tilldeck.schemas import RAW_TABLES, column_names
from tilldeck.session import drop_folder, shuffles_freed, side_by_side
from tilldeck.sources.files import read_raw_csv
from tilldeck.sources.layers import day_counts, kept_small, read_layer, write_layer


def raw_csv_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The nine raw files of a folder; a missing one is an error."""
    return {name: read_raw_csv(spark, f"{folder.rstrip('/')}/{name}.csv") for name in RAW_TABLES}


def build_landed(raw: Mapping[str, DataFrame], root: str, run: RunContext) -> None:
    # One time for all passes of a table.
    now = F.lit(datetime.now(timezone.utc))

    def put(name: str, table: str) -> None:
        landed = in_date_range(land(raw[name], name, run.load_dt), run.start, run.end).withColumn("ods_load_time", now)
        key = "order_id" if "order_id" in column_names(table) else column_names(table)[0]
        write_layer(landed, root, table, run.mode, days=run.days, spread=landed, by=key)

    side_by_side(next(iter(raw.values())).sparkSession, (partial(put, *names) for names in RAW_TABLES.items()))


def on_days_of(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of a layer table on the days that hold any wanted key, so partitions are
    pruned. The stored key column is the index: only it is read of the other days, and
    only the days' names, never keys, come to the driver."""
    held = table.select(key, "dt").join(wanted.select(key), key, "left_semi")
    days = [row["dt"] for row in held.select("dt").distinct().collect()]
    return table.where(F.col("dt").isin(days) if days else F.lit(False))


def fact_sources(spark: SparkSession, root: str, run: RunContext) -> dict[str, tuple[DataFrame, ...]]:
    """The landed tables each fact is made of. The side that owns the day is cut to the
    run's range; the others to days that hold a row of the same key, copies included, so
    a run over a few days does not read all history."""

    def landed(table: str, ranged: bool = False) -> DataFrame:
        bounds = run.days if ranged else (None, None)
        return read_layer(spark, root, table, *bounds)

    orders, payments, refunds = (landed(f"ods_{name}", True) for name in ("orders", "payments", "refunds"))
    items, all_orders, all_payments = landed("ods_order_items"), landed("ods_orders"), landed("ods_payments")
    if all(run.days) and not run.backfill:
        own = items.select("order_item_id", "order_id").join(orders.select("order_id"), "order_id", "left_semi")
        items = on_days_of(items, "order_item_id", own)
        all_orders = on_days_of(all_orders, "order_id", payments)
        all_payments = on_days_of(all_payments, "order_id", refunds)
    return {
        "dwd_trade_order_detail": (orders, items, landed("ods_products")),
        "dwd_trade_payment_detail": (payments, all_orders),
        "dwd_trade_refund_detail": (refunds, all_payments),
        "dwd_user_behavior_detail": (landed("ods_user_events", True),),
        "dwd_inventory_change_detail": (landed("ods_inventory_logs", True),),
    }


FACTS = {
    "dwd_trade_order_detail": facts.trade_order_detail,
    "dwd_trade_payment_detail": facts.payment_detail,
    "dwd_trade_refund_detail": facts.refund_detail,
    "dwd_user_behavior_detail": facts.user_behavior_detail,
    "dwd_inventory_change_detail": facts.inventory_detail,
}


# The landed table whose rows a fact keeps, so its days have about the same shares.
DAYS_OF = {
    "dwd_trade_order_detail": "ods_order_items",
    "dwd_trade_payment_detail": "ods_payments",
    "dwd_trade_refund_detail": "ods_refunds",
    "dwd_user_behavior_detail": "ods_user_events",
    "dwd_inventory_change_detail": "ods_inventory_logs",
}


def build_facts(spark: SparkSession, root: str, run: RunContext) -> None:
    def put(table: str, sources: tuple[DataFrame, ...]) -> None:
        spread = read_layer(spark, root, DAYS_OF[table])
        made, key, scratch = FACTS[table](*sources), column_names(table)[0], None
        if run.backfill and table == "dwd_trade_order_detail":
            # Copies of a line may name several orders: they go before passes over orders.
            orders, items, products = sources
            clean, scratch = kept_small(facts.clean_items(items), "clean-items", key, items.count())
            made, key = facts.detail_of_clean_items(orders, clean, products), "order_id"
        write_layer(made, root, table, run.mode, days=run.days, spread=spread, by=key)
        if scratch:
            drop_folder(spark, scratch)

    side_by_side(spark, (partial(put, *fact) for fact in fact_sources(spark, root, run).items()))


def build_dimensions(spark: SparkSession, root: str, run: RunContext) -> None:
    dt = run.load_dt
    products = read_layer(spark, root, "ods_products")

    def put(df: DataFrame, table: str) -> None:
        write_layer(df, root, table, run.mode)

    with shuffles_freed(spark):
        put(dimensions.dim_user(read_layer(spark, root, "ods_users"), dt), "dim_user")
        put(dimensions.dim_product(products, dt), "dim_product")
        put(dimensions.dim_shop(read_layer(spark, root, "ods_shops"), dt), "dim_shop")
        put(dimensions.dim_category(read_layer(spark, root, "dim_product", dt, dt), dt), "dim_category")
        put(dimensions.dim_date(dimensions.date_range(spark, *run.calendar)), "dim_date")


def build_summaries(spark: SparkSession, root: str, run: RunContext) -> None:
    def fact(table: str) -> DataFrame:
        return read_layer(spark, root, table, run.start, run.end)

    lines = fact("dwd_trade_order_detail")
    payments = fact("dwd_trade_payment_detail")
    refunds = fact("dwd_trade_refund_detail")
    events = fact("dwd_user_behavior_detail")
    stock = fact("dwd_inventory_change_detail")

    counts: dict[str, dict[str, int]] = {}

    def count(name: str, rows: DataFrame) -> None:
        counts[name] = day_counts(rows)

    if run.backfill:
        read = {"lines": lines, "payments": payments, "refunds": refunds, "events": events, "stock": stock}
        side_by_side(spark, (partial(count, *fact) for fact in read.items()))
        counts["all"] = dict(sum((Counter(counts[name]) for name in read if name != "stock"), Counter()))

    def order_facts(within: Column) -> DataFrame:
        # All lines of an order lie on its day.
        return summaries.order_fact(lines.where(within))

    def trade(within: Column) -> DataFrame:
        return summaries.trade_daily(order_facts(within), payments.where(within), refunds.where(within))

    def users(within: Column) -> DataFrame:
        others = (f.where(within) for f in (payments, refunds, events))
        return summaries.user_daily(order_facts(within), *others)

    built: dict[str, Callable[[Column], DataFrame]] = {
        "dws_trade_day_summary": trade,
        "dws_user_day_summary": users,
        "dws_product_day_summary": lambda within: summaries.product_daily(lines.where(within)),
        "dws_shop_day_summary": lambda within: summaries.shop_daily(lines.where(within)),
        "dws_category_day_summary": lambda within: summaries.category_daily(lines.where(within)),
        # A day's users come back on others, so no pass holds only some days.
        "dws_user_retention_summary": lambda _: summaries.user_retention(events),
        "dws_inventory_day_summary": lambda within: summaries.inventory_daily(stock.where(within)),
    }
    # Where rows of the summary are about as many as those of its facts.
    spread = {
        "dws_user_day_summary": "all",
        "dws_product_day_summary": "lines",
        "dws_shop_day_summary": "lines",
        "dws_category_day_summary": "lines",
        "dws_inventory_day_summary": "stock",
    }
    load = {"dws_trade_day_summary": "all"}

    def put(table: str, make: Callable[[Column], DataFrame]) -> None:
        def part(within: Column) -> DataFrame:
            return money_as_double(make(within))

        write_layer(
            part(F.lit(True)), root, table, run.mode, days=run.days,
            spread=counts.get(spread.get(table, "")), load=counts.get(load.get(table, "")), part=part,
        )

    side_by_side(spark, (partial(put, *summary) for summary in built.items()))


def build_metrics(spark: SparkSession, root: str, run: RunContext) -> None:
    def ranged(table: str) -> DataFrame:
        return read_layer(spark, root, table, run.start, run.end)

    def current(table: str, key: str) -> DataFrame:
        return keep_one(read_layer(spark, root, table), [key], [F.col("dt").desc_nulls_last()])

    products = ranged("dws_product_day_summary")
    payments = ranged("dwd_trade_payment_detail")
    built = {
        "ads_retail_dashboard_daily": metrics.retail_dashboard(
            ranged("dws_trade_day_summary"), metrics.repeat_purchase(ranged("dws_user_day_summary"))
        ),
        "ads_product_topn": metrics.product_topn(products, current("dim_product", "product_id")),
        "ads_category_topn": metrics.category_topn(ranged("dws_category_day_summary")),
        "ads_shop_rank": metrics.shop_rank(ranged("dws_shop_day_summary"), current("dim_shop", "shop_id")),
        "ads_user_retention": ranged("dws_user_retention_summary").where(
            F.col("day_diff").isin(*summaries.RETENTION_OFFSETS)
        ),
        "ads_rfm_user_segment": metrics.rfm_segment(payments, run.as_of),
        "ads_refund_analysis": metrics.refund_analysis(ranged("dwd_trade_refund_detail")),
        "ads_inventory_turnover": metrics.inventory_turnover(
            ranged("dws_inventory_day_summary"),
            metrics.product_sales(products, "sales_quantity", "sales_amount"),
        ),
    }
    spread = {"ads_inventory_turnover": ranged("dws_inventory_day_summary")}
    load = {
        "ads_retail_dashboard_daily": ranged("dws_user_day_summary"),
        "ads_product_topn": products,
        "ads_category_topn": ranged("dws_category_day_summary"),
        "ads_shop_rank": ranged("dws_shop_day_summary"),
        "ads_rfm_user_segment": payments,
        "ads_refund_analysis": ranged("dwd_trade_refund_detail"),
    }
    by = {"ads_rfm_user_segment": "user_id"}

    def put(table: str, df: DataFrame) -> None:
        write_layer(
            money_as_double(df), root, table, run.mode, days=run.days,
            spread=spread.get(table), load=load.get(table), by=by.get(table, "dt"),
        )

    side_by_side(spark, (partial(put, *metric) for metric in built.items()))


def layer_quality(spark: SparkSession, root: str, run: RunContext) -> DataFrame:
    """The twelve rules over the written layers."""
    lines = read_layer(spark, root, "dwd_trade_order_detail")
    expected = dimensions.date_range(spark, run.start, run.end) if run.start and run.end else None
    return quality.quality_checks(
        quality.QualityInputs(
            lines=lines,
            orders=lines,
            payments=read_layer(spark, root, "dwd_trade_payment_detail"),
            refunds=read_layer(spark, root, "dwd_trade_refund_detail"),
            events=read_layer(spark, root, "ods_user_events"),
            inventory=read_layer(spark, root, "dwd_inventory_change_detail"),
            users=read_layer(spark, root, "dim_user"),
            products=read_layer(spark, root, "dim_product"),
            shops=read_layer(spark, root, "dim_shop"),
            expected=expected,
        )
    )


def build_retail(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, run: RunContext) -> None:
    """All retail layers, in order."""
    build_landed(raw, root, run)
    build_facts(spark, root, run)
    build_dimensions(spark, root, run)
    build_summaries(spark, root, run)
    build_metrics(spark, root, run)
