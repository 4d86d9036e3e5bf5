"""Every query by name, over the given tables. Each reads whole tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import cached_property, partial, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.context import RunContext
from tilldeck.functions import expressions as E
from tilldeck.functions.frames import in_date_range, keep_one, money_as_double, reported
from tilldeck.operators import behavior as B
from tilldeck.operators import dimensions as D
from tilldeck.operators import facts, landing, metrics, quality
from tilldeck.operators import reporting as R
from tilldeck.operators import summaries as S
from tilldeck.plans import behavior as behavior_plan
from tilldeck.plans import dashboard
from tilldeck.plans import retail as retail_plan
from tilldeck.schemas import LAYERS
from tilldeck.session import drop_folder, scratch_dir, side_by_side
from tilldeck.sources import files, layers
from tilldeck.sources.driver_tables import DriverTables

PROCESS_DT = "2001-08-01"
BEHAVIOR_DT = "2024-01-30"
DASHBOARD_DT = "1998-07-01"
RANGE = ("2024-01-08", "2024-01-21")
RERUN_DT = "2024-01-15"
EMPTIED_DT = "2024-01-16"
SAMPLE_FRACTION = 0.1
SAMPLE_SEED = 20260511
LIMIT_PER_TABLE = 100
GIVEN_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# The measure by which the build queries compare a table's values.
MEASURES = {
    "dwd_trade_order_detail": "quantity",
    "dwd_trade_payment_detail": "pay_amount",
    "dwd_trade_refund_detail": "refund_amount",
    "dwd_inventory_change_detail": "change_quantity",
    "dws_trade_day_summary": "gmv",
    "dws_user_day_summary": "order_count",
    "dws_product_day_summary": "sales_quantity",
    "dws_shop_day_summary": "buyer_count",
    "dws_category_day_summary": "order_count",
    "dws_user_retention_summary": "retained_users",
    "dws_inventory_day_summary": "ending_quantity",
    "ads_retail_dashboard_daily": "pay_user_count",
    "ads_user_retention": "retained_users",
    "ads_rfm_user_segment": "frequency",
    "ads_refund_analysis": "refund_order_count",
    "ads_inventory_turnover": "sales_quantity",
    "dws_synerise_behavior_day_summary": "active_user_count",
    "dws_synerise_event_type_day_summary": "active_sku_count",
    "dws_synerise_product_day_summary": "cart_event_count",
    "dws_synerise_category_day_summary": "active_sku_count",
    "ads_synerise_behavior_dashboard_daily": "event_count",
    "ads_synerise_event_type_trend": "event_count",
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    """Register a builder under its name; its result is put in reported form."""
    QUERIES[build.__name__] = lambda spark, folder: reported(build(Shop(spark, folder)))
    return build


class Shop:
    """The tables and intermediate results queries share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.raw = DriverTables(spark, folder)

    # Order lines without the columns (place, product) that cost extra joins.
    @cached_property
    def items(self) -> DataFrame:
        return facts.clean_items(self.raw.order_items)

    @cached_property
    def orders(self) -> DataFrame:
        return facts.clean_orders(self.raw.orders)

    @cached_property
    def lines(self) -> DataFrame:
        return facts.order_lines(self.raw.order_items, self.raw.orders)

    @cached_property
    def product_lines(self) -> DataFrame:
        return facts.trade_order_detail(self.raw.orders, self.raw.order_items, self.raw.products)

    @cached_property
    def order_fact(self) -> DataFrame:
        return S.order_fact(self.lines)

    @cached_property
    def payments(self) -> DataFrame:
        return facts.clean_payments(self.raw.payments)

    @cached_property
    def refunds(self) -> DataFrame:
        return facts.clean_refunds(self.raw.refunds)

    @cached_property
    def events(self) -> DataFrame:
        return facts.user_behavior_detail(self.raw.user_events)

    @cached_property
    def stock(self) -> DataFrame:
        return S.inventory_daily(facts.inventory_detail(self.raw.inventory_logs))

    @cached_property
    def turnover(self) -> DataFrame:
        sales = metrics.product_sales(self.lines, "quantity", "item_amount")
        return metrics.inventory_turnover(self.stock, sales)

    @cached_property
    def order_day(self) -> DataFrame:
        return S.order_day(self.order_fact)

    @cached_property
    def trade(self) -> DataFrame:
        return S.trade_daily(self.order_fact, self.payments, self.refunds)

    @cached_property
    def paid_trade(self) -> DataFrame:
        """Order and payment measures only, for metrics that need no refunds."""
        return self.order_day.join(S.pay_day(self.payments), "dt", "left").na.fill(0)

    @cached_property
    def repeat(self) -> DataFrame:
        return metrics.repeat_purchase(S.user_pay_day(self.payments))

    @cached_property
    def retention(self) -> DataFrame:
        return S.user_retention(self.events)

    @cached_property
    def rfm(self) -> DataFrame:
        return metrics.rfm_segment(self.payments, PROCESS_DT)

    @cached_property
    def landed_behavior(self) -> dict[str, DataFrame]:
        return {
            name: landing.land_behavior(self.raw.behavior_source(name), source)
            for name, source in landing.BEHAVIOR_SOURCES.items()
        }

    @cached_property
    def properties(self) -> DataFrame:
        return landing.land_product_properties(self.raw.product_properties, BEHAVIOR_DT)

    @cached_property
    def behavior(self) -> DataFrame:
        return B.behavior_detail(self.landed_behavior, self.properties)

    @cached_property
    def behavior_bare(self) -> DataFrame:
        """The unified fact without product columns, so without their join."""
        return B.behavior_detail(self.landed_behavior)

    @cached_property
    def behavior_day(self) -> DataFrame:
        return B.behavior_daily(self.behavior_bare)

    @cached_property
    def behavior_types(self) -> DataFrame:
        return B.behavior_event_type_daily(self.behavior_bare)

    def stored(self, **frames: DataFrame) -> dict[str, DataFrame]:
        """Each frame computed once, as a table in the scratch folder."""
        paths = {name: self.scratch(name) for name in frames}
        side_by_side(self.spark, (partial(df.write.parquet, paths[name]) for name, df in frames.items()))
        return {name: self.spark.read.parquet(path) for name, path in paths.items()}

    def metric_tables(self) -> str:
        """The metric tables the dashboard reads; facts they share are computed once."""
        root = self.scratch("metrics")
        facts_at = {name: self.scratch(name) for name in ("lines", "payments", "refunds", "behavior")}
        movements: list[tuple[DataFrame, str | None]] = []

        def put_lines() -> None:
            # Copies of a line may name several orders: they go before passes over orders.
            rows = self.raw.order_items.count()
            items, kept = layers.kept_small(self.items, "clean-items", "order_item_id", rows)
            found = facts.detail_of_clean_items(self.raw.orders, items, self.raw.products)
            layers.write_scratch(found, facts_at["lines"], "order_id", rows)
            if kept:
                drop_folder(self.spark, kept)

        def put_movements() -> None:
            logs = self.raw.inventory_logs
            movements.append(
                layers.kept_small(facts.inventory_detail(logs), "movements", "inventory_log_id", logs.count())
            )

        def put(name: str, df: DataFrame, key: str, given: DataFrame) -> None:
            layers.write_scratch(df, facts_at[name], key, given.count())

        returned = self.raw.table("lineitem").where(F.col("l_returnflag") == "R")

        side_by_side(
            self.spark,
            (
                put_lines,
                partial(put, "payments", self.payments, "payment_id", self.raw.payments),
                partial(put, "refunds", self.refunds, "refund_id", returned),
                partial(put, "behavior", self.behavior, "client_id", self.raw.table("events")),
                put_movements,
            ),
        )
        lines, payments, refunds, behavior = (self.spark.read.parquet(path) for path in facts_at.values())
        stock = S.inventory_daily(movements[0][0])
        counts = {"lines": {}, "payments": {}, "refunds": {}}

        def count(name: str) -> None:
            counts[name] = layers.day_counts(self.spark.read.parquet(facts_at[name]))

        side_by_side(self.spark, (partial(count, name) for name in counts))

        def trade_dashboard(within: Column) -> DataFrame:
            # All lines of an order lie on its day.
            paid = payments.where(within)
            trade = S.trade_daily(S.order_fact(lines.where(within)), paid, refunds.where(within))
            return metrics.retail_dashboard(trade, metrics.repeat_purchase(S.user_pay_day(paid)))

        sales = metrics.product_sales(lines, "quantity", "item_amount")
        tables = {
            "ads_retail_dashboard_daily": trade_dashboard(F.lit(True)),
            "ads_product_topn": metrics.product_topn(
                S.product_daily(lines), D.dim_product(self.raw.products, PROCESS_DT)
            ),
            "ads_category_topn": metrics.category_topn(S.category_daily(lines)),
            "ads_shop_rank": metrics.shop_rank(S.shop_daily(lines), D.dim_shop(self.raw.shops, PROCESS_DT)),
            "ads_user_retention": self.retention,
            "ads_rfm_user_segment": metrics.rfm_segment(payments, PROCESS_DT),
            "ads_refund_analysis": metrics.refund_analysis(refunds),
            "ads_inventory_turnover": metrics.inventory_turnover(stock, sales),
            "ads_synerise_behavior_dashboard_daily": B.behavior_daily(behavior),
            "ads_synerise_event_type_trend": B.behavior_event_type_daily(behavior),
            "ads_synerise_product_topn": B.behavior_product_topn(B.behavior_product_daily(behavior)),
            "ads_synerise_category_topn": B.behavior_category_topn(B.behavior_category_daily(behavior)),
        }
        # Facts of the table's days, which tell how its rows spread.
        days = {"ads_inventory_turnover": self.raw.inventory_logs}
        load = {
            "ads_retail_dashboard_daily": dict(sum(map(Counter, counts.values()), Counter())),
            "ads_product_topn": counts["lines"],
            "ads_category_topn": counts["lines"],
            "ads_shop_rank": counts["lines"],
            "ads_rfm_user_segment": counts["payments"],
            "ads_refund_analysis": counts["refunds"],
        }
        by = {"ads_rfm_user_segment": "user_id"}
        part = {"ads_retail_dashboard_daily": lambda within: money_as_double(trade_dashboard(within))}
        side_by_side(
            self.spark,
            (
                partial(
                    layers.write_layer, money_as_double(df), root, table, "backfill", spread=days.get(table),
                    load=load.get(table), by=by.get(table, "dt"), part=part.get(table),
                )
                for table, df in tables.items()
            ),
        )
        for path in (*facts_at.values(), movements[0][1]):
            if path:
                drop_folder(self.spark, path)
        return root

    def table_profile(self) -> DataFrame:
        """Rows and columns of every given table."""
        tables = {name: self.raw.table(name) for name in GIVEN_TABLES}
        return reduce(
            DataFrame.unionByName,
            (
                df.agg(F.count("*").alias("row_count")).select(
                    F.lit(name).alias("table_name"), "row_count", F.lit(",".join(df.columns)).alias("columns")
                )
                for name, df in tables.items()
            ),
        )

    def checks(self, only: list[str] | None = None) -> DataFrame:
        """Quality rules on the tables as they arrive, where they can fail; some keys are
        given as missing, unknown or used before, as no given table holds such ones."""
        raw, order = self.raw, F.col("order_id")
        lines = facts.raw_order_lines(raw.order_items, raw.orders).withColumns(
            {
                "product_id": F.when(order % 103 != 0, F.col("product_id")),
                "shop_id": F.when(order % 107 != 0, F.col("shop_id")).otherwise(-1),
            }
        )
        given_payments = raw.payments.withColumn("payment_id", F.when(order % 113 == 1, order - 1).otherwise(order))
        given_refunds = raw.refunds.withColumn("user_id", F.when(order % 109 != 0, F.col("user_id")))
        if only is None:
            # Four rules read the joined lines, which are computed once.
            lines = self.stored(lines=lines.select("order_item_id", *quality.ORDER_KEYS))["lines"]
        headers = self.orders.select(
            "order_id", "order_time", F.col("payable_amount").alias("order_payable_amount")
        )
        payments = facts.with_order(given_payments, headers)
        refunds = facts.with_order(given_refunds, facts.paid_orders(raw.payments))
        if only == ["DQ011"]:
            payments = given_payments
        if only == ["DQ012"]:
            refunds = given_refunds
        return quality.quality_checks(
            quality.QualityInputs(
                lines=lines,
                orders=raw.orders,
                payments=payments,
                refunds=refunds,
                events=raw.user_events,
                inventory=raw.inventory_logs,
                users=raw.table("customer").select(F.col("c_custkey").alias("user_id")),
                products=raw.products,
                shops=raw.table("supplier").select(F.col("s_suppkey").alias("shop_id")),
                expected=D.observed_range(raw.orders),
            ),
            only,
        )

    def scratch(self, purpose: str) -> str:
        return scratch_dir(self.spark, purpose)


# -- sources and sinks ------------------------------------------------------------


@query
def src_csv_roundtrip(shop: Shop) -> DataFrame:
    path = shop.scratch("csv")
    orders = reported(shop.raw.orders_with_place)
    orders.toDF(*(f" {name.upper()} " for name in orders.columns)).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    landed = landing.land(files.read_raw_csv(shop.spark, path), "orders", PROCESS_DT)
    return layers.conform(landed, "ods_orders").drop("ods_load_time")


@query
def src_parquet_events(shop: Shop) -> DataFrame:
    return files.read_raw_parquet(shop.spark, f"{shop.raw.folder}/events.parquet")


@query
def dataset_profile(shop: Shop) -> DataFrame:
    return files.dataset_profile(shop.spark, [f"{shop.raw.folder}/{name}.parquet" for name in GIVEN_TABLES])


@query
def column_profile(shop: Shop) -> DataFrame:
    """Rows, nulls and limits of every column of the given tables."""
    return reduce(
        DataFrame.unionByName,
        (
            files.column_profile(shop.raw.table(name)).select(F.lit(name).alias("table_name"), "*")
            for name in GIVEN_TABLES
        ),
    )


@query
def layer_roundtrip(shop: Shop) -> DataFrame:
    root = shop.scratch("layer")
    layers.write_layer(shop.events, root, "dwd_user_behavior_detail")
    return layers.read_layer(shop.spark, root, "dwd_user_behavior_detail")


@query
def layer_append(shop: Shop) -> DataFrame:
    root = shop.scratch("append")
    for part in (F.col("dt") < RERUN_DT, F.col("dt") >= RERUN_DT):
        layers.write_layer(shop.events.where(part), root, "dwd_user_behavior_detail", mode="append")
    back = layers.read_layer(shop.spark, root, "dwd_user_behavior_detail")
    return back.groupBy("dt", "event_type").agg(F.count("*").alias("event_count"))


@query
def layer_rerun_one_day(shop: Shop) -> DataFrame:
    """One day again, unchanged, and the next one, which lost all its rows."""
    root = shop.scratch("rerun")
    layers.write_layer(shop.events, root, "dwd_user_behavior_detail")
    again = shop.events.where(F.col("dt") != EMPTIED_DT)
    layers.write_layer(
        in_date_range(again, RERUN_DT, EMPTIED_DT), root, "dwd_user_behavior_detail", days=(RERUN_DT, EMPTIED_DT)
    )
    back = layers.read_layer(shop.spark, root, "dwd_user_behavior_detail")
    return back.groupBy("dt", "event_type").agg(F.count("*").alias("event_count"))


@query
def ods_orders(shop: Shop) -> DataFrame:
    landed = landing.land(shop.raw.orders_with_place, "orders", PROCESS_DT)
    return landed.drop("ods_load_time")


@query
def events_date_range(shop: Shop) -> DataFrame:
    return in_date_range(shop.raw.user_events, *RANGE, time_column="event_time")


@query
def dedup_order_items(shop: Shop) -> DataFrame:
    return keep_one(shop.raw.order_items, ["order_item_id"])


@query
def behavior_sample(shop: Shop) -> DataFrame:
    return landing.sample_rows(shop.raw.table("events"), SAMPLE_FRACTION, SAMPLE_SEED, ["event_id"])


@query
def behavior_limit(shop: Shop) -> DataFrame:
    limited = {
        name: landing.limit_rows(shop.raw.behavior_source(name), LIMIT_PER_TABLE)
        for name in landing.BEHAVIOR_SOURCES
    }
    landed = {name: landing.land_behavior(df, landing.BEHAVIOR_SOURCES[name]) for name, df in limited.items()}
    return B.behavior_detail(landed)


# -- expressions --------------------------------------------------------------------


@query
def scalar_text_clean(shop: Shop) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))
    return shop.raw.table("orders").select("o_orderkey", E.clean_text(padded).alias("cleaned"))


@query
def scalar_dates(shop: Shop) -> DataFrame:
    text = F.col("o_orderdate").cast("string")
    landed = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("bad "), text)).otherwise(text)
    day = F.try_to_timestamp(landed).cast("date")
    return shop.raw.table("orders").select(
        "o_orderkey",
        day.alias("order_day"),
        F.year(day).alias("order_year"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days_since"),
    )


@query
def scalar_safe_div(shop: Shop) -> DataFrame:
    denominator = F.when(F.col("l_tax") > 0, F.col("l_discount"))
    return shop.raw.table("lineitem").select(
        "l_orderkey", "l_linenumber", E.safe_div(F.col("l_extendedprice"), denominator).alias("ratio")
    )


@query
def scalar_clean_value(shop: Shop) -> DataFrame:
    value = (
        F.when(F.col("event_type") == "error", float("nan"))
        .when(F.col("event_type") == "click", float("-inf"))
        .otherwise(F.col("value") / 3)
    )
    return shop.raw.table("events").select("event_id", E.clean_value(value).alias("cleaned"))


# -- dimensions ---------------------------------------------------------------------


@query
def dim_user(shop: Shop) -> DataFrame:
    return D.dim_user(shop.raw.users, PROCESS_DT)


@query
def dim_product(shop: Shop) -> DataFrame:
    return D.dim_product(shop.raw.products, PROCESS_DT)


@query
def dim_shop(shop: Shop) -> DataFrame:
    return D.dim_shop(shop.raw.shops, PROCESS_DT)


@query
def dim_category(shop: Shop) -> DataFrame:
    return D.dim_category(shop.raw.products, PROCESS_DT)


@query
def dim_category_distinct_pair(shop: Shop) -> DataFrame:
    return D.dim_category_distinct_pair(shop.raw.products, PROCESS_DT)


@query
def dim_date(shop: Shop) -> DataFrame:
    return D.dim_date(D.observed_range(shop.raw.orders))


# -- facts --------------------------------------------------------------------------


@query
def trade_order_detail(shop: Shop) -> DataFrame:
    return facts.trade_order_detail(shop.raw.orders_with_place, shop.raw.order_items, shop.raw.products)


@query
def trade_order_detail_sql(shop: Shop) -> DataFrame:
    return facts.trade_order_detail_sql(shop.raw.orders_with_place, shop.raw.order_items, shop.raw.products)


@query
def payment_detail(shop: Shop) -> DataFrame:
    return facts.payment_detail(shop.raw.payments, shop.raw.orders)


@query
def refund_detail(shop: Shop) -> DataFrame:
    return facts.refund_detail(shop.raw.refunds, shop.raw.payments)


@query
def user_behavior_detail(shop: Shop) -> DataFrame:
    return shop.events


@query
def inventory_detail(shop: Shop) -> DataFrame:
    return facts.inventory_detail(shop.raw.inventory_logs)


# -- retail summaries ---------------------------------------------------------------


@query
def order_fact(shop: Shop) -> DataFrame:
    return shop.order_fact


@query
def trade_daily(shop: Shop) -> DataFrame:
    return shop.trade


@query
def trade_by_order_date(shop: Shop) -> DataFrame:
    return S.trade_by_order_date(shop.order_fact, shop.payments, shop.refunds)


@query
def user_daily(shop: Shop) -> DataFrame:
    return S.user_daily(shop.order_fact, shop.payments, shop.refunds, shop.events)


@query
def product_daily(shop: Shop) -> DataFrame:
    return S.product_daily(shop.product_lines)


@query
def shop_daily(shop: Shop) -> DataFrame:
    return S.shop_daily(shop.lines)


@query
def category_daily(shop: Shop) -> DataFrame:
    return S.category_daily(shop.product_lines)


@query
def user_retention(shop: Shop) -> DataFrame:
    return shop.retention


@query
def inventory_daily(shop: Shop) -> DataFrame:
    return shop.stock


# -- retail metrics -----------------------------------------------------------------


@query
def metric_gmv(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.order_day, "gmv")


@query
def metric_order_count(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.order_day, "order_count")


@query
def metric_order_user_count(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.order_day, "order_user_count")


@query
def metric_pay_order_count(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.paid_trade, "pay_order_count")


@query
def metric_pay_user_count(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.paid_trade, "pay_user_count")


@query
def metric_pay_amount(shop: Shop) -> DataFrame:
    return metrics.daily_sum(shop.paid_trade, "pay_amount")


@query
def metric_pay_conversion_rate(shop: Shop) -> DataFrame:
    return metrics.daily_ratio(shop.paid_trade, "pay_order_count", "order_count", "pay_conversion_rate")


@query
def metric_avg_order_value(shop: Shop) -> DataFrame:
    return metrics.daily_ratio(shop.paid_trade, "pay_amount", "pay_order_count", "avg_order_value")


@query
def metric_refund_rate(shop: Shop) -> DataFrame:
    return metrics.daily_ratio(shop.trade, "refund_amount", "pay_amount", "refund_rate")


@query
def metric_order_refund_rate(shop: Shop) -> DataFrame:
    return metrics.daily_ratio(shop.trade, "refund_order_count", "pay_order_count", "order_refund_rate")


@query
def repeat_purchase_rate(shop: Shop) -> DataFrame:
    return shop.repeat


@query
def metric_next_day_retention(shop: Shop) -> DataFrame:
    return metrics.retention_after(shop.retention, 1, "next_day")


@query
def metric_seven_day_retention(shop: Shop) -> DataFrame:
    return metrics.retention_after(shop.retention, 7, "seven_day")


@query
def retail_dashboard(shop: Shop) -> DataFrame:
    return metrics.retail_dashboard(shop.trade, shop.repeat)


@query
def product_topn(shop: Shop) -> DataFrame:
    """A product has one category and brand, so these too join after the cut."""
    top = metrics.product_topn(S.item_daily(shop.lines), D.dim_product(shop.raw.products, PROCESS_DT))
    keys = ["product_id", "dt", "category_id", "category_name", "brand"]
    return facts.with_product_attributes(top, shop.raw.products).select(*keys, *(c for c in top.columns if c not in keys))


@query
def category_topn(shop: Shop) -> DataFrame:
    return metrics.category_topn(S.category_daily(shop.product_lines))


@query
def shop_rank(shop: Shop) -> DataFrame:
    return metrics.shop_rank(S.shop_daily(shop.lines), D.dim_shop(shop.raw.shops, PROCESS_DT))


@query
def rfm_segment(shop: Shop) -> DataFrame:
    return shop.rfm


@query
def rfm_segment_threshold(shop: Shop) -> DataFrame:
    return metrics.rfm_segment_threshold(shop.payments, PROCESS_DT)


@query
def refund_analysis(shop: Shop) -> DataFrame:
    return metrics.refund_analysis(shop.refunds)


@query
def inventory_turnover(shop: Shop) -> DataFrame:
    return shop.turnover


# -- behaviour ----------------------------------------------------------------------


@query
def behavior_ods_page_visit(shop: Shop) -> DataFrame:
    return shop.landed_behavior["page_visit"].drop("ods_load_time")


@query
def behavior_product_properties(shop: Shop) -> DataFrame:
    return keep_one(shop.properties.drop("ods_load_time").where(F.col("sku").isNotNull()), ["sku"])


@query
def behavior_detail(shop: Shop) -> DataFrame:
    return shop.behavior


@query
def behavior_detail_dedup(shop: Shop) -> DataFrame:
    return B.behavior_detail(shop.landed_behavior, shop.properties, deduplicate=True)


@query
def behavior_subset_sku_only(shop: Shop) -> DataFrame:
    names = files.choose("add_to_cart, remove_from_cart, product_buy", tuple(landing.BEHAVIOR_SOURCES))
    return B.behavior_detail({name: shop.landed_behavior[name] for name in names}, shop.properties)


@query
def behavior_event_id(shop: Shop) -> DataFrame:
    return shop.behavior_bare.select("client_id", "source_event_type", "event_time", "event_id", "query_hash")


@query
def behavior_event_type_daily(shop: Shop) -> DataFrame:
    return shop.behavior_types


@query
def behavior_daily(shop: Shop) -> DataFrame:
    return shop.behavior_day


@query
def behavior_daily_approx(shop: Shop) -> DataFrame:
    """Exact users per day beside the verdict that the sketch is close."""
    counts = [f"{step}_user_count" for step in ("active", *B.STEPS)]
    sketched = B.behavior_daily(shop.behavior_bare, approx=True).select(
        "dt", *(F.col(c).alias(f"approx_{c}") for c in counts)
    )
    return shop.behavior_day.join(sketched, "dt").select(
        "dt",
        *counts,
        *(
            (F.abs(F.col(f"approx_{c}") - F.col(c)) <= 0.2 * F.col(c)).alias(f"{c}_close")
            for c in counts
        ),
    )


@query
def behavior_users_of_ranges(shop: Shop) -> DataFrame:
    """Distinct users of the seven days up to each day, from the days' merged sketches:
    how near the estimate comes to the exact count."""
    daily = shop.stored(sketches=B.user_sketches(shop.behavior_bare))["sketches"]
    ranges = daily.select(F.date_sub(F.col("dt").cast("date"), 6).cast("string").alias("first_dt"), F.col("dt").alias("last_dt"))
    guessed = B.users_of_ranges(daily, ranges)
    held = F.explode(F.expr("sequence(date(dt), date_add(date(dt), 6), interval 1 day)"))
    days = shop.behavior_bare.groupBy("dt", "client_id").agg(F.bool_or(F.col("event_type") == "pay").alias("pay"))
    spread = days.select("client_id", "pay", held.alias("last_day"))
    exact = spread.groupBy(F.col("last_day").cast("string").alias("last_dt")).agg(
        F.countDistinct("client_id").alias("active_users"),
        F.countDistinct(F.when(F.col("pay"), F.col("client_id"))).alias("pay_users"),
    )

    def near(guess: str, count: str) -> Column:
        # Six standard errors, and one user.
        return F.abs(F.col(guess) - F.col(count)) <= 1 + 0.048 * F.col(count)

    return guessed.join(exact, "last_dt").select(
        "first_dt",
        "last_dt",
        "active_users",
        "pay_users",
        near("active_user_count", "active_users").alias("active_estimate_near"),
        near("pay_user_count", "pay_users").alias("pay_estimate_near"),
    )


@query
def metric_tables_by_name(shop: Shop) -> DataFrame:
    """The behaviour metric tables as catalog tables, partitioned by day, read by name."""
    database = f"metrics_{uuid4().hex}"
    shop.spark.sql(f"CREATE DATABASE {database} LOCATION '{shop.scratch('catalog')}'")
    behavior = shop.stored(behavior=shop.behavior)["behavior"]
    tables = {
        "ads_synerise_behavior_dashboard_daily": B.behavior_daily(behavior),
        "ads_synerise_event_type_trend": B.behavior_event_type_daily(behavior),
        "ads_synerise_product_topn": B.behavior_product_topn(B.behavior_product_daily(behavior)),
        "ads_synerise_category_topn": B.behavior_category_topn(B.behavior_category_daily(behavior)),
    }
    for table, df in tables.items():
        layers.save_as_table(df, table, database)
    return reduce(
        DataFrame.unionByName,
        (
            shop.spark.sql(
                f"SELECT '{table}' AS table_name, dt, count(*) AS row_count, "
                f"CAST(sum(event_count) AS BIGINT) AS event_count FROM {database}.{table} GROUP BY dt"
            )
            for table in tables
        ),
    )


@query
def behavior_product_daily(shop: Shop) -> DataFrame:
    return B.behavior_product_daily(shop.behavior)


@query
def behavior_category_daily(shop: Shop) -> DataFrame:
    return B.behavior_category_daily(shop.behavior)


@query
def behavior_product_topn(shop: Shop) -> DataFrame:
    return B.behavior_product_topn(B.behavior_product_daily(shop.behavior))


@query
def behavior_category_topn(shop: Shop) -> DataFrame:
    return B.behavior_category_topn(B.behavior_category_daily(shop.behavior))


# -- quality ------------------------------------------------------------------------


def _register_rule(name: str, rule: str) -> None:
    QUERIES[name] = lambda spark, folder: Shop(spark, folder).checks([rule])


for _name, _rule in {
    "dq001_dup_order_item": "DQ001",
    "dq002_null_order_keys": "DQ002",
    "dq003_order_amount": "DQ003",
    "dq004_pay_amount": "DQ004",
    "dq005_pay_before_order": "DQ005",
    "dq006_refund_over_paid": "DQ006",
    "dq007_dim_missing": "DQ007",
    "dq008_missing_days": "DQ008",
    "dq009_bad_event_type": "DQ009",
    "dq010_inventory": "DQ010",
    "dq011_dup_payment": "DQ011",
    "dq012_null_refund_keys": "DQ012",
}.items():
    _register_rule(_name, _rule)


@query
def dq_checks(shop: Shop) -> DataFrame:
    return shop.checks()


@query
def dq_summary(shop: Shop) -> DataFrame:
    return quality.quality_summary(shop.checks())


@query
def dq_report(shop: Shop) -> DataFrame:
    return quality.quality_report(shop.checks())


# -- reports ------------------------------------------------------------------------


@query
def latest_dt(shop: Shop) -> DataFrame:
    """The details hold the same days as their summaries, at less cost."""
    stock = facts.inventory_detail(shop.raw.inventory_logs)
    return R.latest_dt(shop.order_fact, shop.retention, shop.refunds, stock)


@query
def latest_non_sparse_dt(shop: Shop) -> DataFrame:
    return R.latest_non_sparse_dt(shop.behavior_types.groupBy("dt").agg(F.sum("event_count").alias("event_count")))


@query
def latest_kpis(shop: Shop) -> DataFrame:
    dashboard_rows = metrics.retail_dashboard(shop.trade, shop.repeat)
    return R.on_day(dashboard_rows, R.latest_dt(shop.order_day))


@query
def latest_behavior_kpis(shop: Shop) -> DataFrame:
    return R.on_day(shop.behavior_day, R.latest_non_sparse_dt(shop.behavior_day))


@query
def latest_day_topn(shop: Shop) -> DataFrame:
    """Best rows of the latest day of six tables, all read from summaries written once."""
    sums = {name: F.sum(name).alias(name) for name in ("sales_quantity", "sales_amount")}
    made = shop.stored(
        sales=shop.lines.groupBy("dt", "product_id", "shop_id").agg(
            F.sum("quantity").alias("sales_quantity"), F.sum("item_amount").alias("sales_amount")
        ),
        refunds=metrics.refund_analysis(shop.refunds),
        stock=shop.stock,
        skus=B.behavior_product_daily(shop.behavior),
        types=shop.behavior_types,
    )
    sales, refunds, stock, skus = (made[name] for name in ("sales", "refunds", "stock", "skus"))
    by_product, by_shop = ["product_id", "category_id"], ["shop_id"]
    by_category = ["category_id", "category_name"]
    # The day is cut first: only its rows join the product columns.
    named = facts.with_product_attributes(sales, shop.raw.products)
    products = named.groupBy("dt", *by_product, "category_name", "brand").agg(sums["sales_amount"])
    categories = named.groupBy("dt", *by_category).agg(sums["sales_amount"])
    shops = sales.groupBy("dt", *by_shop).agg(sums["sales_amount"])
    turnover = metrics.inventory_turnover(stock, sales.groupBy("dt", "product_id").agg(*sums.values()))
    trade_day = R.latest_dt(sales)
    busy_day = R.latest_non_sparse_dt(made["types"].groupBy("dt").agg(F.sum("event_count").alias("event_count")))
    sections = (
        R.day_top(products, trade_day, "products", "sales_amount", by_product),
        R.day_top(categories, trade_day, "categories", "sales_amount", by_category),
        R.day_top(shops, trade_day, "shops", "sales_amount", by_shop),
        R.day_top(refunds, R.latest_dt(refunds), "refunds", "refund_amount", ["refund_reason", "refund_status"]),
        R.day_top(
            turnover, R.latest_dt(stock), "turnover", "inventory_turnover_rate", ["product_id", "shop_id"]
        ),
        R.day_top(skus, busy_day, "skus", "pay_event_count", ["sku", "category_id"]),
    )
    return reduce(DataFrame.unionByName, sections)


@query
def latest_retention(shop: Shop) -> DataFrame:
    return R.latest_retention(shop.retention, R.latest_dt(shop.retention))


@query
def rfm_segment_rollup(shop: Shop) -> DataFrame:
    return R.segment_rollup(shop.rfm)


@query
def period_kpis(shop: Shop) -> DataFrame:
    return R.period_kpis(shop.trade)


@query
def recent_days_window(shop: Shop) -> DataFrame:
    return R.recent_days(shop.order_day, end="2000-12-31")


@query
def funnel_steps(shop: Shop) -> DataFrame:
    return R.funnel_steps(shop.behavior_day)


@query
def event_heatmap(shop: Shop) -> DataFrame:
    return R.event_heatmap(shop.behavior_types)


@query
def conversion_lift(shop: Shop) -> DataFrame:
    return R.conversion_lift(shop.behavior_day)


@query
def conversion_scatter(shop: Shop) -> DataFrame:
    return R.conversion_scatter(shop.behavior_day)


@query
def dashboard_payload(shop: Shop) -> DataFrame:
    """All sections of the dashboard, from metric tables written once, value by value."""
    root = shop.metric_tables()
    sections = dashboard.retail_sections(shop.spark, root, until=DASHBOARD_DT)
    sections |= dashboard.behavior_sections(shop.spark, root)
    sections["public_dataset"] = R.Section(shop.table_profile(), ("table_name",))
    return R.payload_values(R.payload(sections))


# -- whole builds -------------------------------------------------------------------


def _layer_counts(shop: Shop, root: str, tables: list[str]) -> DataFrame:
    """Rows, days, first and last day and the sum of one measure of every written table."""

    def counted(table: str) -> DataFrame:
        measure = F.col(MEASURES[table]) if table in MEASURES else F.lit(None)
        return (
            layers.read_layer(shop.spark, root, table)
            .groupBy("dt")
            .agg(F.count("*").alias("rows"), F.sum(measure.cast("decimal(28,4)")).alias("measure"))
            .agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
                F.count("dt").alias("day_count"),
                F.min("dt").alias("first_dt"),
                F.max("dt").alias("last_dt"),
                F.round(F.sum("measure").cast("double"), 1).alias("measure_sum"),
            )
            .select(F.lit(table).alias("table_name"), "row_count", "day_count", "first_dt", "last_dt", "measure_sum")
        )

    return reduce(DataFrame.unionByName, (counted(table) for table in tables))


@query
def retail_layers_build(shop: Shop) -> DataFrame:
    """All retail layers over the whole tables by day, as one backfill."""
    root = shop.scratch("retail")
    raw = {
        "users": shop.raw.users,
        "shops": shop.raw.shops,
        "products": shop.raw.products,
        "orders": shop.raw.orders_with_place,
        "order_items": shop.raw.order_items.join(shop.raw.orders.select("order_id", "dt"), "order_id", "left"),
        "payments": shop.raw.payments,
        "refunds": shop.raw.refunds,
        "user_events": shop.raw.user_events,
        "inventory_logs": shop.raw.inventory_logs,
    }
    retail_plan.build_retail(shop.spark, raw, root, RunContext(dt=PROCESS_DT, backfill=True))
    tables = [t for layer in ("ods", "dwd", "dim", "dws", "ads") for t in LAYERS[layer] if "synerise" not in t]
    return _layer_counts(shop, root, tables)


@query
def behavior_layers_build(shop: Shop) -> DataFrame:
    root = shop.scratch("behavior")
    raw = {name: shop.raw.behavior_source(name) for name in landing.BEHAVIOR_SOURCES}
    raw[landing.PRODUCT_PROPERTIES] = shop.raw.product_properties
    behavior_plan.build_behavior(shop.spark, raw, root, RunContext(dt=BEHAVIOR_DT), approx=False)
    tables = [t for layer in ("ods", "dwd", "dws", "ads") for t in LAYERS[layer] if "synerise" in t]
    return _layer_counts(shop, root, tables)
