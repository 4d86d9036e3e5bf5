"""The given star-schema tables read as the retail and behaviour raw tables.

Every method is a deterministic projection; FIXTURES.md lists the expressions.
Columns nobody asks for are pruned by Catalyst down to the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.functions.expressions import day_of

# Event names of the given stream and what they stand for.
RETAIL_EVENT_TYPES = {"view": "view", "click": "cart", "purchase": "pay", "signup": "search"}
BEHAVIOR_EVENT_TYPES = {
    "page_visit": "view",
    "search_query": "signup",
    "add_to_cart": "click",
    "remove_from_cart": "error",
    "product_buy": "purchase",
}


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


class DriverTables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- retail ---------------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("c_custkey").alias("user_id"),
                _null("timestamp_ntz").alias("register_time"),
                _null("string").alias("gender"),
                (18 + F.col("c_custkey") % 43).cast("int").alias("age"),
                F.col("n_name").alias("city"),
                F.col("c_mktsegment").alias("user_level"),
                F.col("r_name").alias("channel"),
                (F.col("c_acctbal") > 5000).cast("int").alias("is_member"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_size").alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            _null("bigint").alias("shop_id"),
            _money("p_retailprice").alias("list_price"),
            _null("decimal(18,2)").alias("cost_price"),
            _null("timestamp_ntz").alias("create_time"),
            F.lit("active").alias("status"),
        )

    @cached_property
    def shops(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("s_suppkey").alias("shop_id"),
                F.col("s_name").alias("shop_name"),
                F.lit("marketplace").alias("shop_type"),
                F.col("n_name").alias("city"),
                _null("timestamp_ntz").alias("open_time"),
                F.col("s_acctbal").alias("score"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Order headers without the buyer's place, which costs two joins."""
        return self._order_columns(self.table("orders"), _null("string"))

    @cached_property
    def orders_with_place(self) -> DataFrame:
        placed = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        )
        return self._order_columns(placed, F.col("n_name"))

    @staticmethod
    def _order_columns(df: DataFrame, place: Column) -> DataFrame:
        return df.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            _null("bigint").alias("shop_id"),
            F.col("o_orderdate").alias("order_time"),
            F.lower("o_orderstatus").alias("order_status"),
            _money("o_totalprice").alias("total_amount"),
            # Some given rows break each rule on amounts, times and stock.
            F.when(F.col("o_orderkey") % 97 == 0, 5).otherwise(0).cast("decimal(18,2)").alias("discount_amount"),
            _money("o_totalprice").alias("payable_amount"),
            place.alias("province"),
            place.alias("city"),
            day_of("o_orderdate").alias("dt"),
        )

    @staticmethod
    def _line_id() -> Column:
        return F.concat_ws("-", "l_orderkey", "l_linenumber")

    @staticmethod
    def _line_amount() -> Column:
        paid_share = 1 - F.col("l_discount").cast("decimal(4,2)")
        return (_money("l_extendedprice") * paid_share).cast("decimal(18,4)")

    @cached_property
    def order_items(self) -> DataFrame:
        """Order lines as they arrive: repeated ids included, shop on the line."""
        return self.table("lineitem").select(
            self._line_id().alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            self._line_amount().alias("item_amount"),
            F.try_divide("l_extendedprice", "l_quantity").alias("sale_price"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        late = key % 3 - F.when(key % 83 == 0, 4).otherwise(0)
        paid_on = F.date_add(F.col("o_orderdate").cast("date"), late.cast("int"))
        more = F.when(key % 89 == 0, 7).otherwise(0)
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            paid_on.cast("timestamp_ntz").alias("pay_time"),
            _null("string").alias("pay_method"),
            (_money("o_totalprice") + more).cast("decimal(18,2)").alias("pay_amount"),
            F.when(F.col("o_orderstatus").isin("F", "O"), "success").otherwise("processing").alias("pay_status"),
            paid_on.cast("string").alias("dt"),
        )

    @cached_property
    def refunds(self) -> DataFrame:
        """Returned order lines as they arrive, repeated ids included."""
        returned = self.table("lineitem").where(F.col("l_returnflag") == "R")
        return returned.join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "inner"
        ).select(
            self._line_id().alias("refund_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_shipdate").alias("refund_time"),
            self._line_amount().alias("refund_amount"),
            F.col("o_orderpriority").alias("refund_reason"),
            F.when(F.col("l_linestatus") == "F", "approved").otherwise("pending").alias("refund_status"),
            day_of("l_shipdate").alias("dt"),
        )

    @cached_property
    def user_events(self) -> DataFrame:
        kind = F.col("event_type")
        for given, meant in RETAIL_EVENT_TYPES.items():
            kind = F.when(F.col("event_type") == given, meant).otherwise(kind)
        return self.table("events").select(
            "event_id",
            "user_id",
            self._json_key().alias("product_id"),
            _null("bigint").alias("shop_id"),
            kind.alias("event_type"),
            F.col("ts").alias("event_time"),
            _null("string").alias("session_id"),
            _null("string").alias("device_type"),
            _null("string").alias("source_channel"),
            day_of("ts").alias("dt"),
        )

    @cached_property
    def inventory_logs(self) -> DataFrame:
        """Stock movements of order lines as they arrive, repeated ids included."""
        returned = F.col("l_returnflag") == "R"
        moved = F.when(returned, F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("int")
        before = (1000 + F.col("l_partkey") % 500).cast("int")
        return self.table("lineitem").select(
            self._line_id().alias("inventory_log_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.when(returned, "refund_in").otherwise("sale_out").alias("change_type"),
            moved.alias("change_quantity"),
            before.alias("before_quantity"),
            (before + moved + F.when(F.col("l_orderkey") % 101 == 0, 1).otherwise(0)).alias("after_quantity"),
            F.col("l_shipdate").alias("change_time"),
            day_of("l_shipdate").alias("dt"),
        )

    # -- behaviour ------------------------------------------------------------

    @staticmethod
    def _json_key() -> Column:
        return F.get_json_object("props", "$.k").try_cast("bigint")

    def behavior_source(self, name: str) -> DataFrame:
        """One of the five raw behaviour tables."""
        if name not in BEHAVIOR_EVENT_TYPES:
            raise ValueError(f"unknown behaviour source: {name}")
        value = {
            "page_visit": self._json_key().alias("url"),
            "search_query": F.col("props").alias("query"),
        }.get(name, self._json_key().alias("sku"))
        return (
            self.table("events")
            .where(F.col("event_type") == BEHAVIOR_EVENT_TYPES[name])
            .select(F.col("user_id").alias("client_id"), F.col("ts").alias("timestamp"), value)
        )

    @cached_property
    def product_properties(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku"),
            F.col("p_size").alias("category"),
            F.col("p_retailprice").alias("price"),
            F.col("p_name").alias("name"),
        )
