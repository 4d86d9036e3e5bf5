"""Retail facts to daily subject summaries.

Amounts stay exact decimals here; ``money_as_double`` ends a finished table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilldeck.functions.expressions import safe_div

ORDER_HEADER = ("user_id", "order_time", "order_status", "dt", "total_amount", "discount_amount", "payable_amount")
RETENTION_OFFSETS = (1, 7)
# Days whose activity is kept in one number.
MASK_DAYS = 32


def successful(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("pay_status") == "success")


def approved(refunds: DataFrame) -> DataFrame:
    return refunds.where(F.col("refund_status") == "approved")


def order_fact(lines: DataFrame) -> DataFrame:
    """Order lines collapsed to one row per order.

    Header columns repeat on every line of an order, so any of them will do. A
    shop may differ from line to line and is no column of the order.
    """
    return lines.groupBy("order_id").agg(
        *(F.max(c).alias(c) for c in ORDER_HEADER), F.sum("quantity").alias("item_quantity")
    )


# -- trade by day ---------------------------------------------------------------


def order_day(orders: DataFrame) -> DataFrame:
    """Orders per day. ``order_fact`` holds an order once, so rows are counted."""
    return orders.groupBy("dt").agg(
        F.count("order_id").alias("order_count"),
        F.countDistinct("user_id").alias("order_user_count"),
        F.sum("payable_amount").alias("gmv"),
    )


def _by_order_and_user(
    rows: DataFrame, orders: Sequence[Column], users: Column, amounts: Sequence[str], counted: Sequence[Column]
) -> DataFrame:
    """Sums of ``orders`` (as n0, n1, ...) and ``amounts`` per day, and what
    ``counted`` says of the distinct ``user`` values.

    ``rows`` hold an order of a day once, ``users`` are its users. Each row
    stands once for its order and once for every user, so one grouping finds
    the distinct users and no measure is summed twice.
    """
    counts = [c.alias(f"n{i}") for i, c in enumerate(orders)]
    nothing = [F.lit(None).cast("int").alias(f"n{i}") for i in range(len(orders))]
    kinds = {f.name: f.dataType for f in rows.schema}
    user_kind = rows.select(users.alias("users")).schema["users"].dataType.elementType
    own = F.struct(F.lit(None).cast(user_kind).alias("user"), *counts, *amounts)
    sides = F.transform(
        users,
        lambda user: F.struct(
            user.alias("user"), *nothing, *(F.lit(None).cast(kinds[a]).alias(a) for a in amounts)
        ),
    )
    measures = [*(f"n{i}" for i in range(len(orders))), *amounts]
    return (
        rows.select("dt", F.explode(F.concat(F.array(own), sides)).alias("side"))
        .select("dt", "side.*")
        .groupBy("dt", "user")
        .agg(*(F.sum(m).alias(m) for m in measures))
        .groupBy("dt")
        .agg(*counted, *(F.sum(m).alias(m) for m in measures))
    )


def pay_day(payments: DataFrame) -> DataFrame:
    """Paid orders, paying users and amounts per day."""
    per_order = (
        successful(payments)
        .groupBy("dt", "order_id")
        .agg(F.sum("pay_amount").alias("pay_amount"), F.collect_set("user_id").alias("payers"))
    )
    known = F.col("order_id").isNotNull().cast("int")
    return _by_order_and_user(
        per_order, [known], F.col("payers"), ["pay_amount"], [F.count("user").alias("pay_user_count")]
    ).select("dt", F.col("n0").alias("pay_order_count"), "pay_user_count", "pay_amount")


def refund_day(refunds: DataFrame) -> DataFrame:
    return (
        approved(refunds)
        .groupBy("dt")
        .agg(
            F.countDistinct("order_id").alias("refund_order_count"),
            F.sum("refund_amount").alias("refund_amount"),
        )
    )


def trade_daily(orders: DataFrame, payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Trade per day, every fact on its own day, missing measures 0.

    Days with payments or refunds but no order are absent, by definition.
    """
    return (
        order_day(orders)
        .join(pay_day(payments), "dt", "left")
        .join(refund_day(refunds), "dt", "left")
        .na.fill(0)
        .transform(with_trade_rates)
    )


def with_trade_rates(trade: DataFrame) -> DataFrame:
    return trade.select(
        "dt",
        "gmv",
        "order_count",
        "order_user_count",
        "pay_order_count",
        "pay_user_count",
        "pay_amount",
        safe_div(F.col("pay_order_count"), F.col("order_count")).alias("pay_conversion_rate"),
        safe_div(F.col("pay_amount"), F.col("pay_order_count")).alias("avg_order_value"),
        "refund_order_count",
        "refund_amount",
        safe_div(F.col("refund_amount"), F.col("pay_amount")).alias("refund_rate"),
    )


def trade_by_order_date(orders: DataFrame, payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Trade per day with payments and refunds on their order's day.

    Both sides are summed per order first, so no order is counted twice and
    an order with many payments joins as one row. Missing measures stay null.
    """
    paid = (
        successful(payments)
        .groupBy("order_id")
        .agg(F.sum("pay_amount").alias("pay_amount"), F.collect_set("user_id").alias("payers"))
    )
    returned = approved(refunds).groupBy("order_id").agg(F.sum("refund_amount").alias("refund_amount"))
    placed = (
        orders.join(paid.withColumn("paid", F.lit(1)), "order_id", "left")
        .join(returned.withColumn("returned", F.lit(1)), "order_id", "left")
    )
    amounts = ["payable_amount", "pay_amount", "refund_amount"]
    # A user is told apart as buyer and as payer of the day's orders.
    buyers = F.when(F.col("user_id").isNotNull(), F.array(F.struct(F.lit("buyer").alias("as"), F.col("user_id").alias("id"))))
    payers = F.transform("payers", lambda user: F.struct(F.lit("payer").alias("as"), user.alias("id")))
    none = F.array().cast(placed.select(payers.alias("p")).schema["p"].dataType)
    users = F.concat(F.coalesce(buyers, none), F.coalesce(payers, none))
    counts = [F.lit(1), F.coalesce("paid", F.lit(0)), F.coalesce("returned", F.lit(0))]
    told = [F.count_if(F.col("user.as") == "buyer").alias("buyers"), F.count_if(F.col("user.as") == "payer").alias("payers")]
    return _by_order_and_user(placed, counts, users, amounts, told).select(
        "dt",
        F.col("n0").alias("order_count"),
        F.col("buyers").alias("order_user_count"),
        F.col("payable_amount").alias("gmv"),
        F.col("n1").alias("pay_order_count"),
        F.col("payers").alias("pay_user_count"),
        "pay_amount",
        F.col("n2").alias("refund_order_count"),
        "refund_amount",
    )


# -- users ------------------------------------------------------------------------


def user_pay_day(payments: DataFrame) -> DataFrame:
    return (
        successful(payments)
        .groupBy("dt", "user_id")
        .agg(F.countDistinct("order_id").alias("pay_order_count"), F.sum("pay_amount").alias("pay_amount"))
    )


def user_daily(orders: DataFrame, payments: DataFrame, refunds: DataFrame, events: DataFrame) -> DataFrame:
    """Orders, payments, refunds and events per day and user.

    The four summaries are stacked and summed once instead of joined in full
    three times. A full join never matches null users, so such rows stay apart
    by their source.
    """
    parts = {
        "order": orders.groupBy("dt", "user_id").agg(
            F.count("order_id").alias("order_count"), F.sum("payable_amount").alias("order_amount")
        ),
        "pay": user_pay_day(payments),
        "refund": approved(refunds)
        .groupBy("dt", "user_id")
        .agg(
            F.countDistinct("order_id").alias("refund_order_count"),
            F.sum("refund_amount").alias("refund_amount"),
        ),
        "event": events.groupBy("dt", "user_id").agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col("event_type") == "view").alias("view_count"),
            F.count_if(F.col("event_type") == "cart").alias("cart_count"),
        ),
    }
    unmatched = F.col("dt").isNull() | F.col("user_id").isNull()
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        (part.withColumn("apart", F.when(unmatched, name)) for name, part in parts.items()),
    )
    measures = [c for c in stacked.columns if c not in ("dt", "user_id", "apart")]
    return (
        stacked.groupBy("dt", "user_id", "apart")
        .agg(*(F.sum(c).alias(c) for c in measures))
        .drop("apart")
        .na.fill(0, measures)
    )


def activity_masks(events: DataFrame) -> DataFrame:
    """Active days of each user as bits: one row per user and period of ``MASK_DAYS``
    days, bit ``k`` set for activity on the period's day ``k``. Masks of several runs
    or sources are merged by ``merged_masks``."""
    day = F.datediff(F.col("dt").cast("date"), F.lit("1970-01-01").cast("date"))
    return (
        events.where(F.col("user_id").isNotNull() & day.isNotNull())
        .select("user_id", F.floor(day / MASK_DAYS).cast("int").alias("period"), F.pmod(day, F.lit(MASK_DAYS)).alias("bit"))
        .groupBy("user_id", "period")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("days"))
    )


def merged_masks(*masks: DataFrame) -> DataFrame:
    return (
        reduce(DataFrame.unionByName, masks).groupBy("user_id", "period").agg(F.bit_or("days").alias("days"))
    )


def retention_from_masks(masks: DataFrame, offsets: Sequence[int] = RETENTION_OFFSETS) -> DataFrame:
    """Share of a day's active users who are active again after n days, any n.

    A user's masks stand side by side, a few numbers a year, and each active day looks
    n days ahead by a shift. Cohorts nobody returns to have no row.
    """
    per_user = masks.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("period", "days"))).alias("masks")
    )

    def active(day: Column) -> Column:
        mask = F.try_element_at("masks", F.floor(day / MASK_DAYS).cast("int"))
        return F.coalesce(mask.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(MASK_DAYS)))) != 0, F.lit(False))

    periods = per_user.select("masks", F.explode("masks").alias("period", "days"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_DAYS - 1)), lambda k: F.call_function("shiftright", "days", k).bitwiseAND(F.lit(1).cast("long")) == 1)
    days = periods.select("masks", F.explode(F.transform(bits, lambda k: F.col("period") * MASK_DAYS + k)).alias("day"))
    cohorts = days.groupBy("day").agg(
        F.count("*").alias("cohort_users"),
        *(F.count_if(active(F.col("day") + n)).alias(f"after_{n}") for n in offsets),
    )
    back = F.array(
        *(F.struct(F.lit(n).alias("day_diff"), F.col(f"after_{n}").alias("retained_users")) for n in offsets)
    )
    return (
        cohorts.select(
            F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).cast("string").alias("cohort_dt"),
            "cohort_users",
            F.inline(back),
        )
        .where(F.col("retained_users") > 0)
        .select(
            "cohort_dt",
            "day_diff",
            "cohort_users",
            "retained_users",
            safe_div(F.col("retained_users"), F.col("cohort_users")).alias("retention_rate"),
            F.col("cohort_dt").alias("dt"),
        )
    )


def user_retention(events: DataFrame, offsets: Sequence[int] = RETENTION_OFFSETS) -> DataFrame:
    return retention_from_masks(activity_masks(events), offsets)


# -- sales --------------------------------------------------------------------------


def _sales(lines: DataFrame, *keys: str) -> DataFrame:
    """Sales, orders and buyers per day and ``keys``.

    The lines of a key's buyer lie side by side, order by order: the first line of an
    order and the first of a buyer are marked, and one sum counts them. A task holds one
    sort of its lines and one row per key, and no line is copied to count two things
    distinctly. Dealing by buyer spreads a large key over all tasks. Lines without an
    order or a buyer count as neither.
    """
    buyer = Window.partitionBy("dt", *keys, "user_id").orderBy("order_id")
    order = F.col("order_id").isNotNull() & ~F.col("order_id").eqNullSafe(F.lag("order_id").over(buyer))
    user = F.col("user_id").isNotNull() & (F.row_number().over(buyer) == 1)
    return (
        lines.select("dt", *keys, "user_id", "order_id", "quantity", "item_amount")
        .repartition("dt", *keys, "user_id")
        .select("dt", *keys, "quantity", "item_amount", order.alias("first_of_order"), user.alias("first_of_buyer"))
        .groupBy("dt", *keys)
        .agg(
            F.sum("quantity").alias("sales_quantity"),
            F.sum("item_amount").alias("sales_amount"),
            F.count_if("first_of_order").alias("order_count"),
            F.count_if("first_of_buyer").alias("buyer_count"),
        )
    )


def product_daily(lines: DataFrame) -> DataFrame:
    return _sales(lines, "product_id", "category_id", "category_name", "brand")


def item_daily(lines: DataFrame) -> DataFrame:
    """As ``product_daily``, for lines whose product columns are not joined yet."""
    return _sales(lines, "product_id")


def shop_daily(lines: DataFrame) -> DataFrame:
    return _sales(lines, "shop_id")


def category_daily(lines: DataFrame) -> DataFrame:
    return _sales(lines, "category_id", "category_name")


# -- stock --------------------------------------------------------------------------


def inventory_daily(logs: DataFrame) -> DataFrame:
    """Stock in, out and at the end of the day per product and shop.

    The last log by (time, id) gives the ending stock; ``max_by`` combines
    before the shuffle, so no window has to gather a product's whole day.
    """
    change: Column = F.col("change_quantity")
    return logs.groupBy("dt", "product_id", "shop_id").agg(
        F.sum(F.greatest(change, F.lit(0))).alias("in_quantity"),
        F.sum(F.greatest(-change, F.lit(0))).alias("out_quantity"),
        F.max_by("after_quantity", F.struct("change_time", "inventory_log_id")).alias("ending_quantity"),
        F.avg("before_quantity").alias("avg_before_quantity"),
    )
