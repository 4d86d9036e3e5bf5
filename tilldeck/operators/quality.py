"""Twelve data-quality rules: which rows break them and how many.

Rules that look at the same rows are counted in one pass over them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilldeck.functions.expressions import VALID_EVENT_TYPES, missing_any
from tilldeck.functions.frames import keep_one

# Rule ids, names, tables and descriptions as reported.
RULES = {
    "DQ001": ("主键重复检查", "dwd_trade_order_detail", "订单明细主键 order_item_id 不应重复。"),
    "DQ002": ("关键字段为空检查", "dwd_trade_order_detail", "交易明细关键字段不能为空。"),
    "DQ003": ("订单金额异常检查", "dwd_trade_order_detail", "订单金额、优惠金额和应付金额需满足基本金额关系。"),
    "DQ004": ("支付金额与订单金额一致性检查", "dwd_trade_payment_detail", "成功支付金额应与订单应付金额基本一致。"),
    "DQ005": ("支付时间早于下单时间检查", "dwd_trade_payment_detail", "支付时间不能早于下单时间。"),
    "DQ006": ("退款金额大于支付金额检查", "dwd_trade_refund_detail", "退款金额不能超过成功支付金额。"),
    "DQ007": ("维表关联缺失检查", "dwd_trade_order_detail", "交易明细中的用户、商品、店铺必须能关联到维表。"),
    "DQ008": ("每日分区为空检查", "dwd_trade_order_detail", "指定日期范围内每日应有交易分区。"),
    "DQ009": ("用户行为事件类型非法检查", "ods_user_events", "事件类型必须属于 view/search/cart/favorite/order/pay。"),
    "DQ010": ("库存流水数量异常检查", "dwd_inventory_change_detail", "库存流水需满足 before + change = after，且数量不能异常放大。"),
    "DQ011": ("支付主键重复检查", "dwd_trade_payment_detail", "支付流水 payment_id 不应重复。"),
    "DQ012": ("退款关键字段为空检查", "dwd_trade_refund_detail", "退款明细关键字段不能为空。"),
}
ORDER_KEYS = ("order_id", "user_id", "product_id", "shop_id", "dt")
REFUND_KEYS = ("refund_id", "order_id", "user_id", "refund_time", "dt")
AMOUNT_TOLERANCE = 1
LARGEST_MOVE = 100000
# Wording of the report.
REPORT_TITLE = "# 数据质量报告"
REPORT_TOTALS = ("- 检查项总数：{}", "- 通过：{}", "- 失败：{}")
REPORT_HEADER = ("| 规则ID | 规则名称 | 检查表 | 状态 | 异常数 | 说明 |", "| --- | --- | --- | --- | ---: | --- |")
REPORT_CLOSING = (
    "## 解读",
    "该报告用于离线批处理完成后的基础质量验收。若出现 FAIL，应优先排查源数据生成、DWD 清洗逻辑和维表装载是否一致。",
)


@dataclass(frozen=True)
class QualityInputs:
    """The tables under test. ``orders`` are headers for the amount rule;
    ``expected`` has one row of ``first`` and ``last`` day, or none."""

    lines: DataFrame
    orders: DataFrame
    payments: DataFrame
    refunds: DataFrame
    events: DataFrame
    inventory: DataFrame
    users: DataFrame
    products: DataFrame
    shops: DataFrame
    expected: DataFrame | None = None


def status(error_count: Column) -> Column:
    return F.when(error_count == 0, "PASS").otherwise("FAIL")


def _counted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, in one aggregate."""
    counts = df.agg(*(F.count_if(broken).alias(rule) for rule, broken in rules.items()))
    return _rows(counts, list(rules))


def _rows(counts: DataFrame, rules: Sequence[str]) -> DataFrame:
    """One column per rule to one described row per rule."""
    entries = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule_id"),
                F.lit(RULES[rule][0]).alias("rule_name"),
                F.lit(RULES[rule][1]).alias("table_name"),
                status(F.col(rule)).alias("status"),
                F.col(rule).alias("error_count"),
                F.lit(RULES[rule][2]).alias("description"),
            )
            for rule in rules
        )
    )
    return counts.select(F.inline(entries))


def _repeated(df: DataFrame, key: str, rule: str) -> DataFrame:
    """Number of key values that occur more than once."""
    groups = df.groupBy(key).agg(F.count("*").alias("copies"))
    return _counted(groups, {rule: F.col("copies") > 1})


def _amount_rule(inputs: QualityInputs, _: Sequence[str]) -> DataFrame:
    gap = F.col("total_amount") - F.col("discount_amount") - F.col("payable_amount")
    broken = (
        (F.col("total_amount") < 0)
        | (F.col("discount_amount") < 0)
        | (F.col("payable_amount") < 0)
        | (F.abs(gap) > AMOUNT_TOLERANCE)
    )
    amounts = inputs.orders.select("order_id", "total_amount", "discount_amount", "payable_amount")
    per_order = keep_one(amounts, ["order_id"])
    return _counted(per_order, {"DQ003": broken})


def _line_rules(inputs: QualityInputs, rules: Sequence[str]) -> DataFrame:
    """Blank keys, and keys some dimension does not know, in one pass over the lines.

    Lines keep one flag and the keys, which are looked up in each dimension's distinct
    keys; a null key is unknown. AQE sends a small dimension to all tasks and splits a
    skewed left side.
    """
    keys = (("user_id", inputs.users), ("product_id", inputs.products), ("shop_id", inputs.shops))
    lines = inputs.lines.select(*(key for key, _ in keys), missing_any(ORDER_KEYS).alias("blank"))
    unknown = F.lit(False)
    if "DQ007" in rules:
        for key, dim in keys:
            known = dim.select(key).distinct().withColumn(f"{key}_known", F.lit(True))
            lines = lines.join(known, key, "left")
            unknown = unknown | F.col(f"{key}_known").isNull()
    return _rows(lines.agg(F.count_if("blank").alias("DQ002"), F.count_if(unknown).alias("DQ007")), rules)


def _payment_rules(inputs: QualityInputs, rules: Sequence[str]) -> DataFrame:
    off = F.abs(F.col("pay_amount") - F.col("order_payable_amount")) > AMOUNT_TOLERANCE
    tests = {
        "DQ004": (F.col("pay_status") == "success") & off,
        "DQ005": F.col("pay_time") < F.col("order_time"),
    }
    return _counted(inputs.payments, {rule: test for rule, test in tests.items() if rule in rules})


def _missing_days(inputs: QualityInputs, _: Sequence[str]) -> DataFrame:
    """Expected days without any line; 0 when no range is expected."""
    present = inputs.lines.select("dt").distinct()
    if inputs.expected is None:
        return _counted(present, {"DQ008": F.lit(False)})
    days = inputs.expected.select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("day")
    ).select(F.col("day").cast("string").alias("dt"))
    return _counted(days.join(present, "dt", "left_anti"), {"DQ008": F.lit(True)})


def _event_rule(inputs: QualityInputs, _: Sequence[str]) -> DataFrame:
    return _counted(inputs.events, {"DQ009": ~F.lower("event_type").isin(*VALID_EVENT_TYPES)})


def _stock_rule(inputs: QualityInputs, _: Sequence[str]) -> DataFrame:
    before, change, after = (F.col(f"{c}_quantity").cast("bigint") for c in ("before", "change", "after"))
    broken = (before < 0) | (after < 0) | (before + change != after) | (F.abs(change) > LARGEST_MOVE)
    return _counted(inputs.inventory, {"DQ010": broken})


def _refund_rules(inputs: QualityInputs, rules: Sequence[str]) -> DataFrame:
    tests: dict[str, Column] = {}
    if "DQ006" in rules:
        tests["DQ006"] = F.col("refund_amount") > F.col("paid_amount")
    if "DQ012" in rules:
        tests["DQ012"] = missing_any(REFUND_KEYS)
    return _counted(inputs.refunds, tests)


# Which builder answers which rules; one builder is one pass over its rows.
_BUILDERS: tuple[tuple[tuple[str, ...], Callable[[QualityInputs, Sequence[str]], DataFrame]], ...] = (
    (("DQ001",), lambda inputs, _: _repeated(inputs.lines, "order_item_id", "DQ001")),
    (("DQ002", "DQ007"), _line_rules),
    (("DQ003",), _amount_rule),
    (("DQ004", "DQ005"), _payment_rules),
    (("DQ006", "DQ012"), _refund_rules),
    (("DQ008",), _missing_days),
    (("DQ009",), _event_rule),
    (("DQ010",), _stock_rule),
    (("DQ011",), lambda inputs, _: _repeated(inputs.payments, "payment_id", "DQ011")),
)


def quality_checks(inputs: QualityInputs, only: Sequence[str] | None = None) -> DataFrame:
    """One row per rule: status is PASS when no row breaks it."""
    wanted = set(only or RULES)
    passes = [
        build(inputs, [rule for rule in rules if rule in wanted])
        for rules, build in _BUILDERS
        if wanted.intersection(rules)
    ]
    return reduce(DataFrame.unionByName, passes)


def quality_summary(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") != "PASS").alias("failed"),
    )


def quality_report(checks: DataFrame) -> DataFrame:
    """The Markdown report, one numbered line per row."""
    total, passed, failed = (text.replace("{}", "%d") for text in REPORT_TOTALS)
    fixed_tail = [F.lit(""), *(F.lit(text) for text in REPORT_HEADER)]
    head = quality_summary(checks).select(
        F.posexplode(
            F.array(
                F.lit(REPORT_TITLE),
                F.lit(""),
                F.format_string(total, "total"),
                F.format_string(passed, "passed"),
                F.format_string(failed, "failed"),
                *fixed_tail,
            )
        ).alias("line_no", "line")
    )
    body = checks.select(
        (F.lit(7) + F.substring("rule_id", 3, 3).cast("int")).alias("line_no"),
        F.format_string(
            "| %s | %s | `%s` | %s | %d | %s |",
            "rule_id",
            "rule_name",
            "table_name",
            "status",
            "error_count",
            "description",
        ).alias("line"),
    )
    heading, text = REPORT_CLOSING
    tail = head.sparkSession.range(1).select(
        F.posexplode(F.array(F.lit(""), F.lit(heading), F.lit(""), F.lit(text))).alias("at", "line")
    )
    closing = tail.select((F.col("at") + 8 + len(RULES)).alias("line_no"), "line")
    return head.unionByName(body).unionByName(closing)
