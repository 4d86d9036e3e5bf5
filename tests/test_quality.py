from __future__ import annotations

from dataclasses import replace

import pytest

from tilldeck.operators import quality as Q


@pytest.fixture(scope="module")
def inputs(spark):
    def table(data, schema):
        return spark.createDataFrame(data, schema)

    lines = table(
        [
            ("I1", "O1", "U1", "P1", "S1", "2025-01-01"),
            ("I1", "O1", "U1", "P1", "S1", "2025-01-01"),
            ("I1", "O1", "U1", "P1", "S1", "2025-01-01"),
            ("I2", "O1", " ", "P1", "S1", "2025-01-01"),
            ("I3", "O2", "U9", "P9", "S1", "2025-01-03"),
            ("I4", "O2", "U1", None, "S1", "2025-01-03"),
        ],
        "order_item_id string, order_id string, user_id string, product_id string, shop_id string, dt string",
    )
    amounts = "order_id string, total_amount double, discount_amount double, payable_amount double"
    orders = table(
        [
            ("O1", 100.0, 10.0, 90.0),
            ("O2", 100.0, 10.0, 89.0),
            ("O3", 100.0, 10.0, 88.5),
            ("O4", -5.0, 0.0, -5.0),
            ("O4", -5.0, 0.0, -5.0),
            ("O5", 10.0, -1.0, 11.0),
        ],
        amounts,
    )
    payments = spark.sql(
        """select * from values
        ('Y1', 'success', 90.0D, 91.0D, timestamp'2025-01-01 10:00:00', timestamp'2025-01-01 09:00:00'),
        ('Y1', 'success', 90.0D, 91.5D, timestamp'2025-01-01 08:00:00', timestamp'2025-01-01 09:00:00'),
        ('Y2', 'failed', 9.0D, 91.5D, timestamp'2025-01-01 08:00:00', null)
        as t(payment_id, pay_status, pay_amount, order_payable_amount, pay_time, order_time)"""
    )
    refunds = spark.sql(
        """select * from values
        ('R1', 'O1', 'U1', timestamp'2025-01-01 10:00:00', '2025-01-01', 10.0D, 9.0D),
        ('R2', 'O1', '', timestamp'2025-01-01 10:00:00', '2025-01-01', 10.0D, null),
        ('R3', 'O1', 'U1', null, '2025-01-01', 10.0D, 10.0D)
        as t(refund_id, order_id, user_id, refund_time, dt, refund_amount, paid_amount)"""
    )
    events = table([("view",), ("VIEW",), ("hover",), (None,)], "event_type string")
    inventory = table(
        [(10, 5, 15), (10, 5, 16), (-1, 5, 4), (5, -9, -4), (0, 100001, 100001), (0, 100000, 100000)],
        "before_quantity int, change_quantity int, after_quantity int",
    )
    keys = {k: table([(f"{k[0].upper()}1",), (f"{k[0].upper()}1",)], f"{k}_id string") for k in ("user", "product", "shop")}
    expected = spark.sql("select date'2025-01-01' first, date'2025-01-04' last")
    return Q.QualityInputs(
        lines, orders, payments, refunds, events, inventory, keys["user"], keys["product"], keys["shop"], expected
    )


EXPECTED = {
    "DQ001": 1,
    "DQ002": 2,
    "DQ003": 3,
    "DQ004": 1,
    "DQ005": 1,
    "DQ006": 1,
    "DQ007": 3,
    "DQ008": 2,
    "DQ009": 1,
    "DQ010": 4,
    "DQ011": 1,
    "DQ012": 2,
}


def test_every_rule_counts_its_rows(inputs):
    got = {r.rule_id: r for r in Q.quality_checks(inputs).collect()}
    assert {rule: r.error_count for rule, r in got.items()} == EXPECTED
    assert all(r.status == "FAIL" for r in got.values())


@pytest.mark.parametrize("rule", ["DQ002", "DQ006", "DQ007"])
def test_single_rule(inputs, rule):
    (row,) = Q.quality_checks(inputs, [rule]).collect()
    assert (row.rule_id, row.error_count) == (rule, EXPECTED[rule])


def test_no_expected_range_means_no_missing_day(inputs):
    import dataclasses

    (row,) = Q.quality_checks(dataclasses.replace(inputs, expected=None), ["DQ008"]).collect()
    assert (row.status, row.error_count) == ("PASS", 0)


def test_report(spark):
    checks = spark.createDataFrame(
        [
            ("DQ001", "主键重复检查", "table_a", "PASS", 0, "ok"),
            ("DQ002", "关键字段为空检查", "table_b", "FAIL", 2, "bad"),
        ],
        "rule_id string, rule_name string, table_name string, status string, error_count long, description string",
    )
    lines = [r.line for r in Q.quality_report(checks).orderBy("line_no").collect()]
    assert "- 检查项总数：2" in lines and "- 失败：1" in lines
    assert lines[-5] == "| DQ002 | 关键字段为空检查 | `table_b` | FAIL | 2 | bad |"
    assert lines[-4:] == ["", "## 解读", "", Q.REPORT_CLOSING[1]]
    assert tuple(Q.quality_summary(checks).first()) == (2, 1, 1)


def test_keys_are_probed_in_one_pass_over_the_lines(inputs):
    plan = Q.quality_checks(inputs, ["DQ002", "DQ007"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("order_item_id") <= 1 and plan.count("Join LeftOuter") == 3


def test_blank_keys_are_unknown_keys(spark, inputs):
    lines = spark.createDataFrame(
        [("I1", "O1", "U1", "P1", "S1", "d"), ("I2", None, None, "P1", "S1", "d"), ("I3", "O1", "U1", "P1", "S8", None)],
        inputs.lines.schema,
    )
    got = {r.rule_id: r.error_count for r in Q.quality_checks(replace(inputs, lines=lines), ["DQ002", "DQ007"]).collect()}
    assert got == {"DQ002": 2, "DQ007": 2}
