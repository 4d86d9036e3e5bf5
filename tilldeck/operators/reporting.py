"""Report queries over finished summaries.

Maxima and cut-off days are scalar subqueries, so no summary has to pass
through a single task to be compared with its own total.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilldeck.functions.expressions import clean_value, safe_div
from tilldeck.functions.frames import positioned
from tilldeck.operators.behavior import STEPS

SPARSE_SHARE = 0.1
WINDOW_DAYS = 42
TOP = 10
# Steps of the conversion funnel.
FUNNEL = ("view", "search", "cart", "pay")


def latest_dt(*tables: DataFrame) -> DataFrame:
    """Latest day over several tables."""
    tops = (table.agg(F.max("dt").alias("dt")) for table in tables)
    return reduce(DataFrame.unionByName, tops).agg(F.max("dt").alias("latest_dt"))


def latest_non_sparse_dt(daily: DataFrame, count_column: str = "event_count") -> DataFrame:
    """Latest day with at least a tenth of the busiest day's events.

    Without any positive count every day qualifies.
    """
    peak = daily.select(F.coalesce(F.max(count_column), F.lit(0))).scalar()
    dense = (peak <= 0) | (F.col(count_column) >= peak * SPARSE_SHARE)
    return daily.where(dense).agg(F.max("dt").alias("latest_dt"))


def on_day(table: DataFrame, day: DataFrame) -> DataFrame:
    """Rows of the day a one-row, one-column DataFrame names."""
    return table.where(F.col("dt") == day.scalar())


def day_top(
    table: DataFrame, day: DataFrame, section: str, by: str, keys: Sequence[str], keep: int = TOP
) -> DataFrame:
    """The day's best rows of one table in a shape all sections share."""
    order = [F.col(by).desc_nulls_last(), *(F.col(key).asc_nulls_last() for key in keys)]
    label = F.concat_ws("/", *(F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys))
    return (
        on_day(table, day)
        .orderBy(*order)
        .limit(keep)
        .select(
            F.lit(section).alias("section"),
            "dt",
            label.alias("item"),
            clean_value(F.col(by).cast("double")).alias("value"),
        )
    )


def segment_rollup(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("user_segment").agg(
        F.count("user_id").alias("user_count"), F.sum("monetary").alias("monetary")
    )


def latest_retention(retention: DataFrame, day: DataFrame, keep: int = 2 * TOP) -> DataFrame:
    return on_day(retention, day).orderBy("cohort_dt", "day_diff").limit(keep)


def period_kpis(trade: DataFrame) -> DataFrame:
    """Key figures of a whole period: ratios of sums, denominators at least 1."""
    measures = ("gmv", "pay_amount", "refund_amount", "order_count", "pay_order_count", "pay_user_count")
    totals = trade.agg(*(F.coalesce(F.sum(m), F.lit(0)).cast("double").alias(m) for m in measures))

    def share(numerator: str, denominator: str) -> Column:
        return F.col(numerator) / F.greatest(F.col(denominator), F.lit(1.0))

    return totals.select(
        F.round("gmv", 2).alias("gmv"),
        F.round("pay_amount", 2).alias("pay_amount"),
        F.round(share("pay_order_count", "order_count"), 4).alias("pay_conversion_rate"),
        F.round(share("pay_amount", "pay_order_count"), 2).alias("avg_order_value"),
        F.round(1 - share("pay_user_count", "pay_order_count"), 4).alias("repeat_purchase_rate"),
        F.round(share("refund_amount", "pay_amount"), 4).alias("refund_rate"),
    )


def recent_days(
    table: DataFrame, start: str | None = None, end: str | None = None, keep: int = WINDOW_DAYS
) -> DataFrame:
    """The last ``keep`` days of a range, or of all days if the range is empty."""
    day = F.col("dt")
    inside = F.lit(True)
    if start:
        inside = inside & (day >= start)
    if end:
        inside = inside & (day <= end)
    days = table.select("dt").distinct()
    empty = days.select(~F.coalesce(F.bool_or(inside), F.lit(False))).scalar()
    chosen = table.where(empty | inside)
    first = (
        chosen.select("dt").distinct().orderBy(day.desc()).limit(keep).select(F.min("dt")).scalar()
    )
    return chosen.where(day >= first)


def funnel_steps(daily: DataFrame) -> DataFrame:
    """Each day's four funnel steps with their share of the largest one."""
    counts = [F.col(f"{step}_event_count") for step in FUNNEL]
    largest = F.greatest(F.lit(1), *counts)
    steps = F.array(
        *(
            F.struct(
                F.lit(number).alias("step_no"),
                F.lit(step).alias("step"),
                count.alias("event_count"),
                safe_div(count, largest).alias("share"),
            )
            for number, (step, count) in enumerate(zip(FUNNEL, counts), start=1)
        )
    )
    return daily.select("dt", F.inline(steps))


def event_heatmap(event_types: DataFrame) -> DataFrame:
    """Day by event type, absent cells 0, with the square root of each
    count's share of the largest count as colour intensity."""
    peak = event_types.select(F.greatest(F.lit(1), F.max("event_count"))).scalar()
    matrix = event_types.groupBy("dt").pivot("event_type", list(STEPS)).agg(F.sum("event_count")).na.fill(0)
    cells = matrix.unpivot("dt", list(STEPS), "event_type", "event_count")
    return cells.select(
        "dt",
        "event_type",
        "event_count",
        clean_value(F.sqrt(F.col("event_count") / peak)).alias("intensity"),
    )


def conversion_lift(daily: DataFrame) -> DataFrame:
    """Each day's view-to-pay rate against the mean rate of all given days."""
    rate = F.coalesce(F.col("view_to_pay_rate"), F.lit(0.0))
    mean = daily.select(F.avg(rate)).scalar()
    return daily.select(
        "dt",
        clean_value(rate).alias("view_to_pay_rate"),
        clean_value(mean).alias("window_mean"),
        clean_value(safe_div(rate - mean, mean)).alias("lift"),
    )


def conversion_scatter(daily: DataFrame) -> DataFrame:
    """Users, rate and events of each day, scaled by their maxima."""

    floors = {"active_user_count": 1.0, "view_to_pay_rate": 0.001, "event_count": 1.0}
    peaks = daily.select(
        F.struct(*(F.greatest(F.lit(floor), F.max(F.col(c).cast("double"))).alias(c) for c, floor in floors.items()))
    ).scalar()

    def scaled(column: str) -> Column:
        return clean_value(F.coalesce(F.col(column), F.lit(0)).cast("double") / peaks.getField(column))

    return daily.select(
        "dt",
        scaled("active_user_count").alias("user_scale"),
        scaled("view_to_pay_rate").alias("rate_scale"),
        scaled("event_count").alias("event_scale"),
    )


@dataclass(frozen=True)
class Section:
    """Rows of one dashboard section and the columns they are listed by, a ``-`` in
    front for descending. Nulls come last."""

    rows: DataFrame
    order: tuple[str, ...] = ()


def _sort_key(section: Section) -> Column:
    """The order of any section in one comparable type."""
    keys = []
    for name in section.order:
        column = F.col(name.removeprefix("-"))
        if isinstance(section.rows.schema[name.removeprefix("-")].dataType, T.NumericType):
            number = column.cast("double") * (-1 if name.startswith("-") else 1)
            keys.append(F.struct(F.coalesce(number, F.lit(float("inf"))).alias("n"), F.lit("").alias("t")))
        elif name.startswith("-"):
            raise ValueError(f"{name}: only numbers are listed in descending order")
        else:
            null = F.when(column.isNull(), float("inf")).otherwise(0.0)
            keys.append(F.struct(null.alias("n"), F.coalesce(column.cast("string"), F.lit("")).alias("t")))
    return F.array(*keys) if keys else F.expr("cast(array() as array<struct<n: double, t: string>>)")


def payload(sections: dict[str, Section]) -> DataFrame:
    """Dashboard sections as rows of (section, position, record, values).

    ``position`` counts from 1 in the section's order, ``record`` is the row as JSON
    with cleaned numbers, ``values`` the same as an array of typed entries. Positions
    are found without any section passing through one task, see ``positioned``.
    """

    def records(name: str, section: Section) -> DataFrame:
        columns, entries = [], []
        for field in section.rows.schema:
            column, number, text = F.col(field.name), F.lit(None).cast("double"), F.lit(None).cast("string")
            if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
                column = number = clean_value(column.cast("double"))
            elif isinstance(field.dataType, T.NumericType):
                number = column.cast("double")
            else:
                text = column.cast("string")
            columns.append(column.alias(field.name))
            entries.append(F.struct(F.lit(field.name).alias("key"), text.alias("text"), number.alias("number")))
        return section.rows.select(
            F.lit(name).alias("section"),
            _sort_key(section).alias("sort_key"),
            F.to_json(F.struct(*columns)).alias("record"),
            F.array(*entries).alias("values"),
        )

    rows = reduce(DataFrame.unionByName, (records(name, section) for name, section in sections.items()))
    return positioned(rows, ["section"], ["sort_key", "record"]).drop("sort_key")


def payload_values(payload: DataFrame) -> DataFrame:
    """One row per value of the payload."""
    return payload.select("section", "position", F.inline("values")).withColumnsRenamed(
        {"text": "text_value", "number": "number_value"}
    )
