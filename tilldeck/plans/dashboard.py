"""The dashboard payload from written metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.operators import reporting as R
from tilldeck.operators.reporting import Section
from tilldeck.sources.layers import read_layer

# Section, metric table and the order of the latest day's top rows.
RETAIL_TOPS = (
    ("product_topn", "ads_product_topn", ("-sales_amount", "rank_no")),
    ("category_topn", "ads_category_topn", ("-sales_amount", "rank_no")),
    ("shop_rank", "ads_shop_rank", ("-sales_amount", "rank_no")),
    ("refund_analysis", "ads_refund_analysis", ("-refund_amount", "refund_reason", "refund_status")),
    ("inventory_turnover", "ads_inventory_turnover", ("-inventory_turnover_rate", "product_id", "shop_id")),
)
BEHAVIOR_TOPS = (
    ("synerise_product_topn", "ads_synerise_product_topn", ("-pay_event_count", "rank_no")),
    ("synerise_category_topn", "ads_synerise_category_topn", ("-pay_event_count", "rank_no")),
)


def _top(table: DataFrame, day: DataFrame, order: tuple[str, ...], keep: int) -> Section:
    by = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]
    return Section(R.on_day(table, day).orderBy(*by).limit(keep), order)


def retail_sections(
    spark: SparkSession, root: str, topn: int = R.TOP, until: str | None = None
) -> dict[str, Section]:
    """Sections of the retail metric tables, as of their latest day, no later than
    ``until`` if given."""
    daily = read_layer(spark, root, "ads_retail_dashboard_daily")
    retention = read_layer(spark, root, "ads_user_retention")
    rfm = read_layer(spark, root, "ads_rfm_user_segment")
    tops = {section: read_layer(spark, root, table) for section, table, _ in RETAIL_TOPS}
    dated = [daily, retention, rfm, *tops.values()]
    day = R.latest_dt(*(table.where(F.col("dt") <= until) if until else table for table in dated))
    # Money as decimal: the sum must not depend on the order of rows.
    segments = R.segment_rollup(rfm.withColumn("monetary", F.col("monetary").cast("decimal(28,4)")))
    sections = {
        "latest_dt": Section(day),
        "kpis": Section(R.on_day(daily, day)),
        "daily": Section(daily, ("dt",)),
        "retention": Section(R.latest_retention(retention, day, 2 * topn), ("cohort_dt", "day_diff")),
        "rfm_segment": Section(segments, ("-user_count", "user_segment")),
    }
    for section, _, order in RETAIL_TOPS:
        sections[section] = _top(tops[section], day, order, topn)
    return sections


def behavior_sections(spark: SparkSession, root: str, topn: int = R.TOP) -> dict[str, Section]:
    daily = read_layer(spark, root, "ads_synerise_behavior_dashboard_daily")
    day = R.latest_non_sparse_dt(daily)
    sections = {
        "synerise_latest_dt": Section(day),
        "synerise_kpis": Section(R.on_day(daily, day)),
        "synerise_daily": Section(daily, ("dt",)),
        "synerise_event_type": Section(read_layer(spark, root, "ads_synerise_event_type_trend"), ("dt", "event_type")),
    }
    for section, table, order in BEHAVIOR_TOPS:
        rows = read_layer(spark, root, table)
        sections[section] = _top(rows, day, order, topn)
        sections[f"{section}_all"] = Section(rows, ("dt", "rank_no"))
    return sections
