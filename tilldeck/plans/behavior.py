"""The behaviour layers over a date range; any stage can be left out."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tilldeck.context import RunContext
from tilldeck.functions.frames import in_date_range
from tilldeck.operators import behavior
from tilldeck.operators.landing import (
    BEHAVIOR_SOURCES,
    LANDED_PRODUCT_PROPERTIES,
    PRODUCT_PROPERTIES,
    land_behavior,
    land_product_properties,
    limit_rows,
    sample_rows,
)
from tilldeck.sources.files import choose, read_raw_parquet
from tilldeck.sources.layers import read_layer, write_layer

STAGES = ("ods", "dwd", "dws", "ads")
RAW_BEHAVIOR_TABLES = (*BEHAVIOR_SOURCES, PRODUCT_PROPERTIES)


def raw_parquet_tables(
    spark: SparkSession, folder: str, tables: str | Sequence[str] = "all"
) -> dict[str, DataFrame]:
    """The chosen raw tables of a folder; a missing file is an error."""
    names = choose(tables, RAW_BEHAVIOR_TABLES)
    return {name: read_raw_parquet(spark, f"{folder.rstrip('/')}/{name}.parquet") for name in names}


def build_landed(
    raw: Mapping[str, DataFrame],
    root: str,
    run: RunContext,
    sample_fraction: float = 0.0,
    limit_per_table: int = 0,
    mode: str = "overwrite",
    output_partitions: int | None = None,
) -> None:
    for name, df in raw.items():
        df = limit_rows(sample_rows(df, sample_fraction), limit_per_table)
        if name == PRODUCT_PROPERTIES:
            landed, table = land_product_properties(df, run.behavior_load_dt), LANDED_PRODUCT_PROPERTIES
        else:
            source = BEHAVIOR_SOURCES[name]
            landed, table = in_date_range(land_behavior(df, source), run.start, run.end), source.landed
        write_layer(landed, root, table, mode, output_partitions, run.days)


def build_detail(
    spark: SparkSession,
    root: str,
    run: RunContext,
    tables: str | Sequence[str] = "all",
    limit_per_table: int = 0,
    deduplicate: bool = False,
    broadcast_products: bool = False,
    output_partitions: int | None = None,
) -> None:
    sources = [BEHAVIOR_SOURCES[name] for name in choose(tables, tuple(BEHAVIOR_SOURCES))]
    landed = {
        source.name: limit_rows(
            read_layer(spark, root, source.landed, run.start, run.end), limit_per_table
        )
        for source in sources
    }
    properties = None
    if any(source.value == "sku" for source in sources):
        properties = read_layer(spark, root, LANDED_PRODUCT_PROPERTIES)
    detail = behavior.behavior_detail(landed, properties, deduplicate, broadcast_products)
    write_layer(
        detail, root, "dwd_synerise_user_behavior_detail", output_partitions=output_partitions, days=run.days
    )


def build_summaries(
    spark: SparkSession, root: str, run: RunContext, approx: bool = True, output_partitions: int | None = None
) -> None:
    """Daily summaries; user and sku counts are sketches unless ``approx`` is off."""
    events = read_layer(spark, root, "dwd_synerise_user_behavior_detail", run.start, run.end)
    built = {
        "dws_synerise_event_type_day_summary": behavior.behavior_event_type_daily,
        "dws_synerise_behavior_day_summary": behavior.behavior_daily,
        "dws_synerise_product_day_summary": behavior.behavior_product_daily,
        "dws_synerise_category_day_summary": behavior.behavior_category_daily,
    }
    for table, build in built.items():
        write_layer(build(events, approx), root, table, output_partitions=output_partitions, days=run.days)


def build_metrics(spark: SparkSession, root: str, run: RunContext, topn: int = behavior.TOP) -> None:
    def ranged(table: str) -> DataFrame:
        return read_layer(spark, root, table, run.start, run.end)

    built = {
        "ads_synerise_behavior_dashboard_daily": ranged("dws_synerise_behavior_day_summary"),
        "ads_synerise_event_type_trend": ranged("dws_synerise_event_type_day_summary"),
        "ads_synerise_product_topn": behavior.behavior_product_topn(
            ranged("dws_synerise_product_day_summary"), topn
        ),
        "ads_synerise_category_topn": behavior.behavior_category_topn(
            ranged("dws_synerise_category_day_summary"), topn
        ),
    }
    for table, df in built.items():
        write_layer(df, root, table, days=run.days)


def build_behavior(
    spark: SparkSession,
    raw: Mapping[str, DataFrame] | None,
    root: str,
    run: RunContext,
    skip: Collection[str] = (),
    tables: str | Sequence[str] = "all",
    sample_fraction: float = 0.0,
    limit_per_table: int = 0,
    mode: str = "overwrite",
    deduplicate: bool = False,
    broadcast_products: bool = False,
    approx: bool = True,
    topn: int = behavior.TOP,
    output_partitions: int | None = None,
) -> None:
    """All behaviour layers in order, without the stages named in ``skip``."""
    if "ods" not in skip:
        build_landed(raw or {}, root, run, sample_fraction, limit_per_table, mode, output_partitions)
    if "dwd" not in skip:
        events = [name for name in choose(tables, RAW_BEHAVIOR_TABLES) if name in BEHAVIOR_SOURCES]
        build_detail(
            spark, root, run, events, limit_per_table, deduplicate, broadcast_products, output_partitions
        )
    if "dws" not in skip:
        build_summaries(spark, root, run, approx, output_partitions)
    if "ads" not in skip:
        build_metrics(spark, root, run, topn)
