"""Raw tables to typed landed tables."""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilldeck.functions.expressions import day_of
from tilldeck.functions.casts import as_time, typed

# Fixed value: tag of the public behaviour dataset, part of every event id.
BEHAVIOR_DATASET = "synerise_recsys_2025"


@dataclass(frozen=True)
class BehaviorSource:
    """A raw behaviour table: its name, landed table, payload and meaning."""

    name: str
    landed: str
    value: str
    value_type: str
    event_type: str


# The five raw behaviour tables.
BEHAVIOR_SOURCES = {
    source.name: source
    for source in (
        BehaviorSource("page_visit", "ods_synerise_page_visit", "url", "bigint", "view"),
        BehaviorSource("search_query", "ods_synerise_search_query", "query", "string", "search"),
        BehaviorSource("add_to_cart", "ods_synerise_add_to_cart", "sku", "bigint", "cart"),
        BehaviorSource("remove_from_cart", "ods_synerise_remove_from_cart", "sku", "bigint", "remove_cart"),
        BehaviorSource("product_buy", "ods_synerise_product_buy", "sku", "bigint", "pay"),
    )
}
PRODUCT_PROPERTIES = "product_properties"
LANDED_PRODUCT_PROPERTIES = "ods_synerise_product_properties"


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case, in one projection."""
    return df.toDF(*(name.strip().lower() for name in df.columns))


def land(df: DataFrame, table_name: str, load_dt: str) -> DataFrame:
    """Names normalised, ``dt`` set or reformatted, audit columns added."""
    df = normalize_names(df)
    if "dt" not in df.columns:
        dt = F.lit(load_dt)
    elif isinstance(df.schema["dt"].dataType, T.StringType):
        dt = F.col("dt").try_cast("date").cast("string")
    else:
        dt = day_of("dt")
    return df.withColumns(
        {"dt": dt, "ods_load_time": F.current_timestamp(), "source_table": F.lit(table_name)}
    )


def land_behavior(df: DataFrame, source: BehaviorSource) -> DataFrame:
    """One raw behaviour table; rows whose time cannot be read are dropped."""
    event_time = as_time(df, "timestamp")
    return (
        df.select(
            typed(df, "client_id", "bigint"),
            F.col("timestamp").cast("string").alias("raw_timestamp"),
            event_time.alias("event_time"),
            typed(df, source.value, source.value_type),
        )
        .where(F.col("event_time").isNotNull())
        .withColumns(
            {
                "dt": day_of("event_time"),
                "source_dataset": F.lit(BEHAVIOR_DATASET),
                "source_table": F.lit(source.name),
                "ods_load_time": F.current_timestamp(),
            }
        )
    )


def land_product_properties(df: DataFrame, load_dt: str) -> DataFrame:
    return df.select(
        typed(df, "sku", "bigint"),
        typed(df, "category", "bigint").alias("category_id"),
        typed(df, "price", "double"),
        typed(df, "name", "string").alias("product_name"),
        F.lit(load_dt).alias("dt"),
        F.lit(BEHAVIOR_DATASET).alias("source_dataset"),
        F.lit(PRODUCT_PROPERTIES).alias("source_table"),
        F.current_timestamp().alias("ods_load_time"),
    )


def sample_rows(df: DataFrame, fraction: float, seed: int = 20260511, by: Sequence[str] | None = None) -> DataFrame:
    """Seeded Bernoulli sample; a fraction outside (0, 1) keeps everything.

    A hash of the seed and the columns ``by`` (default: all) decides, so the
    sample is the same however the rows are partitioned. Equal rows are kept or
    dropped together.
    """
    if not 0 < fraction < 1:
        return df
    values = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by or df.columns)
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), *values), 256)
    return df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < round(fraction * (1 << 32)))


def limit_rows(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of all columns, through one task,
    for development runs; 0 keeps everything."""
    if limit <= 0:
        return df
    return df.orderBy(*df.columns).limit(limit)
