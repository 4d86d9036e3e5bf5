"""Snapshot dimensions and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.functions.expressions import age_group
from tilldeck.functions.casts import as_time, typed
from tilldeck.functions.frames import keep_one


def _latest_first(df: DataFrame) -> list:
    return [F.col("dt").desc_nulls_last()] if "dt" in df.columns else []


def _unique(df: DataFrame, key: str) -> DataFrame:
    """One row per key, from its latest snapshot."""
    return keep_one(df, [key], _latest_first(df))


def dim_user(users: DataFrame, dt: str) -> DataFrame:
    users = _unique(users, "user_id").withColumn("age", typed(users, "age", "int"))
    return users.select(
        "user_id",
        as_time(users, "register_time").alias("register_time"),
        "gender",
        "age",
        age_group(F.col("age")).alias("age_group"),
        "city",
        "user_level",
        "channel",
        typed(users, "is_member", "int"),
        F.lit(dt).alias("dt"),
    )


def dim_product(products: DataFrame, dt: str) -> DataFrame:
    return _unique(products, "product_id").select(
        "product_id",
        "product_name",
        "category_id",
        "category_name",
        "brand",
        "shop_id",
        typed(products, "list_price", "double"),
        typed(products, "cost_price", "double"),
        as_time(products, "create_time").alias("create_time"),
        "status",
        F.lit(dt).alias("dt"),
    )


def dim_shop(shops: DataFrame, dt: str) -> DataFrame:
    return _unique(shops, "shop_id").select(
        "shop_id",
        "shop_name",
        "shop_type",
        "city",
        as_time(shops, "open_time").alias("open_time"),
        typed(shops, "score", "double"),
        F.lit(dt).alias("dt"),
    )


def dim_category(products: DataFrame, dt: str) -> DataFrame:
    """One row per category id, a null id included."""
    pairs = products.select("category_id", "category_name")
    return keep_one(pairs, ["category_id"]).select(
        "category_id", "category_name", F.lit(1).alias("category_level"), F.lit(dt).alias("dt")
    )


def dim_category_distinct_pair(products: DataFrame, dt: str) -> DataFrame:
    """Every distinct (id, name) pair, without a null id."""
    return (
        products.where(F.col("category_id").isNotNull())
        .select("category_id", "category_name")
        .distinct()
        .select("*", F.lit(1).alias("category_level"), F.lit(dt).alias("dt"))
    )


def dim_date(days: DataFrame) -> DataFrame:
    """One row per day of the ranges given as ``first`` and ``last`` dates."""
    date = F.col("date")
    return (
        days.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("date"))
        .select(
            date.cast("string").alias("date_id"),
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofmonth(date).alias("day"),
            F.weekofyear(date).alias("week_of_year"),
            F.dayofweek(date).isin(1, 7).cast("int").alias("is_weekend"),
        )
        .withColumn("dt", F.col("date_id"))
    )


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )


def observed_range(df: DataFrame) -> DataFrame:
    """First and last ``dt`` of a table, as input of :func:`dim_date`."""
    return df.agg(F.min("dt").cast("date").alias("first"), F.max("dt").cast("date").alias("last"))
