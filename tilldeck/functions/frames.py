"""DataFrame-in, DataFrame-out helpers shared by every layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilldeck.session import scratch_dir

_RANK, _TASK, _ROW = "__rank", "__task", "__row"


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: int, rank: str) -> DataFrame:
    """First ``keep`` rows of every key in the given order, numbered from 1.

    The rank filter lets Spark cut each key to ``keep`` rows before the
    shuffle (WindowGroupLimit), so a hot key never reaches one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= keep)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per business key, fixed by an order over all other columns."""
    order = list(order or ())
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return ranked(df, keys, order + rest, 1, _RANK).drop(_RANK)


def positioned(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 1, in the given order inside its key.

    A key of any size is spread: rows are dealt to tasks by ranges of key and order,
    numbered inside their task and written to the shared scratch folder; then a sum
    over one row per task and key gives how many rows came before. Give an order
    without ties where places must not depend on the run.
    """
    spark, sort = df.sparkSession, [*keys, *order]
    path = scratch_dir(spark, "positions")
    dealt = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt.select("*", F.spark_partition_id().alias(_TASK), F.monotonically_increasing_id().alias(_ROW)).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy(*keys, _TASK).agg(F.min(_ROW).alias("__first"), F.count("*").alias("__rows"))
    before = Window.partitionBy(*keys).orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("__ahead", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    place = F.col(_ROW) - F.col("__first") + F.col("__ahead") + 1
    return rows.join(ahead, [*keys, _TASK]).select(*df.columns, place.alias(name))


def in_date_range(
    df: DataFrame, start: str | None = None, end: str | None = None, time_column: str | None = None
) -> DataFrame:
    """Rows whose ``dt`` lies in the inclusive range; unchanged without ``dt``.

    On a layer table ``dt`` is the partition column, so this prunes partitions.
    Name the ``time_column`` that ``dt`` was derived from to get the same range
    pushed into an unpartitioned scan as well.
    """
    if "dt" not in df.columns:
        return df
    if start:
        df = df.where(F.col("dt") >= start)
        if time_column:
            df = df.where(F.col(time_column) >= F.lit(start).cast("date").cast("timestamp_ntz"))
    if end:
        df = df.where(F.col("dt") <= end)
        if time_column:
            df = df.where(F.col(time_column) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return df


def money_as_double(df: DataFrame) -> DataFrame:
    """Finished amounts as doubles; sums before this point stay exact decimals."""
    decimals = {f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    if not decimals:
        return df
    return df.select(*(F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns))


def times_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` and dates as ``yyyy-MM-dd`` text."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def reported(df: DataFrame) -> DataFrame:
    """Query-result form: amounts as double, times as text."""
    return times_as_text(money_as_double(df))
