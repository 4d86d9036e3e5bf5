"""Columns of raw tables in the types the layers ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilldeck.functions.expressions import lenient_cast


def as_time(df: DataFrame, column: str) -> Column:
    """A time column as a timestamp; malformed text becomes null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column)


def typed(df: DataFrame, column: str, target_type: str) -> Column:
    return lenient_cast(F.col(column), df.schema[column].dataType.simpleString(), target_type).alias(column)
