"""Raw files: CSV and Parquet scans and the profile of a dataset folder."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text; a missing file is an error.

    Types are given at landing by name, so no inference pass reads the data
    and a changed column order does no harm.
    """
    return spark.read.option("header", True).csv(path)


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def choose(names: str | Sequence[str], known: Sequence[str]) -> list[str]:
    """``"all"``, a comma-separated text or a list, checked against ``known``."""
    if isinstance(names, str):
        if names.strip().lower() == "all":
            return list(known)
        names = [name.strip() for name in names.split(",") if name.strip()]
    unknown = [name for name in names if name not in known]
    if unknown:
        raise ValueError(f"unknown table(s): {', '.join(unknown)}")
    if not names:
        raise ValueError("no table selected")
    return list(names)


def dataset_profile(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Per data file: rows, size and columns. Only Parquet footers are read."""

    def profile(path: str) -> DataFrame:
        df = spark.read.parquet(path)
        columns = ",".join(df.columns)
        return (
            df.groupBy(F.col("_metadata.file_path").alias("file_path"))
            .agg(F.count("*").alias("row_count"), F.max("_metadata.file_size").alias("size_bytes"))
            .select(
                F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
                "row_count",
                F.round(F.col("size_bytes") / 1024 / 1024, 1).alias("size_mb"),
                F.lit(columns).alias("columns"),
            )
        )

    return reduce(DataFrame.unionByName, (profile(path) for path in paths))


def column_profile(df: DataFrame, by_file: bool = False) -> DataFrame:
    """Per column, and per data file if asked: rows, nulls, least and greatest value.

    Numbers have theirs in ``min_number`` and ``max_number``, texts, days and times as
    text; nested and binary columns have none. One pass, combined in every task first.
    """
    file = [F.col("_metadata.file_name").alias("file_name")] if by_file else []
    entries, sums = [], []
    for place, field in enumerate(df.schema):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        limits = {"text": F.lit(None).cast("string"), "number": F.lit(None).cast("double")}
        values: dict[str, list[Column]] = {name: [null, null] for name, null in limits.items()}
        sums.append(F.count(column).alias(f"n_{place}"))
        if isinstance(kind, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            sums += [F.min(column).alias(f"low_{place}"), F.max(column).alias(f"high_{place}")]
            ends = [F.col(f"low_{place}"), F.col(f"high_{place}")]
            if isinstance(kind, T.NumericType):
                values["number"] = [end.cast("double") + 0.0 for end in ends]  # no negative zero
            elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                values["text"] = [F.date_format(end, "yyyy-MM-dd HH:mm:ss") for end in ends]
            else:
                values["text"] = [end.cast("string") for end in ends]
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("row_count"),
                (F.col("row_count") - F.col(f"n_{place}")).alias("null_count"),
                *(v.alias(f"{end}_{name}") for name, pair in values.items() for end, v in zip(("min", "max"), pair)),
            )
        )
    counted = df.groupBy(*file).agg(F.count("*").alias("row_count"), *sums)
    return counted.select(*(["file_name"] if by_file else []), F.inline(F.array(*entries)))
