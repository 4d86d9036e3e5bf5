"""Report files: JSON lines for dashboards and one Markdown text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_payload(payload: DataFrame, path: str) -> None:
    """One folder per section, one JSON record per line, in the order of positions:
    along the files' names and inside each file."""
    (
        payload.repartitionByRange("section", "position")
        .sortWithinPartitions("section", "position")
        .select("section", F.col("record").alias("value"))
        .write.mode("overwrite")
        .partitionBy("section")
        .text(path)
    )


def write_markdown(lines: DataFrame, path: str) -> None:
    """A report of a fixed, small number of lines as one text file."""
    (
        lines.orderBy("line_no")
        .select(F.col("line").alias("value"))
        .coalesce(1)
        .write.mode("overwrite")
        .text(path)
    )
