"""Layer tables: ``<root>/<layer>/<table>/dt=...`` as Parquet, or, after a backfill,
files of runs of days in ``<root>/<layer>/<table>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tilldeck.functions.casts import typed
from tilldeck.functions.frames import in_date_range
from tilldeck.schemas import OPTIONAL, layer_of, schema_of
from tilldeck.session import drop_folder, room_for, rows_at_a_time, scratch_dir


# Rows of a run of days, where the runs are cut by the days of another table.
RUN_ROWS = 400_000
# Codec of backfilled tables and scratch files, about a quarter smaller than snappy.
CODEC = "zstd"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer_of(table)}/{table}"


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in contract order and type; a missing one is an error.

    Malformed values become null, as they would on a lenient cast.
    """
    schema = schema_of(table)
    for name in OPTIONAL.get(table, ()):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(schema[name].dataType))
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks column(s): {', '.join(missing)}")
    return df.select(*(typed(df, field.name, field.dataType.simpleString()) for field in schema))


def read_layer(
    spark: SparkSession, root: str, table: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A layer table, optionally only its partitions in a date range.

    The schema is given, so ``dt`` stays text and no footer is opened to infer.
    """
    df = spark.read.schema(schema_of(table)).parquet(table_path(root, table))
    return in_date_range(df, start, end)


def write_layer(
    df: DataFrame,
    root: str,
    table: str,
    mode: str = "overwrite",
    output_partitions: int | None = None,
    days: tuple[str | None, str | None] = (None, None),
    spread: DataFrame | dict[str, int] | None = None,
    load: DataFrame | dict[str, int] | None = None,
    by: str = "dt",
    part: Callable[[Column], DataFrame] | None = None,
) -> None:
    """Write by day. ``overwrite`` replaces the days present in ``df``.

    Give the range a run covers as ``days``: days of it that had rows and have
    none any more are emptied, before the new days show: the new rows are computed
    into scratch files first, so a run that fails leaves the table as it was, or
    with such days emptied, but never new days beside rows that are no more. Other
    days stay.

    The rebalance hint puts one day's rows together without forcing a large
    day into one task: AQE splits big partitions and merges small ones.

    ``backfill`` writes a new table over many days: each file holds a run of days
    in order, with ``dt`` as a column, so thousands of small days need few files.
    Day filters skip files and row groups by their statistics. Readers see no
    difference, but such a table is only written as a whole. ``spread`` is a stored
    table whose rows lie on days in about the same shares, or its ``day_counts``: it tells
    the runs, and the new table is computed once instead of a second time to find them.

    A large backfill is written in passes, so that shuffle files are those of a pass:
    each takes the rows of some days or, where ``by`` names a key, of some hashes of it.
    Rows of ``load``, the stored table it is computed from (``spread`` unless given), tell
    how many. A pass is a filter on ``df``; give ``part`` where that would not reach the
    input: it makes the pass's rows from the filter. All rows of a day or key are in one
    pass, however many.
    """
    shaped = conform(df, table)
    path = table_path(root, table)
    if mode == "backfill":
        _backfill(df.sparkSession, part or shaped.where, path, table, spread, load, by)
        return
    if _has_files(df.sparkSession, path):
        raise ValueError(f"{path} was written in runs of days; single days cannot be written to it")
    if mode == "overwrite" and all(days) and (before := _written_days(df.sparkSession, root, table, days)):
        staged = scratch_dir(df.sparkSession, f"staged-{table}")
        _in_runs(shaped).write.parquet(staged)
        shaped = df.sparkSession.read.schema(shaped.schema).parquet(staged)
        now = {row["dt"] for row in shaped.select("dt").distinct().collect()}
        nothing = shaped.drop("dt").where("false")
        for day in sorted(before - now):
            nothing.write.mode("overwrite").parquet(f"{path}/dt={day}")
    _show(shaped, path, mode, output_partitions)


def _backfill(
    spark: SparkSession,
    part: Callable[[Column], DataFrame],
    path: str,
    table: str,
    spread: DataFrame | dict[str, int] | None,
    load: DataFrame | dict[str, int] | None,
    by: str,
) -> None:
    days = {} if spread is None else day_counts(spread)
    loaded = days if load is None else day_counts(load)
    total = sum(loaded.values())
    mode = "errorifexists"
    filters = _passes(spark, loaded, by)
    for chosen, held in filters:
        rows = conform(part(chosen), table)
        share = {day: -(-count // len(filters)) for day, count in days.items()}
        if held is not None:
            share = {day: count for day, count in days.items() if held(day)}
        runs = _in_runs(rows) if spread is None else _in_runs_by(rows, share)
        try:
            with room_for(spark, -(-total // len(filters))):
                runs.write.mode(mode).option("compression", CODEC).parquet(path)
        except Exception:
            if mode == "append":
                # No reader may take some passes for the table.
                drop_folder(spark, path)
            raise
        mode = "append"


def _passes(
    spark: SparkSession, counts: dict[str, int], by: str
) -> list[tuple[Column, Callable[[str], bool] | None]]:
    """Filters that together let each row through once, for days with the same test on
    a day's text. Rows without a day are in the first."""
    number = max(1, -(-sum(counts.values()) // rows_at_a_time(spark)))
    if by != "dt":
        return [(chosen, None) for chosen in _key_passes(number, by)]
    total, before, ends = sum(counts.values()), 0, []
    for day in sorted(counts):
        if before * number // max(1, total) > len(ends):
            ends.append(last)
        before, last = before + counts[day], day
    day, found = F.col("dt"), []
    for low, high in zip([None, *ends], [*ends, None]):
        chosen = F.lit(True) if low is None else day > low
        if high is not None:
            chosen = chosen & (day <= high)
        if low is None and high is not None:
            chosen = chosen | day.isNull()
        found.append((chosen, lambda d, low=low, high=high: (low is None or d > low) and (high is None or d <= high)))
    return found


def _key_passes(number: int, key: str) -> list[Column]:
    if number == 1:
        return [F.lit(True)]
    return [F.pmod(F.xxhash64(key), F.lit(number)) == i for i in range(number)]


def write_scratch(df: DataFrame, path: str, key: str, rows: int) -> DataFrame:
    """``df``, computed from so many rows, written in passes over hashes of ``key``."""
    spark = df.sparkSession
    filters = _key_passes(max(1, -(-rows // rows_at_a_time(spark))), key)
    for chosen in filters:
        with room_for(spark, -(-rows // len(filters))):
            df.where(chosen).write.mode("append").option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_small(df: DataFrame, purpose: str, key: str, rows: int) -> tuple[DataFrame, str | None]:
    """``df`` as it is, where one pass holds its rows. Else a scratch table of it and its
    folder, so later passes over another key find it finished."""
    if rows <= rows_at_a_time(df.sparkSession):
        return df, None
    path = scratch_dir(df.sparkSession, purpose)
    return write_scratch(df, path, key, rows), path


def day_counts(table: DataFrame | dict[str, int]) -> dict[str, int]:
    """Rows of each day, the only thing that comes to the driver."""
    if isinstance(table, dict):
        return table
    counts = table.where("dt is not null").groupBy("dt").count().collect()
    return {row["dt"]: row["count"] for row in counts}


def _in_runs(df: DataFrame) -> DataFrame:
    """Rows in the order of days, over tasks that each own a run of days. A hash of
    the row is the second key of the range, so a large day fills several tasks."""
    row = F.xxhash64(*(c for c in df.columns if c != "dt"))
    return _by_day(df.repartitionByRange("dt", row))


def _in_runs_as(df: DataFrame, spread: DataFrame) -> DataFrame:
    """As ``_in_runs``, with the runs cut by the days of ``spread``, of which only the
    days and their counts come to the driver. Rows of days it lacks, and those without a
    day, lie among all runs."""
    return _in_runs_by(df, day_counts(spread))


def _in_runs_by(df: DataFrame, counts: dict[str, int]) -> DataFrame:
    total = sum(counts.values())
    tasks, before, dealt = max(1, -(-total // RUN_ROWS)), 0, []
    for day in sorted(counts):
        first, last = before * tasks // total, (before + counts[day] - 1) * tasks // total
        dealt.append((day, first, last - first + 1))
        before += counts[day]
    runs = F.broadcast(df.sparkSession.createDataFrame(dealt, "dt string, __first int, __parts int"))
    held = df.join(runs, "dt", "left")
    row = F.xxhash64(*(c for c in df.columns if c != "dt"))
    place = F.col("__first") + F.when(F.col("__parts") > 1, F.pmod(row, F.col("__parts"))).otherwise(0)
    dealt_out = held.repartitionById(tasks, F.coalesce(place, F.pmod(row, F.lit(tasks))).cast("int"))
    return _by_day(dealt_out.select(*df.columns))


def _by_day(df: DataFrame) -> DataFrame:
    """Each task's rows by day; then by the table's first key, so like values lie side
    by side and files are smaller."""
    return df.sortWithinPartitions("dt", df.columns[0])


def _show(df: DataFrame, path: str, mode: str, output_partitions: int | None) -> None:
    size = [output_partitions] if output_partitions else []
    (
        df.hint("rebalance", *size, F.col("dt"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether Parquet files lie in the folder itself, not in those of days."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder) and any(
        found.isFile() and found.getPath().getName().endswith(".parquet") for found in files.listStatus(folder)
    )


def _written_days(spark: SparkSession, root: str, table: str, days: tuple[str, str]) -> set[str]:
    """Days of the range that hold rows."""
    try:
        rows = read_layer(spark, root, table, *days)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row["dt"] for row in rows.select("dt").distinct().collect()}


def save_as_table(df: DataFrame, table: str, database: str | None = None) -> None:
    """The same contract as a catalog table, created unless it exists."""
    shaped = conform(df, table).hint("rebalance", F.col("dt"))
    name = f"{database}.{table}" if database else table
    shaped.write.mode("ignore").format("parquet").partitionBy("dt").saveAsTable(name)
