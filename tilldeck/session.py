"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Condition

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime settings the layers rely on. AQE sizes shuffles, splits skewed join
# partitions (also where that costs one more exchange) and rebalances writes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}

# Whether a query's shuffle files are removed when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows of large tables that are worked on at a time, for each core of the application:
# they bound the shuffle files.
PASS_ROWS = 5_000_000


def build_session(
    app_name: str = "tilldeck",
    master: str | None = None,
    time_zone: str = "UTC",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the settings above; the master comes from spark-submit
    unless given. ``time_zone`` decides the calendar day of zoned timestamps;
    ``driver_memory`` matters to local sessions, where the driver does all work.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.session.timeZone", time_zone)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """Independent writes side by side: most are one small task for a while."""
    with shuffles_freed(spark), ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files behind. Otherwise these stay until
    the driver happens to collect garbage, so a chain of writes piles all of them up."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def rows_at_a_time(spark: SparkSession) -> int:
    return PASS_ROWS * spark.sparkContext.defaultParallelism


class _Room:
    """Lets writes in while the rows they read together stay below a bound."""

    def __init__(self) -> None:
        self._left, self._rows = Condition(), 0

    @contextmanager
    def taken(self, rows: int, most: int) -> Iterator[None]:
        rows = min(rows, most)
        with self._left:
            self._left.wait_for(lambda: self._rows + rows <= most)
            self._rows += rows
        try:
            yield
        finally:
            with self._left:
                self._rows -= rows
                self._left.notify_all()


_ROOM = _Room()


def room_for(spark: SparkSession, rows: int):
    """Waits until a write over so many rows fits beside those that run."""
    return _ROOM.taken(rows, rows_at_a_time(spark))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the cluster's shared one.

    Only a local session may lack that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/tilldeck-{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this engine wrote, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
