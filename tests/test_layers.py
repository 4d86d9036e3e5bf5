from __future__ import annotations

import glob
import time

import pytest
from pyspark.sql import functions as F
from tables import RAW, landed, raw_table

from tilldeck import session
from tilldeck.context import RunContext
from tilldeck.session import scratch_dir, side_by_side
from tilldeck.sources import files, layers

TABLE = "dwd_user_behavior_detail"


def events(spark, days, per_day=3):
    return spark.range(days * per_day).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("u").alias("user_id"),
        *(F.lit(None).cast("string").alias(c) for c in ("product_id", "shop_id")),
        F.lit("view").alias("event_type"),
        F.lit(None).cast("timestamp_ntz").alias("event_time"),
        *(F.lit(None).cast("string").alias(c) for c in ("session_id", "device_type", "source_channel")),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % days).cast("int")).cast("string").alias("dt"),
    )


def test_roundtrip_keeps_text_days(spark, tmp_path, rows):
    df = events(spark, 4)
    layers.write_layer(df, str(tmp_path), TABLE)
    back = layers.read_layer(spark, str(tmp_path), TABLE)
    assert dict(back.dtypes)["dt"] == "string" and rows(back, "event_id", "dt") == rows(df, "event_id", "dt")
    assert len(glob.glob(f"{tmp_path}/dwd/{TABLE}/dt=*")) == 4


def test_rerun_of_one_day_leaves_the_others(spark, tmp_path, rows):
    df = events(spark, 4)
    root = str(tmp_path)
    layers.write_layer(df, root, TABLE)
    before = rows(layers.read_layer(spark, root, TABLE))
    for _ in range(2):
        layers.write_layer(df.where("dt = '2025-01-02'"), root, TABLE)
    assert rows(layers.read_layer(spark, root, TABLE)) == before


def test_append(spark, tmp_path):
    df = events(spark, 2)
    for _ in range(2):
        layers.write_layer(df, str(tmp_path), TABLE, mode="append")
    assert layers.read_layer(spark, str(tmp_path), TABLE).count() == 2 * df.count()


def test_days_prune_partitions(spark, tmp_path):
    layers.write_layer(events(spark, 4), str(tmp_path), TABLE)
    df = layers.read_layer(spark, str(tmp_path), TABLE, "2025-01-02", "2025-01-03")
    assert df.count() == 6
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt" in plan


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows on one day must not end in one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40000")
    try:
        hot = events(spark, 1, 20000).unionAll(events(spark, 5, 8000)).repartition(4)
        layers.write_layer(hot.withColumn("event_id", F.sha2("event_id", 256)), str(tmp_path), TABLE)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/dwd/{TABLE}/dt=2025-01-01/*.parquet")) > 1
    assert layers.read_layer(spark, str(tmp_path), TABLE).count() == 60000


def test_backfill_writes_runs_of_days(spark, tmp_path, rows):
    root, df = str(tmp_path), events(spark, 400, 5)
    layers.write_layer(df.repartition(7), root, TABLE, mode="backfill")
    back = layers.read_layer(spark, root, TABLE)
    assert rows(back, "event_id", "dt") == rows(df, "event_id", "dt")
    assert not glob.glob(f"{root}/dwd/{TABLE}/dt=*")
    assert len(glob.glob(f"{root}/dwd/{TABLE}/*.parquet")) <= 4
    day = layers.read_layer(spark, root, TABLE, "2025-01-02", "2025-01-03")
    assert day.count() == 10 and "PushedFilters: [IsNotNull(dt)" in day._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        layers.write_layer(df, root, TABLE, mode="backfill")
    with pytest.raises(ValueError, match="runs of days"):
        layers.write_layer(df, root, TABLE, days=("2025-01-01", "2025-01-02"))


def test_backfill_tasks_own_runs_of_days_and_share_a_large_one(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = events(spark, 1, 3000).unionAll(events(spark, 300, 10)).withColumn("event_id", F.expr("uuid()"))
        layers.write_layer(hot, str(tmp_path), TABLE, mode="backfill")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = (
        layers.read_layer(spark, str(tmp_path), TABLE)
        .groupBy("_metadata.file_name").agg(F.min("dt").alias("low"), F.max("dt").alias("high"))
        .orderBy("low", "high").collect()
    )
    assert sum(s.low == "2025-01-01" for s in spans) > 1
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("by", ["dt", "event_id"])
def test_a_large_backfill_is_written_in_passes(spark, tmp_path, monkeypatch, rows, by):
    """A large day, days and keys that are null and days that the counted table lacks:
    each row is written once."""
    monkeypatch.setattr(session, "PASS_ROWS", 200)
    plain = events(spark, 1, 1000).unionAll(events(spark, 200, 5)).withColumn("event_id", F.expr("uuid()"))
    spark.createDataFrame(plain.collect(), plain.schema).write.parquet(str(tmp_path / "given"))
    hot = spark.read.parquet(str(tmp_path / "given"))
    odd = events(spark, 202, 1).where("dt > '2025-07-10'").withColumn("dt", F.expr("if(event_id % 2 = 0, null, dt)"))
    new = hot.unionAll(odd).withColumn("event_id", F.expr("if(event_id like 'a%', null, event_id)"))
    layers.write_layer(new, str(tmp_path), TABLE, mode="backfill", spread=hot, by=by)
    back = layers.read_layer(spark, str(tmp_path), TABLE)
    assert rows(back, "event_id", "dt") == rows(new, "event_id", "dt")
    assert len({path.split("part-")[1][6:42] for path in glob.glob(f"{tmp_path}/dwd/{TABLE}/*.parquet")}) > 1


def test_a_table_whose_second_pass_fails_is_not_left_in_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "PASS_ROWS", 50)
    spread = events(spark, 100, 5)
    bad = spread.withColumn("user_id", F.expr("if(dt > '2025-04-01', raise_error('no'), user_id)"))
    with pytest.raises(Exception, match="no"):
        layers.write_layer(bad, str(tmp_path), TABLE, mode="backfill", spread=spread)
    assert not glob.glob(f"{tmp_path}/dwd/{TABLE}")


def test_writes_side_by_side_leave_no_shuffle_files(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(f) for f in (files.apply(i) for i in range(files.size())) if "shuffle_" in str(f)}

    before, setting = shuffled(), spark.conf.get(session.FREE_SHUFFLES)
    df = events(spark, 50).repartition(5, "dt")
    side_by_side(spark, [lambda n=n: df.write.parquet(str(tmp_path / n)) for n in "ab"])
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(session.FREE_SHUFFLES) == setting
    df.write.parquet(str(tmp_path / "c"))
    assert shuffled() - before


def test_runs_cut_by_a_stored_table_compute_the_new_one_once(spark, tmp_path, monkeypatch, rows):
    """The days tell the runs: no range is sampled, a large day is shared, and days that
    the other table lacks stay."""
    monkeypatch.setattr(layers, "RUN_ROWS", 1000)
    hot = events(spark, 1, 3000).unionAll(events(spark, 300, 10)).withColumn("event_id", F.expr("xxhash64(event_id, monotonically_increasing_id())").cast("string"))
    plan = layers._in_runs_as(layers.conform(hot, TABLE), hot)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    new = hot.unionAll(events(spark, 302, 1).where("dt > '2025-10-27'"))
    layers.write_layer(new, str(tmp_path), TABLE, mode="backfill", spread=hot)
    back = layers.read_layer(spark, str(tmp_path), TABLE)
    assert rows(back, "event_id", "dt") == rows(new, "event_id", "dt")
    spans = (
        back.where(F.col("dt") < "2025-10-01").groupBy("_metadata.file_name")
        .agg(F.min("dt").alias("low"), F.max("dt").alias("high")).orderBy("low", "high").collect()
    )
    assert sum(s.low == "2025-01-01" for s in spans) > 1
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_emptied_days_are_cleared_before_new_ones_show(spark, tmp_path, monkeypatch):
    root, df = str(tmp_path), events(spark, 4)
    layers.write_layer(df, root, TABLE)
    new = events(spark, 4, 5).where("dt != '2025-01-02'")
    days = ("2025-01-01", "2025-01-03")

    def counts():
        return {r.dt: r["count"] for r in layers.read_layer(spark, root, TABLE).groupBy("dt").count().collect()}

    show = layers._show
    monkeypatch.setattr(layers, "_show", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        layers.write_layer(new.where("dt <= '2025-01-03'"), root, TABLE, days=days)
    assert counts() == {"2025-01-01": 3, "2025-01-03": 3, "2025-01-04": 3}
    monkeypatch.setattr(layers, "_show", show)
    layers.write_layer(new.where("dt <= '2025-01-03'"), root, TABLE, days=days)
    assert counts() == {"2025-01-01": 5, "2025-01-03": 5, "2025-01-04": 3}


def test_a_run_that_cannot_be_computed_changes_nothing(spark, tmp_path, rows):
    root, df = str(tmp_path), events(spark, 3)
    layers.write_layer(df, root, TABLE)
    before = rows(layers.read_layer(spark, root, TABLE))
    broken = df.where("dt = '2025-01-01'").withColumn("user_id", F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        layers.write_layer(broken, root, TABLE, days=("2025-01-01", "2025-01-03"))
    assert rows(layers.read_layer(spark, root, TABLE)) == before


def test_catalog_table(spark, tmp_path):
    spark.sql(f"create database if not exists shelf location '{tmp_path}/shelf'")
    for _ in range(2):
        layers.save_as_table(events(spark, 2), TABLE, "shelf")
    assert spark.table(f"shelf.{TABLE}").count() == 6
    spark.sql("drop database shelf cascade")


def test_optional_columns_land_as_null(spark):
    assert landed(spark, "order_items").select("shop_id").distinct().collect()[0][0] is None


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = str(tmp_path / "users.csv")
    users = raw_table(spark, "users")
    users.select(*reversed(users.columns)).write.option("header", True).csv(path)
    back = files.read_raw_csv(spark, path)
    assert {r.user_id for r in back.collect()} == {"U1", "U2"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_raw_csv(spark, str(tmp_path / "absent.csv"))


def test_dataset_profile(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(7).coalesce(1).write.parquet(path)
    (row,) = files.dataset_profile(spark, [path]).collect()
    assert (row.row_count, row.columns) == (7, "id") and row.file_name.endswith(".parquet")


def test_run_context():
    assert RunContext().load_dt == "1970-01-01" and RunContext().as_of == "2099-12-31"
    run = RunContext("2025-01-01", "2025-01-03")
    assert (run.load_dt, run.as_of, run.calendar) == ("2025-01-03", "2025-01-03", ("2025-01-01", "2025-01-03"))
    assert RunContext(dt="2025-01-02").calendar == ("2025-01-02", "2025-01-02")


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path.startswith(shared or "/tmp") and path != scratch_dir(spark, "x")


def test_every_raw_table_has_a_contract():
    from tilldeck.schemas import RAW_TABLES, TABLES, schema_of

    assert set(RAW_TABLES) == set(RAW)
    assert all(schema_of(t).names[-1] == "dt" for t in TABLES)


def test_column_profile_by_file(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.sql("select id, if(id = 3, null, concat('t', id)) t, array(id) a, date'2024-01-01' d from range(4)")
    for part in ("id < 2", "id >= 2"):
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    rows = {(r.column_name, r.min_number): r for r in files.column_profile(spark.read.parquet(path), by_file=True).collect()}
    assert len(rows) == 5 and len({r.file_name for r in rows.values()}) == 2
    assert (rows["id", 2.0].max_number, rows["id", 2.0].row_count) == (3.0, 2)
    whole = {r.column_name: r for r in files.column_profile(spark.read.parquet(path)).collect()}
    assert (whole["t"].null_count, whole["t"].min_text, whole["t"].max_text) == (1, "t0", "t2")
    assert whole["a"].min_text is None and whole["d"].max_text == "2024-01-01"
    assert files.column_profile(df.where("false")).where("row_count = 0").count() == 4
