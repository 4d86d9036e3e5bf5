from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tilldeck.functions.frames import (
    positioned,
    in_date_range,
    keep_one,
    money_as_double,
    ranked,
    reported,
)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_keep_one_is_fixed_by_all_columns(spark, rows):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("j", None, None), (None, 5, "x"), (None, 4, "y")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "id string, n int, s string").repartition(3)
        got = {r.id: (r.n, r.s) for r in keep_one(df, ["id"]).collect()}
        assert got == {"k": (1, "a"), "j": (None, None), None: (4, "y")}


def test_keep_one_cuts_copies_before_the_shuffle(spark):
    df = keep_one(spark.range(10).withColumn("v", F.col("id") % 2), ["v"])
    physical = plan(df).split("== Physical Plan ==")[1]
    shuffle = physical.index("Exchange hashpartitioning")
    assert physical.index("WindowGroupLimit") < shuffle < physical.rindex("WindowGroupLimit")


def test_ranked_numbers_without_gaps(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = ranked(df, ["g"], [F.col("id").desc()], 4, "n").groupBy("g").agg(F.sort_array(F.collect_list("n")).alias("n"))
    assert all(list(r.n) == [1, 2, 3, 4] for r in got.collect())


def test_date_range_is_inclusive_and_optional(spark, rows):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "dt string")
    assert rows(in_date_range(df, "2024-01-02", "2024-01-02")) == [("2024-01-02",)]
    assert in_date_range(df, None, "2024-01-02").count() == 2
    assert in_date_range(df).count() == 3
    other = df.withColumnRenamed("dt", "day")
    assert in_date_range(other, "2030-01-01").count() == 3


def test_date_range_reaches_an_unpartitioned_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2024-01-02 10:00:00' as ts").write.parquet(path)
    df = spark.read.parquet(path).withColumn("dt", F.col("ts").cast("date").cast("string"))
    found = in_date_range(df, "2024-01-02", "2024-01-02", "ts")
    assert found.count() == 1
    assert "GreaterThanOrEqual(ts" in plan(found) and "LessThan(ts" in plan(found)


def test_reported_form(spark):
    df = spark.createDataFrame(
        [(Decimal("1.10"), dt.datetime(2024, 1, 2, 3, 4, 5, 600000), dt.date(2024, 1, 2), 7)],
        "m decimal(18,2), t timestamp_ntz, d date, n int",
    )
    assert tuple(reported(df).first()) == (1.1, "2024-01-02 03:04:05", "2024-01-02", 7)
    assert dict(money_as_double(df).dtypes)["m"] == "double"


def test_positions_of_a_key_that_fills_many_tasks(spark):
    for name, value in (("adaptive.coalescePartitions.enabled", "false"), ("shuffle.partitions", "7")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) as k", "(id * 7919) % 5000 as v", "'x' as other")
        got = positioned(df, ["k"], ["v"])
        expected = df.selectExpr("*", "cast(row_number() over (partition by k order by v) as long) as position")
        assert got.exceptAll(expected).isEmpty() and got.count() == 5000 and got.columns == ["k", "v", "other", "position"]
        assert positioned(df.where("false"), ["k"], ["v"]).collect() == []
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
