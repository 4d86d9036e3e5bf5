"""Both layer builds end to end, from files to reports, on hand-written data."""

from __future__ import annotations

import glob
import json
import re

import pytest
from tables import RAW, raw_table
from test_behavior import EVENTS

from tilldeck import session
from tilldeck.__main__ import main
from tilldeck.context import RunContext
from tilldeck.plans import retail
from tilldeck.schemas import ADS, DIM, DWD, DWS, ODS
from tilldeck.sources.layers import read_layer


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    root = str(tmp_path_factory.mktemp("layers"))
    for name in RAW:
        raw_table(spark, name).coalesce(1).write.option("header", True).csv(f"{raw}/{name}.csv")
    days = ["--start-date", "2025-01-01", "--end-date", "2025-01-03"]
    main(["--time-zone", "UTC", "retail", "--input", str(raw), "--output", root, *days])
    for name, (value, data) in EVENTS.items():
        spark.createDataFrame(data, f"client_id string, timestamp string, {value}").write.parquet(
            f"{raw}/{name}.parquet"
        )
    spark.createDataFrame([("10", "5", "2.5", "pen")], "sku string, category string, price string, name string").write.parquet(
        f"{raw}/product_properties.parquet"
    )
    main(["--time-zone", "UTC", "behavior", "--input", str(raw), "--output", root, "--exact"])
    return root


@pytest.mark.parametrize("table", [*ODS, *DIM, *DWD, *DWS, *ADS])
def test_every_table_is_written(spark, root, table):
    assert read_layer(spark, root, table).count() > 0


def test_values_reach_the_last_layer(spark, root):
    got = {r.dt: r for r in read_layer(spark, root, "ads_retail_dashboard_daily").collect()}
    assert got["2025-01-01"].gmv == 140.0 and got["2025-01-01"].repeat_purchase_rate == 1.0
    retention = read_layer(spark, root, "ads_user_retention").collect()
    assert [(r.cohort_dt, r.day_diff, r.cohort_users, r.retained_users) for r in retention] == [
        ("2025-01-01", 1, 2, 1)
    ]
    assert read_layer(spark, root, "dim_date").count() == 3
    top = read_layer(spark, root, "ads_synerise_product_topn").where("rank_no = 1").collect()
    assert {r.dt for r in top} == {"2024-01-01", "2024-01-02"}


def test_a_day_can_be_built_again(spark, root, rows, tmp_path):
    table = "dws_trade_day_summary"
    before = rows(read_layer(spark, root, table))
    days = ["--start-date", "2025-01-02", "--end-date", "2025-01-02"]
    main(["--time-zone", "UTC", "retail", "--input", "unused", "--output", root, "--stages", "dwd,dws", *days])
    assert rows(read_layer(spark, root, table)) == before


def test_a_run_of_one_day_reads_the_days_that_hold_its_keys(spark, root, rows):
    run = RunContext("2025-01-02", "2025-01-02")
    sources = retail.fact_sources(spark, root, run)
    whole = retail.fact_sources(spark, root, RunContext())
    for table in ("dwd_trade_order_detail", "dwd_trade_payment_detail", "dwd_trade_refund_detail"):
        other = sources[table][1]
        plan = other._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ (IN|=) ", plan)
        built = retail.FACTS[table](*sources[table])
        expected = retail.FACTS[table](*whole[table]).where("dt = '2025-01-02'")
        assert rows(built) == rows(expected)


def test_days_of_copies_are_read_and_others_are_not(spark, tmp_path):
    data = [("I1", "O1", "d1"), ("I1", "O9", "d3"), ("I2", "O2", "d2"), ("I3", None, "d4")]
    spark.createDataFrame(data, "order_item_id string, order_id string, dt string").write.partitionBy("dt").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    wanted = table.where("order_id = 'O1'")
    assert {r.dt for r in retail.on_days_of(table, "order_item_id", wanted).collect()} == {"d1", "d3"}
    assert retail.on_days_of(table, "order_item_id", wanted.where("false")).collect() == []


def test_a_backfill_in_passes_equals_one_at_once(spark, tmp_path, monkeypatch, rows):
    raw = {name: raw_table(spark, name) for name in RAW}
    run = RunContext(dt="2025-01-03", backfill=True)
    retail.build_retail(spark, raw, str(tmp_path / "one"), run)
    monkeypatch.setattr(session, "PASS_ROWS", 1)
    retail.build_retail(spark, raw, str(tmp_path / "passes"), run)
    for table in [t for t in (*ODS, *DIM, *DWD, *DWS, *ADS) if "synerise" not in t]:
        one, passes = (read_layer(spark, str(tmp_path / at), table).drop("ods_load_time") for at in ("one", "passes"))
        assert rows(one) == rows(passes), table
    landed = read_layer(spark, str(tmp_path / "passes"), "ods_order_items")
    assert landed.select("_metadata.file_name").distinct().count() > 1
    assert landed.select("ods_load_time").distinct().count() == 1


def test_stages_can_be_skipped(spark, root):
    main(
        ["--time-zone", "UTC", "behavior", "--output", root, "--exact", "--topn", "1"]
        + ["--skip-ods", "--skip-dwd", "--skip-dws"]
    )
    assert {r.rank_no for r in read_layer(spark, root, "ads_synerise_product_topn").collect()} == {1}


def test_quality_report(root, tmp_path):
    out = str(tmp_path / "report")
    days = ["--start-date", "2025-01-01", "--end-date", "2025-01-03"]
    main(["--time-zone", "UTC", "quality", "--input", root, "--output", out, *days])
    (path,) = glob.glob(f"{out}/part-*")
    text = open(path, encoding="utf-8").read().splitlines()
    assert text[0] == "# 数据质量报告" and text[2] == "- 检查项总数：12"
    status = {line.split(" | ")[0][2:]: line.split(" | ")[3:5] for line in text if line.startswith("| DQ")}
    assert status["DQ001"] == ["PASS", "0"]
    assert status["DQ004"] == ["FAIL", "1"]  # 68 paid of 70
    assert status["DQ006"] == ["FAIL", "1"]  # 60 refunded of 50
    assert status["DQ007"] == ["FAIL", "1"]  # product P9
    assert status["DQ008"] == ["FAIL", "1"]  # nothing ordered on the third day
    assert status["DQ009"] == ["FAIL", "1"]


def test_dashboard_payload(root, tmp_path):
    out = str(tmp_path / "payload")
    main(["--time-zone", "UTC", "dashboard", "--input", root, "--output", out])
    sections = {}
    for path in glob.glob(f"{out}/section=*/*.txt"):
        section = path.split("section=")[1].split("/")[0]
        sections.setdefault(section, []).extend(json.loads(x) for x in open(path, encoding="utf-8"))
    assert len(sections["daily"]) == 2 and sections["synerise_latest_dt"] == [{"latest_dt": "2024-01-02"}]
    assert sections["latest_dt"] == [{"latest_dt": "2025-01-03"}]
    assert {"rfm_segment", "synerise_kpis", "synerise_product_topn_all"} <= set(sections)


def test_profile(root, tmp_path):
    out = str(tmp_path / "profile")
    main(["--time-zone", "UTC", "profile", "--output", out, f"{root}/dim/dim_shop"])
    (path,) = glob.glob(f"{out}/part-*")
    assert json.loads(open(path).readline())["row_count"] == 2
