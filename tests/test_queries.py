"""Every query against its SQL counterpart, and the shape of key plans."""

from __future__ import annotations

import glob
import re
from uuid import uuid4

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tilldeck import session
from tilldeck.oracle import ORACLE
from tilldeck.plans.catalog import QUERIES, Shop

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"dataset_profile"}
# Minutes of small files; test_builds covers them, oracle_check.py compares them.
BUILDS = {"retail_layers_build", "behavior_layers_build"}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_only_named_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - BUILDS))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], ORACLE[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).collect()


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "dt"


@pytest.fixture
def plan(spark):
    """Physical plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")

    def text(name: str) -> str:
        found = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
        return re.sub(r"#\d+L?", "", found.split("== Physical Plan ==")[1])

    yield text
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize(
    "name",
    ["trade_order_detail", "trade_daily", "user_daily", "product_topn", "inventory_turnover", "behavior_detail", "dq_checks"],
)
def test_no_cross_join_and_no_python(plan, name):
    text = plan(name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["product_topn", "category_topn", "shop_rank", "behavior_product_topn"])
def test_top_rows_are_cut_before_the_shuffle(plan, name):
    text = plan(name)
    cut = text.index("WindowGroupLimit [dt]")
    assert cut < text.index("Exchange hashpartitioning(dt, ", cut) < text.rindex("WindowGroupLimit [dt]")


def test_scans_read_only_needed_columns(plan):
    text = plan("user_retention")
    assert "value" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "EqualTo(l_returnflag,R)" in plan("refund_analysis")


def test_retention_needs_no_join(plan):
    assert "Join" not in plan("user_retention")


def test_user_daily_stacks_without_another_shuffle(plan):
    text = plan("user_daily")
    assert "FullOuter" not in text
    assert "Exchange" not in text[: text.index("Union")]


def test_behavior_day_reads_each_source_once_and_copies_no_row(plan):
    text = plan("behavior_daily")
    assert text.count("FileScan") == 5 and "Expand" not in text


@pytest.mark.parametrize(
    "name",
    ["product_daily", "shop_daily", "category_daily", "trade_daily", "behavior_event_type_daily", "behavior_category_daily"],
)
def test_distinct_counts_copy_no_row(plan, name):
    assert "Expand" not in plan(name)


def test_product_columns_join_the_best_products_only(plan):
    text = plan("product_topn")
    assert text[: text.index("WindowGroupLimit")].count("LeftOuter") == 2


def test_the_latest_day_is_cut_before_product_columns_join(spark, monkeypatch):
    """All lines are summed once by product and shop, without their join to products."""
    made = {}
    stored = Shop.stored
    monkeypatch.setattr(Shop, "stored", lambda shop, **frames: made.update(frames) or stored(shop, **frames))
    QUERIES["latest_day_topn"](spark, FOLDER)
    plan = made["sales"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "p_partkey" not in plan and "p_brand" not in plan


def test_a_day_filter_reaches_the_orders_below_the_line_join(spark):
    day = QUERIES["trade_order_detail"](spark, FOLDER).where("dt = '1995-01-01'")
    text = day._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join Inner")
    assert re.search(r"Filter [^\n]*1995-01-01", text[join:])
    assert text.count("lineitem") <= 1 and "Filter" not in text[:join].split("Join")[0] or "1995-01-01" not in text[:join]


def test_the_dashboard_in_passes_equals_sql_and_leaves_no_facts(spark, connection, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "PASS_ROWS", 800)
    monkeypatch.setattr("tilldeck.plans.catalog.scratch_dir", lambda _, purpose: f"{tmp_path}/{purpose}-{uuid4().hex}")
    assert compare(spark, connection, QUERIES["dashboard_payload"], ORACLE["dashboard_payload"], FOLDER) is None
    assert not glob.glob(f"{tmp_path}/lines-*") and glob.glob(f"{tmp_path}/metrics-*")


def test_the_entry_adds_the_training_data_queries_only_if_they_exist():
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLE)
