"""Physical-plan properties of the registered queries, and the large-dimension
(shuffle-join) path checked against the oracle."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from vodlens.operators import joins  # noqa: E402

SF = "/root/testdata/sf0.001"
CUSTOMER_REPORTS = [
    "vod_by_folder", "vod_by_folder_level", "vod_by_movie_chapter", "vod_by_movie",
    "customers_by_location", "vod_by_main_menu", "sessions_by_location", "unique_pageview",
    "recsys_impressions", "recsys_conversion", "submenu_behaviours", "vod_by_menu",
    "join_customers", "top_items_with_titles",
]


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: executed_plan(fn(spark, SF)) for n, fn in E.queries().items()}


def test_no_cross_joins_or_python_udfs(plans):
    for name, plan in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_small_dimensions_are_broadcast(plans):
    for name in ["vod_by_folder", "vod_by_menu", "recsys_conversion", "top_items_with_titles"]:
        assert "BroadcastHashJoin" in plans[name], name
        assert "SortMergeJoin" not in plans[name], name


def test_top_k_limits_before_shuffle(plans):
    assert "WindowGroupLimit" in plans["top_items_daily"] and "Partial" in plans["top_items_daily"]


def test_scans_are_pruned(plans):
    # the folder report reads 5 of the 6 event columns and 2 of the part columns
    p = plans["vod_by_folder"]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p
    # the app pivot needs neither the event id nor the value
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plans["customer_app_pivot"]


def test_large_dimension_path_matches_oracle(spark):
    """Force every dimension over the broadcast bound: customer reports then
    pre-aggregate per customer and shuffle-join; results must not change."""
    con = duck(SF)
    spark.conf.set(joins.CONF_KEY, "10")
    try:
        for name in CUSTOMER_REPORTS:
            df = E.queries()[name](spark, SF)
            plan = executed_plan(df)
            r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
            assert r["match"], r
            if name in ("vod_by_folder", "recsys_conversion", "submenu_behaviours"):
                assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset(joins.CONF_KEY)


def test_broadcast_bound_counts_bytes(spark):
    rows = [(i, "x" * 1000) for i in range(2000)]
    wide = spark.createDataFrame(rows, "ID long, note string")
    n, size = joins.measure(wide)
    assert n == 2000 and size >= 2000 * 1000
    assert joins.fits_broadcast(wide)
    spark.conf.set(joins.CONF_BYTES, str(1_000_000))
    try:
        assert not joins.fits_broadcast(wide)  # 2,000 rows but ~2 MB of text
        narrow = wide.select("ID")
        assert joins.fits_broadcast(narrow)
    finally:
        spark.conf.unset(joins.CONF_BYTES)
