"""Cross-report properties on the driver's tables."""

import pytest
from pyspark.sql import functions as F

from vodlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def q(spark, name):
    return QUERIES[name](spark, SF)


def total(df, col):
    return df.agg(F.sum(col)).collect()[0][0]


def test_levels_add_up_to_folder_views(spark):
    assert total(q(spark, "vod_by_folder_level"), "TotalViews") == total(q(spark, "vod_by_folder"), "TotalViews")


def test_conversion_counts_add_up(spark):
    r = q(spark, "recsys_conversion").select(
        (F.col("Q1") + F.col("MPT") + F.col("Q3") + F.col("CMPL")).alias("a"),
        (F.col("MPLY") + F.col("APLY")).alias("b"),
    )
    assert r.where(F.col("a") != F.col("b")).count() == 0
    assert r.count() > 0


def test_miss_between_zero_and_access(spark):
    r = q(spark, "submenu_behaviours")
    assert r.where((F.col("Miss") < 0) | (F.col("Miss") > F.col("Access"))).count() == 0


def test_matrix_total_is_top_list_total(spark):
    m = q(spark, "title_device_matrix")
    mt = total(m.select((F.col("mobile") + F.col("box") + F.col("smarttv")).alias("t")), "t")
    assert mt == total(q(spark, "top_items_with_titles"), "count_duration")


def test_hour_columns_add_up_to_daily_views(spark):
    hours = q(spark, "views_day_hour")
    s = sum(F.col(f"h{i:02d}") for i in range(24))
    joined = hours.select("device", "day", s.alias("hs")).join(q(spark, "views_daily"), ["device", "day"])
    assert joined.where(F.col("hs") != F.col("views")).count() == 0
    assert joined.count() == 90


def test_top_lists_bounded_and_long_ids(spark):
    t = q(spark, "top_items_daily")
    per = t.groupBy("device", "day").count()
    assert per.agg(F.max("count")).collect()[0][0] <= 10
    assert t.where(F.length("ItemId") <= 12).count() == 0


def test_leaving_soon_is_subset(spark):
    pv, ls = q(spark, "unique_pageview"), q(spark, "leaving_soon_pageview")
    assert ls.exceptAll(pv).count() == 0
    assert ls.count() == pv.where(F.col("SubMenuId").isin("48", "49", "50")).count()


def test_catalogues_list_every_part(spark):
    from vodlens.sources import fixtures

    parts = fixtures.table(spark, SF, "part").count()
    assert [c.count() for c in fixtures.movie_folders(spark, SF)] == [parts, parts]
    rows = q(spark, "join_folder_left").groupBy("ItemId").agg(F.countDistinct("Folder").alias("n"), F.max("Folder").alias("f")).collect()
    assert any(r["f"] is None for r in rows) and any(r["n"] > 1 for r in rows)  # no folder; several folders


def test_pivot_other_apps_give_zero_rows(spark):
    p = q(spark, "customer_app_pivot")
    zero = p.where((F.col("VOD") == 0) & (F.col("CHILD") == 0) & (F.col("RELAX") == 0)).count()
    assert zero > 0  # customers whose views were all in other apps keep a row


def test_expected_fixture_figures(spark):
    # Figures computed independently with plain SQL (FIXTURES.md part C).
    assert q(spark, "vod_by_folder").count() == 1961
    assert q(spark, "customer_app_pivot").count() == 1617
    assert q(spark, "unique_pageview").count() == 2495
    assert q(spark, "series_movies").count() == 4006
    assert q(spark, "recsys_conversion").count() == 1614
    assert q(spark, "topic_lane_rows").count() == 5372
    assert q(spark, "top_items_daily").count() == 900
    assert q(spark, "title_device_matrix").count() == 29
    menu = {r["MenuID"]: r["n"] for r in q(spark, "vod_by_menu").groupBy("MenuID").agg(F.sum("TotalCustomer").alias("n")).collect()}
    assert len(menu) == 7


def test_device_documents_agree_with_flat_reports(spark, tmp_dir):
    import json
    import os

    from vodlens.operators.views import device_documents
    from vodlens.sinks import write_json_result

    docs = device_documents(q(spark, "views_daily"), q(spark, "views_day_hour"), q(spark, "top_items_with_titles"))
    rows = {r["device"]: r for r in docs.collect()}
    assert set(rows) == {"mobile", "box", "smarttv"}
    daily = q(spark, "views_daily").orderBy("day")
    hours = q(spark, "views_day_hour")
    for dev, r in rows.items():
        want = [x["views"] for x in daily.where(F.col("device") == dev).collect()]
        assert r["daily_views"] == want and r["total"] == sum(want)
        assert len(r["hour_matrix"]) == len(want) and all(len(h) == 24 for h in r["hour_matrix"])
        assert [sum(h) for h in r["hour_matrix"]] == want
        h = hours.where((F.col("device") == dev) & (F.col("day") == "2024-01-05")).collect()[0]
        assert r["by_hour"]["2024-01-05"]["07"] == h["h07"]
        top = r["top10"]["2024-01-05"]
        assert 0 < len(top) <= 10 and top[0]["count_duration"] >= top[-1]["count_duration"]
    write_json_result(docs, f"{tmp_dir}/docs")
    [name] = [f for f in os.listdir(f"{tmp_dir}/docs") if f.endswith(".json")]
    lines = open(f"{tmp_dir}/docs/{name}", encoding="utf-8").read().splitlines()
    assert len(lines) == 3 and "by_hour" in json.loads(lines[0])
