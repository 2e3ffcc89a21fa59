"""Reports that need one pass: dense views, cube, folder calendar, distincts without Expand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vodlens.operators import views as vw
from vodlens.operators.distincts import flagged_counts
from vodlens.plans.catalog import QUERIES, Inputs
from vodlens.schema import VIEWS
from vodlens.sources import views as view_src

SF = "/root/testdata/sf0.001"


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["views_daily", "views_total", "views_day_hour", "views_hour_total", "views_cube", "fmt_thousands"])
def test_views_are_scanned_once(spark, name):
    final = plan(QUERIES[name](spark, SF)).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["vod_by_main_menu", "unique_pageview", "leaving_soon_pageview"])
def test_no_expand(spark, name):
    assert "Expand" not in plan(QUERIES[name](spark, SF))


def test_cube_runs_over_counts(spark):
    p = plan(QUERIES["views_cube"](spark, SF)).split("== Initial Plan ==")[0]
    assert p.index("Expand") < p.rindex("Exchange hashpartitioning(device") < p.index("FileScan")  # over the counts


def test_folder_calendar_opens_no_file(spark, tmp_dir):
    i = Inputs(spark, SF)
    view_src.write_views(i.views.withColumn("day", F.when(F.col("ItemId") != "s1", F.col("day"))), tmp_dir)  # some days are NULL
    got = vw.calendar_of_folders(spark, tmp_dir)
    assert "FileScan" not in plan(got)
    assert sorted(got.collect()) == sorted(vw.calendar_of(i.views.where("ItemId <> 's1'")).collect())
    assert vw.calendar_of_folders(spark, f"{tmp_dir}/none").count() == 0


def _views(spark, rows):
    return spark.createDataFrame([(d, day, app, "i", None, ts) for d, day, app, ts in rows], VIEWS)


def test_dense_hours_edge_rows(spark):
    day, ts = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 7)
    v = _views(spark, [("box", day, "PHIM BỘ", ts), ("box", day, "PHIM BỘ", ts), ("box", None, "phim bộ", ts), ("radio", dt.date(2024, 1, 4), "phim bộ", ts),
                       (None, day, "phim bộ", ts), ("mobile", dt.date(2024, 1, 1), "other", ts), ("box", day, None, None)])
    got = {(r.device, r.day.day): r.views for r in vw.views_daily(vw.dense_hours(v)).collect()}
    assert got == {(d, k): 2 if (d, k) == ("box", 2) else 0 for d in ("mobile", "box", "smarttv") for k in (1, 2, 3, 4)}
    only = vw.views_day_hour(vw.dense_hours(v, "2024-01-02", "2024-01-02")).where("device = 'box'").collect()
    assert len(only) == 1 and only[0].h07 == 2 and only[0].h08 == 0
    assert vw.dense_hours(v.limit(0)).count() == 0
    assert vw.dense_hours(v.limit(0), "2024-01-02", "2024-01-03").count() == 6


def test_flagged_counts_equal_count_distinct(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 37).alias("a"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 41 % 13).alias("b"), (F.col("id") % 11).alias("n"))
    got = flagged_counts(rows, ["g"], {"na": "a", "nb": "b", "na2": "a"}, ["n"], [F.sum("n").alias("n")])
    want = rows.groupBy("g").agg(F.sum("n").alias("n"), F.count_distinct("a").alias("na"), F.count_distinct("b").alias("nb"), F.count_distinct("a").alias("na2"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 5
    one = flagged_counts(rows, ["g"], {"na": "a"}, ["n"], [F.sum("n").alias("n")])
    assert one.exceptAll(want.select("g", "n", "na")).count() == 0
    assert flagged_counts(rows.limit(0), ["g"], {"na": "a"}, ["n"], []).count() == 0
