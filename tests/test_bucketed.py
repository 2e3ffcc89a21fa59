"""Customer joins over tables landed in matching buckets: no shuffle of the logs."""

import os

import pytest
from pyspark.sql import functions as F

from vodlens.operators import customer, folder, joins, menu, movie, pageview, recsys, submenu
from vodlens.plans.catalog import Inputs
from vodlens.plans.daily import Dims, run_days
from vodlens.sources import bucketed

SF = "/root/testdata/sf0.001"
REPORTS = {
    "vod_by_folder": lambda l, c, f: folder.vod_by_folder(l, c, f),
    "vod_by_folder_level": lambda l, c, f: folder.vod_by_folder_level(l, c, f),
    "vod_by_movie_chapter": lambda l, c, f: movie.vod_by_movie_chapter(l, c),
    "vod_by_movie": lambda l, c, f: movie.vod_by_movie(l, c),
    "customers_by_location": lambda l, c, f: movie.customers_by_location(l, c),
    "vod_by_main_menu": lambda l, c, f: menu.vod_by_main_menu(l, c),
    "sessions_by_location": lambda l, c, f: folder.sessions_by_location(l, c, f),
    "unique_pageview": lambda l, c, f: pageview.unique_pageview(l, c),
    "recsys_impressions": lambda l, c, f: recsys.recsys_impressions(l, c),
    "recsys_conversion": lambda l, c, f: recsys.recsys_conversion(l, c),
    "submenu_behaviours": lambda l, c, f: submenu.submenu_behaviours(l, c),
}


@pytest.fixture(scope="module")
def night(spark):
    """A customer with a third of all rows, unparsable ids, and their landed tables."""
    i = Inputs(spark, SF)
    h = F.pmod(F.hash("ts", "ItemId"), F.lit(9))
    logs = i.logs.withColumn("CustomerID", F.when(h < 3, "7").when(h == 3, "no id").otherwise(F.col("CustomerID"))).checkpoint()
    cus = i.cus.checkpoint()
    landed = bucketed.land(logs, cus, buckets=16)
    yield logs, cus, i.listfolder.checkpoint(), landed
    landed.drop()


@pytest.mark.parametrize("name", REPORTS)
def test_report_equals_and_logs_are_not_shuffled_for_the_join(night, name):
    logs, cus, lf, landed = night
    want, got = REPORTS[name](logs, cus, lf), REPORTS[name](landed.logs, landed.cus, lf)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("SortMergeJoin"):]  # the join and what feeds it
    assert "Bucketed: true" in below and "SelectedBucketsCount: 16 out of 16" in below
    assert "Exchange hashpartitioning" not in below


def test_hot_customer_is_dealt_over_buckets(night):
    logs, cus, _, landed = night
    n = logs.count()
    per = landed.logs.groupBy(F.pmod(F.hash(joins.KEY, joins.SALT), F.lit(16)).alias("b")).count()
    assert per.agg(F.max("count")).first()[0] < 0.25 * n  # the hot customer alone has a third
    salts = {r["ID"]: r["n"] for r in landed.cus.groupBy("ID").agg(F.count("*").alias("n")).collect()}
    assert salts[7] >= 5 and sum(v > 1 for v in salts.values()) <= 16
    assert landed.logs.drop(joins.KEY, joins.SALT).exceptAll(logs).count() == 0 and landed.logs.count() == n
    assert landed.cus.where(f"{joins.SALT} = 0").count() == cus.count()


def test_plain_logs_meet_a_landed_customer_table_once(night):
    logs, cus, _, landed = night
    assert movie.customers_by_location(logs, landed.cus).exceptAll(movie.customers_by_location(logs, cus)).count() == 0
    assert joins.with_customers(logs, landed.cus).count() == joins.with_customers(logs, cus).count()


def test_empty_tables_and_bucket_counts(spark, night):
    logs, cus, lf, _ = night
    empty = bucketed.land(logs.limit(0), cus, buckets=8)
    assert movie.customers_by_location(empty.logs, empty.cus).count() == 0
    empty.drop()
    assert [bucketed.buckets_for(n) for n in (0, 32_000_000, 32_000_001, 10**12)] == [8, 8, 16, 262_144]


def test_run_days_over_buckets_leaves_no_tables(spark, night, tmp_dir):
    logs, cus, lf, _ = night
    i = Inputs(spark, SF)
    before = {t.name for t in spark.catalog.listTables()}
    run_days({"2024-02-01": logs}, Dims(cus, lf, i.fol), [5, 8], tmp_dir, "bucketed")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.read.parquet(f"{tmp_dir}/customers_by_location/dt=2024-02-01").exceptAll(movie.customers_by_location(logs, cus)).count() == 0
    assert spark.read.parquet(f"{tmp_dir}/customer_app_pivot/dt=2024-02-01").count() == customer.customer_app_pivot(logs).count()
    assert not os.path.exists("spark-warehouse/vodlens_logs")
