"""One customer holding a third of all rows: both join paths give the same
result, which equals a brute-force pandas computation; the large-dimension
path aggregates before its join."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vodlens.operators import folder, joins, menu, movie, pageview, recsys, submenu
from vodlens.plans.catalog import Inputs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    i = Inputs(spark, SF)
    ev = i.logs
    # every third event belongs to customer 7
    hot = F.when(F.hash("ts", "LogId", "ItemId") % 3 == 0, F.lit("7")).otherwise(F.col("CustomerID"))
    return ev.withColumn("CustomerID", hot), i


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


REPORTS = {
    "vod_by_folder": lambda l, i: folder.vod_by_folder(l, i.cus, i.listfolder),
    "vod_by_folder_level": lambda l, i: folder.vod_by_folder_level(l, i.cus, i.listfolder),
    "sessions_by_location": lambda l, i: folder.sessions_by_location(l, i.cus, i.listfolder),
    "vod_by_movie_chapter": lambda l, i: movie.vod_by_movie_chapter(l, i.cus),
    "vod_by_movie": lambda l, i: movie.vod_by_movie(l, i.cus),
    "customers_by_location": lambda l, i: movie.customers_by_location(l, i.cus),
    "vod_by_main_menu": lambda l, i: menu.vod_by_main_menu(l, i.cus),
    "unique_pageview": lambda l, i: pageview.unique_pageview(l, i.cus),
    "recsys_impressions": lambda l, i: recsys.recsys_impressions(l, i.cus),
    "recsys_conversion": lambda l, i: recsys.recsys_conversion(l, i.cus),
    "submenu_behaviours": lambda l, i: submenu.submenu_behaviours(l, i.cus),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_paths_agree_under_skew(spark, skewed, name):
    logs, i = skewed
    share = logs.where(F.col("CustomerID") == "7").count() / logs.count()
    assert share > 0.3
    small = REPORTS[name](logs, i)
    small_plan = _plan(small)
    spark.conf.set(joins.CONF_KEY, "10")
    try:
        large = REPORTS[name](logs, i)
        large_plan = _plan(large)
        assert _same(small, large)
    finally:
        spark.conf.unset(joins.CONF_KEY)
    # the large-dimension path adds the per-customer pre-aggregation
    assert large_plan.count("HashAggregate") > small_plan.count("HashAggregate")


def test_folder_report_matches_pandas_under_skew(spark, skewed):
    logs, i = skewed
    got = folder.vod_by_folder(logs, i.cus, i.listfolder).toPandas()
    lg = logs.where(F.col("LogId") == "52").select(
        "Date", "CustomerID", "ItemId", "RealTimePlaying", "Duration").toPandas()
    cus = i.cus.toPandas()
    lf = i.listfolder.toPandas()
    r = pd.to_numeric(lg["RealTimePlaying"], errors="coerce")
    d = pd.to_numeric(lg["Duration"], errors="coerce")
    lg["dur"] = d.where(r >= d, r)
    lg["ik"] = pd.to_numeric(lg["ItemId"], errors="coerce").astype("Int64")
    lg["ck"] = pd.to_numeric(lg["CustomerID"], errors="coerce").astype("Int64")
    lf["MovieID"] = lf["MovieID"].astype("Int64")
    m = lg.merge(lf, left_on="ik", right_on="MovieID", how="left").merge(cus, left_on="ck", right_on="ID")
    want = (m.groupby(["Date", "Area", "UType", "Folder"], dropna=False)
             .agg(TotalViews=("CustomerID", "size"), TotalCustomers=("CustomerID", "nunique"),
                  TotalDuration=("dur", "sum"))
             .reset_index())
    want["TotalDuration"] = want["TotalDuration"].round(2)
    key = ["Date", "Area", "UType", "Folder"]
    a = got.sort_values(key, na_position="first").reset_index(drop=True)
    b = want.sort_values(key, na_position="first").reset_index(drop=True)
    assert len(a) == len(b)
    assert (a["TotalViews"].values == b["TotalViews"].values).all()
    assert (a["TotalCustomers"].values == b["TotalCustomers"].values).all()
    assert ((a["TotalDuration"] - b["TotalDuration"]).abs() < 1e-6).all()


SKEW_CONF = {
    joins.CONF_KEY: "10",  # dimension over the broadcast bound
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
}


def _split_by_aqe(spark, build):
    """Run ``build()`` broadcast and then as a shuffle join with skew
    thresholds scaled to the fixture; return (final plan, same result)."""
    small = build()
    small.collect()
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        large = build()
        large.collect()  # runs this frame's own adaptive plan to its final form
        plan = large._jdf.queryExecution().executedPlan().toString()
        return plan, _same(small, large)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(logs, col, value):
    logs = logs.withColumn(col, F.when(F.hash("ts", "Session") % 3 == 0, F.lit(value)).otherwise(F.col(col)))
    # AQE splits a skewed partition at map-task boundaries; the fixture file is
    # one row group (one task), a real log has many input splits.
    logs = logs.repartition(8)
    assert logs.where(F.col(col) == value).count() / logs.count() > 0.3
    return logs


def test_hot_movie_is_split_by_aqe_when_the_catalogue_is_not_broadcast(spark):
    i = Inputs(spark, SF)
    logs = _hot(i.logs.where(F.col("LogId") == "52"), "ItemId", "70")  # movie 70 has a folder
    plan, same = _split_by_aqe(spark, lambda: joins.with_folders(logs, i.listfolder))
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "skew=true" in plan  # the hot movie's partition was split
    assert same


def test_hot_customer_row_join_is_split_by_aqe_when_customers_are_not_broadcast(spark):
    i = Inputs(spark, SF)
    logs = _hot(i.logs.where(F.col("LogId") == "52"), "CustomerID", "7")
    plan, same = _split_by_aqe(spark, lambda: joins.with_customers(logs, i.cus))
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "skew=true" in plan
    assert same


def test_rows_without_a_movie_key_are_spread_in_one_plan(spark, skewed):
    """A third of the rows have an id that is no number."""
    _, i = skewed
    logs = i.logs.where(F.col("LogId") == "52")
    bad = F.when(F.pmod(F.hash("ts", "CustomerID"), F.lit(3)) == 0, F.lit("undefined")).otherwise(F.col("ItemId"))
    logs = logs.select("Date", "CustomerID", "ts", bad.alias("ItemId")).checkpoint()
    lookup = i.listfolder.checkpoint()
    small = joins.with_folders(logs, lookup)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set(joins.CONF_KEY, "10")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        large = joins.with_folders(logs, lookup)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "Union" not in plan and "_spread" in plan[plan.index("SortMergeJoin"):].split("\n")[0]
        per = large.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("ItemId") == "undefined").alias("n")).collect()
        nulls = sum(r["n"] for r in per)
        assert nulls > 0.25 * logs.count() and max(r["n"] for r in per) < 0.2 * nulls
        assert large.exceptAll(small).count() == 0 and small.exceptAll(large).count() == 0
    finally:
        spark.conf.unset(joins.CONF_KEY)
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
