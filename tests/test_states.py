"""Report states of dump days: exact sums and distinct counts, whatever the split."""

import pytest
from pyspark.sql import functions as F

from vodlens.operators import mergeable
from vodlens.plans import states
from vodlens.plans.catalog import QUERIES, Inputs
from vodlens.plans.daily import JOBS, STATE_JOBS, Dims, run_days

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    i = Inputs(spark, SF)
    return i, Dims(i.cus, i.listfolder, i.fol)


def split(logs, n):
    """Dumps with every Date, customer and session spread over all of them."""
    part = F.pmod(F.xxhash64("ts"), F.lit(n))
    return {f"2024-02-{k + 1:02d}": logs.where(part == k) for k in range(n)}


def same(got, want):
    got = got.select(*want.columns)
    return got.count() == want.count() and not got.exceptAll(want).count() and not want.exceptAll(got).count()


def test_any_split_gives_the_whole_report(spark, inputs, tmp_dir):
    i, dims = inputs
    for day, logs in split(i.logs, 2).items():
        states.land_day(logs, dims, day, tmp_dir)
    for name in mergeable.REPORTS:
        assert same(states.combined(spark, tmp_dir, name), QUERIES[name](spark, SF)), name


def test_adding_up_the_days_reports_would_be_wrong(spark, inputs, tmp_dir):
    i, dims = inputs
    parts = split(i.logs, 2)
    made = [mergeable.REPORTS["vod_by_menu"].rows(p, dims).groupBy("Date", "MenuID").agg(F.count_distinct("CustomerID").alias("n")) for p in parts.values()]
    added = made[0].unionByName(made[1]).agg(F.sum("n")).first()[0]
    assert added > QUERIES["vod_by_menu"](spark, SF).agg(F.sum("TotalCustomer")).first()[0]


def test_repeated_and_unfinished_nights(spark, inputs, tmp_dir):
    i, dims = inputs
    one, two = split(i.logs, 2).items()
    names = ["vod_by_main_menu"]
    states.land_day(one[1], dims, one[0], tmp_dir, names)
    states.land_day(two[1], dims, two[0], tmp_dir, names)
    ids = {(r.kind, r.text): r.n for r in states.numbering(spark, tmp_dir).collect()}
    for kind in ("customer", "session"):  # dense and unique
        got = sorted(n for (k, _), n in ids.items() if k == kind)
        assert got == list(range(1, len(got) + 1)) and got
    # a load without _SUCCESS does not count, and a repeated night adds nothing
    spark.createDataFrame([("customer", "ghost", 1)], mergeable.NUMBERING).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_dir}/ids/load=broken")
    states.land_day(two[1], dims, two[0], tmp_dir, names)
    assert {(r.kind, r.text): r.n for r in states.numbering(spark, tmp_dir).collect()} == ids
    assert same(states.combined(spark, tmp_dir, names[0]), QUERIES[names[0]](spark, SF))
    # a corrected dump replaces its own day only
    states.land_day(two[1].limit(0), dims, two[0], tmp_dir, names)
    want = mergeable.REPORTS[names[0]].rows(one[1], dims).agg(F.sum("n")).first()[0]
    assert states.combined(spark, tmp_dir, names[0]).agg(F.sum("TotalViews")).first()[0] == want
    with pytest.raises(FileNotFoundError, match="2031"):
        states.combined(spark, tmp_dir, names[0], ["2031-01-01"])


def test_hot_customer_and_null_ids(spark, inputs, tmp_dir):
    i, dims = inputs
    hot = F.when(F.pmod(F.hash("ts", "ItemId"), F.lit(3)) == 0, F.lit("7")).otherwise(F.col("CustomerID"))
    logs = i.logs.withColumn("CustomerID", hot).withColumn("Session", F.when(F.col("ChapterID") != "3", F.col("Session")))
    for day, part in split(logs, 2).items():
        states.land_day(part, dims, day, tmp_dir, ["vod_by_main_menu"])
    from vodlens.operators.menu import vod_by_main_menu

    assert same(states.combined(spark, tmp_dir, "vod_by_main_menu"), vod_by_main_menu(logs, dims.cus))


def test_more_ids_than_one_bitmap_holds(spark):
    report = mergeable.Mergeable(None, ["g"], distinct={"people": ("customer", "who")})
    rows = spark.range(100_000).select((F.col("id") % 2).alias("g"), F.concat(F.lit("c"), F.col("id") % 70_001).alias("who"))
    ids = mergeable.new_ids(spark.createDataFrame([], mergeable.NUMBERING), mergeable.ids_of(rows.withColumn("CustomerID", F.col("who")), {"customer"})).cache()
    assert ids.agg(F.max("n"), F.count_distinct("n")).first()[:] == (70_001, 70_001)
    state = mergeable.state_of(rows, report, ids)
    assert state.where("bucket is not null").select("bucket").distinct().count() == 3
    assert same(mergeable.report_of(state.unionByName(state), report), rows.groupBy("g").agg(F.count_distinct("who").alias("people")))


def test_run_days_lands_states(spark, inputs, tmp_dir):
    i, dims = inputs
    assert set(STATE_JOBS.values()) == set(mergeable.REPORTS) and set(STATE_JOBS) < set(JOBS)
    run_days(split(i.logs, 2), dims, [5], f"{tmp_dir}/out", "checkpoint", f"{tmp_dir}/st")
    assert same(states.combined(spark, f"{tmp_dir}/st", "customers_by_location"), QUERIES["customers_by_location"](spark, SF))
    assert spark.read.parquet(f"{tmp_dir}/out/customers_by_location").select("dt").distinct().count() == 2
