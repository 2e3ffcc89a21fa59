"""Sources and sinks: JSON/ORC round trips, source fallback, partition
pruning, promotion feed, JDBC through embedded in-memory Derby (no port)."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from vodlens.operators.clean import clean_archive, clean_kafka
from vodlens.sinks import append_if_rows, append_jdbc, write_json_result, write_table, xml_rows
from vodlens.sources import fixtures
from vodlens.sources import logs as log_src
from vodlens.sources import views as view_src
from vodlens.sources import vouchers
from vodlens.sources.dims import jdbc_table, list_folders, menu_folders

SF = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_read_logs_prefers_kafka_then_falls_back(spark, tmp_dir):
    kafka, archive = f"{tmp_dir}/kafka", f"{tmp_dir}/archive"
    log_src.write_raw(fixtures.raw_kafka_logs(spark, SF), kafka)
    log_src.write_raw(fixtures.raw_archive_logs(spark, SF), archive)
    days = ["2024-01-02", "2024-01-03"]
    want_k = clean_kafka(fixtures.raw_kafka_logs(spark, SF)).where(F.col("Date").cast("string").isin(*days))
    want_a = clean_archive(fixtures.raw_archive_logs(spark, SF)).where(F.col("Date").cast("string").isin(*days))

    got = log_src.read_logs(spark, kafka, archive, days, "k")
    assert got.exceptAll(want_k).count() == 0 and want_k.exceptAll(got).count() == 0
    got = log_src.read_logs(spark, f"{tmp_dir}/missing", archive, days, "k")
    assert got.exceptAll(want_a).count() == 0 and want_a.exceptAll(got).count() == 0
    got = log_src.read_logs(spark, kafka, f"{tmp_dir}/missing", days, "h")
    assert got.count() == want_k.count()
    with pytest.raises(ValueError):
        log_src.read_logs(spark, kafka, archive, days, "z")


def test_read_logs_falls_back_per_day_and_lists_only_those_days(spark, tmp_dir):
    kafka, archive = f"{tmp_dir}/kafka", f"{tmp_dir}/archive"
    day = F.to_date(F.col("received_at").cast("timestamp")).cast("string")
    early = ["2024-01-02", "2024-01-03", "2024-01-04"]
    # Kafka dumps exist for three days only; the archive has every day.
    log_src.write_raw(fixtures.raw_kafka_logs(spark, SF).where(day.isin(*early)), kafka)
    log_src.write_raw(fixtures.raw_archive_logs(spark, SF), archive)
    days = ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"]
    in_days = lambda df, ds: df.where(F.col("Date").cast("string").isin(*ds))
    want = in_days(clean_kafka(fixtures.raw_kafka_logs(spark, SF)), days[:2]).unionByName(
        in_days(clean_archive(fixtures.raw_archive_logs(spark, SF)), days[2:]))
    got = log_src.read_logs(spark, kafka, archive, days, "k")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Only the requested day folders reach the file index.
    files = log_src.read_raw(spark, archive, "archive", dates=days[2:]).inputFiles()
    assert files and all(("dt=2024-01-05" in f) or ("dt=2024-01-06" in f) for f in files)
    # A day in neither source gives no rows; no day at all is an error.
    assert log_src.read_raw(spark, kafka, "kafka", dates=["2023-01-01"]).count() == 0
    with pytest.raises(FileNotFoundError):
        log_src.read_logs(spark, kafka, archive, ["2023-01-01"], "k")


def test_partition_filter_prunes_days(spark, tmp_dir):
    path = f"{tmp_dir}/kafka"
    log_src.write_raw(fixtures.raw_kafka_logs(spark, SF), path)
    df = log_src.read_raw(spark, path, "kafka", dates=["2024-01-05"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-05" in plan
    assert df.select(F.to_date("received_at").cast("string")).distinct().collect()[0][0] == "2024-01-05"


def test_views_read_lists_only_wanted_folders(spark, tmp_dir):
    views = fixtures.views(spark, SF)
    root = f"{tmp_dir}/views"
    view_src.write_views(views, root)
    df = view_src.read_views(spark, root, devices=["box", "tv"], start="2024-01-03", end="2024-01-04")
    files = df.inputFiles()
    assert files and all("device=box/day=2024-01-0" in f for f in files)
    assert {f.split("day=")[1][:10] for f in files} == {"2024-01-03", "2024-01-04"}
    none = view_src.read_views(spark, root, start="2030-01-01")
    assert none.count() == 0 and none.columns == df.columns


def test_views_orc_partitions_and_legacy_layout(spark, tmp_dir):
    views = fixtures.views(spark, SF)
    root = f"{tmp_dir}/views"
    view_src.write_views(views, root)
    df = view_src.read_views(spark, root, devices=["box"], start="2024-01-03", end="2024-01-04")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    want = views.where((F.col("device") == "box") & F.col("day").between("2024-01-03", "2024-01-04"))
    assert df.exceptAll(want.select(*df.columns)).count() == 0 and df.count() == want.count()
    # legacy: plain day folders, device and day taken from the path
    legacy = f"{tmp_dir}/legacy"
    for dev in ("mobile", "box"):
        for day in ("2024-01-03", "2024-01-04"):
            part = views.where((F.col("device") == dev) & (F.col("day") == day)).drop("device", "day")
            part.write.orc(f"{legacy}/{dev}/views_{day}")
    paths = [f"{legacy}/{d}/views_{day}" for d in ("mobile", "box") for day in ("2024-01-03", "2024-01-04")]
    got = view_src.read_day_folders(spark, paths, r"/([a-z]+)/views_([0-9-]{10})/")
    want2 = views.where(F.col("device").isin("mobile", "box") & F.col("day").between("2024-01-03", "2024-01-04"))
    assert got.exceptAll(want2.select(*got.columns)).count() == 0 and got.count() == want2.count()


def test_voucher_feed_and_payload(spark, tmp_dir):
    rows = [(1, 'A & "B"', "E1", 12.9, "2024-01-01T00:00:00", "2024-02-01T00:00:00", "on", "g", "p", "i<1>", "t", "s"),
            (2, None, "E2", 5.0, "2024-01-02T10:00:00", "2024-02-02T00:00:00", "on", "g", "p", "i", "t", "s")]
    items = spark.createDataFrame(rows, [f.name for f in vouchers.VOUCHER_FEED.fields[0].dataType.elementType.fields])
    path = f"{tmp_dir}/feed"
    vouchers.write_feed(vouchers.pack_pages(items, page_size=1), path)
    out = vouchers.voucher_rows(vouchers.read_feed(spark, path)).orderBy("id").collect()
    assert out[0]["discount"] == 12 and out[0]["fromDate"] == "2024-01-01"
    assert out[0]["xml"].startswith('<T ID="1" Name="A &amp; &quot;B&quot;" eventCode="E1" description="" discount="12"')
    assert 'images="i&lt;1&gt;"' in out[0]["xml"] and out[0]["xml"].endswith('serviceType="s"/>')
    assert 'Name=""' in out[1]["xml"]
    pay = vouchers.xml_payloads(vouchers.voucher_rows(vouchers.read_feed(spark, path)), chunk_rows=10).collect()
    assert len(pay) == 1 and pay[0]["n"] == 2 and pay[0]["payload"].index('ID="1"') < pay[0]["payload"].index('ID="2"')


def test_feed_keeps_ids_and_discounts_of_any_type(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/feed")
    doc = {"data": [{"id": "A12", "discount": "15", "name": 7}, {"id": 12, "discount": 15.9, "name": None}, {"id": 3000000000, "discount": "many"}, "odd", None]}
    with open(f"{tmp_dir}/feed/pages.json", "w") as f:
        f.write(json.dumps(doc) + "\n{broken\n" + json.dumps({"data": []}) + "\n" + json.dumps({"other": 1}) + "\n" + json.dumps({"data": {"id": 1}}) + "\n")
    got = {r["id"]: r for r in vouchers.voucher_rows(vouchers.read_feed(spark, f"{tmp_dir}/feed")).collect()}
    assert {k: (r["discount"], r["name"]) for k, r in got.items()} == {"A12": (15, "7"), "12": (15, None), "3000000000": (None, None)}
    assert 'ID="A12"' in got["A12"]["xml"] and 'discount=""' in got["3000000000"]["xml"]
    with open(f"{tmp_dir}/whole.json", "w") as f:  # one document over many lines
        json.dump(doc, f, indent=2)
    assert vouchers.read_feed(spark, f"{tmp_dir}/whole.json", multiline=True).count() == 3


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,3)"])
def test_views_keep_the_type_of_their_files(spark, tmp_dir, kind):
    from vodlens.operators.views import item_views

    views = fixtures.views(spark, SF).withColumn("duration", F.col("duration").cast(kind))
    view_src.write_views(views, f"{tmp_dir}/v")
    got = view_src.read_views(spark, f"{tmp_dir}/v")
    assert dict(got.dtypes)["duration"] == kind and got.count() == views.count()
    box = view_src.read_views(spark, f"{tmp_dir}/v", devices=["box"])
    assert item_views(box).exceptAll(item_views(views.where("device = 'box'"))).count() == 0


def test_jdbc_append_twice_and_read_back(spark):
    url = f"jdbc:derby:memory:vl{uuid.uuid4().hex[:8]};create=true"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, NAME string")
    assert append_jdbc(df, url, "T1", DERBY, atomic=True) == 2
    assert append_jdbc(df, url, "T1", DERBY, batchsize=1) == 2
    back = jdbc_table(spark, url, "T1", properties=DERBY)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    q = jdbc_table(spark, url, query="SELECT ID FROM T1 WHERE ID = 2", properties=DERBY)
    assert q.count() == 2
    part = jdbc_table(spark, url, "T1", properties=DERBY, partition_column="ID", lower_bound=1,
                      upper_bound=3, num_partitions=2)
    assert part.rdd.getNumPartitions() == 2 and part.count() == 4
    assert append_if_rows(df.limit(0), url, "T1", properties=DERBY) is False
    assert append_if_rows(df, url, "T1", properties=DERBY) is True
    assert jdbc_table(spark, url, "T1", properties=DERBY).count() == 6


def test_jdbc_atomic_append_is_all_or_nothing(spark):
    url = f"jdbc:derby:memory:vl{uuid.uuid4().hex[:8]};create=true"
    rows = spark.range(0, 5000, numPartitions=6).selectExpr("CAST(id AS INT) AS ID", "CAST(id % 7 AS STRING) AS NAME")
    # Written in parallel to a staging table, moved in one transaction.
    assert append_jdbc(rows, url, "T2", DERBY, atomic=True, num_partitions=3) == 5000
    assert jdbc_table(spark, url, "T2", properties=DERBY).count() == 5000
    # A move that fails (no EXTRA column in T2) leaves T2 untouched.
    bad = rows.withColumn("EXTRA", F.lit(1))
    with pytest.raises(Exception):
        append_jdbc(bad, url, "T2", DERBY, atomic=True)
    assert jdbc_table(spark, url, "T2", properties=DERBY).count() == 5000
    # No staging table is left behind.
    left = jdbc_table(spark, url, query="SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLENAME LIKE 'T2_STG_%'",
                      properties=DERBY)
    assert left.count() == 0


def test_jdbc_dimension_lookups(spark):
    url = f"jdbc:derby:memory:vl{uuid.uuid4().hex[:8]};create=true"
    append_jdbc(fixtures.menu_detail(spark, SF), url, "MENU_DETAIL", DERBY)
    menus = menu_folders(jdbc_table(spark, url, "MENU_DETAIL", properties=DERBY))
    assert "PushedFilters" in menus._jdf.queryExecution().executedPlan().toString()
    assert menus.count() == fixtures.menu_detail(spark, SF).count()
    movies, series = fixtures.movie_folders(spark, SF)
    lf = list_folders(movies, series)
    assert lf.count() == movies.distinct().count() + series.distinct().count()


def test_json_result_and_tables(spark, tmp_dir):
    df = spark.createDataFrame([("phim bộ", 1), ("x", None)], "t string, n int")
    write_json_result(df, f"{tmp_dir}/res")
    files = [f for f in os.listdir(f"{tmp_dir}/res") if f.endswith(".json")]
    assert len(files) == 1
    text = open(f"{tmp_dir}/res/{files[0]}", encoding="utf-8").read()
    assert "phim bộ" in text and json.loads(text.splitlines()[1])["n"] is None
    t = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int").select(
        F.col("d").cast("date").alias("Date"), "v")
    write_table(t, f"{tmp_dir}/tbl", ["Date"])
    write_table(t.where("v = 2").withColumn("v", F.lit(9)), f"{tmp_dir}/tbl", ["Date"])
    back = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/tbl").select("v").collect())
    assert back == [(1,), (9,)]  # re-run replaced its own day only


def test_xml_rows_sink(spark):
    df = spark.createDataFrame([("2024-01-01", "C<1>", 3)], "Date string, Contract string, VOD long")
    assert xml_rows(df).collect()[0]["xml"] == '<T Date="2024-01-01" Contract="C&lt;1&gt;" VOD="3"/>'


def test_file_list_source_and_snapshot_and_calendar(spark, tmp_dir):
    from vodlens.operators.views import calendar
    from vodlens.sources.dims import customer_snapshot

    # SRC3: explicit files, read as Kafka-dump records
    path = f"{tmp_dir}/kafka"
    log_src.write_raw(fixtures.raw_kafka_logs(spark, SF), path)
    files = [os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs
             if f.endswith(".json") and "dt=2024-01-07" in r]
    got = log_src.read_logs(spark, None, None, source="f", files=files)
    want = clean_kafka(fixtures.raw_kafka_logs(spark, SF)).where(F.col("Date") == "2024-01-07")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # SRC7: one snapshot date out of a dated customer table
    cus = spark.createDataFrame(
        [(1, 0, "U1", "2024-01-01"), (1, 2, "U2", "2024-01-02"), (2, 1, "U1", "2024-01-02")],
        "ID long, Area int, UType string, d string")
    snap = customer_snapshot(cus, "2024-01-02", "d")
    assert sorted(tuple(r) for r in snap.collect()) == [(1, 2, "U2"), (2, 1, "U1")]
    # SRC10: inclusive calendar across a month end
    days = [r[0].isoformat() for r in calendar(spark, "2022-12-30", "2023-01-02").collect()]
    assert days == ["2022-12-30", "2022-12-31", "2023-01-01", "2023-01-02"]


def test_pivot_rows_to_xml_payload(spark):
    from vodlens.operators.customer import customer_app_pivot

    logs = fixtures.logs(spark, SF)
    pivot = customer_app_pivot(logs)
    rows = xml_rows(pivot, attrs=["Date", "Contract", "CustomerID", "VOD", "CHILD", "RELAX"])
    pay = vouchers.xml_payloads(rows.repartition(4), chunk_rows=100, order_col=None)
    stats = pay.agg(F.sum("n"), F.max("n")).collect()[0]
    assert stats[0] == pivot.count() and stats[1] <= 100
    assert pay.where(~F.col("payload").startswith("<T Date=")).count() == 0
    # every element appears exactly once across the payloads
    n_elems = pay.select(F.explode(F.split("payload", "/>")).alias("e")).where(F.col("e") != "").count()
    assert n_elems == pivot.count()
    # empty input: no payload rows, hence no procedure call
    assert vouchers.xml_payloads(rows.limit(0), order_col=None).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_xml_payloads_bounded_with_a_hot_id(spark, shuffled):
    # id 5 has a third of all rows: chunks are cut by position, not by id.
    # ``shuffled``: the input comes out of a shuffle, so a recomputation would
    # see other arrival orders — positions must still be exact.
    n = 3000
    ids = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))
    src = spark.range(0, n, numPartitions=5)
    if shuffled:
        src = src.repartition(7, F.col("id") % 11)
    rows = src.select(
        ids.alias("id"), F.concat(F.lit('<T ID="'), ids.cast("string"), F.lit('" R="'), F.col("id").cast("string"), F.lit('"/>')).alias("xml")
    )
    pay = vouchers.xml_payloads(rows, chunk_rows=100).orderBy("chunk").collect()
    assert [p["chunk"] for p in pay] == list(range(n // 100))
    assert all(p["n"] == 100 for p in pay)
    elems = [e + "/>" for p in pay for e in p["payload"].split("/>") if e]
    assert sorted(elems) == sorted(r["xml"] for r in rows.collect())
    got_ids = [int(e.split('"')[1]) for e in elems]
    assert got_ids == sorted(got_ids)
    # the positions themselves: 0..n-1, each once
    pos = vouchers.global_positions(rows, ["id"]).select("_pos").collect()
    assert sorted(r[0] for r in pos) == list(range(n))


def test_measured_ranges_read_a_skewed_key_evenly(spark):
    from vodlens.sources.dims import jdbc_measured

    url = f"jdbc:derby:memory:vl{uuid.uuid4().hex[:8]};create=true"
    n = 4000
    key = F.when(F.col("id") % 50 == 0, F.lit(None).cast("bigint")).otherwise(F.floor(F.pow(F.col("id") / 400.0, 9)).cast("bigint"))  # crowded at the low end
    spark.range(n).select(key.alias("K"), F.col("id").alias("V")).write.format("jdbc").options(url=url, dbtable="T", **DERBY).save()
    sizes = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    even = jdbc_measured(spark, url, "T", "K", 8, DERBY)
    linear = jdbc_table(spark, url, "T", properties=DERBY, partition_column="K", lower_bound=0, upper_bound=10**9, num_partitions=8)
    assert sorted(r["V"] for r in even.collect()) == list(range(n)) and sum(sizes(linear)) == n
    hot = even.where("K = 0").count()  # one value cannot be cut
    rest = sorted(sizes(even))
    assert len(rest) >= 6 and max(x for x in rest if x < hot or hot < n / 8) <= 2 * n / 8 < max(sizes(linear))
    spark.range(1).select(F.lit(5).alias("K")).write.format("jdbc").options(url=url, dbtable="ONE", **DERBY).save()
    assert jdbc_measured(spark, url, "ONE", "K", 8, DERBY).count() == 1
    spark.range(0).select(F.col("id").alias("K")).write.format("jdbc").options(url=url, dbtable="EMPTY_T", **DERBY).save()
    assert jdbc_measured(spark, url, "EMPTY_T", "K", 8, DERBY).count() == 0
