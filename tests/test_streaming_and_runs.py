"""Streaming ingest (availableNow over landed files) and the report runner."""

import pytest
from pyspark.sql import functions as F

from vodlens.operators.clean import clean_kafka
from vodlens.plans.daily import JOBS, Dims, date_range, parse_jobs, run_reports
from vodlens.plans.catalog import Inputs
from vodlens.sources import fixtures
from vodlens.sources import logs as log_src
from vodlens.streaming import file_log_stream, start_ingest
from vodlens.streaming.ingest import clean_kafka_values

SF = "/root/testdata/sf0.001"


def test_ingest_matches_batch_clean_and_resumes(spark, tmp_dir):
    raw = fixtures.raw_kafka_logs(spark, SF)
    land, out, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/clean", f"{tmp_dir}/ckpt"
    first = raw.where(F.to_date("received_at") < "2024-01-15")
    log_src.write_raw(first, f"{land}/a")
    q = start_ingest(file_log_stream(spark, land), out, ckpt)
    q.awaitTermination(120)
    n1 = spark.read.parquet(out).count()
    assert n1 == clean_kafka(first).count()
    # new files land; a second catch-up run picks up only those
    log_src.write_raw(raw.where(F.to_date("received_at") >= "2024-01-15"), f"{land}/b")
    q = start_ingest(file_log_stream(spark, land), out, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = clean_kafka(raw)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_kafka_values_parse_to_the_batch_clean_logs(spark):
    # Records as a producer puts them on the topic: JSON bytes in ``value``.
    raw = fixtures.raw_kafka_logs(spark, SF)
    values = raw.select(
        F.to_json(F.struct("received_at", "fields"), {"timestampFormat": log_src.TS_FORMAT})
        .cast("binary")
        .alias("value")
    )
    got, want = clean_kafka_values(values), clean_kafka(raw)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_parse_jobs_and_dates():
    assert parse_jobs("k,2,10") == ("k", [2, 10])
    assert parse_jobs("h")[1] == sorted(JOBS)  # source only → all jobs
    assert parse_jobs("k,0")[1] == sorted(JOBS)
    assert date_range("2024-01-30", "2024-02-02") == ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]


def test_run_all_reports_with_sink(spark, tmp_dir):
    i = Inputs(spark, SF)
    dims = Dims(cus=i.cus, listfolder=i.listfolder, fol=i.fol)
    written = {}

    def sink(name, df):
        path = f"{tmp_dir}/{name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = spark.read.parquet(path).count()

    out = run_reports(i.logs, dims, None, sink)
    assert set(written) == set(out) and len(out) == 16
    assert written["vod_by_folder"] == out["vod_by_folder"].count() > 0


def test_dated_customer_snapshots(spark):
    i = Inputs(spark, SF)
    from vodlens.operators.folder import vod_by_folder

    # a snapshot per day with identical contents gives the undated result
    span = F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))
    snap = i.cus.withColumn("SnapshotDate", F.explode(span))
    a = vod_by_folder(i.logs, snap, i.listfolder)
    b = vod_by_folder(i.logs, i.cus, i.listfolder)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_checkpointed_run_matches_persisted(spark):
    i = Inputs(spark, SF)
    dims = Dims(cus=i.cus, listfolder=i.listfolder, fol=i.fol)
    a = run_reports(i.logs, dims, [2, 13], how="checkpoint")
    b = run_reports(i.logs, dims, [2, 13], how="none")
    for name in a:
        assert a[name].exceptAll(b[name]).count() == 0 and b[name].exceptAll(a[name]).count() == 0


def test_cli_end_to_end(spark, tmp_dir):
    from vodlens.plans.daily import main

    i = Inputs(spark, SF)
    log_src.write_raw(fixtures.raw_kafka_logs(spark, SF), f"{tmp_dir}/kafka")
    i.cus.write.parquet(f"{tmp_dir}/cus")
    i.listfolder.write.parquet(f"{tmp_dir}/lf")
    fixtures.menu_detail(spark, SF).write.parquet(f"{tmp_dir}/menus")
    main(["k,2,16", "2024-01-02", "2024-01-03", "--kafka", f"{tmp_dir}/kafka",
          "--customers", f"{tmp_dir}/cus", "--listfolder", f"{tmp_dir}/lf",
          "--menus", f"{tmp_dir}/menus", "--out", f"{tmp_dir}/out"])
    got = spark.read.parquet(f"{tmp_dir}/out/vod_by_folder")
    assert sorted(r[0].isoformat() for r in got.select("Date").distinct().collect()) == ["2024-01-02", "2024-01-03"]
    assert sorted(r[0].isoformat() for r in got.select("dt").distinct().collect()) == ["2024-01-02", "2024-01-03"]
    assert spark.read.parquet(f"{tmp_dir}/out/topic_lane_rows").count() > 0


def _dumps(spark, days):
    """Clean logs by dump day; the last dump also holds the first day's late records."""
    logs = Inputs(spark, SF).logs.withColumn("d", F.col("Date").cast("string"))
    late = (F.col("d") == days[0]) & (F.pmod(F.xxhash64("Session"), F.lit(7)) == 0)
    dump = F.when(late, F.lit(days[-1])).otherwise(F.col("d"))
    logs = logs.withColumn("dump", dump)
    return {d: logs.where(F.col("dump") == d).drop("d", "dump") for d in days}


def test_nights_late_records_and_repeats_lose_nothing(spark, tmp_dir):
    from vodlens.operators.topic_lane import topic_lane_rows
    from vodlens.plans.daily import run_days

    i, days, out = Inputs(spark, SF), ["2024-01-03", "2024-01-04"], f"{tmp_dir}/out"
    dims, dumps = Dims(cus=i.cus, listfolder=i.listfolder, fol=i.fol), _dumps(spark, days)
    for night in (days[0], days[1], days[1]):  # the second night is repeated
        run_days({night: dumps[night]}, dims, [5, 16], out)
    rows = spark.read.parquet(f"{out}/topic_lane_rows")
    want = {d: topic_lane_rows(dumps[d]).count() for d in days}
    assert all(want.values())
    assert {r["dt"].isoformat(): r["count"] for r in rows.groupBy("dt").count().collect()} == want
    by = spark.read.parquet(f"{out}/customers_by_location")
    dates = {(r["dt"].isoformat(), r["Date"].isoformat()) for r in by.select("dt", "Date").distinct().collect()}
    assert dates == {(days[0], days[0]), (days[1], days[0]), (days[1], days[1])}


def test_gaps_are_errors_that_name_the_days(spark, tmp_dir):
    from vodlens.plans.daily import run_days

    i, days = Inputs(spark, SF), ["2024-01-03", "2024-01-04"]
    cus = i.cus.withColumn("SnapshotDate", F.lit("2024-01-03").cast("date"))
    with pytest.raises(ValueError, match="2024-01-04"):
        run_days(_dumps(spark, days), Dims(cus, i.listfolder, i.fol), [5], f"{tmp_dir}/out")
    raw = fixtures.raw_kafka_logs(spark, SF).where("to_date(received_at) = '2024-01-03'")
    log_src.write_raw(raw, f"{tmp_dir}/kafka")
    with pytest.raises(FileNotFoundError, match="2024-01-04"):
        log_src.read_logs(spark, f"{tmp_dir}/kafka", None, days, "k")
    with pytest.raises(ValueError, match="files"):
        log_src.read_logs(spark, None, None, days, "f")


def test_one_failing_job_does_not_stop_the_others(spark, monkeypatch):
    i, seen = Inputs(spark, SF), []

    def broken(logs, dims):
        raise RuntimeError("broken")

    monkeypatch.setitem(JOBS, 2, broken)
    with pytest.raises(ExceptionGroup):
        run_reports(i.logs, Dims(i.cus, i.listfolder, i.fol), [2, 5], lambda name, df: seen.append(name))
    assert seen == ["customers_by_location"]
    assert run_reports(i.logs, Dims(i.cus, i.listfolder, i.fol), [], how="none") == {}


def test_ingest_restart_without_a_checkpoint_argument(spark, tmp_dir):
    raw = fixtures.raw_kafka_logs(spark, SF)
    land, out = f"{tmp_dir}/land", f"{tmp_dir}/clean"
    for name, part in (("a", "< '2024-01-15'"), ("b", ">= '2024-01-15'")):
        log_src.write_raw(raw.where(f"to_date(received_at) {part}"), f"{land}/{name}")
        start_ingest(file_log_stream(spark, land), out).awaitTermination(120)
    assert spark.read.parquet(out).count() == clean_kafka(raw).count()


def test_every_timestamp_form_is_read(spark, tmp_dir):
    forms = ["2024-01-01T10:00:00.123456+07:00", "2024-01-01T10:00:01Z", "2024-01-01T10:00:02+00:00",
             "2024-01-01 10:00:03", "2024-01-01T10:00:04.5"]
    spark.createDataFrame([(f'{{"received_at": "{f}", "fields": {{}}}}',) for f in forms], "value string").write.text(f"{tmp_dir}/raw")
    got = log_src.read_raw(spark, f"{tmp_dir}/raw")
    assert got.where("received_at is not null").count() == len(forms)
