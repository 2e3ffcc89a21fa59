"""Rejected records: a reason for each, none lost, counts that add up."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vodlens.operators import clean, quarantine
from vodlens.plans import daily
from vodlens.plans.catalog import Inputs
from vodlens.schema import RAW_ARCHIVE
from vodlens.sources import fixtures
from vodlens.sources import logs as src

SF = "/root/testdata/sf0.001"
GOOD = {
    "LogId": "52", "AppId": "21", "AppName": "VOD", "CustomerID": "5", "Contract": "c", "Session": "s", "Mac": "m", "SubMenuId": "7", "ItemId": "9",
    "ChapterID": "1", "Duration": "10", "RealTimePlaying": "4", "ElapsedTimePlaying": "5", "ListOnFolder": "1", "Folder": "2"}
TIME = "2024-02-01T10:00:00.000Z"


def record(time=TIME, **change):
    fields = {k: v for k, v in {**GOOD, **change}.items() if v is not None}
    return json.dumps({"received_at": time, "fields": fields})


LINES = {
    "accepted": [record(), record(LogId="20", Duration=None), record(LogId="512", SubMenuId="")],
    "record": ["{not json", "", "[1, 2]", json.dumps({"received_at": TIME})],
    "time": [record(time="yesterday"), record(time=None)],
    "identity": [record(CustomerID="0"), record(Session=None), record(Contract=""), record(Mac=None)],
    "application": [record(AppId="99", AppName="FILM")],
    "kind": [record(LogId="99")],
    "view": [record(Duration="0"), record(RealTimePlaying="NaN"), record(ListOnFolder="undefined"), record(SubMenuId="")],
}


@pytest.fixture()
def landed(tmp_dir):
    """A dump day of the lines above; blank lines are no records."""
    folder = f"{tmp_dir}/kafka/dt=2024-02-01"
    os.makedirs(folder)
    lines = [x for part in LINES.values() for x in part]
    open(f"{folder}/a.json", "w").write("\n".join(lines[::2]))
    open(f"{folder}/b.json", "w").write("\n".join(lines[1::2]) + "\n")
    return f"{tmp_dir}/kafka", {k: [x for x in v if x] for k, v in LINES.items()}


def test_every_record_is_accepted_or_has_its_reason(spark, landed, tmp_dir):
    root, lines = landed
    raw = src.read_raw(spark, root, "kafka", dates=["2024-02-01"], corrupt=True)
    n = src.land_checked(raw, "kafka", f"{tmp_dir}/out", "2024-02-01")
    assert n == {"read": sum(map(len, lines.values())), **{k: len(v) for k, v in lines.items()}}
    assert n["read"] == sum(v for k, v in n.items() if k != "read")
    rejects = src.read_landed(spark, f"{tmp_dir}/out", reason=None).collect()
    assert len(rejects) == n["read"] - n["accepted"] and {r.dt for r in rejects} == {"2024-02-01"}
    text = lambda part: sorted(x.replace(" ", "") for x in part)
    assert text(r.raw for r in rejects if r.reason == "record") == text(lines["record"])
    assert any("yesterday" in r.raw for r in rejects if r.reason == "time")  # the text as it came
    back = [json.loads(r.raw)["fields"] for r in rejects if r.reason == "identity"]
    assert sorted(map(str, back)) == sorted(str(json.loads(x)["fields"]) for x in lines["identity"])
    clean_rows = src.read_landed(spark, f"{tmp_dir}/out", ["2024-02-01"])
    want = clean.clean_kafka(src.read_raw(spark, root, "kafka", dates=["2024-02-01"]))
    assert clean_rows.columns == want.columns
    assert clean_rows.exceptAll(want).count() == 0 and want.exceptAll(clean_rows).count() == 0


def test_a_repeated_day_replaces_itself_only(spark, landed, tmp_dir):
    root, lines = landed
    raw = src.read_raw(spark, root, "kafka", corrupt=True)
    out = f"{tmp_dir}/out"
    for day in ("2024-02-01", "2024-02-02", "2024-02-01"):
        src.land_checked(raw, "kafka", out, day)
    assert src.read_landed(spark, out).count() == 2 * len(lines["accepted"])
    assert src.land_checked(raw.where("fields.LogId = '20'"), "kafka", out, "2024-02-02")["read"] == 1
    assert src.read_landed(spark, out, ["2024-02-02"]).count() == 1
    assert src.read_landed(spark, out, ["2024-02-02"], None).count() == 0  # reasons without rows this time are gone
    assert src.read_landed(spark, out, ["2024-02-01"], "view").count() == len(lines["view"])


@pytest.mark.parametrize("kind", ["kafka", "archive"])
def test_accepted_are_what_the_rule_keeps(spark, kind):
    raw = fixtures.raw_kafka_logs(spark, SF) if kind == "kafka" else fixtures.raw_archive_logs(spark, SF)
    rule = clean.kafka_rule() if kind == "kafka" else clean.archive_rule()
    r = quarantine.checked(raw.withColumn("kept", F.coalesce(rule, F.lit(False))), kind)
    assert r.where((F.col("reason") == "accepted") != F.col("kept")).count() == 0
    assert r.select("reason").distinct().count() > 2


def test_archive_time_that_does_not_parse_is_counted(spark, tmp_dir):
    rows = [(TIME, GOOD), ("soon", GOOD), (None, GOOD), (TIME, None), (TIME, {**GOOD, "Duration": "x"}), (TIME, {k: v for k, v in GOOD.items() if k != "ItemId"})]
    raw = spark.createDataFrame(rows, RAW_ARCHIVE)
    n = src.land_checked(raw, "archive", tmp_dir, "2024-02-01")
    assert (n["read"], n["accepted"], n["time"], n["record"], n["view"], n["identity"]) == (6, 1, 2, 1, 1, 1)
    assert clean.clean_archive(raw).where("Date is null").count() == 1  # the rule alone keeps it, without a day
    assert src.read_landed(spark, tmp_dir).where("Date is null").count() == 0
    assert src.land_checked(raw.limit(0), "archive", tmp_dir, "2024-02-03")["read"] == 0


def test_a_night_over_landed_rows(spark, tmp_dir, capsys):
    i = Inputs(spark, SF)
    raw = fixtures.raw_kafka_logs(spark, SF).where("to_date(received_at) <= '2024-01-03'")
    src.write_raw(raw, f"{tmp_dir}/kafka")
    for name, df in (("cus", i.cus), ("lf", i.listfolder), ("fol", i.fol)):
        df.write.parquet(f"{tmp_dir}/{name}")
    daily.main(["k,5", "2024-01-01", "2024-01-02", "--kafka", f"{tmp_dir}/kafka", "--customers", f"{tmp_dir}/cus", "--listfolder", f"{tmp_dir}/lf",
                "--menus", f"{tmp_dir}/fol", "--out", f"{tmp_dir}/out", "--materialize", "none", "--land", f"{tmp_dir}/checked", "--states", f"{tmp_dir}/st"])
    said = capsys.readouterr().out
    assert said.count("kafka: read") == 2
    want = clean.clean_kafka(raw.where("to_date(received_at) <= '2024-01-02'"))
    assert src.read_landed(spark, f"{tmp_dir}/checked").count() == want.count()
    from vodlens.operators.movie import customers_by_location
    from vodlens.plans.states import combined

    report = customers_by_location(want, i.cus)
    assert combined(spark, f"{tmp_dir}/st", "customers_by_location").select(*report.columns).exceptAll(report).count() == 0
    with pytest.raises(FileNotFoundError, match="2025-01-01"):
        src.source_of(spark, f"{tmp_dir}/kafka", None, "2025-01-01")
