"""A night in one commit: whole or not at all, repeated without effect."""

import uuid

import pytest
from pyspark.sql import functions as F

from vodlens.plans import daily
from vodlens.plans.catalog import Inputs
from vodlens.sinks import night as nt
from vodlens.sinks.jdbc import _execute
from vodlens.sources import fixtures
from vodlens.sources import logs as src

SF = "/root/testdata/sf0.001"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
DAY = "2024-02-01"


@pytest.fixture()
def db():
    return nt.Database(f"jdbc:derby:memory:night{uuid.uuid4().hex[:8]};create=true", {"driver": DRIVER})


def rows(spark, db, name):
    return sorted(tuple(r) for r in db.table(spark, name).collect())


def reports(spark, n=3):
    return {"PLAYS": spark.range(n).select("id", F.lit("x").alias("Date")), "PEOPLE": spark.range(2 * n).select((F.col("id") * 10).alias("n"))}


def put(spark, db, day, made, again=False):
    night = nt.Night(spark, db, day, again)
    kept = [night.stage(name, df) for name, df in made.items()]
    return kept, night.commit()


def stages(spark, db):
    return db.table(spark, "SYS.SYSTABLES").where(F.col("TABLENAME").contains("_STG_")).count()


def test_a_night_is_repeated_without_effect_and_replaced_on_demand(spark, db):
    assert put(spark, db, DAY, reports(spark)) == ([True, True], {"PLAYS": 3, "PEOPLE": 6})
    assert put(spark, db, DAY, reports(spark)) == ([False, False], {})
    assert put(spark, db, "2024-02-02", reports(spark, 1))[1] == {"PLAYS": 1, "PEOPLE": 2}
    assert rows(spark, db, "PLAYS") == [(0, "x", DAY), (0, "x", "2024-02-02"), (1, "x", DAY), (2, "x", DAY)]
    assert nt.done(spark, db, DAY) == {"PLAYS": 3, "PEOPLE": 6}
    assert put(spark, db, DAY, reports(spark, 2), again=True)[1] == {"PLAYS": 2, "PEOPLE": 4}
    assert [r for r in rows(spark, db, "PLAYS") if r[2] == DAY] == [(0, "x", DAY), (1, "x", DAY)]
    assert nt.done(spark, db, DAY) == {"PLAYS": 2, "PEOPLE": 4} and len(rows(spark, db, "PEOPLE")) == 6
    assert stages(spark, db) == 0
    # a report added to a night that is done goes in alone
    assert put(spark, db, DAY, {**reports(spark), "MORE": spark.range(1)}) == ([False, False, True], {"MORE": 1})


def test_failure_between_two_moves_leaves_nothing(spark, db):
    put(spark, db, "2024-01-31", reports(spark, 1))
    before = {t: rows(spark, db, t) for t in ("PLAYS", "PEOPLE", nt.MANIFEST)}
    _execute(spark, db.url, db.properties, ["ALTER TABLE PEOPLE ADD CONSTRAINT FEW CHECK (\"n\" < 30)"])
    with pytest.raises(Exception, match="FEW"):
        put(spark, db, DAY, reports(spark, 2))  # PLAYS moves, PEOPLE breaks the check
    assert {t: rows(spark, db, t) for t in before} == before and stages(spark, db) == 0
    _execute(spark, db.url, db.properties, ["ALTER TABLE PEOPLE DROP CONSTRAINT FEW"])
    assert put(spark, db, DAY, reports(spark, 2))[1] == {"PLAYS": 2, "PEOPLE": 4}


def test_of_two_racing_nights_one_commits(spark, db):
    a, b = nt.Night(spark, db, DAY), nt.Night(spark, db, DAY)
    for night in (a, b):
        assert night.stage("PLAYS", reports(spark)["PLAYS"])
    a.commit()
    with pytest.raises(Exception, match="(?i)duplicate|23505"):
        b.commit()
    assert len(rows(spark, db, "PLAYS")) == 3 and stages(spark, db) == 0


def test_run_through_the_database(spark, db, tmp_dir, monkeypatch):
    i = Inputs(spark, SF)
    raw = fixtures.raw_kafka_logs(spark, SF).where("to_date(received_at) <= '2024-01-03'")
    src.write_raw(raw, f"{tmp_dir}/kafka")
    for name, df in (("CUS", i.cus), ("LF", i.listfolder), ("MENU", fixtures.menu_detail(spark, SF))):
        df.write.format("jdbc").options(url=db.url, dbtable=name, **db.properties).save()
    args = ["k,2,5,6", "2024-01-01", "2024-01-02", "--kafka", f"{tmp_dir}/kafka", "--customers", "table:CUS", "--listfolder", "table:LF", "--menus", "table:MENU",
            "--out", f"{tmp_dir}/out", "--jdbc", db.url, "--jdbc-driver", DRIVER, "--to-db"]
    daily.main(args)
    names = ["vod_by_folder", "customers_by_location", "vod_by_menu"]
    sizes = {t: len(rows(spark, db, t)) for t in names}
    assert all(sizes.values())
    for day in ("2024-01-01", "2024-01-02"):
        held = nt.done(spark, db, day)
        assert set(held) == set(names)
        want = spark.read.parquet(f"{tmp_dir}/out/customers_by_location/dt={day}")
        got = db.table(spark, "customers_by_location").where(F.col("DT") == day).drop("DT")
        assert held["customers_by_location"] == want.count() and got.select(*want.columns).exceptAll(want).count() == 0
    daily.main(args)  # a repeated night
    assert {t: len(rows(spark, db, t)) for t in names} == sizes

    # a day with a failing job leaves the database as it was
    def broken(logs, dims):
        raise RuntimeError("no such report")

    monkeypatch.setitem(daily.JOBS, 16, broken)
    with pytest.raises(ExceptionGroup):
        daily.run_days({"2024-01-03": i.logs}, daily.Dims(i.cus, i.listfolder, i.fol), [5, 16], f"{tmp_dir}/out", "none", db=db)
    assert nt.done(spark, db, "2024-01-03") == {} and len(rows(spark, db, "customers_by_location")) == sizes["customers_by_location"] and stages(spark, db) == 0
