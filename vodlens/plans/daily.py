"""Nightly report runs (RUN1) and date-range backfills (RUN2).

``run_reports`` takes clean logs and the dimensions, runs the chosen reports
and hands each result to a sink; a failing report does not stop the others, and
all errors are raised at the end.  The clean logs are persisted once (they feed
every report); a lost executor only recomputes its own blocks from the source
files.  A backfill runs dump day by dump day (``run_days``): every report is
written under the dump day ``dt`` whose logs it read, with the customer snapshot of
that day.  A late record keeps its own ``Date`` inside a later ``dt``, so it adds to
the earlier day and erases nothing, and a repeated day replaces itself only.

Command line (same argument shape as the original batch)::

    python -m vodlens.plans.daily k,2,10,13 2024-01-01 [2024-01-07] \
        --kafka PATH --archive PATH --customers PATH --listfolder PATH \
        --menus PATH --out PATH
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import customer, folder, menu, movie, pageview, recsys, submenu, topic_lane
from ..operators.joins import SNAPSHOT_COL
from ..sinks.night import Database, Night
from ..sources import bucketed


@dataclass
class Dims:
    cus: DataFrame
    listfolder: DataFrame
    fol: DataFrame


Report = Callable[[DataFrame, Dims], dict[str, DataFrame]]


def _one(name: str, fn) -> Report:
    return lambda logs, d: {name: fn(logs, d)}


def _pageviews(logs: DataFrame, d: Dims) -> dict[str, DataFrame]:
    pv = pageview.unique_pageview(logs, d.cus)
    return {"unique_pageview": pv, "leaving_soon_pageview": pageview.leaving_soon_pageview(pv)}


# Job numbers of the original nightly batch → reports (job 15 only called
# stored procedures and has no data work here).
JOBS: dict[int, Report] = {
    1: _one("vod_by_folder_level", lambda l, d: folder.vod_by_folder_level(l, d.cus, d.listfolder)),
    2: _one("vod_by_folder", lambda l, d: folder.vod_by_folder(l, d.cus, d.listfolder)),
    3: _one("vod_by_movie_chapter", lambda l, d: movie.vod_by_movie_chapter(l, d.cus)),
    4: _one("vod_by_movie", lambda l, d: movie.vod_by_movie(l, d.cus)),
    5: _one("customers_by_location", lambda l, d: movie.customers_by_location(l, d.cus)),
    6: _one("vod_by_menu", lambda l, d: menu.vod_by_menu(l, d.listfolder, d.fol)),
    7: _one("vod_by_main_menu", lambda l, d: menu.vod_by_main_menu(l, d.cus)),
    8: _one("customer_app_pivot", lambda l, d: customer.customer_app_pivot(l)),
    9: _one("sessions_by_location", lambda l, d: folder.sessions_by_location(l, d.cus, d.listfolder)),
    10: _pageviews,
    11: _one("series_movies", lambda l, d: customer.series_movies(l)),
    12: _one("recsys_impressions", lambda l, d: recsys.recsys_impressions(l, d.cus)),
    13: _one("recsys_conversion", lambda l, d: recsys.recsys_conversion(l, d.cus)),
    14: _one("submenu_behaviours", lambda l, d: submenu.submenu_behaviours(l, d.cus)),
    16: _one("topic_lane_rows", lambda l, d: topic_lane.topic_lane_rows(l)),
}


# Jobs whose report can be landed as a state (operators.mergeable).
STATE_JOBS = {
    1: "vod_by_folder_level", 2: "vod_by_folder", 3: "vod_by_movie_chapter", 4: "vod_by_movie", 5: "customers_by_location",
    6: "vod_by_menu", 7: "vod_by_main_menu", 9: "sessions_by_location", 10: "unique_pageview",
}


def mergeable_reports(jobs: list[int] | None) -> list[str]:
    return [name for n, name in STATE_JOBS.items() if jobs is None or n in jobs]


def parse_jobs(spec: str) -> tuple[str, list[int]]:
    """``'k,2,10'`` → (``'k'``, [2, 10]); no job numbers or ``0`` → all jobs."""
    parts = [p.strip() for p in spec.split(",") if p.strip()]
    source = parts[0].lower() if parts else "k"
    nums = [int(p) for p in parts[1:]]
    if not nums or nums[0] == 0:
        nums = sorted(JOBS)
    unknown = [n for n in nums if n not in JOBS]
    if unknown:
        raise ValueError(f"unknown job numbers {unknown}; known: {sorted(JOBS)}")
    return source, nums


def materialize(logs: DataFrame, how: str = "persist") -> DataFrame:
    """Make the clean logs reusable by every report of the run.

    * ``persist`` — keep them in executor memory/disk; a lost executor's blocks
      are recomputed from the source files (short lineage).  For daily sizes
      that fit the cluster.
    * ``checkpoint`` — write them once to the shared ``spark.checkpoint.dir``
      and cut the lineage; reports then re-read the files.  For very large runs.
    * ``bucketed`` (of ``run_days``) — logs and customers are landed once in matching
      buckets (``sources.bucketed``), so no report shuffles the logs for its join.
    * ``none`` — the input is already a landed table (e.g. the streaming
      ingest output); each report reads only its own columns and days.
    """
    if how == "persist":
        return logs.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(logs.sparkSession)
        return logs.checkpoint(eager=True)
    if how == "none":
        return logs
    raise ValueError(f"unknown materialization {how!r}")


def run_reports(
    logs: DataFrame,
    dims: Dims,
    jobs: list[int] | None = None,
    sink: Callable[[str, DataFrame], None] | None = None,
    how: str = "persist",
) -> dict[str, DataFrame]:
    """Run the chosen jobs over ``logs``; with a ``sink`` every result is
    written before persisted logs are released."""
    base = materialize(logs, how)
    out: dict[str, DataFrame] = {}
    errors: list[Exception] = []
    try:
        for n in sorted(JOBS) if jobs is None else jobs:
            try:
                made = JOBS[n](base, dims)
                if sink is not None:
                    for name, df in made.items():
                        sink(name, df)
                out.update(made)
            except Exception as e:  # the night goes on with the other jobs
                e.add_note(f"job {n}")
                errors.append(e)
    finally:
        if sink is not None and how == "persist":
            base.unpersist()
    if errors:
        raise ExceptionGroup(f"{len(errors)} jobs failed", errors)
    return out


def snapshots_of(cus: DataFrame, days: list[str]) -> dict[str, DataFrame]:
    """The customer table of each day: the day's snapshot where the table holds one
    per day (days without one raise an error that names them), else all of it."""
    if SNAPSHOT_COL not in cus.columns:
        return {d: cus for d in days}
    day = F.col(SNAPSHOT_COL).cast("date")
    held = cus.where(day.isin(*map(dt.date.fromisoformat, days))).select(day.alias("d")).distinct()
    missing = sorted(set(days) - {r["d"].isoformat() for r in held.collect()})
    if missing:
        raise ValueError(f"no customer snapshot for {missing}")
    return {d: cus.where(day == F.lit(dt.date.fromisoformat(d))).drop(SNAPSHOT_COL) for d in days}


def run_days(
    logs_by_day: dict[str, DataFrame],
    dims: Dims,
    jobs: list[int] | None,
    out: str,
    how: str = "persist",
    states_root: str | None = None,
    db: Database | None = None,
    again: bool = False,
) -> None:
    """Run the jobs over the logs of each dump day and write every report as Parquet
    under ``out/<report>/dt=<day>``; other days' results are not touched.  With
    ``states_root`` the reports that count distinct ids also land their state there,
    for ``states.combined`` to add up over dump days.  With ``db`` a day's reports also
    go into its tables, all in one transaction after the last job; a day with a failed
    job leaves the database as it was, and reports that the manifest already holds for
    a day are left alone (``again``: replaced)."""
    from ..sinks.files import write_table
    from .states import land_day

    cus = snapshots_of(dims.cus, list(logs_by_day))
    errors: list[Exception] = []
    for day, logs in logs_by_day.items():
        day_dims = Dims(cus[day], dims.listfolder, dims.fol)

        night: Night | None = None

        def sink(name: str, df: DataFrame, day: str = day) -> None:
            write_table(df, f"{out}/{name}/dt={day}")
            if night:
                night.stage(name, df.sparkSession.read.parquet(f"{out}/{name}/dt={day}"))

        landed = None
        try:
            night = Night(logs.sparkSession, db, day, again) if db else None
            if how == "bucketed":
                landed = bucketed.land(logs, day_dims.cus)
                base, day_dims = landed.logs, Dims(landed.cus, dims.listfolder, dims.fol)
            else:
                base = materialize(logs, how)
            try:
                run_reports(base, day_dims, jobs, sink, "none")
                if states_root:
                    land_day(base, day_dims, day, states_root, mergeable_reports(jobs))
                if night:
                    night.commit()
            finally:
                if night:
                    night.discard()
                if how == "persist":
                    base.unpersist()
                if landed:
                    landed.drop()
        except Exception as e:
            e.add_note(f"dump day {day}")
            errors.append(e)
    if errors:
        raise ExceptionGroup(f"{len(errors)} of {len(logs_by_day)} days had failing jobs", errors)


def date_range(start: str, end: str | None) -> list[str]:
    if start == "now":
        start = dt.date.today().isoformat()
    a = dt.date.fromisoformat(start)
    b = dt.date.fromisoformat(end) if end else a
    return [(a + dt.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def main(argv: list[str] | None = None) -> None:
    from ..session import get_spark
    from ..sources import dims as dim_src
    from ..sources.logs import land_checked, read_landed, read_logs, read_raw, source_of

    p = argparse.ArgumentParser(prog="vodlens.plans.daily")
    p.add_argument("jobs", help="source letter then job numbers, e.g. k,2,10")
    p.add_argument("start", nargs="?", default=dt.date.today().isoformat())
    p.add_argument("end", nargs="?", default=None)
    p.add_argument("--kafka")
    p.add_argument("--archive")
    p.add_argument("--files", nargs="+", help="Kafka-dump files of source f")
    p.add_argument("--fmt", default="json", help="format of the landed logs: json, parquet or orc")
    p.add_argument("--customers", required=True, help="Parquet or table:NAME with ID, Area, UType[, SnapshotDate]")
    p.add_argument("--listfolder", required=True, help="Parquet or table:NAME with MovieID, Folder")
    p.add_argument("--menus", required=True, help="Parquet or table:NAME with MenuID, FolderID")
    p.add_argument("--jdbc", help="database of table:NAME dimensions, and with --to-db of the reports")
    p.add_argument("--jdbc-driver", help="driver class; user and password are read from VODLENS_DB_USER and VODLENS_DB_PASSWORD")
    p.add_argument("--to-db", action="store_true", help="also write each day's reports to the database, in one transaction")
    p.add_argument("--again", action="store_true", help="replace days that the database already holds")
    p.add_argument("--out", required=True)
    p.add_argument("--land", help="folder to land each day's checked logs in, clean rows and rejects; the reports read the clean rows")
    p.add_argument("--states", help="folder of report states, to add dump days up exactly")
    p.add_argument("--materialize", default="persist", choices=["persist", "checkpoint", "bucketed", "none"])
    a = p.parse_args(argv)

    spark = get_spark()
    source, jobs = parse_jobs(a.jobs)
    days = date_range(a.start, a.end)
    if source == "f":
        if len(days) > 1:
            raise ValueError("given files are one dump: give one day")
        logs = {days[0]: read_logs(spark, None, None, source=source, files=a.files, fmt=a.fmt)}
    elif a.land:
        found = {d: source_of(spark, a.kafka, a.archive, d, source) for d in days}  # names a missing day before any is run
        logs = {}
        for d, (kind, path) in found.items():
            n = land_checked(read_raw(spark, path, kind, a.fmt, [d], corrupt=True), kind, a.land, d)
            print(f"{d} {kind}: " + ", ".join(f"{k} {v}" for k, v in n.items()))
            logs[d] = read_landed(spark, a.land, [d])
    else:
        read_logs(spark, a.kafka, a.archive, days, source, fmt=a.fmt)  # names every missing day before any is run
        logs = {d: read_logs(spark, a.kafka, a.archive, [d], source, fmt=a.fmt) for d in days}
    secrets = {"driver": a.jdbc_driver, "user": os.environ.get("VODLENS_DB_USER"), "password": os.environ.get("VODLENS_DB_PASSWORD")}
    db = Database(a.jdbc, {k: v for k, v in secrets.items() if v}) if a.jdbc else None

    def dim(spec: str) -> DataFrame:
        if not spec.startswith("table:"):
            return spark.read.parquet(spec)
        if db is None:
            raise ValueError(f"{spec} needs --jdbc")
        return db.table(spark, spec.removeprefix("table:"))

    dims = Dims(cus=dim(a.customers), listfolder=dim(a.listfolder), fol=dim_src.menu_folders(dim(a.menus)))
    if a.to_db and db is None:
        raise ValueError("--to-db needs --jdbc")

    run_days(logs, dims, jobs, a.out, a.materialize, a.states, db if a.to_db else None, a.again)


if __name__ == "__main__":
    main()
