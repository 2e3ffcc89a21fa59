"""Landed report states: nightly partial reports that add up exactly (RUN2).

    <root>/ids/load=<name>/                  numbering of ids, one load per append
    <root>/state/<report>/dt=<dump day>/     state of each report (operators.mergeable)

``land_day`` numbers the ids a dump day brings in and writes the day's states;
``combined`` merges the states of any dump days into the report by event ``Date``.  A
repeated day finds its ids numbered and replaces its own states only.  A load counts
once its writer has committed (``_SUCCESS``), so a night that failed while numbering
leaves nothing behind; one night runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators import mergeable
from ..sinks.files import write_table
from ..sources.listing import partition_values


def numbering(spark: SparkSession, root: str) -> DataFrame:
    """(kind, text, n) of all committed loads."""
    base = f"{root.rstrip('/')}/ids"
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(sc._jsc.hadoopConfiguration())
    loads = [f"{base}/load={v}" for v in sorted(partition_values(spark, base, "load"))]
    loads = [p for p in loads if fs.exists(path(f"{p}/_SUCCESS"))]
    return spark.read.schema(mergeable.NUMBERING).parquet(*loads) if loads else spark.createDataFrame([], mergeable.NUMBERING)


def land_day(logs: DataFrame, dims, day: str, root: str, reports: Iterable[str] | None = None) -> None:
    """Number the ids of one dump day's logs and write the states of its reports."""
    spark = logs.sparkSession
    root = root.rstrip("/")
    chosen = {name: mergeable.REPORTS[name] for name in (mergeable.REPORTS if reports is None else reports)}
    kinds = {kind for r in chosen.values() for kind, _ in r.distinct.values()}
    if not kinds:
        return
    fresh = mergeable.new_ids(numbering(spark, root), mergeable.ids_of(logs, kinds))
    fresh.write.parquet(f"{root}/ids/load={day}-{uuid.uuid4().hex[:12]}")
    known = numbering(spark, root)
    for name, report in chosen.items():
        write_table(mergeable.state_of(report.rows(logs, dims), report, known), f"{root}/state/{name}/dt={day}")


def combined(spark: SparkSession, root: str, name: str, days: Iterable[str] | None = None) -> DataFrame:
    """The report over the given dump days (all landed ones by default)."""
    base = f"{root.rstrip('/')}/state/{name}"
    have = partition_values(spark, base, "dt")
    wanted = sorted(have if days is None else set(days))
    missing = [d for d in wanted if d not in have]
    if missing or not wanted:
        raise FileNotFoundError(f"no landed state of {name} for {missing or 'any day'} under {root}")
    state = spark.read.option("basePath", base).parquet(*[f"{base}/dt={d}" for d in wanted])
    return mergeable.report_of(state, mergeable.REPORTS[name])
