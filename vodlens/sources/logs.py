"""Raw log readers (SRC1-SRC4).

Logs land as JSON (or Parquet) under one folder per source, partitioned by
day (``dt=YYYY-MM-DD``).  Readers always pass an explicit schema, so nothing
is inferred at 100 TB, and are handed only the requested day folders, so only
those days are listed and read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_archive, clean_kafka
from ..operators.quarantine import ACCEPTED, CORRUPT, REASONS, landing_rows
from ..schema import LOGS, RAW_ARCHIVE, RAW_KAFKA
from .listing import partition_values

# Microsecond event times survive a JSON round trip with this format.  It is for
# writing only: readers set none, so any ISO form (``Z``, offset or no zone, with
# or without a fraction) is read; a time without zone is in the session's zone.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
PARTITION = "dt"


def _dates(dates: Iterable | None):
    return None if dates is None else [str(d) for d in dates]


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    kind: str = "kafka",
    fmt: str = "json",
    dates: Iterable | None = None,
    corrupt: bool = False,
) -> DataFrame:
    """Read raw logs of one source; ``kind`` is ``kafka`` (struct fields) or
    ``archive`` (map fields).  ``dates`` prunes ``dt=`` partitions; ``corrupt`` keeps
    the text of JSON records that do not parse in a column of their own."""
    schema = RAW_KAFKA if kind == "kafka" else RAW_ARCHIVE
    if corrupt and fmt == "json":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if _partitioned(path):
        schema = T.StructType(schema.fields + [T.StructField(PARTITION, T.StringType())])
    r = spark.read.format(fmt).schema(schema)
    if fmt == "json":
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    ds = _dates(dates)
    if ds is not None and _partitioned(path):
        # Hand the reader only the requested day folders: a root path would
        # make the file index list every file of every day first.
        have = day_folders(spark, path)
        paths = [f"{path.rstrip('/')}/{PARTITION}={d}" for d in sorted(set(ds)) if d in have]
        if not paths:
            return spark.createDataFrame([], schema).drop(PARTITION)
        df = r.option("basePath", path).load(paths)
    else:
        df = r.load(path)
    if ds is not None and PARTITION in df.columns:
        df = df.where(F.col(PARTITION).isin(*ds))
    return df.drop(PARTITION) if PARTITION in df.columns else df


def day_folders(spark: SparkSession, root: str | None) -> set[str]:
    """Days present under ``root`` (``dt=`` folder names)."""
    return partition_values(spark, root, PARTITION)


def _partitioned(path) -> bool:
    # Partition discovery adds ``dt`` for a folder root; explicit file lists
    # (SRC3) carry no partition column.
    return isinstance(path, str) and not path.endswith((".json", ".parquet", ".gz"))


def write_raw(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Land raw logs partitioned by day (used by tests and the streaming ingest)."""
    day = F.date_format(F.col("received_at").cast("timestamp"), "yyyy-MM-dd")
    # REBALANCE clusters rows by day (few files per day) while AQE splits a
    # skewed day over several tasks instead of one.
    out = df.withColumn(PARTITION, day).hint("rebalance", PARTITION)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION)
    if fmt == "json":
        w = w.option("timestampFormat", TS_FORMAT)
    w.format(fmt).save(path)


def source_of(spark: SparkSession, kafka_path: str | None, archive_path: str | None, day: str, source: str = "k") -> tuple[str, str]:
    """(kind, path) that a dump day is read from: the preferred source if it has the
    day's folder, else the other (SRC4)."""
    order = [("kafka", kafka_path), ("archive", archive_path)]
    for kind, root in order if source.lower() == "k" else order[::-1]:
        if root and day in day_folders(spark, root):
            return kind, root
    raise FileNotFoundError(f"no log folder for {day} under {kafka_path} or {archive_path}")


def land_checked(raw: DataFrame, kind: str, path: str, day: str) -> dict[str, int]:
    """Check one dump day's raw logs and land all of them in one pass:
    ``path/dt=<day>/reason=accepted`` holds the flat clean rows, ``reason=<check>`` the
    rejected records as text.  A repeated day replaces itself.  Returns the records
    written by reason, observed during the write."""
    seen = Observation("land_checked")
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in [ACCEPTED, *REASONS]]
    rows = landing_rows(raw, kind).observe(seen, F.count(F.lit(1)).alias("read"), *counts)
    out = rows.withColumn(PARTITION, F.lit(day)).hint("rebalance", "reason")
    _drop_folder(raw.sparkSession, f"{path.rstrip('/')}/{PARTITION}={day}")  # a reason may have no rows this time
    out.write.mode("append").partitionBy(PARTITION, "reason").parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def _drop_folder(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def read_landed(spark: SparkSession, path: str, dates: Iterable | None = None, reason: str | None = ACCEPTED) -> DataFrame:
    """Rows of ``land_checked``: the clean logs, the rejected records of one reason
    (dt, raw), or with None every rejected record (dt, reason, raw)."""
    schema = T.StructType([*LOGS.fields, T.StructField("raw", T.StringType()), T.StructField(PARTITION, T.StringType()), T.StructField("reason", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if dates is not None:
        df = df.where(F.col(PARTITION).isin(*_dates(dates)))
    if reason == ACCEPTED:
        return df.where(F.col("reason") == ACCEPTED).select(*LOGS.names)
    if reason is None:
        return df.where(F.col("reason") != ACCEPTED).select(PARTITION, "reason", "raw")
    return df.where(F.col("reason") == reason).select(PARTITION, "raw")


def read_logs(
    spark: SparkSession,
    kafka_path: str | None,
    archive_path: str | None,
    dates: Iterable | None = None,
    source: str = "k",
    files: list[str] | None = None,
    fmt: str = "json",
) -> DataFrame:
    """SRC4: clean logs from the preferred source, falling back to the other.

    ``k`` — Kafka dump first, then archive; ``h`` — archive first, then Kafka;
    ``f`` — the given files, read as Kafka-dump records.  With ``dates`` the
    choice is made per day, as the original did day by day: each day comes
    from the preferred source if its day folder exists there, else from the
    other; the days of each source are read in one scan and the two cleaned
    parts are unioned; days that neither source has raise an error that names them.
    Without ``dates`` a source whose path does not exist
    raises at analysis time and the other one is tried.
    """
    src = (source or "k").lower()
    if src == "f":
        if not files:
            raise ValueError("source 'f' needs a list of files")
        return clean_kafka(read_raw(spark, files, "kafka", fmt))
    if src not in ("k", "h"):
        raise ValueError(f"unknown log source {source!r}; use 'k', 'h' or 'f'")
    kafka = lambda ds=dates: clean_kafka(read_raw(spark, kafka_path, "kafka", fmt, ds))
    archive = lambda ds=dates: clean_archive(read_raw(spark, archive_path, "archive", fmt, ds))
    order = [(kafka, kafka_path), (archive, archive_path)]
    if src == "h":
        order.reverse()
    ds = _dates(dates)
    if ds is not None and all(p is None or _partitioned(p) for _, p in order):
        todo, parts = sorted(set(ds)), []
        for read, root in order:
            present = day_folders(spark, root)  # one listing per source
            here = [d for d in todo if d in present]
            if here:
                parts.append(read(here))
                todo = [d for d in todo if d not in here]
        if todo:
            raise FileNotFoundError(f"no log folder for {todo} under {kafka_path} or {archive_path}")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    order = [read for read, _ in order]
    last: Exception | None = None
    for attempt in order:
        try:
            df = attempt()
            df.schema  # resolve now so a missing path fails here
            return df
        except (AnalysisException, TypeError) as e:
            last = e
    raise last  # type: ignore[misc]
