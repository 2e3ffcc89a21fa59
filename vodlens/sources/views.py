"""Per-device view logs stored as ORC (SRC9).

Layout: ``<root>/device=<name>/day=<yyyy-MM-dd>/*.orc``.  One ``read.orc``
over the wanted device/day folders (named by folder listings, so other days'
files are never listed); the device and day filters stay in the plan
(``PartitionFilters``).  The older layout of
plain day folders is read from a path list, with device and day taken from
each file's path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import VIEWS
from .listing import partition_values

DATA_COLUMNS = [f for f in VIEWS.fields if f.name not in ("device", "day")]


def write_views(df: DataFrame, root: str) -> None:
    """Write device=/day= folders; REBALANCE keeps few files per folder and
    lets AQE split a heavy device-day over several tasks."""
    df.hint("rebalance", "device", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("device", "day").orc(root)


def read_views(
    spark: SparkSession,
    root: str,
    devices: Iterable[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The views of a device=/day= tree, their columns in the type of the files (a
    duration may be a decimal, a bigint or a double); one footer tells the types."""
    if devices is None and start is None and end is None:
        df = spark.read.orc(root)
    else:
        # Only the wanted device=/day= folders reach the file index.
        base = root.rstrip("/")
        wanted = partition_values(spark, base, "device")
        if devices is not None:
            wanted &= set(devices)
        paths = [
            f"{base}/device={dev}/day={d}"
            for dev in sorted(wanted)
            for d in sorted(partition_values(spark, f"{base}/device={dev}", "day"))
            if (start is None or d >= start) and (end is None or d <= end)
        ]
        if not paths:  # same columns, in the order a partitioned read gives
            return spark.createDataFrame([], VIEWS).select(*[c.name for c in DATA_COLUMNS], "device", "day")
        df = spark.read.option("basePath", base).orc(paths)
    df = df.select(*[c.name for c in DATA_COLUMNS], F.col("device").cast("string").alias("device"), F.col("day").cast("date").alias("day"))
    if devices is not None:
        df = df.where(F.col("device").isin(*list(devices)))
    if start is not None:
        df = df.where(F.col("day") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("day") <= F.lit(end).cast("date"))
    return df


def read_day_folders(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """Legacy layout: ``paths`` of plain day folders; ``pattern`` is a regex with
    two groups, device and ``yyyy-MM-dd`` day, matched against each file path."""
    from pyspark.sql import types as T

    schema = T.StructType(DATA_COLUMNS)
    df = spark.read.schema(schema).orc(paths)
    fp = F.col("_metadata.file_path")
    return df.select(
        F.regexp_extract(fp, pattern, 1).alias("device"),
        F.regexp_extract(fp, pattern, 2).cast("date").alias("day"),
        *[c.name for c in DATA_COLUMNS],
    )
