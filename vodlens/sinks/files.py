"""File sinks: named JSON results (SNK6), Parquet/ORC report tables, XML payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_result(df: DataFrame, path: str) -> None:
    """SNK6: a small named result as one UTF-8 JSON-lines file (non-ASCII kept).

    Only for results bounded by construction (per-device grids, top lists);
    large reports go to ``write_table``.  ``repartition(1)`` (not ``coalesce``)
    so only the file writer is single; the stage computing ``df`` stays
    parallel.
    """
    df.repartition(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write a report table; with ``partition_by=['Date']`` and dynamic partition
    overwrite a re-run replaces its own days instead of appending duplicates."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def xml_rows(df: DataFrame, tag: str = "T", attrs: list[str] | None = None) -> DataFrame:
    """SNK5: one ``<T a="..." .../>`` element per row (values escaped)."""
    from ..sources.vouchers import xml_escape

    names = attrs or df.columns
    parts = [F.lit(f"<{tag}")]
    for a in names:
        parts += [F.lit(f' {a}="'), xml_escape(F.coalesce(F.col(a).cast("string"), F.lit(""))), F.lit('"')]
    parts.append(F.lit("/>"))
    return df.withColumn("xml", F.concat(*parts))
