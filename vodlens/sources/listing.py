"""Partition folder names from directory listings (metadata only).

Handing a reader the wanted ``col=value`` folders, instead of the table root,
keeps Spark's file index from listing every file of every other partition.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # what Spark's writers name a NULL


def partition_values(spark: SparkSession, root: str | None, column: str) -> set[str]:
    """Values ``v`` of the ``column=v`` folders directly under ``root`` (one
    listing of folder names, no file listing); empty if ``root`` is missing."""
    if not root:
        return set()
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return set()
    prefix = f"{column}="
    return {
        st.getPath().getName()[len(prefix):]
        for st in fs.listStatus(p)
        if st.isDirectory() and st.getPath().getName().startswith(prefix)
    }
