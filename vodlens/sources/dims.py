"""Dimension sources: menu → folder, movie → folder, customer snapshot.

Each builder takes DataFrames (from JDBC, Parquet or the test mapping) so the
same lookup logic serves every backend.  ``jdbc_table`` reads a SQL table in
parallel when a numeric partition column is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The menus whose folders are reported.
REPORT_MENU_IDS = [3, 4, 5, 6, 7, 8, 15]


def menu_folders(menu_detail: DataFrame, menu_ids: list[int] | None = None) -> DataFrame:
    """SRC5: (MenuID, FolderID) of the reported menus; the filter is pushed to
    the source (Parquet row groups, or the JDBC WHERE clause)."""
    ids = menu_ids or REPORT_MENU_IDS
    return menu_detail.where(F.col("MenuID").isin(*ids)).select(
        F.col("MenuID").cast("int").alias("MenuID"), F.col("FolderID").cast("int").alias("FolderID")
    )


def list_folders(movies: DataFrame, series: DataFrame) -> DataFrame:
    """SRC6: DISTINCT (ID, Folder) of each catalogue, UNION ALL of the two
    (a movie listed in both keeps both rows)."""

    def pick(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("ID").cast("bigint").alias("MovieID"), F.col("Folder").cast("int").alias("Folder")
        ).distinct()

    return pick(movies).unionAll(pick(series))


def customer_snapshot(customers: DataFrame, snapshot_date=None, date_col: str | None = None) -> DataFrame:
    """SRC7: (ID, Area, UType) for one snapshot date (all rows when the source
    has no snapshot column)."""
    df = customers
    if snapshot_date is not None and date_col:
        df = df.where(F.col(date_col) == F.lit(snapshot_date).cast("date"))
    return df.select(
        F.col("ID").cast("bigint").alias("ID"), F.col("Area"), F.col("UType").cast("string")
    )


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """SRC8: read a SQL table or query.  With a partition column the read is
    split into ``num_partitions`` range queries run by executors in parallel."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition_column:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return r.load()


def key_bounds(keys: DataFrame, column: str, parts: int) -> list[int]:
    """Inner bounds that cut the keys into at most ``parts`` ranges of like counts.

    Quantiles of the counted keys: a key that fills several ranges is one bound, so a
    hot key has a range of its own and the keys beside it are still cut evenly."""
    at = [k / parts for k in range(1, parts)]
    found = keys.where(F.col(column).isNotNull()).approxQuantile(column, at, 0.1 / parts)
    return sorted({int(x) for x in found} | {int(x) + 1 for i, x in enumerate(found) if i and x == found[i - 1]})


def jdbc_measured(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    num_partitions: int = 8,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """SRC8 with measured ranges: the integer key column alone is read first, in equal
    steps between its least and greatest value, and its quantiles become the ranges of
    the parallel read.  Equal steps, as ``jdbc_table`` takes them, put nearly all rows
    of a skewed key into one range.  Rows with a NULL key are read by the first one."""
    props = properties or {}
    bounds = jdbc_table(spark, url, query=f"SELECT MIN({partition_column}) AS LO, MAX({partition_column}) AS HI FROM {table}", properties=props).first()
    if bounds["LO"] is None or bounds["LO"] == bounds["HI"]:
        return jdbc_table(spark, url, table, properties=props)
    keys = jdbc_table(spark, url, f"(SELECT {partition_column} FROM {table}) K", properties=props, partition_column=partition_column,
                      lower_bound=int(bounds["LO"]), upper_bound=int(bounds["HI"]) + 1, num_partitions=num_partitions)
    cuts = key_bounds(keys, keys.columns[0], num_partitions)
    if not cuts:
        return jdbc_table(spark, url, table, properties=props)
    c = partition_column
    ranges = [f"{c} < {cuts[0]} OR {c} IS NULL", *(f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])), f"{c} >= {cuts[-1]}"]
    return spark.read.jdbc(url, table, predicates=ranges, properties=props)
