"""JDBC sinks (SNK1-SNK3, SNK7).

Rows go from executors straight to the database (``df.write.jdbc``); nothing
is collected on the driver.  Errors raise instead of being printed.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows per JDBC batch (the original loader inserted 100,000 rows at a time).
DEFAULT_BATCH = 100_000


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batchsize: int = DEFAULT_BATCH,
    atomic: bool = False,
    columns: list[str] | None = None,
    num_partitions: int | None = None,
) -> int:
    """Append ``df`` to ``table``; columns are matched by name (SNK1/SNK3).

    JDBC commits once per task.  ``atomic=True`` therefore lands the rows in a
    staging table first — executors write it in parallel — and then moves
    them with one ``INSERT … SELECT`` inside a single database transaction:
    all rows or none, and no task or driver ever holds the whole result.
    ``num_partitions`` bounds the number of concurrent connections with a
    round-robin repartition, so the stage that computes ``df`` keeps its
    parallelism.  Returns the number of rows written (SNK2), observed during
    the write itself — no second pass over the data.
    """
    props = dict(properties or {})
    seen = Observation("jdbc_append")
    rows = df.select(*columns) if columns else df
    out = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if num_partitions:
        out = out.repartition(num_partitions)
    if not atomic:
        _write(out, url, table, "append", props, batchsize, num_partitions)
        return int(seen.get["rows"])
    stage = f"{table}_STG_{uuid.uuid4().hex[:10].upper()}"
    try:
        _write(out, url, stage, "overwrite", props, batchsize, num_partitions)
        # Creates the target as a plain append would, if it is missing
        # (``limit(0)`` is an empty relation: nothing is computed).
        _write(rows.limit(0), url, table, "append", props, batchsize, None)
        _move_rows(df.sparkSession, url, props, stage, table, out.columns)
    finally:
        _execute(df.sparkSession, url, props, [f"DROP TABLE {stage}"], ignore_errors=True)
    return int(seen.get["rows"])


def _write(out: DataFrame, url, table, mode, props, batchsize, num_partitions) -> None:
    w = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    w = w.option("batchsize", str(batchsize))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def _move_rows(spark: SparkSession, url, props, stage: str, table: str, cols: list[str]) -> None:
    """``INSERT INTO table (cols) SELECT cols FROM stage`` in one transaction."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    names = ", ".join(dialect.quoteIdentifier(c) for c in cols)
    _execute(spark, url, props, [f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}"])


def _execute(spark: SparkSession, url, props, statements: list[str], ignore_errors: bool = False) -> None:
    """Run statements in the database through one driver-side connection and
    one transaction (the statements move rows inside the database; none pass
    through Spark's driver)."""
    jvm = spark._jvm
    conn = None
    try:
        if "driver" in props:
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            jvm.java.lang.Class.forName(props["driver"], True, loader)
        jp = jvm.java.util.Properties()
        for k, v in props.items():
            if k in ("user", "password"):
                jp.setProperty(k, v)
        conn = jvm.java.sql.DriverManager.getConnection(url, jp)
        conn.setAutoCommit(False)
        st = conn.createStatement()
        try:
            for sql in statements:
                st.executeUpdate(sql)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            st.close()
    except Exception:
        if not ignore_errors:
            raise
    finally:
        if conn is not None:
            conn.close()


def append_if_rows(df: DataFrame, url: str, table: str, **kw) -> bool:
    """SNK7: skip the write (and the connection) when there is nothing to load.

    The result is persisted while it is tested and written, so the report is
    computed once (a lost executor's blocks are recomputed from lineage).
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if kept.isEmpty():
            return False
        append_jdbc(kept, url, table, **kw)
        return True
    finally:
        kept.unpersist()
