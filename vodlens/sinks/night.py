"""One database commit for a night (SNK1, RUN1).

Every report of a dump day is written to a staging table by the executors; then a
single transaction moves all of them and records each in a manifest table keyed by
(DT, JOB).  A night is in the database whole or not at all, a repeated night finds its
jobs in the manifest and changes nothing, and of two nights that race for a day the
manifest's key lets only one commit.

Report tables hold the report's columns and ``DT``, the dump day; a late record's
rows have an earlier ``Date`` in a later ``DT``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .jdbc import DEFAULT_BATCH, _execute, _write

MANIFEST = "VODLENS_RUNS"


@dataclass(frozen=True)
class Database:
    """Where a run reads and writes SQL tables; ``properties`` are JDBC options
    (driver, user, password)."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    num_partitions: int | None = None  # most connections that one write opens

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, dbtable=name, **self.properties).load()

    def has(self, spark: SparkSession, name: str) -> bool:
        try:
            self.table(spark, name).schema  # resolved by the database
        except Exception as e:
            if any(x in str(e) for x in ("42X05", "42P01", "does not exist", "doesn't exist", "Invalid object name")):
                return False
            raise
        return True


def ensure_manifest(spark: SparkSession, db: Database) -> None:
    if not db.has(spark, MANIFEST):
        _execute(spark, db.url, db.properties, [
            f"CREATE TABLE {MANIFEST} (DT VARCHAR(10) NOT NULL, JOB VARCHAR(128) NOT NULL, N BIGINT NOT NULL, RUN_ID VARCHAR(36) NOT NULL, "
            f"PRIMARY KEY (DT, JOB))"])


def done(spark: SparkSession, db: Database, day: str) -> dict[str, int]:
    """Reports of a dump day that a committed night has written, with their rows."""
    ensure_manifest(spark, db)
    rows = db.table(spark, MANIFEST).where(F.col("DT") == day).select("JOB", "N").collect()  # one row per report
    return {r["JOB"]: r["N"] for r in rows}


class Night:
    """The reports of one dump day on their way into the database.

    ``stage`` each report, then ``commit``; ``discard`` drops what is staged.  With
    ``again`` a day that is in the database is replaced, in the same transaction."""

    def __init__(self, spark: SparkSession, db: Database, day: str, again: bool = False):
        self.spark, self.db, self.day, self.again = spark, db, day, again
        self.run = str(uuid.uuid4())
        self.known = done(spark, db, day)
        self.staged: dict[str, tuple[str, list[str], int]] = {}

    def stage(self, name: str, report: DataFrame) -> bool:
        """Write a report to its staging table; False if the day already has it."""
        if name in self.known and not self.again:
            return False
        table = f"{name}_STG_{uuid.uuid4().hex[:8]}".upper()
        seen = Observation("night_stage")
        rows = report.withColumn("DT", F.lit(self.day))
        out = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        if self.db.num_partitions:
            out = out.repartition(self.db.num_partitions)
        self.staged[name] = (table, rows.columns, 0)  # known before the write, so that discard finds a part of it
        props = {**self.db.properties, "createTableColumnTypes": "DT VARCHAR(10)"}  # a type that every database compares
        _write(out, self.db.url, table, "overwrite", props, DEFAULT_BATCH, self.db.num_partitions)
        self.staged[name] = (table, rows.columns, int(seen.get["n"]))
        _write(rows.limit(0), self.db.url, name, "append", props, DEFAULT_BATCH, None)  # the target, if it is missing
        return True

    def commit(self) -> dict[str, int]:
        """Move all staged reports in one transaction; rows by report."""
        quote = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.db.url).quoteIdentifier
        steps = []
        for name, (table, columns, n) in self.staged.items():
            cols = ", ".join(quote(c) for c in columns)
            if self.again and name in self.known:
                steps += [f"DELETE FROM {name} WHERE {quote('DT')} = '{self.day}'", f"DELETE FROM {MANIFEST} WHERE DT = '{self.day}' AND JOB = '{name}'"]
            steps += [f"INSERT INTO {name} ({cols}) SELECT {cols} FROM {table}",
                      f"INSERT INTO {MANIFEST} (DT, JOB, N, RUN_ID) VALUES ('{self.day}', '{name}', {n}, '{self.run}')"]
        try:
            if steps:
                _execute(self.spark, self.db.url, self.db.properties, steps)
            return {name: n for name, (_, _, n) in self.staged.items()}
        finally:
            self.discard()

    def discard(self) -> None:
        for table, _, _ in self.staged.values():
            _execute(self.spark, self.db.url, self.db.properties, [f"DROP TABLE {table}"], ignore_errors=True)
        self.staged = {}
