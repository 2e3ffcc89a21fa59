"""Logs and customers landed in matching buckets, so that a night's customer joins
need no shuffle (JN1).

Eleven reports join the same two tables.  ``land`` deals the clean logs once into
buckets by (customer key, salt), the customers likewise; every join after that reads
bucket by bucket.  The salt is 0 but for hot customers, those with more rows than a
bucket's fair share (at most as many as there are buckets, so the list of them may be
broadcast): their rows are dealt over enough salts by ``SALT_BY`` and their customer
row is repeated for each.  Logs without a customer key never join and are dealt over
all buckets.  Rows that agree in ``SALT_BY`` and customer share a salt, so groupings
by customer, session and menu session need no shuffle either.

The tables are external ones under the shared checkpoint folder; ``Landed.drop``
removes both.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import key
from ..operators.joins import KEY, SALT, customer_dim
from ..session import scratch_path

SALT_BY = ["Date", "AppName", "Session", "MenuSession"]
ROWS_PER_BUCKET = 4_000_000


@dataclass
class Landed:
    logs: DataFrame
    cus: DataFrame
    tables: dict[str, str]

    def drop(self) -> None:
        spark = self.logs.sparkSession
        sc = spark.sparkContext
        for name, path in self.tables.items():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, least: int = 8) -> int:
    """A power of two, so that tables landed for other sizes still line up."""
    n = least
    while n * rows_per_bucket < rows:
        n *= 2
    return n


def hot_customers(logs: DataFrame, buckets: int, rows: int) -> DataFrame:
    """(key, salts) of customers with over 1/``buckets`` of the ``rows``: fewer than
    ``buckets`` rows, whatever the input."""
    fair = max(1.0, rows / buckets)
    counts = logs.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fair)
    return counts.select(F.col(KEY).alias("hot_key"), F.least(F.ceil(F.col("n") / fair), F.lit(buckets)).cast("int").alias("salts"))


def _save(df: DataFrame, name: str, path: str, buckets: int, cols: tuple[str, str]) -> DataFrame:
    # the same hash as the buckets': each task writes one bucket
    df.repartition(buckets, *cols).write.format("parquet").option("path", path).bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(name)
    return df.sparkSession.table(name)


def land(logs: DataFrame, cus: DataFrame, buckets: int | None = None) -> Landed:
    spark: SparkSession = logs.sparkSession
    keyed = logs.withColumn(KEY, key("CustomerID"))
    rows = logs.count()
    buckets = buckets or buckets_for(rows)
    hot = hot_customers(keyed.select(KEY), buckets, rows).checkpoint()
    slot = F.xxhash64(*SALT_BY)
    salt = F.when(F.col(KEY).isNull(), F.pmod(slot, F.lit(buckets))).otherwise(F.pmod(slot, F.coalesce("salts", F.lit(1)).cast("bigint")))
    salted = keyed.join(F.broadcast(hot), F.col(KEY) == F.col("hot_key"), "left").withColumn(SALT, salt.cast("int")).drop("hot_key", "salts")
    dim = customer_dim(cus).join(F.broadcast(hot), F.col("ID") == F.col("hot_key"), "left")
    dim = dim.select("ID", "Area", "UType", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias(SALT))
    tag = uuid.uuid4().hex[:12]
    names = {t: f"vodlens_{t}_{tag}" for t in ("logs", "customers")}
    paths = {names[t]: scratch_path(spark, t) for t in names}
    return Landed(
        _save(salted, names["logs"], paths[names["logs"]], buckets, (KEY, SALT)),
        _save(dim, names["customers"], paths[names["customers"]], buckets, ("ID", SALT)), paths)
