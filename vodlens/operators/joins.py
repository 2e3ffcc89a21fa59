"""Dimension joins with a checked broadcast.

A dimension is broadcast only after one aggregation pass has measured it: its
row count and the bytes of its text columns (``octet_length``), turned into
an upper bound of its in-memory size; both must be under the bounds
(``vodlens.broadcast.maxRows``, ``vodlens.broadcast.maxBytes``).  The pass is
a plain aggregation — every task sums its own rows and only one row per task
crosses the shuffle (``limit(n).count()`` would instead funnel up to n rows of
every partition through one task).  Above the bounds the join is a shuffle
join: AQE may still turn it into a broadcast from measured sizes, and its
skew-join splitting handles a hot key on the fact side.  ``by_customer``
aggregates per customer *before* a shuffle join, so a hot customer is already
collapsed by map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import key

# Default bounds for a broadcast dimension.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
CONF_KEY = "vodlens.broadcast.maxRows"
CONF_BYTES = "vodlens.broadcast.maxBytes"
# Per-row overhead and per-value width assumed for non-text columns (bytes);
# generous for an UnsafeRow of a few fixed-width fields.
ROW_OVERHEAD = 32
FIXED_WIDTH = 8
# Optional column of a customer table holding one snapshot per day.
SNAPSHOT_COL = "SnapshotDate"


# Columns of logs and customers landed in matching buckets (sources.bucketed).
KEY, SALT = "_ck", "_salt"


def carried(df: DataFrame) -> list[str]:
    """The bucket columns, where ``df`` still has both; a projection that keeps them
    keeps the later customer join free of a shuffle."""
    return [KEY, SALT] if {KEY, SALT} <= set(df.columns) else []


def max_broadcast_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(CONF_KEY, None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_ROWS


def max_broadcast_bytes(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(CONF_BYTES, None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_BYTES


def measure(dim: DataFrame) -> tuple[int, int]:
    """(rows, upper bound of bytes) of ``dim`` in one aggregation pass."""
    text = [f.name for f in dim.schema.fields if f.dataType.typeName() in ("string", "binary")]
    other = len(dim.schema.fields) - len(text)
    text_bytes = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in text), F.lit(0))
    r = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes.cast("bigint")).alias("b")).collect()[0]
    rows, tb = int(r["n"]), int(r["b"] or 0)
    return rows, rows * (ROW_OVERHEAD + FIXED_WIDTH * other + 8 * len(text)) + tb


def fits_broadcast(dim: DataFrame, max_rows: int | None = None) -> bool:
    bound = max_rows if max_rows is not None else max_broadcast_rows(dim)
    rows, size = measure(dim)  # at every join: a table may have grown since the last
    return rows <= bound and size <= max_broadcast_bytes(dim)


def sized_broadcast(dim: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(dim)`` when its row count is under the bound, else ``dim``."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: Column | list[str] | str,
    how: str = "inner",
    max_rows: int | None = None,
) -> DataFrame:
    return fact.join(sized_broadcast(dim, max_rows), on, how)


def with_customers(df: DataFrame, cus: DataFrame, customer_col: str = "CustomerID") -> DataFrame:
    """Inner join on the customer id (text in logs, bigint in ``cus``) (JN1).

    The log id is converted once to a bigint key so ``'007'`` matches 7, as the
    original comparison of text with a number did.
    """
    if carried(df) and SALT in cus.columns:
        c = cus.select("ID", "Area", "UType", F.col(SALT).alias("_cus_salt"))
        return df.join(c, (F.col(KEY) == F.col("ID")) & (F.col(SALT) == F.col("_cus_salt"))).drop("ID", "_cus_salt", KEY, SALT)
    f = df.drop(KEY, SALT).withColumn("_ck", key(customer_col))
    c = customer_dim(cus)
    cond = F.col("_ck") == F.col("ID")
    if "_snap" in c.columns and "Date" in df.columns:
        # Dated snapshots (backfills): each day joins its own snapshot.
        cond = cond & (F.col("Date") == F.col("_snap"))
    return join_dim(f, c, cond).drop("_ck", "ID", "_snap")


def customer_dim(cus: DataFrame) -> DataFrame:
    """The projection of the customer table that is joined (and size-checked)."""
    cols = ["ID", "Area", "UType"]
    if SALT in cus.columns:  # a landed table repeats hot customers
        cus = cus.where(F.col(SALT) == 0)
    if SNAPSHOT_COL in cus.columns:
        return cus.select(*cols, F.col(SNAPSHOT_COL).cast("date").alias("_snap"))
    return cus.select(*cols)


def by_customer(
    facts: DataFrame,
    cus: DataFrame,
    keys: list[str],
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Attach Area/UType to fact rows, choosing the plan by dimension size (tables
    landed in matching buckets join bucket by bucket, whatever their size).

    ``keys`` must contain ``CustomerID``; ``measures`` are additive columns
    (counts as 0/1, sums) that the caller re-aggregates with ``sum``.

    * ``cus`` under the broadcast bound: project the measures per row and join
      the broadcast dimension map-side; no extra shuffle, and the caller's
      aggregation combines partial results before its shuffle.
    * ``cus`` too large: sum the measures per key first — map-side partial
      aggregation collapses a hot customer to one row per task — and
      shuffle-join that much smaller frame.
    """
    measures = measures or {}
    rows = facts.select(*keys, *carried(facts), *[m.alias(n) for n, m in measures.items()])
    if carried(facts) and SALT in cus.columns:
        return with_customers(rows, cus)
    rows = rows.drop(KEY, SALT)
    if fits_broadcast(customer_dim(cus)):
        return with_customers(rows, cus)
    if measures:
        pre = rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])
    else:
        pre = rows.distinct()
    return with_customers(pre, cus)


# Groups that rows without a key are spread over in a shuffle.
NULL_SPREAD = 1024


def with_folders(df: DataFrame, listfolder: DataFrame, item_col: str = "ItemId") -> DataFrame:
    """LEFT join of the movie → folder lookup (JN2): a missing folder stays NULL,
    a movie in several folders yields one row per folder.

    Ids that are no number have no key and never match, but a shuffle would send all of
    them to one task.  So the key of a large lookup's join has a second part: 0 where
    there is a movie key, else a number from 1 on by the row's values, which no lookup
    row has.  A hot movie is left to AQE's skew split."""
    lf = listfolder.select("MovieID", "Folder")
    f = df.withColumn("_ik", key(item_col))
    if fits_broadcast(lf):
        return f.join(F.broadcast(lf), F.col("_ik") == F.col("MovieID"), "left").drop("_ik", "MovieID")
    spread = F.when(F.col("_ik").isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SPREAD)) + 1).otherwise(F.lit(0))
    # 0 on every row, but no literal: the optimizer would take a literal out of the join's keys
    held = lf.withColumn("_held", F.pmod("MovieID", F.lit(1).cast("bigint")))
    on = (F.col("_ik") == F.col("MovieID")) & (F.col("_spread") == F.col("_held"))
    return f.withColumn("_spread", spread.cast("bigint")).join(held, on, "left").drop("_ik", "MovieID", "_spread", "_held")


def with_menus(df: DataFrame, fol: DataFrame, folder_col: str = "Folder") -> DataFrame:
    """Folder → menu inner join (JN3); NULL folders drop out."""
    m = fol.select("MenuID", "FolderID")
    return join_dim(df, m, F.col(folder_col) == F.col("FolderID")).drop("FolderID")
