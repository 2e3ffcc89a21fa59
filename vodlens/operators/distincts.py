"""Several exact distinct counts in one aggregation, without Expand.

Spark answers two ``count(distinct …)`` of one grouping by Expand: every input row is
copied once per distinct column before anything is combined.  Here the rows are first
added up per (group, ids) — map-side, so repeated views of a customer in a session
cost nothing after the scan — and of the rows left that hold an id in a group exactly
one is flagged; the flags add up to the distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flagged_counts(rows: DataFrame, keys: list[str], ids: dict[str, str], sums: list[str], measures: list[Column]) -> DataFrame:
    """``rows`` by ``keys``: the distinct non-NULL values of each column of ``ids``
    (output → column) and ``measures``, aggregates over the columns ``sums``, which
    are added up before."""
    columns = list(dict.fromkeys(ids.values()))
    out = rows.groupBy(*keys, *columns).agg(*[F.sum(c).alias(c) for c in sums])
    for c in columns:
        others = [o for o in columns if o != c]
        # NULL ids are in no count: they are spread by the other ids instead of meeting in one task
        spread = [F.when(F.col(c).isNull(), F.col(o)) for o in others]
        first = F.row_number().over(Window.partitionBy(*keys, c, *spread).orderBy(*others or [c])) == 1
        out = out.withColumn(f"_first_{c}", F.when(first & F.col(c).isNotNull(), 1).otherwise(0).cast("bigint"))
    return out.groupBy(*keys).agg(*measures, *[F.sum(f"_first_{c}").alias(o) for o, c in ids.items()])
