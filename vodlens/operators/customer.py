"""Per-customer reports without the customer dimension (AG8, AG11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MAIN_APPS, log_is


def customer_app_pivot(logs: DataFrame, apps: list[str] | None = None) -> DataFrame:
    """AG8: finished views per (Date, upper Contract, CustomerID), one column
    per app (upper-cased AppName), zero when absent.

    The pivot values are fixed, so the pivot is one conditional aggregation:
    a single shuffle, and customers whose views are all in other apps keep an
    all-zero row.
    """
    apps = apps or MAIN_APPS
    app = F.upper("AppName")
    return (
        logs.where(log_is("52"))
        .groupBy("Date", F.upper("Contract").alias("Contract"), "CustomerID")
        .agg(*[F.count_if(app == a).alias(a) for a in apps])
    )


def series_movies(logs: DataFrame) -> DataFrame:
    """AG11: per (Date, upper Contract, CustomerID), events whose folder list
    mentions 19 or 91 (series) and events that mention neither (movies).
    A NULL folder list counts for neither.  All log kinds count."""
    lof = F.col("ListOnFolder")
    series = lof.like("%19%") | lof.like("%91%")
    movies = ~lof.like("%19%") & ~lof.like("%91%")
    return logs.groupBy("Date", F.upper("Contract").alias("Contract"), "CustomerID").agg(
        F.sum(F.when(series, 1).otherwise(0)).alias("ViewSeries"),
        F.sum(F.when(movies, 1).otherwise(0)).alias("ViewMovies"),
    )
