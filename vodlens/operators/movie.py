"""Movie and location reports (AG3, AG4, AG5) over finished views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import capped, exact, log_is, time_total
from .joins import by_customer

def one():
    """A count of 1 per row (bigint, so sums never overflow an int)."""
    return F.lit(1).cast("bigint")


def view_facts(logs: DataFrame, cus: DataFrame, *keys: str, measured: bool = False) -> DataFrame:
    """Rows of AG3-AG5 before grouping: finished views with customer and ``keys``,
    with ``measured`` also the additive measures ``n`` and ``dur``."""
    measures = {"n": one(), "dur": exact(capped())} if measured else None
    return by_customer(logs.where(log_is("52")), cus, ["Date", "CustomerID", *keys], measures)


def vod_by_movie_chapter(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG3: Date, UType, ItemId, ChapterID → views, customers, capped duration."""
    rows = view_facts(logs, cus, "ItemId", "ChapterID", measured=True)
    return rows.groupBy("Date", "UType", "ItemId", "ChapterID").agg(
        F.sum("n").alias("TotalViews"),
        F.count_distinct("CustomerID").alias("TotalCustomers"),
        time_total("dur").alias("TotalDuration"),
    )


def vod_by_movie(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG4: Date, UType, ItemId → distinct customers."""
    return view_facts(logs, cus, "ItemId").groupBy("Date", "UType", "ItemId").agg(
        F.count_distinct("CustomerID").alias("TotalCustomers")
    )


def customers_by_location(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG5: Date, Area, UType → distinct customers."""
    return view_facts(logs, cus).groupBy("Date", "Area", "UType").agg(
        F.count_distinct("CustomerID").alias("TotalCustomers")
    )
