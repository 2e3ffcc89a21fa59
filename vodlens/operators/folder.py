"""Folder reports: views, customers and watch time by folder (AG1, AG2, AG9).

Plan shape shared by the customer reports: filter finished views (LogId 52),
attach folders (broadcast lookup), attach Area/UType with ``by_customer``
(broadcast when the customer table is under the bound, else pre-aggregate per
customer and shuffle-join), then one aggregation to (Date, Area, UType, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import capped, exact, level, log_is, time_total
from .joins import by_customer, carried, with_folders

def one():
    """A count of 1 per row (bigint, so sums never overflow an int)."""
    return F.lit(1).cast("bigint")


def _finished_views(logs: DataFrame, *cols) -> DataFrame:
    return logs.where(log_is("52")).select("Date", "CustomerID", "ItemId", *carried(logs), *cols)


def folder_facts(logs: DataFrame, cus: DataFrame, listfolder: DataFrame, by_level: bool = False) -> DataFrame:
    """Rows of AG1 (AG2 with ``by_level``) before grouping: keys, CustomerID and the
    additive measures ``n`` and ``dur``."""
    cols = [exact(capped()).alias("dur")]
    if by_level:
        cols.append(level("RealTimePlaying", "ElapsedTimePlaying", "Duration").alias("Level"))
    v = with_folders(_finished_views(logs, *cols), listfolder)
    keys = ["Date", "CustomerID", *(["Level"] if by_level else []), "Folder"]
    return by_customer(v, cus, keys, {"n": one(), "dur": F.col("dur")})


def _views_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("TotalViews"),
        F.count_distinct("CustomerID").alias("TotalCustomers"),
        time_total("dur").alias("TotalDuration"),
    )


def vod_by_folder(logs: DataFrame, cus: DataFrame, listfolder: DataFrame) -> DataFrame:
    """AG1: Date, Area, UType, Folder → TotalViews, TotalCustomers, TotalDuration."""
    return _views_by(folder_facts(logs, cus, listfolder), "Date", "Area", "UType", "Folder")


def vod_by_folder_level(logs: DataFrame, cus: DataFrame, listfolder: DataFrame) -> DataFrame:
    """AG2: AG1 split by completion level."""
    return _views_by(folder_facts(logs, cus, listfolder, by_level=True), "Date", "Area", "UType", "Level", "Folder")


def session_facts(logs: DataFrame, cus: DataFrame, listfolder: DataFrame) -> DataFrame:
    """Rows of AG9 before grouping."""
    v = with_folders(_finished_views(logs, "Session"), listfolder)
    return by_customer(v, cus, ["Date", "CustomerID", "Folder", "Session"])


def sessions_by_location(logs: DataFrame, cus: DataFrame, listfolder: DataFrame) -> DataFrame:
    """AG9: Date, Area, UType, Folder → distinct sessions."""
    return session_facts(logs, cus, listfolder).groupBy("Date", "Area", "UType", "Folder").agg(
        F.count_distinct("Session").alias("TotalSession")
    )


def folder_rows(logs: DataFrame, listfolder: DataFrame) -> DataFrame:
    """JN2 on its own: finished views with their folder (NULL when unknown)."""
    v = _finished_views(logs, "Session", capped().alias("dur"))
    return with_folders(v, listfolder)
