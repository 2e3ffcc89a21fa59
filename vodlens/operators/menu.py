"""Main-menu and menu reports (AG6, AG7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import capped, exact, log_is, main_menu_folder, time_total
from .distincts import flagged_counts
from .joins import by_customer, with_folders, with_menus


def main_menu_facts(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """Rows of AG6 before grouping."""
    return by_customer(
        logs.where(log_is("52")).withColumn("Folder", main_menu_folder()),
        cus,
        ["Date", "CustomerID", "Folder", "Session"],
        {"n": F.lit(1).cast("bigint"), "dur": exact(capped())},
    )


def vod_by_main_menu(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG6: Date, Area, Folder (app: VOD 2, RELAX 3, CHILD 4, else NULL) →
    views, distinct customers, distinct sessions, capped duration."""
    return flagged_counts(
        main_menu_facts(logs, cus),
        ["Date", "Area", "Folder"],
        {"TotalCustomers": "CustomerID", "TotalSession": "Session"},
        ["n", "dur"],
        [F.sum("n").alias("TotalViews"), time_total("dur").alias("TotalDuration")],
    )


def menu_facts(logs: DataFrame, listfolder: DataFrame, fol: DataFrame) -> DataFrame:
    """Rows of AG7 before grouping."""
    v = logs.where(log_is("52")).select("Date", "CustomerID", "ItemId")
    return with_menus(with_folders(v, listfolder), fol)


def vod_by_menu(logs: DataFrame, listfolder: DataFrame, fol: DataFrame) -> DataFrame:
    """AG7: Date, MenuID → distinct customers (folder LEFT join, then the menu
    inner join drops views without a folder).  No customer join."""
    return (
        menu_facts(logs, listfolder, fol)
        .groupBy("Date", "MenuID")
        .agg(F.count_distinct("CustomerID").alias("TotalCustomer"))
    )
