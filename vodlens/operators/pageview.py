"""Page views and unique page views by submenu and movie (AG10, CLN7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import capped, exact, log_is, submenu, time_total
from .distincts import flagged_counts
from .joins import by_customer

# Placeholder submenu ids that are rejected.
SUBMENU_PLACEHOLDERS = ["undefined", "null", ""]
# Submenus of the "leaving soon" shelf.
LEAVING_SOON_SUBMENUS = ["48", "49", "50"]


def valid_submenu(c: str = "SubMenuId"):
    return F.col(c).isNotNull() & ~F.col(c).isin(*SUBMENU_PLACEHOLDERS)


def pageview_facts(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """Rows of AG10 before grouping; ``Viewer`` and ``Visit`` are the customer and
    session of rows that hold finished views, else NULL."""
    is_view = log_is("52")
    rows = by_customer(
        logs.where(log_is("52", "512") & valid_submenu()).withColumn("SubMenuId", submenu()),
        cus,
        ["Date", "CustomerID", "SubMenuId", "ItemId", "Session"],
        {
            "pv": F.when(log_is("512"), 1).otherwise(0).cast("bigint"),
            "views": F.when(is_view, 1).otherwise(0).cast("bigint"),
            "dur": F.when(is_view, exact(capped())).otherwise(exact(F.lit(0))),
        },
    )
    seen = F.col("views") > 0
    return rows.withColumns({"Viewer": F.when(seen, F.col("CustomerID")), "Visit": F.when(seen, F.col("Session"))})


def unique_pageview(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG10: Date, Area, UType, SubMenuId ('0' → '1000'), ItemId →
    PV (clicks, LogId 512), TotalViews (LogId 52), distinct customers and
    sessions among finished views, capped duration of finished views."""
    return flagged_counts(
        pageview_facts(logs, cus),
        ["Date", "Area", "UType", "SubMenuId", "ItemId"],
        {"TotalCustomers": "Viewer", "UniquePV": "Visit"},
        ["pv", "views", "dur"],
        [F.sum("pv").alias("PV"), F.sum("views").alias("TotalViews"), time_total("dur").alias("TotalDuration")],
    )


def leaving_soon_pageview(pageviews: DataFrame) -> DataFrame:
    """CLN7: the rows of AG10 for the leaving-soon submenus (the filter is on a
    grouping column, so Catalyst moves it below the aggregation)."""
    return pageviews.where(F.col("SubMenuId").isin(*LEAVING_SOON_SUBMENUS))
