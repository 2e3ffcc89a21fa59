"""Submenu access / miss counts (AG14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import log_is, submenu
from .joins import by_customer, carried

TUPLE = ["Date", "AppId", "CustomerID", "Session", "SessionSubMenu", "SubMenuId"]


def submenu_behaviours(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG14: Date, Area, UType, AppId, SubMenuId → Access, Miss, Session.

    An access is a distinct (Date, app, customer, session, menu session,
    submenu) tuple of submenu views (57); it is a hit when the same tuple has a
    click (512), compared with plain equality, so a tuple with a NULL part
    never hits.  Access counts accessed tuples with a menu session, Miss =
    Access − Hit, Session counts distinct sessions of all accessed tuples.

    Instead of de-duplicating views and clicks separately and joining them,
    both kinds of rows are grouped once by the tuple with a flag per kind —
    one shuffle, with map-side partial aggregation for hot tuples.
    """
    rows = logs.where(
        log_is("512", "57")
        & F.col("SubMenuId").isNotNull()
        & ~F.col("SubMenuId").isin("", "undefined", "null")
    ).select(
        "Date",
        F.col("AppName").alias("AppId"),
        "CustomerID",
        "Session",
        F.col("MenuSession").alias("SessionSubMenu"),
        submenu().alias("SubMenuId"),
        "LogId",
        *carried(logs),
    )
    # bucket columns follow from customer, day, app and sessions: the same groups
    tuples = rows.groupBy(*TUPLE, *carried(logs)).agg(
        F.bool_or(log_is("57")).alias("viewed"), F.bool_or(log_is("512")).alias("clicked")
    )
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in TUPLE])
    accessed = tuples.where("viewed")
    per_cus = by_customer(
        accessed,
        cus,
        ["Date", "AppId", "CustomerID", "SubMenuId", "Session"],
        {
            "access": F.when(F.col("SessionSubMenu").isNotNull(), 1).otherwise(0).cast("bigint"),
            "hit": F.when(F.col("clicked") & complete, 1).otherwise(0).cast("bigint"),
        },
    )
    return (
        per_cus
        .groupBy("Date", "Area", "UType", "AppId", "SubMenuId")
        .agg(
            F.sum("access").alias("Access"),
            (F.sum("access") - F.sum("hit")).alias("Miss"),
            F.count_distinct("Session").alias("Session"),
        )
    )
