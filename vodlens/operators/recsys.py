"""Recommendation-shelf reports: impressions/clicks (AG12) and play conversion (AG13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import app_from_id, capped, exact, is_number, level, log_is, num, playing_time, position, submenu
from .joins import by_customer, carried

# Completion percentages are averaged as decimals of this many places.
PERCENT_DIGITS = 10


def recsys_impressions(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG12: Date, Area, UType, AppId (app name from id), SubMenuId, isHome →
    IMP (rows), CLK (clicks), POS (sum of position scores).

    Input rows: clicks (512), submenu views (57) with an ItemId, home
    impressions (20).  SubMenuId: root '0' → '1000' (not for 20), 20 → '1600',
    57 → the ItemId, else as logged; rows whose SubMenuId is 'undefined' drop.
    """
    is20, is57, is512 = log_is("20"), log_is("57"), log_is("512")
    rows = logs.where(is512 | (is57 & F.col("ItemId").isNotNull()) | is20)
    sub = (
        F.when(is_number("SubMenuId", 0) & ~is20, F.lit("1000"))
        .when(is20, F.lit("1600"))
        .when(is57, F.col("ItemId"))
        .otherwise(F.col("SubMenuId"))
    )
    home = F.coalesce(is_number("SubMenuId", 1600) & F.col("Screen").like("%Home%"), F.lit(False)) | is20
    pos_text = F.when(
        is512 & F.col("Position").isNotNull() & (F.col("Position") != "undefined"), F.col("Position")
    ).otherwise(F.lit("0"))
    events = rows.select(
        "Date",
        "CustomerID",
        *carried(logs),
        app_from_id().alias("AppId"),
        sub.alias("SubMenuId"),
        F.when(home, 1).otherwise(0).alias("isHome"),
        F.when(is512, 1).otherwise(0).cast("bigint").alias("clk"),
        position(pos_text).alias("pos"),
    ).where(F.col("SubMenuId") != "undefined")
    per_cus = by_customer(
        events,
        cus,
        ["Date", "CustomerID", "AppId", "SubMenuId", "isHome"],
        {"imp": F.lit(1).cast("bigint"), "clk": F.col("clk"), "pos": F.col("pos")},
    )
    return (
        per_cus
        .groupBy("Date", "Area", "UType", "AppId", "SubMenuId", "isHome")
        .agg(
            F.sum("imp").alias("IMP"),
            F.sum("clk").alias("CLK"),
            F.sum("pos").alias("POS"),
        )
    )


def recsys_conversion(logs: DataFrame, cus: DataFrame) -> DataFrame:
    """AG13: play conversion per (Date, Area, UType, AppId, Folder, isHome).

    Per event (LogId 51 manual play, 52 finished view): playing time and
    completion level; 52 uses the player position when positive, else capped
    watched time.  Per movie/chapter: MPLY = min(plays, finished views),
    average completion percent.  Per shelf: MPLY, APLY = views − MPLY,
    AVT = round(Σ playing time / Σ views), APR = round(mean of per-movie
    averages, 2), level counts; shelves without views (AVT NULL) are dropped.
    Times and percentages are added as decimals, so no rounding depends on the
    order of the rows.
    """
    is51, is52 = log_is("51"), log_is("52")
    elapsed = F.when(num("ElapsedTimePlaying") > 0, num("ElapsedTimePlaying")).otherwise(capped())
    zero = F.lit(0.0)
    r = F.when(is52, num("RealTimePlaying")).otherwise(zero)
    e = F.when(is52, elapsed).otherwise(zero)
    d = F.when(is52, num("Duration")).otherwise(zero)
    pt = playing_time(r, e, d)
    lv = level(r, e, d)
    home = F.coalesce(
        is_number("SubMenuId", 1600) & (F.col("Screen").like("%Home%") | F.col("MenuSession").isNull()),
        F.lit(False),
    )
    ev = logs.where(is51 | is52).select(
        "Date",
        "CustomerID",
        *carried(logs),
        F.col("AppName").alias("AppId"),
        submenu().alias("Folder"),
        F.when(home, 1).otherwise(0).alias("isHome"),
        F.col("ItemId").alias("MovieID"),
        "ChapterID",
        F.when(is51, 1).otherwise(0).alias("mply"),
        exact(pt).alias("pt"),
        exact(F.when(is52, F.try_divide(pt, d) * 100).otherwise(zero), PERCENT_DIGITS).alias("apr"),
        F.when(is52 & (lv <= 1), 1).otherwise(0).alias("q1"),
        F.when(is52 & (lv == 2), 1).otherwise(0).alias("mpt"),
        F.when(is52 & (lv == 3), 1).otherwise(0).alias("q3"),
        F.when(is52 & (lv == 4), 1).otherwise(0).alias("cmpl"),
    )
    movie_keys = ["AppId", "Folder", "isHome", "MovieID", "ChapterID"]
    counts = ["q1", "mpt", "q3", "cmpl"]
    measures = {
        "mply": F.col("mply").cast("bigint"),
        "pt": F.col("pt"),
        "apr_sum": F.col("apr"),
        "apr_n": F.when(F.col("apr").isNotNull(), 1).otherwise(0).cast("bigint"),
        **{c: F.col(c).cast("bigint") for c in counts},
    }
    per_cus = by_customer(ev, cus, ["Date", "CustomerID", *movie_keys], measures)
    per_movie = (
        per_cus
        .groupBy("Date", "Area", "UType", *movie_keys)
        .agg(
            F.sum("mply").alias("mply"),
            F.sum("pt").alias("pt"),
            exact(F.try_divide(F.sum("apr_sum"), F.sum("apr_n")), PERCENT_DIGITS).alias("apr"),
            *[F.sum(c).alias(c) for c in counts],
        )
        .withColumn("plays", F.col("q1") + F.col("mpt") + F.col("q3") + F.col("cmpl"))
        .withColumn("mply", F.least("mply", "plays"))
    )
    shelf = per_movie.groupBy("Date", "Area", "UType", "AppId", "Folder", "isHome").agg(
        F.sum("mply").alias("MPLY"),
        (F.sum("plays") - F.sum("mply")).alias("APLY"),
        F.round(F.try_divide(F.sum("pt").cast("double"), F.sum("plays")), 0).alias("AVT"),
        F.round(F.avg("apr"), 2).cast("double").alias("APR"),
        F.sum("q1").alias("Q1"),
        F.sum("mpt").alias("MPT"),
        F.sum("q3").alias("Q3"),
        F.sum("cmpl").alias("CMPL"),
    )
    return shelf.where(F.col("AVT").isNotNull())
