"""Topic-lane detail rows (AG15) and the session funnel over them (AG16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import exact, log_is, num, time_total

# Log kinds kept in the topic-lane extract.
TOPIC_LANE_LOG_IDS = ["512", "51", "55", "56", "52"]
LANE = ["Screen", "SubMenuId", "Folder"]


def topic_lane_rows(logs: DataFrame) -> DataFrame:
    """AG15: detail rows with a playing session (no aggregation)."""
    return logs.where(F.col("PlayingSession").isNotNull() & log_is(*TOPIC_LANE_LOG_IDS)).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date"),
        "Screen",
        "SubMenuId",
        "CustomerID",
        "Contract",
        "ItemId",
        F.upper("AppName").alias("AppId"),
        "PlayingSession",
        "LogId",
        "Folder",
        "RealTimePlaying",
    )


def topic_lane_funnel(logs: DataFrame) -> DataFrame:
    """AG16: clicks (512) give the (screen, submenu, folder) of a playing
    session; finished views (52) of the same session and day are summed into
    it (views without a click land in the NULL lane, lanes without views keep
    NULL sums).

    One scan and no join: clicks and views are added up together by session with
    the lane (clicks) or the customer (views), so a busy session is reduced
    map-side; a window over its few remaining rows then hands the sums of the
    views to each lane.  Rows without a day meet no lane.
    """
    click = F.col("click")
    sums = (
        logs.where(F.col("PlayingSession").isNotNull() & log_is("512", "52"))
        .withColumn("click", log_is("512"))
        .groupBy(
            "Date", "PlayingSession", "click",
            *[F.when(click, F.col(c)).alias(c) for c in LANE],
            F.when(~click, F.col("CustomerID")).alias("CustomerID"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum(exact(F.when(~click, num("RealTimePlaying")))).alias("secs"))
        .withColumn("seen", F.when(~click, F.col("n")))
        .withColumn("people", F.when(~click, F.col("CustomerID").isNotNull().cast("bigint")))
    )
    session = Window.partitionBy("Date", "PlayingSession")
    dated = F.col("Date").isNotNull()
    values = ["seen", "people", "secs"]
    rows = sums.withColumn("has_lane", F.bool_or(click).over(session) & dated).withColumns(
        {f"all_{c}": F.when(dated, F.sum(c).over(session)) for c in values}
    )
    # a session's lanes take its sums; views of a session without a lane stay as they are
    return (
        rows.where(click | ~F.col("has_lane"))
        .groupBy("Date", *LANE)
        .agg(
            F.sum(F.when(click, F.col("all_seen")).otherwise(F.col("seen"))).alias("TotalView"),
            F.sum(F.when(click, F.col("all_people")).otherwise(F.col("people"))).alias("TotalCustomer"),
            time_total(F.when(click, F.col("all_secs")).otherwise(F.col("secs"))).alias("TotalDuration"),
            F.count_if(click).alias("TotalSess"),
        )
    )
