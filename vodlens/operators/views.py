"""Per-device view-log reports of the series notebook (AG17-AG23, TOP1, CLN6).

One scan of the view log, one filter, then a handful of ``groupBy``s —
instead of one Spark job per device, day and hour.  Dense outputs (every
device × day, every hour) come from a generated calendar grid joined to the
counts, never from a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fmt import day_label, fmt_unit, hour_label
from ..schema import DEVICES
from ..sources.listing import NULL_FOLDER, partition_values
from .joins import sized_broadcast

# Fixed value: the series application whose views are analysed.
SERIES_APP = "phim bộ"
HOURS = list(range(24))


def series_views(views: DataFrame, app: str = SERIES_APP) -> DataFrame:
    """CLN6: case-insensitive app match."""
    return views.where(F.lower("AppName") == app)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """SRC10: every day of the inclusive range, one row each."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")
    )


def calendar_of(views: DataFrame) -> DataFrame:
    """SRC10 over the data: every day between the first and the last view."""
    span = views.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("day"))


def calendar_of_folders(spark: SparkSession, root: str) -> DataFrame:
    """SRC10 over landed views: every day between the first and the last ``day=``
    folder of any device, from folder names alone (no file is opened)."""
    devices = partition_values(spark, root, "device")
    days = sorted({d for v in devices for d in partition_values(spark, f"{root.rstrip('/')}/device={v}", "day") if d != NULL_FOLDER})
    if not days:
        return spark.createDataFrame([], "day date")
    return calendar(spark, days[0], days[-1])


def day_labels(days: DataFrame) -> DataFrame:
    """FN8: day and its ``yyyy-MM-dd-Ddd`` label."""
    return days.select("day", day_label("day").alias("label"))


def _devices() -> Column:
    return F.explode(F.array(*[F.lit(d) for d in DEVICES])).alias("device")


def device_hour_grid(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(_devices(), hour_label(F.col("id")).alias("hour"))


def dense_hours(views: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(device, day, hours): 24 counts of series views for every device and every day
    from ``start`` to ``end``, by default from the first to the last view (of any
    application), in one scan of the views.

    The views are counted per device and day; one more aggregation keeps the span of
    days and the counts as a map, one row bounded by the calendar, from which the
    grid is generated.  So neither the calendar nor the zero days need another scan
    or a join."""
    series, hour = F.lower("AppName") == SERIES_APP, F.hour("playing_session")
    per_day = views.groupBy("device", "day").agg(F.array(*[F.count_if(series & (hour == i)) for i in HOURS]).alias("hours"))
    known = F.col("day").isNotNull() & F.col("device").isin(*DEVICES)
    lo, hi = (F.lit(x).cast("date") if x else f("day") for x, f in ((start, F.min), (end, F.max)))
    entry = F.struct(F.struct("device", "day").alias("key"), F.col("hours").alias("value"))
    whole = per_day.agg(lo.alias("lo"), hi.alias("hi"), F.map_from_entries(F.collect_list(F.when(known, entry))).alias("counts"))
    grid = whole.select(_devices(), "lo", "hi", "counts").select("device", F.explode(F.sequence("lo", "hi")).alias("day"), "counts")
    return grid.select(
        "device", "day", F.coalesce(F.try_element_at("counts", F.struct("device", "day")), F.array_repeat(F.lit(0).cast("bigint"), len(HOURS))).alias("hours"))


def _added(hours: Column) -> Column:
    return F.reduce(hours, F.lit(0).cast("bigint"), lambda a, x: a + x)


def views_daily(dense: DataFrame) -> DataFrame:
    """AG17: views per device per day, zero for days without views."""
    return dense.select("device", "day", _added(F.col("hours")).alias("views"))


def views_total(daily: DataFrame) -> DataFrame:
    """AG18: total views per device over the range."""
    return daily.groupBy("device").agg(F.sum("views").alias("views"))


def views_day_hour(dense: DataFrame) -> DataFrame:
    """AG19: device × day rows with 24 zero-filled hour columns ``h00``..``h23``."""
    return dense.select("device", "day", *[F.col("hours")[i].alias(f"h{i:02d}") for i in HOURS])


def views_hour_total(views: DataFrame) -> DataFrame:
    """AG20: views per device per hour of day over all days (24 rows per device)."""
    counts = (
        series_views(views)
        .groupBy("device", hour_label(F.hour("playing_session")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("views"))
    )
    grid = device_hour_grid(views.sparkSession)
    return grid.join(counts, ["device", "hour"], "left").select(
        "device", "hour", F.coalesce("views", F.lit(0)).alias("views")
    )


# Levels of the cube: name and the columns that it groups by.
CUBE = {"total": ["device"], "day": ["device", "day"], "hour": ["device", "hour"], "day_hour": ["device", "day", "hour"]}


def views_cube(views: DataFrame) -> DataFrame:
    """AG17-AG20 in one pass: level, device, day, hour, views of the series views, one
    row per group of each level (no zero rows).  The views are counted once at the
    finest level; GROUPING SETS then runs over those few counts, so that its row
    expansion does not multiply the log."""
    finest = series_views(views).groupBy("device", "day", hour_label(F.hour("playing_session")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    cube = finest.groupingSets(list(CUBE.values()), "device", "day", "hour").agg(
        F.grouping("day").alias("no_day"), F.grouping("hour").alias("no_hour"), F.sum("n").alias("views"))
    level = F.when((F.col("no_day") == 1) & (F.col("no_hour") == 1), "total").when(F.col("no_hour") == 1, "day").when(F.col("no_day") == 1, "hour")
    return cube.select(level.otherwise("day_hour").alias("level"), "device", "day", "hour", "views")


def views_daily_formatted(daily: DataFrame) -> DataFrame:
    """FN10 applied to the daily counts: ``'<n/1000>K'``."""
    return daily.select("device", "day", "views", fmt_unit("views", "K").alias("views_k"))


def item_views(views: DataFrame) -> DataFrame:
    """AG21: per device, day and item — views with a duration and their sum."""
    return (
        series_views(views)
        .groupBy("device", "day", "ItemId")
        .agg(
            F.count("duration").alias("count_duration"),
            F.sum("duration").cast("double").alias("sum_duration"),
        )
    )


def top_items_daily(items: DataFrame, first: int = 20, keep: int = 10, min_id_len: int = 12) -> DataFrame:
    """TOP1: per device-day take the ``first`` items by view count, drop short
    ids (length ≤ ``min_id_len``), keep the best ``keep`` of the rest.

    Ties break on ItemId.  ``row_number() <= first`` lets Spark insert a
    partial per-group limit before the shuffle, so a huge device-day never
    sends more than ``first`` rows per partition to its window task.
    """
    order = [F.desc("count_duration"), F.asc_nulls_last("ItemId")]
    w = Window.partitionBy("device", "day").orderBy(*order)
    head = items.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= first)
    kept = head.where(F.length("ItemId") > min_id_len)
    return (
        kept.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= keep)
        .select("device", "day", "rank", "ItemId", "count_duration", "sum_duration")
    )


def with_titles(top: DataFrame, titles: DataFrame) -> DataFrame:
    """SRC12/JN6: attach title and Vietnamese title by id (NULL when unknown)."""
    t = titles.select("ItemId", "title", "title_vie")
    return top.join(sized_broadcast(t), "ItemId", "left")


def top_titles_distinct(top_titles: DataFrame) -> DataFrame:
    """AG22: every Vietnamese title that reached a daily top list."""
    return top_titles.select("title_vie").distinct()


def title_device_matrix(top_titles: DataFrame) -> DataFrame:
    """AG23: Vietnamese title × device, summed daily-top view counts, zero-filled."""
    return top_titles.groupBy("title_vie").agg(
        *[
            F.sum(F.when(F.col("device") == d, F.col("count_duration")).otherwise(F.lit(0))).alias(d)
            for d in DEVICES
        ]
    )


def device_documents(daily: DataFrame, day_hour: DataFrame, top_titles: DataFrame) -> DataFrame:
    """SNK6 shapes, one row per device: the daily counts as a list ordered by
    day, their total, ``{day: {hh: views}}``, the day × hour matrix, and
    ``{day: [top records]}``.  Every document is bounded by the calendar length
    (days × 24 values, days × 10 records), not by the data size."""
    hours = [f"h{i:02d}" for i in HOURS]
    labels = F.array(*[F.lit(f"{i:02d}") for i in HOURS])
    day_s = F.date_format("day", "yyyy-MM-dd")
    per_day = daily.join(day_hour, ["device", "day"]).select(
        "device", "day", "views", day_s.alias("d"), F.array(*[F.col(h) for h in hours]).alias("hour_row")
    )
    counts = per_day.groupBy("device").agg(
        F.sort_array(F.collect_list(F.struct("day", "views", "d", "hour_row"))).alias("days"),
        F.sum("views").alias("total"),
    )
    record = F.struct("rank", "ItemId", "count_duration", "sum_duration", "title", "title_vie")
    tops = top_titles.groupBy("device", day_s.alias("d")).agg(
        F.transform(F.sort_array(F.collect_list(record)), lambda r: r.dropFields("rank")).alias("items")
    )
    top_docs = tops.groupBy("device").agg(F.map_from_entries(F.collect_list(F.struct("d", "items"))).alias("top10"))
    return counts.join(top_docs, "device", "left").select(
        "device",
        F.transform("days", lambda x: x["views"]).alias("daily_views"),
        "total",
        F.map_from_entries(
            F.transform("days", lambda x: F.struct(x["d"], F.map_from_arrays(labels, x["hour_row"])))
        ).alias("by_hour"),
        F.transform("days", lambda x: x["hour_row"]).alias("hour_matrix"),
        "top10",
    )
