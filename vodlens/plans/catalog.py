"""Registered queries: each report bound to inputs derived from the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame``.  Inputs are derived with Spark
from ``events``, ``customer`` and ``part`` (see ``sources.fixtures``), so the
work of every query grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as fx
from ..operators import clean, customer, folder, menu, movie, pageview, quarantine, recsys, submenu, topic_lane
from ..operators import views as vw
from ..operators.joins import with_customers
from ..session import scratch_path
from ..sources import bucketed, dims, fixtures
from ..sources import logs as log_src
from ..sources import views as view_src
from ..sources import vouchers
from . import daily, states

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Lazily built inputs of one (session, table folder) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def logs(self) -> DataFrame:
        return fixtures.logs(self.spark, self.sf_dir)

    @property
    def cus(self) -> DataFrame:
        return dims.customer_snapshot(fixtures.customers(self.spark, self.sf_dir))

    @property
    def listfolder(self) -> DataFrame:
        return dims.list_folders(*fixtures.movie_folders(self.spark, self.sf_dir))

    @property
    def fol(self) -> DataFrame:
        return dims.menu_folders(fixtures.menu_detail(self.spark, self.sf_dir))

    @property
    def views(self) -> DataFrame:
        return fixtures.views(self.spark, self.sf_dir)

    @property
    def titles(self) -> DataFrame:
        return fixtures.titles(self.spark, self.sf_dir)

    @property
    def days(self) -> DataFrame:
        return vw.calendar_of(self.views)

    @property
    def dense(self) -> DataFrame:
        return vw.dense_hours(self.views)

    def top_titles(self) -> DataFrame:
        top = vw.top_items_daily(vw.item_views(self.views))
        return vw.with_titles(top, self.titles)


QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        return fn

    return deco


# --- sources and dimensions -------------------------------------------------


@register("src_logs_json")
def _src_logs_json(i: Inputs) -> DataFrame:
    """SRC1/2/4: land the raw Kafka-dump records as JSON by day, read them back
    with the explicit schema and normalise (no cleaning)."""
    path = scratch_path(i.spark, "kafka")
    log_src.write_raw(fixtures.raw_kafka_logs(i.spark, i.sf_dir), path)
    return clean.normalize_kafka(log_src.read_raw(i.spark, path, "kafka"))


@register("src_views_orc")
def _src_views_orc(i: Inputs) -> DataFrame:
    """SRC9: land the view log as device=/day= ORC folders and read it back."""
    root = scratch_path(i.spark, "views")
    view_src.write_views(i.views, root)
    return view_src.read_views(i.spark, root)


@register("dim_menu_folder")
def _dim_menu_folder(i: Inputs) -> DataFrame:
    return i.fol


@register("dim_list_folder")
def _dim_list_folder(i: Inputs) -> DataFrame:
    return i.listfolder


@register("dim_customers")
def _dim_customers(i: Inputs) -> DataFrame:
    return i.cus


@register("calendar_days")
def _calendar_days(i: Inputs) -> DataFrame:
    return i.days


@register("calendar_folders")
def _calendar_folders(i: Inputs) -> DataFrame:
    """SRC9 + SRC10: days of the landed ORC folders, from their names."""
    root = scratch_path(i.spark, "views")
    view_src.write_views(i.views, root)
    return vw.calendar_of_folders(i.spark, root)


@register("day_labels")
def _day_labels(i: Inputs) -> DataFrame:
    return vw.day_labels(i.days)


@register("voucher_rows")
def _voucher_rows(i: Inputs) -> DataFrame:
    """SRC11 + SNK4: land the feed as JSON pages, read, explode, render XML."""
    path = scratch_path(i.spark, "feed")
    vouchers.write_feed(vouchers.pack_pages(fixtures.voucher_items(i.spark, i.sf_dir)), path)
    return vouchers.voucher_rows(vouchers.read_feed(i.spark, path))


# --- cleaning rules and joins ---------------------------------------------------


@register("clean_logs_kafka")
def _clean_logs_kafka(i: Inputs) -> DataFrame:
    return clean.clean_kafka(fixtures.raw_kafka_logs(i.spark, i.sf_dir))


@register("clean_logs_archive")
def _clean_logs_archive(i: Inputs) -> DataFrame:
    return clean.clean_archive(fixtures.raw_archive_logs(i.spark, i.sf_dir))


@register("clean_logs_archive_json")
def _clean_logs_archive_json(i: Inputs) -> DataFrame:
    """SRC1 + CLN1: land the raw archive records as JSON by day, read them back, clean."""
    path = scratch_path(i.spark, "archive")
    log_src.write_raw(fixtures.raw_archive_logs(i.spark, i.sf_dir), path)
    return clean.clean_archive(log_src.read_raw(i.spark, path, "archive"))


@register("log_rejects")
def _log_rejects(i: Inputs) -> DataFrame:
    """CLN1 + CLN2 with reasons: raw records of both shapes by source and outcome, and
    how many of them the cleaning rule keeps."""
    out = None
    for kind, raw, rule in (("kafka", fixtures.raw_kafka_logs(i.spark, i.sf_dir), clean.kafka_rule()),
                            ("archive", fixtures.raw_archive_logs(i.spark, i.sf_dir), clean.archive_rule())):
        counts = quarantine.checked(raw.withColumn("kept", rule), kind).groupBy(F.lit(kind).alias("source"), "reason").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept"))
        out = counts if out is None else out.unionByName(counts)
    return out


@register("landed_logs")
def _landed_logs(i: Inputs) -> DataFrame:
    """SRC2 + CLN2: raw JSON checked and landed in one pass; the clean rows read back."""
    raw_path, path = scratch_path(i.spark, "kafka"), scratch_path(i.spark, "checked")
    log_src.write_raw(fixtures.raw_kafka_logs(i.spark, i.sf_dir), raw_path)
    log_src.land_checked(log_src.read_raw(i.spark, raw_path, "kafka", corrupt=True), "kafka", path, "2024-02-01")
    return log_src.read_landed(i.spark, path)


@register("join_customers")
def _join_customers(i: Inputs) -> DataFrame:
    return with_customers(i.logs, i.cus)


@register("join_folder_left")
def _join_folder_left(i: Inputs) -> DataFrame:
    return folder.folder_rows(i.logs, i.listfolder)


# --- scalar functions over every log row -------------------------------------------


@register("fn_playing_time")
def _fn_playing_time(i: Inputs) -> DataFrame:
    return i.logs.select(
        "RealTimePlaying",
        "ElapsedTimePlaying",
        "Duration",
        fx.playing_time("RealTimePlaying", "ElapsedTimePlaying", "Duration").alias("PlayingTime"),
    )


@register("fn_level")
def _fn_level(i: Inputs) -> DataFrame:
    return i.logs.select(
        "RealTimePlaying",
        "ElapsedTimePlaying",
        "Duration",
        fx.level("RealTimePlaying", "ElapsedTimePlaying", "Duration").alias("Level"),
    )


@register("fn_position")
def _fn_position(i: Inputs) -> DataFrame:
    return i.logs.select("Position", fx.position("Position").alias("pos"))


@register("fn_capped_duration")
def _fn_capped_duration(i: Inputs) -> DataFrame:
    return i.logs.select("RealTimePlaying", "Duration", fx.capped().alias("cap"))


# --- daily VOD reports ---------------------------------------------------------------


@register("vod_by_folder")
def _vod_by_folder(i: Inputs) -> DataFrame:
    return folder.vod_by_folder(i.logs, i.cus, i.listfolder)


@register("vod_by_folder_level")
def _vod_by_folder_level(i: Inputs) -> DataFrame:
    return folder.vod_by_folder_level(i.logs, i.cus, i.listfolder)


@register("vod_by_movie_chapter")
def _vod_by_movie_chapter(i: Inputs) -> DataFrame:
    return movie.vod_by_movie_chapter(i.logs, i.cus)


@register("vod_by_movie")
def _vod_by_movie(i: Inputs) -> DataFrame:
    return movie.vod_by_movie(i.logs, i.cus)


@register("customers_by_location")
def _customers_by_location(i: Inputs) -> DataFrame:
    return movie.customers_by_location(i.logs, i.cus)


@register("vod_by_main_menu")
def _vod_by_main_menu(i: Inputs) -> DataFrame:
    return menu.vod_by_main_menu(i.logs, i.cus)


@register("vod_by_menu")
def _vod_by_menu(i: Inputs) -> DataFrame:
    return menu.vod_by_menu(i.logs, i.listfolder, i.fol)


@register("customer_app_pivot")
def _customer_app_pivot(i: Inputs) -> DataFrame:
    return customer.customer_app_pivot(i.logs)


@register("sessions_by_location")
def _sessions_by_location(i: Inputs) -> DataFrame:
    return folder.sessions_by_location(i.logs, i.cus, i.listfolder)


@register("unique_pageview")
def _unique_pageview(i: Inputs) -> DataFrame:
    return pageview.unique_pageview(i.logs, i.cus)


@register("leaving_soon_pageview")
def _leaving_soon_pageview(i: Inputs) -> DataFrame:
    return pageview.leaving_soon_pageview(pageview.unique_pageview(i.logs, i.cus))


@register("series_movies")
def _series_movies(i: Inputs) -> DataFrame:
    return customer.series_movies(i.logs)


@register("recsys_impressions")
def _recsys_impressions(i: Inputs) -> DataFrame:
    return recsys.recsys_impressions(i.logs, i.cus)


@register("recsys_conversion")
def _recsys_conversion(i: Inputs) -> DataFrame:
    return recsys.recsys_conversion(i.logs, i.cus)


@register("submenu_behaviours")
def _submenu_behaviours(i: Inputs) -> DataFrame:
    return submenu.submenu_behaviours(i.logs, i.cus)


@register("topic_lane_rows")
def _topic_lane_rows(i: Inputs) -> DataFrame:
    return topic_lane.topic_lane_rows(i.logs)


@register("topic_lane_funnel")
def _topic_lane_funnel(i: Inputs) -> DataFrame:
    return topic_lane.topic_lane_funnel(i.logs)


# --- reports over logs and customers landed in matching buckets ---------------------------

def _over_buckets(name: str, report) -> None:
    @register(f"bucketed_{name}")
    def _query(i: Inputs) -> DataFrame:
        landed = bucketed.land(i.logs, i.cus)
        return report(landed.logs, daily.Dims(landed.cus, i.listfolder, i.fol))


_over_buckets("vod_by_folder", lambda l, d: folder.vod_by_folder(l, d.cus, d.listfolder))
_over_buckets("vod_by_main_menu", lambda l, d: menu.vod_by_main_menu(l, d.cus))
_over_buckets("submenu_behaviours", lambda l, d: submenu.submenu_behaviours(l, d.cus))


# --- reports added up from landed states of two dump days ------------------------------


def _backfill(name: str) -> None:
    @register(f"backfill_{name}")
    def _query(i: Inputs) -> DataFrame:
        root = scratch_path(i.spark, "states")
        dims_ = daily.Dims(i.cus, i.listfolder, i.fol)
        for day, logs in fixtures.logs_by_dump(i.spark, i.sf_dir).items():
            states.land_day(logs, dims_, day, root, [name])
        return states.combined(i.spark, root, name)


for _name in ("vod_by_folder", "vod_by_main_menu", "vod_by_menu", "unique_pageview"):
    _backfill(_name)


# --- per-device view reports ------------------------------------------------------------


@register("views_daily")
def _views_daily(i: Inputs) -> DataFrame:
    return vw.views_daily(i.dense)


@register("views_total")
def _views_total(i: Inputs) -> DataFrame:
    return vw.views_total(vw.views_daily(i.dense))


@register("views_day_hour")
def _views_day_hour(i: Inputs) -> DataFrame:
    return vw.views_day_hour(i.dense)


@register("views_hour_total")
def _views_hour_total(i: Inputs) -> DataFrame:
    return vw.views_hour_total(i.views)


@register("views_cube")
def _views_cube(i: Inputs) -> DataFrame:
    return vw.views_cube(i.views)


@register("fmt_thousands")
def _fmt_thousands(i: Inputs) -> DataFrame:
    return vw.views_daily_formatted(vw.views_daily(i.dense))


@register("item_views")
def _item_views(i: Inputs) -> DataFrame:
    return vw.item_views(i.views)


@register("top_items_daily")
def _top_items_daily(i: Inputs) -> DataFrame:
    return vw.top_items_daily(vw.item_views(i.views))


@register("top_items_with_titles")
def _top_items_with_titles(i: Inputs) -> DataFrame:
    return i.top_titles()


@register("top_titles_distinct")
def _top_titles_distinct(i: Inputs) -> DataFrame:
    return vw.top_titles_distinct(i.top_titles())


@register("title_device_matrix")
def _title_device_matrix(i: Inputs) -> DataFrame:
    return vw.title_device_matrix(i.top_titles())
