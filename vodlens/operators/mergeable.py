"""Report states that can be added up across dump days, with exact distinct counts.

A late record puts one ``Date`` into several dump days, and the customers or sessions
of two partial reports cannot be added.  A *state* keeps, per report key, the sums
and for each distinct count bitmaps of the ids seen: one bitmap of 32,768 places per
(key, count, bucket of ids).  States of any days merge by adding sums and OR-ing
bitmaps; a repeated day replaces its own state.

Text ids get dense numbers from 1 on by a *numbering*, a table (kind, text, n) that
only grows (``with_new_ids``), so every day's bitmaps speak of the same ids.

Plan shapes: the rows are first reduced to distinct (key, id) pairs, so a customer
with a third of all rows is a few pairs by the time its number is looked up; bitmaps
are built map-side and merged per (key, count, bucket), so no key's ids meet in one
task; the last step adds one count per bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import folder, menu, movie, pageview

# Watch time is added as decimals: exact, so equal in any order and any split.
EXACT = "decimal(28,6)"


@dataclass(frozen=True)
class Mergeable:
    """A report as rows to group: ``rows(logs, dims)`` gives the keys, the columns of
    ``sums`` and ``times`` (watch time, rounded in the report) and of ``distinct``
    (output → (kind of id, column))."""

    rows: Callable
    keys: list[str]
    sums: dict[str, str] = field(default_factory=dict)
    times: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, tuple[str, str]] = field(default_factory=dict)


_VIEWS = {"sums": {"TotalViews": "n"}, "times": {"TotalDuration": "dur"}}
_CUSTOMERS = {"TotalCustomers": ("customer", "CustomerID")}

REPORTS: dict[str, Mergeable] = {
    "vod_by_folder": Mergeable(
        lambda l, d: folder.folder_facts(l, d.cus, d.listfolder), ["Date", "Area", "UType", "Folder"], **_VIEWS, distinct=_CUSTOMERS),
    "vod_by_folder_level": Mergeable(
        lambda l, d: folder.folder_facts(l, d.cus, d.listfolder, by_level=True), ["Date", "Area", "UType", "Level", "Folder"], **_VIEWS, distinct=_CUSTOMERS),
    "vod_by_movie_chapter": Mergeable(
        lambda l, d: movie.view_facts(l, d.cus, "ItemId", "ChapterID", measured=True), ["Date", "UType", "ItemId", "ChapterID"], **_VIEWS, distinct=_CUSTOMERS),
    "vod_by_movie": Mergeable(lambda l, d: movie.view_facts(l, d.cus, "ItemId"), ["Date", "UType", "ItemId"], distinct=_CUSTOMERS),
    "customers_by_location": Mergeable(lambda l, d: movie.view_facts(l, d.cus), ["Date", "Area", "UType"], distinct=_CUSTOMERS),
    "vod_by_main_menu": Mergeable(
        lambda l, d: menu.main_menu_facts(l, d.cus), ["Date", "Area", "Folder"], **_VIEWS,
        distinct={**_CUSTOMERS, "TotalSession": ("session", "Session")}),
    "vod_by_menu": Mergeable(
        lambda l, d: menu.menu_facts(l, d.listfolder, d.fol), ["Date", "MenuID"], distinct={"TotalCustomer": ("customer", "CustomerID")}),
    "sessions_by_location": Mergeable(
        lambda l, d: folder.session_facts(l, d.cus, d.listfolder), ["Date", "Area", "UType", "Folder"], distinct={"TotalSession": ("session", "Session")}),
    "unique_pageview": Mergeable(
        lambda l, d: pageview.pageview_facts(l, d.cus), ["Date", "Area", "UType", "SubMenuId", "ItemId"],
        sums={"PV": "pv", "TotalViews": "views"}, times={"TotalDuration": "dur"},
        distinct={"TotalCustomers": ("customer", "Viewer"), "UniquePV": ("session", "Visit")}),
}

NUMBERING = "kind string, text string, n bigint"


# Kinds of ids and the log column that holds them.
ID_COLUMNS = {"customer": "CustomerID", "session": "Session"}


def ids_of(logs: DataFrame, kinds: set[str]) -> DataFrame:
    """(kind, text): the distinct ids of the kinds in the logs, in one scan."""
    each = [F.struct(F.lit(k).alias("kind"), F.col(ID_COLUMNS[k]).cast("string").alias("text")) for k in sorted(kinds)]
    return logs.select(F.inline(F.array(*each))).where("text is not null").distinct()


def new_ids(known: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows to append to a numbering: ids it does not hold, with the numbers
    after its last one.  Numbers are dense: each partition of the (checkpointed) new
    ids counts on from the sum of those before it."""
    ensure_checkpoint_dir(ids.sparkSession)
    fresh = ids.join(known.select("kind", "text"), ["kind", "text"], "left_anti")
    part = F.spark_partition_id().alias("part")
    fresh = fresh.select("kind", "text", part).checkpoint()
    # one row per partition and kind: bounded by the number of tasks
    before = F.coalesce(F.sum("size").over(Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = fresh.groupBy("kind", "part").agg(F.count(F.lit(1)).alias("size")).withColumn("before", before)
    last = known.groupBy("kind").agg(F.max("n").alias("last"))
    start = sizes.join(last, "kind", "left").select("kind", "part", (F.col("before") + F.coalesce("last", F.lit(0))).alias("start"))
    place = F.row_number().over(Window.partitionBy("kind", "part").orderBy("text"))
    return fresh.withColumn("place", place).join(start, ["kind", "part"]).select("kind", "text", (F.col("start") + F.col("place")).alias("n"))


def state_of(rows: DataFrame, report: Mergeable, numbering: DataFrame) -> DataFrame:
    """The state of ``rows``: keys, the sums (on rows with a NULL ``counted``), and for
    each distinct count bitmaps by bucket."""
    keys = report.keys
    empty = [F.lit(None).cast("string").alias("counted"), F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bitmap")]
    sums = [F.sum(c).cast("bigint").alias(out) for out, c in report.sums.items()]
    sums += [F.sum(F.col(c).try_cast(EXACT)).alias(out) for out, c in report.times.items()]
    parts = [rows.groupBy(*keys).agg(*sums or [F.lit(0)]).select(*keys, *empty, *report.sums, *report.times)]
    for out, (kind, column) in report.distinct.items():
        pairs = rows.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("string").alias("text")).distinct()
        known = numbering.where(F.col("kind") == kind).select("text", "n")
        maps = pairs.join(known, "text").groupBy(*keys, F.bitmap_bucket_number("n").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap"))
        nothing = [F.lit(None).cast("bigint").alias(c) for c in report.sums] + [F.lit(None).cast("decimal(38,6)").alias(c) for c in report.times]
        parts.append(maps.select(*keys, F.lit(out).alias("counted"), "bucket", "bitmap", *nothing))
    state = parts[0]
    for p in parts[1:]:
        state = state.unionByName(p)
    return state


def merged(state: DataFrame, report: Mergeable) -> DataFrame:
    """States of several days as one state (same columns)."""
    sums = [F.sum(c).alias(c) for c in report.sums] + [F.sum(c).cast("decimal(38,6)").alias(c) for c in report.times]
    return state.groupBy(*report.keys, "counted", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), *sums)


def report_of(state: DataFrame, report: Mergeable) -> DataFrame:
    """The report that a (merged) state stands for."""
    one = merged(state, report)
    counts = [F.coalesce(F.sum(F.when(F.col("counted") == c, F.bitmap_count("bitmap"))), F.lit(0)).alias(c) for c in report.distinct]
    sums = [F.sum(c).alias(c) for c in report.sums] + [F.round(F.sum(c), 2).cast("double").alias(c) for c in report.times]
    return one.groupBy(*report.keys).agg(*sums, *counts)
