"""Map the driver's synthetic tables onto the package's input datasets.

The driver ships TPC-H-like tables (``events``, ``customer``, ``part``, ...);
this module derives, with Spark, the raw set-top-box logs, the customer, folder
and menu dimensions, the per-device view logs and the title table that the
reports consume.  The rules are listed in FIXTURES.md (part B); the oracle SQL
states the same rules independently in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LOG_FIELDS


# Read DataFrames of the (read-only) driver tables, per session: listing the
# file and reading its footer once is enough for every query of a run.
_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (id(spark), path)
    if k not in _TABLES:
        _TABLES[k] = spark.read.parquet(path)
    return _TABLES[k]


def _by(k: Column, mod: int, values: list) -> Column:
    """``values[k % mod]`` as a CASE chain (NULL entries allowed)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(k % mod == i, lit) if out is None else out.when(k % mod == i, lit)
    return out


def _s(c: Column) -> Column:
    return c.cast("string")


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("k", F.regexp_extract("props", r"[0-9]+", 0).cast("int"))


def _log_fields(ev: DataFrame) -> dict[str, Column]:
    k, uid, eid = F.col("k"), F.col("user_id"), F.col("event_id")
    et = F.col("event_type")
    day = _s(F.to_date("ts"))
    real = _s(F.col("value").cast("decimal(10,2)"))
    log_id = (
        F.when(et == "view", "52")
        .when(et == "click", "512")
        .when(et == "signup", "57")
        .when(et == "error", "20")
        .otherwise(F.when(k % 4 < 2, "51").when(k % 4 == 2, "55").otherwise("56"))
    )
    return {
        "LogId": log_id,
        "AppId": F.when(k % 29 == 28, "99").otherwise(_by(k, 3, ["21", "24", "23"])),
        "AppName": F.when(k % 29 == 28, "FILM")
        .when(k % 29 == 27, "vod")
        .otherwise(_by(k, 3, ["VOD", "CHILD", "RELAX"])),
        "CustomerID": F.when(uid % 37 == 36, "0").otherwise(_s(uid)),
        "Contract": F.concat(F.lit("sgh"), _s(uid)),
        "Session": F.when(k % 23 == 22, "").otherwise(F.concat(_s(uid), F.lit("-"), day)),
        "Mac": F.when(k % 31 == 30, F.lit(None).cast("string"))
        .when(k % 31 == 29, "")
        .otherwise("aa:bb"),
        "MenuSession": F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("m"), _s(uid))
        ),
        "PlayingSession": F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("p"), _s(eid % 500))
        ),
        "Screen": F.when(k % 5 < 2, "HomeScreen")
        .when(k % 5 == 2, F.lit(None).cast("string"))
        .otherwise("Detail"),
        "SubMenuId": _by(k, 10, ["0", "1600", "48", "49", "50", "undefined", None, "", "7", "7"]),
        "ItemId": F.when(
            et == "signup", F.when(k % 13 == 0, "undefined").otherwise(_s(k % 5))
        ).otherwise(_s((k * 7) % 200)),
        "ChapterID": _s(k % 12),
        "Duration": F.when(k % 20 == 0, "0").otherwise(_s((k % 4 + 1) * 10)),
        "RealTimePlaying": real,
        "ElapsedTimePlaying": F.when(eid % 3 == 0, "0").otherwise(real),
        "ListOnFolder": _by(k, 4, ["19,3", "91", "2,5", None]),
        "Folder": _s(k % 9),
        "Position": _by(k, 6, ["3:2", "5:0", "7", "undefined", None, "x:1"]),
    }


def _as_records(ev: DataFrame, record: Column) -> DataFrame:
    """One raw record per event, produced by a generator.

    Filters above (the cleaning rules) cannot be pushed below a generator, so
    they run on the built record — as they would on records read from files —
    instead of being inlined into, and re-evaluating, the record construction
    once per predicate reference.
    """
    return ev.select(F.inline(F.array(record)))


def raw_kafka_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-dump shaped raw log: ``received_at timestamp, fields struct``."""
    ev = events_with_k(spark, sf_dir)
    f = _log_fields(ev)
    record = F.struct(
        F.col("ts").cast("timestamp").alias("received_at"),
        F.struct(*[f[n].alias(n) for n in LOG_FIELDS]).alias("fields"),
    )
    return _as_records(ev, record)


def raw_archive_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive shaped raw log: ``received_at`` text and a ``fields`` map.

    JSON writers leave out null members, so a NULL field becomes a missing key.
    """
    ev = events_with_k(spark, sf_dir)
    f = _log_fields(ev)
    m = F.create_map(*[x for n in LOG_FIELDS for x in (F.lit(n), f[n])])
    record = F.struct(
        F.col("ts").cast("string").alias("received_at"),
        F.map_filter(m, lambda _k, v: v.isNotNull()).alias("fields"),
    )
    return _as_records(ev, record)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat ``logs`` frame of every mapped event (no cleaning rule applied).

    Same rows as ``normalize_kafka(raw_kafka_logs(...))`` (checked in tests),
    but projected flat so unused fields — and the source columns behind them —
    are pruned instead of building the whole record struct per row.
    """
    ev = events_with_k(spark, sf_dir)
    f = _log_fields(ev)
    ts = F.col("ts").cast("timestamp")
    return ev.select(ts.alias("ts"), F.to_date(ts).alias("Date"), *[f[n].alias(n) for n in LOG_FIELDS])


def logs_by_dump(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``logs`` as two dump days: every fifth event id arrives late, in the second."""
    ev = events_with_k(spark, sf_dir)
    f = _log_fields(ev)
    ts, late = F.col("ts").cast("timestamp"), F.col("event_id") % 5 == 0
    cols = [ts.alias("ts"), F.to_date(ts).alias("Date"), *[f[n].alias(n) for n in LOG_FIELDS]]
    return {"2024-02-01": ev.where(~late).select(*cols), "2024-02-02": ev.where(late).select(*cols)}


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("ID"),
        (F.col("c_nationkey") % 3).cast("int").alias("Area"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "U1")
        .otherwise("U2")
        .alias("UType"),
    )


# Movie id in a catalogue = part key + its offset, so each catalogue
# lists every part; items 0-20 are in none (they keep a NULL folder in the LEFT join)
# and items from 151 on are in both (fan-out).
MOVIE_KEY_OFFSET, SERIES_KEY_OFFSET = 20, 150


def movie_folders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two catalogue tables behind the movie→folder lookup (SRC6), both over
    the whole ``part`` table."""
    p = table(spark, sf_dir, "part")
    movies = p.select((F.col("p_partkey") + MOVIE_KEY_OFFSET).alias("ID"), F.col("p_size").cast("int").alias("Folder"))
    series = p.select((F.col("p_partkey") + SERIES_KEY_OFFSET).alias("ID"), (F.col("p_size") % 5 + 1).cast("int").alias("Folder"))
    return movies, series


# Menu id assigned to folders by ``p_size % 7``.
MENU_BY_SIZE_MOD7 = [3, 4, 5, 6, 7, 8, 15]


def menu_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu → folder detail table (input of SRC5)."""
    p = table(spark, sf_dir, "part")
    menu = None
    for i, m in enumerate(MENU_BY_SIZE_MOD7):
        cond = F.col("p_size") % 7 == i
        menu = F.when(cond, m) if menu is None else menu.when(cond, m)
    return p.select(
        menu.cast("int").alias("MenuID"), F.col("p_size").cast("int").alias("FolderID")
    ).distinct()


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-device view log (the ORC day folders of the series notebook)."""
    ev = events_with_k(spark, sf_dir)
    k, eid = F.col("k"), F.col("event_id")
    item = F.when(eid % 8 == 0, F.concat(F.lit("s"), _s(k % 3))).otherwise(
        F.lpad(_s((eid * 31 + k) % 40), 24, "0")
    )
    return ev.select(
        _by(F.col("user_id"), 3, ["mobile", "box", "smarttv"]).alias("device"),
        F.to_date("ts").alias("day"),
        F.when(k % 5 == 0, "Phim Lẻ").when(k % 5 == 1, "PHIM BỘ").otherwise("phim bộ").alias("AppName"),
        item.alias("ItemId"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("value").cast("decimal(10,2)")).cast("decimal(10,2)").alias("duration"),
        F.col("ts").cast("timestamp").alias("playing_session"),
    )


# Fixed value: item id of a title = part key + this offset, so every part row is
# a title and view items 0-3 have none (missing titles stay NULL, Q8).
TITLE_KEY_OFFSET = 4


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title lookup (SRC12) over the whole ``part`` table."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.lpad(_s(F.col("p_partkey") + TITLE_KEY_OFFSET), 24, "0").alias("ItemId"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("vie "), F.col("p_name")).alias("title_vie"),
    )


def voucher_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion rows derived from ``part`` (flat, before packing into feed pages)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("EV"), _s(F.col("p_partkey") % 50)).alias("eventCode"),
        F.col("p_size").cast("double").alias("discount"),
        F.lit("2024-01-01T00:00:00").alias("fromDate"),
        F.lit("2024-02-01T23:59:59").alias("toDate"),
        F.lit("active").alias("status"),
        F.lit("G1").alias("quotaGeneralCode"),
        F.lit("P1").alias("quotaPrivateCode"),
        F.concat(F.lit("img/"), _s(F.col("p_partkey")), F.lit(".png")).alias("images"),
        F.col("p_brand").alias("voucherType"),
        F.col("p_type").alias("serviceType"),
    )
