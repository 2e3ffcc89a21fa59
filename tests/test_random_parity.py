"""Differential test on adversarial random inputs.

Random logs and views full of edge values (numeric text like '00', '1600.0',
' 7', '1,234', NULLs, empty strings, malformed positions and folder lists)
go through the Spark reports and through the DuckDB oracle bodies
(``oracle_sql_over``); both must agree row for row.
"""

import datetime as dt
import decimal
import os
import random
import sys

import duckdb
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracle import _rows  # noqa: E402
from duck_oracle.sql import oracle_sql_over  # noqa: E402
from vodlens.functions import exprs as fx  # noqa: E402
from vodlens.operators import customer, folder, menu, movie, pageview, recsys, submenu, topic_lane  # noqa: E402
from vodlens.operators import views as vw  # noqa: E402
from vodlens.operators.joins import with_customers  # noqa: E402
from vodlens.schema import LOG_FIELDS, LOGS, TITLES, VIEWS  # noqa: E402

VALUES = {
    "LogId": ["52", "52", "52", "512", "512", "51", "57", "20", "55", "99", None],
    "AppId": ["21", "23", "24", "99", None],
    "AppName": ["VOD", "CHILD", "RELAX", "vod", "FILM", None],
    "CustomerID": ["1", "2", "3", "007", "0", "", "x", None, "5"],
    "Contract": ["c1", "C1", "c2", "", None],
    "Session": ["s1", "s2", "s3", "", None],
    "Mac": ["aa", "", None],
    "MenuSession": ["m1", "m2", None],
    "PlayingSession": ["p1", "p2", "p3", None],
    "Screen": ["HomeScreen", "Detail", None, "home"],
    "SubMenuId": ["0", "00", "1600", "1600.0", "48", "49", "50", "7", " 7", "undefined", "null", "", None],
    "ItemId": ["1", "2", "10", "007", "undefined", None, "abc"],
    "ChapterID": ["1", "2", None],
    "Duration": ["10", "20", "0", "", None, "abc", "1.5", "-5"],
    "RealTimePlaying": ["5", "15", "0", "0.5", "1,234", "", None, "20", "12.25"],
    "ElapsedTimePlaying": ["0", "3", "", None, "25", "-1", "7.75"],
    "ListOnFolder": ["19,3", "91", "2,5", "190", "undefined", None, ""],
    "Folder": ["1", "2"],
    "Position": ["3:2", "5:0", "7", "undefined", None, "x:1", "3:", "3:2:9", " 4 ", "-2:3", ""],
}

LOG_REPORTS = {
    "vod_by_folder": lambda l, d: folder.vod_by_folder(l, d["cus"], d["lf"]),
    "vod_by_folder_level": lambda l, d: folder.vod_by_folder_level(l, d["cus"], d["lf"]),
    "vod_by_movie_chapter": lambda l, d: movie.vod_by_movie_chapter(l, d["cus"]),
    "vod_by_movie": lambda l, d: movie.vod_by_movie(l, d["cus"]),
    "customers_by_location": lambda l, d: movie.customers_by_location(l, d["cus"]),
    "vod_by_main_menu": lambda l, d: menu.vod_by_main_menu(l, d["cus"]),
    "vod_by_menu": lambda l, d: menu.vod_by_menu(l, d["lf"], d["fol"]),
    "customer_app_pivot": lambda l, d: customer.customer_app_pivot(l),
    "sessions_by_location": lambda l, d: folder.sessions_by_location(l, d["cus"], d["lf"]),
    "unique_pageview": lambda l, d: pageview.unique_pageview(l, d["cus"]),
    "leaving_soon_pageview": lambda l, d: pageview.leaving_soon_pageview(pageview.unique_pageview(l, d["cus"])),
    "series_movies": lambda l, d: customer.series_movies(l),
    "recsys_impressions": lambda l, d: recsys.recsys_impressions(l, d["cus"]),
    "recsys_conversion": lambda l, d: recsys.recsys_conversion(l, d["cus"]),
    "submenu_behaviours": lambda l, d: submenu.submenu_behaviours(l, d["cus"]),
    "topic_lane_rows": lambda l, d: topic_lane.topic_lane_rows(l),
    "topic_lane_funnel": lambda l, d: topic_lane.topic_lane_funnel(l),
    "join_customers": lambda l, d: with_customers(l, d["cus"]),
    "join_folder_left": lambda l, d: folder.folder_rows(l, d["lf"]),
    "fn_playing_time": lambda l, d: l.select("RealTimePlaying", "ElapsedTimePlaying", "Duration",
                                             fx.playing_time("RealTimePlaying", "ElapsedTimePlaying", "Duration").alias("PlayingTime")),
    "fn_level": lambda l, d: l.select("RealTimePlaying", "ElapsedTimePlaying", "Duration",
                                      fx.level("RealTimePlaying", "ElapsedTimePlaying", "Duration").alias("Level")),
    "fn_position": lambda l, d: l.select("Position", fx.position("Position").alias("pos")),
    "fn_capped_duration": lambda l, d: l.select("RealTimePlaying", "Duration", fx.capped().alias("cap")),
}


def _top(v, t):
    return vw.with_titles(vw.top_items_daily(vw.item_views(v)), t)


VIEW_REPORTS = {
    "views_daily": lambda v, t: vw.views_daily(vw.dense_hours(v)),
    "views_total": lambda v, t: vw.views_total(vw.views_daily(vw.dense_hours(v))),
    "views_day_hour": lambda v, t: vw.views_day_hour(vw.dense_hours(v)),
    "views_hour_total": lambda v, t: vw.views_hour_total(v),
    "views_cube": lambda v, t: vw.views_cube(v),
    "fmt_thousands": lambda v, t: vw.views_daily_formatted(vw.views_daily(vw.dense_hours(v))),
    "item_views": lambda v, t: vw.item_views(v),
    "top_items_daily": lambda v, t: vw.top_items_daily(vw.item_views(v)),
    "top_items_with_titles": _top,
    "top_titles_distinct": lambda v, t: vw.top_titles_distinct(_top(v, t)),
    "title_device_matrix": lambda v, t: vw.title_device_matrix(_top(v, t)),
}


def random_logs(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = dt.datetime(2024, 3, 1 + rnd.randrange(3), rnd.randrange(24), rnd.randrange(60), i % 60)
        rows.append({"ts": ts, "Date": ts.date(), **{f: rnd.choice(VALUES[f]) for f in LOG_FIELDS}})
    return pd.DataFrame(rows, columns=[f.name for f in LOGS.fields])


def random_views(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = dt.datetime(2024, 3, 1 + rnd.randrange(4), rnd.randrange(24), rnd.randrange(60))
        item = rnd.choice(["0" * 20 + str(rnd.randrange(30)).zfill(4), "s1", None, "x" * 13])
        dur = rnd.choice([None, decimal.Decimal(f"{rnd.randrange(1, 9999)}.{rnd.randrange(100):02d}")])
        rows.append({"device": rnd.choice(["mobile", "box", "smarttv", "tv"]), "day": ts.date(),
                     "AppName": rnd.choice(["phim bộ", "PHIM BỘ", "Phim Bộ", "phim lẻ", None]),
                     "ItemId": item, "duration": dur, "playing_session": ts})
    return pd.DataFrame(rows, columns=[f.name for f in VIEWS.fields])


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    seed = request.param
    logs = random_logs(2500, seed)
    views = random_views(2500, seed + 100)
    cus = pd.DataFrame({"ID": [0, 1, 2, 3, 5, 7, 7], "Area": [0, 1, 2, 0, 1, 2, 2],
                        "UType": ["U1", "U2", "U1", "U2", "U1", "U2", "U1"]})
    lf = pd.DataFrame({"MovieID": [1, 2, 2, 10, 11], "Folder": [5, 6, 7, 5, 8]})
    fol = pd.DataFrame({"MenuID": [3, 4, 15], "FolderID": [5, 6, 8]})
    ttl = pd.DataFrame({"ItemId": ["0" * 20 + str(i).zfill(4) for i in range(0, 30, 2)],
                        "title": [f"t{i}" for i in range(15)], "title_vie": [f"vie t{i % 5}" for i in range(15)]})
    con = duckdb.connect()
    for name, df in {"rlogs": logs, "rvws": views, "rcus": cus, "rlf": lf, "rfol": fol, "rttl": ttl}.items():
        con.register(name, df)
    sql = oracle_sql_over({
        "logs": "SELECT * FROM rlogs", "cus": "SELECT * FROM rcus", "listfolder": "SELECT * FROM rlf",
        "fol": "SELECT * FROM rfol", "vws": "SELECT * FROM rvws", "ttl": "SELECT * FROM rttl",
    })
    s = {
        "logs": spark.createDataFrame(logs, LOGS),
        "views": spark.createDataFrame(views, VIEWS),
        "titles": spark.createDataFrame(ttl, TITLES),
        "cus": spark.createDataFrame(cus, "ID long, Area int, UType string"),
        "lf": spark.createDataFrame(lf, "MovieID long, Folder int"),
        "fol": spark.createDataFrame(fol, "MenuID int, FolderID int"),
    }
    return s, con, sql


def _check(df, con, sql):
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    b = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    if a != b:
        sa, sb = set(a), set(b)
        raise AssertionError(f"spark-only {list(sa - sb)[:3]} oracle-only {list(sb - sa)[:3]}")


@pytest.mark.parametrize("name", sorted(LOG_REPORTS))
def test_log_reports(data, name):
    s, con, sql = data
    _check(LOG_REPORTS[name](s["logs"], s), con, sql[name])


@pytest.mark.parametrize("name", sorted(VIEW_REPORTS))
def test_view_reports(data, name):
    s, con, sql = data
    _check(VIEW_REPORTS[name](s["views"], s["titles"]), con, sql[name])
