"""Edge tables and brute-force models for the scalar functions (FN1-FN5, FN8-FN10)."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vodlens.functions import (
    app_from_id,
    capped,
    day_label,
    fmt_unit,
    hour_label,
    level,
    main_menu_folder,
    playing_time,
    position,
    submenu,
)

_INT = re.compile(r"^\s*[+-]?[0-9]+\s*$")


def py_int(s):
    """int() of a text value as the original (Python 2) helpers saw it."""
    if s is None or not _INT.match(s):
        raise ValueError(s)
    return int(s)


def model_position(pos):
    try:
        parts = pos.split(":")
        item, page = py_int(parts[0]), py_int(parts[1])
        return item if page == 0 else item * page
    except (ValueError, IndexError, AttributeError):
        try:
            return py_int(pos)
        except ValueError:
            return 0


def model_playing_time(r, e, d):
    if r is None or e is None or d is None:
        return None
    if e != 0:
        return e
    if r == 0:
        return r
    return d if r > d else r


def model_level(r, e, d):
    t = model_playing_time(r, e, d)
    if t is None:
        return 0
    if d == 0:
        return 1
    q = t / d
    if 0 < q <= 0.25:
        return 1
    if 0.25 < q <= 0.5:
        return 2
    if 0.5 < q <= 0.75:
        return 3
    if q > 0.75:
        return 4
    return 0


def run(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


POSITIONS = ["3:2", "5:0", "7", "undefined", None, "x:1", "3:", ":4", "3:2:9", " 4 : 2 ", "0:0",
             "-2:3", "+5", "", "1.5", "2:x", "12:12"]


def test_position_edges(spark):
    got = run(spark, [(p,) for p in POSITIONS], "p string", position("p"))
    assert [g[0] for g in got] == [model_position(p) for p in POSITIONS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="0123456789:x -+", max_size=7), min_size=1, max_size=25))
def test_position_matches_model(spark, texts):
    got = run(spark, [(t,) for t in texts], "p string", position("p"))
    assert [g[0] for g in got] == [model_position(t) for t in texts]


TRIPLES = [
    (0.0, 0.0, 0.0), (5.0, 0.0, 10.0), (15.0, 0.0, 10.0), (5.0, 3.0, 10.0), (0.0, 0.0, 10.0),
    (2.5, 0.0, 10.0), (5.0, 0.0, 10.0), (7.5, 0.0, 10.0), (7.6, 0.0, 10.0), (1.0, 0.0, 0.0),
    (-1.0, 0.0, 10.0), (None, 1.0, 2.0), (3.0, None, 2.0), (1.0, 1.0, None), (10.0, 0.0, 10.0),
]


def test_playing_time_and_level_edges(spark):
    got = run(spark, TRIPLES, "r double, e double, d double",
              playing_time("r", "e", "d"), level("r", "e", "d"))
    assert [g[0] for g in got] == [model_playing_time(*t) for t in TRIPLES]
    assert [g[1] for g in got] == [model_level(*t) for t in TRIPLES]


def test_level_ratio_boundaries(spark):
    # exactly .25, .5 and .75 fall in the lower level; ratio 0 is level 0
    rows = [(x, "0", "100") for x in ["0", "25", "25.01", "50", "75", "75.5", "100"]]
    got = run(spark, rows, "r string, e string, d string", level("r", "e", "d"))
    assert [g[0] for g in got] == [0, 1, 2, 2, 3, 4, 4]


def test_text_inputs_not_numbers(spark):
    rows = [("1,234", "0", "10"), ("abc", "0", "10"), ("5", "0", "")]
    got = run(spark, rows, "r string, e string, d string", playing_time("r", "e", "d"), level("r", "e", "d"))
    assert got == [(None, 0), (None, 0), (None, 0)]


def test_capped(spark):
    rows = [("5", "10"), ("15", "10"), ("10", "10"), ("x", "10"), ("5", None), (None, "3")]
    got = run(spark, rows, "r string, d string", capped("r", "d"))
    assert [g[0] for g in got] == [5.0, 10.0, 10.0, None, 5.0, None]


def test_submenu_and_app(spark):
    rows = [("0", "21", "x"), ("00", "23", "x"), ("7", "24", "x"), ("undefined", "99", "FILM"),
            (None, None, None), ("1600", "21", "VOD")]
    got = run(spark, rows, "s string, a string, n string",
              submenu("s"), app_from_id("a", "n"), main_menu_folder("n"))
    assert [g[0] for g in got] == ["1000", "1000", "7", "undefined", None, "1600"]
    assert [g[1] for g in got] == ["VOD", "RELAX", "CHILD", "FILM", None, "VOD"]
    assert [g[2] for g in got] == [None, None, None, None, None, 2]


def test_formatting(spark):
    df = spark.createDataFrame([(1234, "2022-12-01", 7), (0, "2022-12-04", 13), (5, "2022-12-05", 0)],
                               "n long, d string, h int")
    got = df.select(fmt_unit("n", "K"), fmt_unit("n", "M"), day_label(F.col("d").cast("date")),
                    hour_label("h")).collect()
    assert [tuple(r) for r in got] == [
        ("1.234K", "0.001234M", "2022-12-01-Thu", "07"),
        ("0.0K", "0.0M", "2022-12-04-Sun", "13"),
        ("0.005K", "0.000005M", "2022-12-05-Mon", "00"),
    ]


TRICKY = ['12', ' 12 ', '\t12\n', '+12', '-0', '12.0', '12.5', '1e3', '0x1p3', '1.5d', '1.5f', '1_000',
          '١٢', '　12　', ' 12', 'Infinity', ' inf ', '-inf', 'NaN', 'nan', '+nan', '--1', '',
          ' ', 'undefined', 'x:1', '3:2', '9223372036854775808', '.5', '5.', 'Inf', 'INFINITY', '\x0112',
          '12\x00', '1,234', 'null', '0012', None]


def test_guarded_casts_equal_try_cast(spark):
    from vodlens.functions.exprs import num, to_long

    df = spark.createDataFrame([(t,) for t in TRICKY], "s string")
    got = df.select(num("s").alias("a"), F.col("s").try_cast("double").alias("b"),
                    to_long("s").alias("c"), F.col("s").try_cast("bigint").alias("d")).collect()
    for t, r in zip(TRICKY, got):
        same_d = (r["a"] == r["b"]) or (r["a"] != r["a"] and r["b"] != r["b"])  # NaN
        assert same_d, (t, r)
        assert r["c"] == r["d"], (t, r)
