"""Column expressions shared by the reports (built-in functions only).

Every helper returns a ``Column`` so it stays inside whole-stage codegen; no
Python UDF is involved.  Text fields are converted with ``try_cast`` so a
malformed value becomes NULL (ANSI mode would otherwise fail the job).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Superset patterns of the text ``try_cast`` accepts: integers (ASCII digits,
# sign, surrounding ASCII space/control characters) and doubles (a digit, or
# an inf/nan literal).  ``try_cast`` on other text takes Spark's error path,
# which costs 5-20x a successful cast; the cheap pattern test skips it for
# placeholders such as 'undefined' or ''.  Text passing the test is still
# converted (and judged) by ``try_cast``.
INT_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
NUM_HINT = r"[0-9]|(?i:inf|nan)"


def num(c: ColumnOrName) -> Column:
    """Text → double; anything unparsable is NULL."""
    t = _c(c)
    return F.when(t.rlike(NUM_HINT), t.try_cast("double"))


def to_long(c: ColumnOrName) -> Column:
    """Text → bigint; anything unparsable (or out of range) is NULL."""
    t = _c(c)
    return F.when(t.rlike(INT_TEXT), t.try_cast("bigint"))


def _dbl(c: ColumnOrName) -> Column:
    """Column names are text fields; Columns are already numbers."""
    return num(c) if isinstance(c, str) else c.try_cast("double")


def log_is(*ids: str) -> Column:
    """LogId test, always against text literals."""
    return F.col("LogId").isin(*ids) if len(ids) > 1 else F.col("LogId") == ids[0]


def capped(real: ColumnOrName = "RealTimePlaying", dur: ColumnOrName = "Duration") -> Column:
    """Watched time capped at the content length (FN4).

    ``real >= dur`` gives ``dur``; otherwise, including when either side is not a
    number, ``real``.
    """
    r, d = _dbl(real), _dbl(dur)
    return F.when(r >= d, d).otherwise(r)


def exact(c: ColumnOrName, digits: int = 6) -> Column:
    """A number as a decimal, so that sums are the same in any order of the rows;
    NULL when it is infinite, NaN or out of range."""
    return _c(c).try_cast(f"decimal(28,{digits})")


def time_total(c: ColumnOrName) -> Column:
    """The sum of exact times, rounded to 2 decimals."""
    return F.round(F.sum(_c(c)), 2).cast("double")


def playing_time(real: ColumnOrName, elapsed: ColumnOrName, dur: ColumnOrName) -> Column:
    """Playing time (FN1): the player position when non-zero; else 0 when nothing
    was watched; else watched time capped at the content length.  Any input that
    is not a number gives NULL."""
    r, e, d = _dbl(real), _dbl(elapsed), _dbl(dur)
    return (
        F.when(r.isNull() | e.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(e != 0, e)
        .when(r == 0, r)
        .when(r > d, d)
        .otherwise(r)
    )


def level(real: ColumnOrName, elapsed: ColumnOrName, dur: ColumnOrName) -> Column:
    """Completion level (FN2) of playing time over content length.

    Length 0 → 1; ratio in (0, .25] → 1, (.25, .5] → 2, (.5, .75] → 3, above →
    4; ratio ≤ 0 (or NaN) or any input not a number → 0.

    The quarter buckets are ``ceil(4 · ratio)`` clamped to 0..4 (× 4 is exact in
    binary floating point), so the playing-time expression appears once
    instead of once per bucket test.
    """
    t, d = playing_time(real, elapsed, dur), _dbl(dur)
    quarter = F.ceil(F.try_divide(t, d) * 4)
    return (
        F.when(t.isNull(), 0)
        .when(d == 0, 1)
        .otherwise(F.least(F.greatest(quarter, F.lit(0)), F.lit(4)).cast("int"))
    )


def position(pos: ColumnOrName) -> Column:
    """Screen position score (FN3) of ``"item:page"`` text.

    Both parts integers: page 0 → item, else item × page (parts after the second
    are ignored).  Otherwise the whole text as an integer, else 0.
    The parts are cut with ``substring_index`` (no per-row array).
    """
    p = _c(pos)
    has_page = F.instr(p, ":") > 0
    item = to_long(F.substring_index(p, ":", 1))
    page = to_long(F.substring_index(F.substring_index(p, ":", 2), ":", -1))
    return (
        F.when(
            has_page & item.isNotNull() & page.isNotNull(),
            F.when(page == 0, item).otherwise(F.try_multiply(item, page)),
        )
        .otherwise(F.coalesce(to_long(p), F.lit(0).cast("bigint")))
    )


def is_number(c: ColumnOrName, value: float) -> Column:
    """Numeric equality of a text field, NULL-safe as false (``'0'``, ``'00'``)."""
    return F.coalesce(num(c) == F.lit(value), F.lit(False))


def submenu(c: ColumnOrName = "SubMenuId") -> Column:
    """SubMenuId with the root menu ``0`` reported as ``'1000'`` (FN5)."""
    return F.when(is_number(c, 0), F.lit("1000")).otherwise(_c(c))


# Application ids and the app names they stand for.
APP_BY_ID = {"21": "VOD", "23": "RELAX", "24": "CHILD"}
# Main-menu folder code of each app.
FOLDER_BY_APP = {"VOD": 2, "RELAX": 3, "CHILD": 4}
# The three apps in report order.
MAIN_APPS = ["VOD", "CHILD", "RELAX"]


def app_from_id(app_id: ColumnOrName = "AppId", app_name: ColumnOrName = "AppName") -> Column:
    out = None
    for k, v in APP_BY_ID.items():
        cond = _c(app_id) == k
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(_c(app_name))


def main_menu_folder(app_name: ColumnOrName = "AppName") -> Column:
    up = F.upper(_c(app_name))
    out = None
    for k, v in FOLDER_BY_APP.items():
        out = F.when(up == k, v) if out is None else out.when(up == k, v)
    return out


def key(c: ColumnOrName) -> Column:
    """Text id → bigint join key (numeric match, ``'007'`` = 7)."""
    return to_long(c)
