"""Display formatting: day labels, hour labels, counts in thousands/millions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import ColumnOrName, _c


def day_label(day: ColumnOrName) -> Column:
    """``yyyy-MM-dd-Mon`` style label (FN8), English day abbreviation."""
    return F.date_format(_c(day), "yyyy-MM-dd-E")


def hour_label(h: ColumnOrName) -> Column:
    """Hour as two characters, ``'07'`` (FN9)."""
    return F.lpad(_c(h).cast("string"), 2, "0")


def fmt_unit(x: ColumnOrName, unit: str = "K") -> Column:
    """Count → ``'<x/1000>K'``; any other unit divides by one million (FN10).  Plain
    decimals, at least one and no needless zeros: never an exponent."""
    exact = _c(x).cast("decimal(29,0)") / F.lit(1000 if unit == "K" else 1000000).cast("decimal(7,0)")
    digits = F.regexp_replace(exact.cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.concat(digits, F.lit(unit))
