"""SC17-SC19: display strings for report tables, as Column expressions.

Python-style number formats are rebuilt from ``format_number`` (which
rounds half-even on the exact binary value, like Python's formatter):

* ``thousands(x)``  -> "1,234"          (int with grouping)
* ``money(x)``      -> "1,234.57"       (2 decimals with grouping)
* ``percent(x, 1)`` -> "12.3%"          (x * 100, 1 decimal)
* ``fixed(x, 3)``   -> "4.123"          (no grouping)
NULL becomes "not available" where the report says so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "not available"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def thousands(c: Column | str) -> Column:
    return F.format_number(_col(c).cast("long"), 0)


def money(c: Column | str) -> Column:
    return F.format_number(_col(c).cast("double"), 2)


def fixed(c: Column | str, digits: int) -> Column:
    return F.regexp_replace(F.format_number(_col(c).cast("double"), digits), ",", "")


def percent(c: Column | str, digits: int = 1) -> Column:
    x = _col(c).cast("double") * F.lit(100.0)
    return F.concat(F.regexp_replace(F.format_number(x, digits), ",", ""), F.lit("%"))


def or_not_available(text: Column, value: Column | str) -> Column:
    return F.when(_finite(_col(value)), text).otherwise(F.lit(NOT_AVAILABLE))


def month_label(c: Column | str) -> Column:
    """'2018-03' style label."""
    return F.date_format(_col(c), "yyyy-MM")


def long_month_label(c: Column | str) -> Column:
    """'March 2018' style label."""
    return F.date_format(_col(c), "MMMM yyyy")


def day_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def short_id(c: Column | str, width: int = 8) -> Column:
    """First ``width`` characters followed by '...'."""
    return F.concat(F.substring(_col(c), 1, width), F.lit("..."))
