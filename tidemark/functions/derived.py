"""Derived columns (D-1 ... D-9), all built-in expressions.

Three-valued logic is kept exactly: ``flag_equals`` and ``is_delayed`` are never null, while
``delay_category`` sends a null delay to its last branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.cleaners import ColumnOrName, _c

# --- fixed values: delay category thresholds (minutes, inclusive upper bounds) and labels ---
DELAY_CATEGORIES = ((0, "On Time"), (5, "Slight Delay"), (15, "Moderate Delay"))
DELAY_CATEGORY_OTHER = "Significant Delay"


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """D-1: (end - start) in minutes from whole epoch seconds of each side, rounded to 2; null if either is."""
    return F.round((F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60, 2)


def flag_equals(c: ColumnOrName, value) -> Column:
    """D-2/D-5: ``c == value``, with null read as false."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))


def year_month(c: ColumnOrName) -> Column:
    """D-3: 'yyyy-MM' text."""
    return F.date_format(_c(c), "yyyy-MM")


def year_of(c: ColumnOrName) -> Column:
    """D-3/D-6: calendar year as int."""
    return F.year(_c(c))


def age_days(c: ColumnOrName, as_of: Column | str | None = None) -> Column:
    """D-4: days from ``c`` to ``as_of`` (a date or 'yyyy-MM-dd'; default: today); null if ``c`` is."""
    ref = F.current_date() if as_of is None else (F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
    return F.datediff(ref, _c(c))


def is_delayed(minutes: ColumnOrName) -> Column:
    """D-7: minutes > 0; null minutes -> false."""
    return F.coalesce(_c(minutes) > 0, F.lit(False))


def delay_category(minutes: ColumnOrName) -> Column:
    """D-8: first matching threshold; null minutes fall through to 'Significant Delay'."""
    m = _c(minutes)
    expr = None
    for limit, label in DELAY_CATEGORIES:
        expr = F.when(m <= limit, label) if expr is None else expr.when(m <= limit, label)
    return expr.otherwise(DELAY_CATEGORY_OTHER)


def efficiency(minutes: ColumnOrName, km: ColumnOrName) -> Column:
    """D-9: minutes per km rounded to 2, only when km > 0 (the guard also avoids an ANSI divide error)."""
    return F.when(_c(km) > 0, F.round(_c(minutes) / _c(km), 2))
