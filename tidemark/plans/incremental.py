"""Run window for incremental runs.

The window is a closed date range on a timestamp column, built from literals so Catalyst pushes it to
the Parquet scan (row groups outside the range are skipped). Rows with a null date fall outside every
window; a publishing run reads them beside it, so that its rules can quarantine them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_window(ts: Column, start_date: str | None, end_date: str | None) -> Column:
    """``start_date <= ts < end_date + 1 day`` (dates 'YYYY-MM-DD'; one side may be open)."""
    if not start_date and not end_date:
        raise ValueError("an incremental run needs start_date or end_date")
    cond = F.lit(True)
    if start_date:
        cond = cond & (ts >= F.lit(start_date).cast("date").cast("timestamp_ntz"))
    if end_date:
        nxt = (_dt.date.fromisoformat(end_date) + _dt.timedelta(days=1)).isoformat()
        cond = cond & (ts < F.lit(nxt).cast("date").cast("timestamp_ntz"))
    return cond


def touched_months(start_date: str | None, end_date: str | None) -> Callable[[Column], Column]:
    """Condition on a 'yyyy-MM' column: the window's months, and null (rows without a date)."""

    def touched(month: Column) -> Column:
        cond = F.lit(True)
        if start_date:
            cond = cond & (month >= start_date[:7])
        if end_date:
            cond = cond & (month <= end_date[:7])
        return F.coalesce(cond, F.lit(True))

    return touched
