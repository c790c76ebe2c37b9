"""Date columns and the anchor dates of a run.  Nothing here reads the clock."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_key(col) -> Column:
    """``MM/yyyy`` text of a date."""
    return F.date_format(_c(col), "MM/yyyy")


def days_between(start, end) -> Column:
    """Calendar days from start to end (bigint)."""
    return F.datediff(_c(end), _c(start)).cast("bigint")


def whole_months_between(start, end) -> Column:
    """Completed months from start to end; the last day of a shorter month does not complete one."""
    return F.timestamp_diff("MONTH", _c(start), _c(end))


def ts_from_parts(day, clock, offset_hours: int = 0) -> Column:
    """Timestamp from a ``yyyy-MM-dd`` text, an ``HH:mm:ss`` text and an hour offset; NULL if unreadable."""
    text = F.concat_ws(" ", _c(day), _c(clock))
    ts = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return ts + F.expr(f"make_dt_interval(0, {offset_hours})")


def day_in_month(month_start, day) -> Column:
    """The given day of the month, or its last day when the month is shorter."""
    first = F.trunc(_c(month_start), "MM")
    return F.least(F.date_add(first, _c(day) - 1), F.last_day(first))


def anchor_dates(as_of: date) -> dict[str, date]:
    """Named dates that reports hang on, from one explicit run date."""
    first = as_of.replace(day=1)
    last_month = (first - timedelta(days=1)).replace(day=1)
    next_month = (first + timedelta(days=32)).replace(day=1)
    return {
        "today": as_of,
        "yesterday": as_of - timedelta(days=1),
        "first_day_month": first,
        "last_day_month": next_month - timedelta(days=1),
        "first_day_last_month": last_month,
        "last_day_last_month": first - timedelta(days=1),
        "first_day_next_month": next_month,
    }
