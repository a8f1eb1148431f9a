"""Date predicates written against an explicit ``as_of`` date.

Each predicate is a range on the raw column where the SQL allowed it, so that
Parquet/JDBC scans receive it as a pushed filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def days_since(as_of: dt.date, col: Column | str) -> Column:
    """FN1 ``datediff(CURDATE(), d)``."""
    return F.datediff(F.lit(as_of), _c(col))


def on_or_after(col: Column | str, day: dt.date) -> Column:
    return _c(col) >= F.lit(day)


def text_date_on_or_after(col: Column | str, day: dt.date) -> Column:
    """FLT3: the first 10 characters are an ISO date on or after ``day``.

    The string range is what the scan can use for row-group skipping; it holds for every
    ISO text that passes. The parsed date keeps other text ('n/a', '2024/01/01') out.
    """
    parsed = F.try_to_timestamp(F.substring(_c(col), 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return (_c(col) >= F.lit(day.isoformat())) & (parsed >= F.lit(day))


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def next_month_start(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def month_in_interval(as_of: dt.date, start: Column | str, end: Column | str) -> Column:
    """FLT11 ``left(start,7) <= left(as_of,7) <= left(end,7)``.

    Month-granular comparison rewritten as two plain date ranges:
    start < first day of next month and end >= first day of this month.
    """
    return (_c(start) < F.lit(next_month_start(as_of))) & (_c(end) >= F.lit(month_start(as_of)))


def not_after_day(col: Column | str, as_of: dt.date) -> Column:
    """``ts <= current_timestamp`` for a run on ``as_of``: any time up to the end of that day.

    Written as ``ts < as_of + 1 day`` with a DATE literal, which Spark widens to
    the column's timestamp type and pushes to the scan.
    """
    return _c(col) < F.lit(as_of + dt.timedelta(days=1))
