"""Date helpers; all are Catalyst built-ins and stay inside codegen.

They accept both ``TIMESTAMP`` and ``TIMESTAMP_NTZ`` inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of(ts: Column | str) -> Column:
    """``DATE(ts)``."""
    return F.to_date(_c(ts))


def month_of(ts: Column | str) -> Column:
    """``DATE_TRUNC(DATE(ts), MONTH)`` as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def on_day(ts: Column | str, day: dt.date | str) -> Column:
    """``DATE(ts) = day`` as a typed literal.

    Catalyst rewrites the comparison on ``to_date`` into a half-open range
    on the raw timestamp, which is pushed to the Parquet reader (row-group
    skipping) and to partition pruning when the day column exists.
    """
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return day_of(ts) == F.lit(day)


def in_days(ts: Column | str, start: dt.date | str, end: dt.date | str) -> Column:
    """``start <= DATE(ts) <= end`` (both ends included)."""
    if isinstance(start, str):
        start = dt.date.fromisoformat(start)
    if isinstance(end, str):
        end = dt.date.fromisoformat(end)
    d = day_of(ts)
    return (d >= F.lit(start)) & (d <= F.lit(end))


def previous_day(day: dt.date | str) -> dt.date:
    """The run of day D extracts the rows of D-1 (``prev_ds``)."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return day - dt.timedelta(days=1)
