"""Daily increments: the slice of one purchase day, a range of days, and the
first-day rule that makes a multi-day backfill equal a day-by-day loop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.temporal import on_day


def day_slice(df: DataFrame, ts_col: str, day: dt.date | str) -> DataFrame:
    """Rows with ``DATE(ts_col) = day``; NULL timestamps never match.

    Catalyst turns the predicate into ``ts >= day AND ts < day + 1`` on the
    raw column, pushed to the Parquet reader.
    """
    return df.filter(on_day(ts_col, day))


def first_day_rows(df: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Keep, per key, only the rows of the key's earliest day.

    Loading days one by one, a key first seen on day d inserts all of its
    day-d rows (in-batch duplicates go in together) and later days find it
    present.  Loading the whole range as one batch must therefore keep only
    each key's first-day rows.  Rows with a NULL key part never match, so
    they are all kept.

    Plan: the earliest day per key is an aggregate (partial aggregation
    map-side, so a hot key costs one row per map task), joined back with a
    LEFT SEMI join on key and day (AQE splits a skewed key's partition).
    No window sorts all rows of one key in one task.
    """
    keys = list(keys)
    day = F.to_date(F.col(ts_col))
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else any_null | c
    firsts = (
        df.filter(~any_null)
        .groupBy(*[F.col(k).alias(f"__f_{k}") for k in keys])
        .agg(F.min(day).alias("__f_day"))
    )
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__f_{k}")
        cond = c if cond is None else cond & c
    cond = cond & (day == F.col("__f_day"))
    keyed = df.filter(~any_null).join(firsts, on=cond, how="left_semi")
    return keyed.unionByName(df.filter(any_null))
