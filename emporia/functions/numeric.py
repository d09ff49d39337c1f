"""Arithmetic helpers that keep the warehouse's NULL-on-zero semantics.

Spark 4 runs ANSI mode: a plain ``/`` by zero raises, so ratios use
``try_divide`` (NULL on a zero divisor, as SAFE_DIVIDE does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """NULL when ``den`` is 0 or NULL."""
    return F.try_divide(num, den)


def rounded_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(SAFE_DIVIDE(num, den), scale)`` returned as DOUBLE.

    ``round`` is HALF_UP.  With an exact DECIMAL numerator the quotient is
    a decimal, so ties are decided on the exact value, not on a binary
    approximation of it.
    """
    return F.round(safe_divide(num, den), scale).cast("double")


def mean(col: Column) -> Column:
    """``AVG(col)`` as sum over non-NULL count, in DOUBLE.

    For DOUBLE input this is AVG; for an exact DECIMAL input the sum stays
    exact and only the final quotient is rounded to a double.
    """
    return safe_divide(F.sum(col).cast("double"), F.count(col).cast("double"))

