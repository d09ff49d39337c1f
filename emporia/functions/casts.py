"""Strict and lenient typed parsing of text columns.

* strict  — the ingest layer: a value that does not parse stops the job,
  and the error names the column and the offending text;
* lenient — the extract layer: a value that does not parse becomes NULL.

Both are built from ``try_cast`` plus ``raise_error``, so they behave the
same whatever the session's ANSI setting is, and stay in whole-stage
codegen (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens pandas.read_csv treats as missing by default
# (pandas documentation, ``na_values``).  The raw files are read with
# these semantics, so each token becomes NULL on ingest.
PANDAS_NULL_TOKENS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nullify_tokens(col: Column | str, tokens: tuple[str, ...] = PANDAS_NULL_TOKENS) -> Column:
    """Map every missing-value token to NULL."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def lenient(col: Column | str, dtype: T.DataType | str, fmt: str | None = None) -> Column:
    """Parse text into ``dtype``; NULL when it does not parse."""
    c = _c(col)
    if fmt is not None and _is_timestamp(dtype):
        # parse and zone conversion both use the session zone (UTC)
        return F.try_to_timestamp(c, F.lit(fmt)).cast(dtype)
    return c.try_cast(dtype)


def strict(col: Column | str, dtype: T.DataType | str, name: str, fmt: str | None = None) -> Column:
    """Parse text into ``dtype``; a non-NULL text that does not parse raises."""
    c = _c(col)
    return required_parse(c, lenient(c, dtype, fmt), dtype, name)


def required_parse(text: Column, parsed: Column, dtype: T.DataType | str, name: str) -> Column:
    """``parsed``, raising with column and value named where ``text`` is there and it is NULL."""
    message = F.concat(F.lit(f"cannot parse column {name} as {_type_name(dtype)}: '"), text.cast("string"), F.lit("'"))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def strict_int_via_double(col: Column | str, name: str) -> Column:
    """``astype(int)`` of a numeric text: '01037' and '1037.0' both give 1037."""
    return strict(col, "double", name).cast("int")


def _is_timestamp(dtype: T.DataType | str) -> bool:
    if isinstance(dtype, str):
        return dtype.lower().startswith("timestamp")
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def _type_name(dtype: T.DataType | str) -> str:
    return dtype if isinstance(dtype, str) else dtype.simpleString()
