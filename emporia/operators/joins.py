"""Join helpers.

:func:`small_side` broadcasts a lookup only after measuring it.  A lookup
that is itself a join (a dimension enriched with other tables) gets a static
size estimate that is the product of its inputs' sizes, so Spark would plan
a sort-merge join and shuffle the large side once more.  The measurement is
one aggregate, summed map-side: rows and the bytes of their values.  Beyond
the bound the join stays a shuffle join, with AQE splitting skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: largest lookup we broadcast, in measured bytes
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

#: of a row, and of each of its fields, besides the bytes of strings
ROW_BYTES, FIELD_BYTES = 32, 16


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row takes: fixed shares per row and field, and the real length of strings."""
    total = F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
    return total


def measured_bytes(df: DataFrame) -> Column:
    """Aggregate: the bytes of all rows (0 for none)."""
    return F.coalesce(F.sum(row_bytes(df)), F.lit(0))


def small_side(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when its measured size is within ``max_bytes``, else ``df``."""
    return small_sides(df, max_bytes=max_bytes)[0]


def small_sides(*dfs: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> list[DataFrame]:
    """:func:`small_side` for several lookups, measured in one job."""
    if not dfs:
        return []
    probes = [df.agg(measured_bytes(df).alias("n")).select(F.lit(i).alias("lookup"), "n") for i, df in enumerate(dfs)]
    sizes = {r.lookup: r.n for r in reduce(DataFrame.unionByName, probes).collect()}
    return [F.broadcast(df) if sizes[i] <= max_bytes else df for i, df in enumerate(dfs)]
