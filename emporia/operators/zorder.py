"""Clustering on several columns by interleaved ranks (Z-order).

A sort by (a, b, c) keeps rows of one ``a`` together; a filter on ``c`` alone
finds its values in every part of the file.  Here each column's value becomes
its rank among the column's values, a few bits, and the ranks' bits are
interleaved into one sort key: neighbours in the file are near in *all*
columns, so the row groups' min/max statistics skip data for a filter on any
of them.

Ranks come from boundaries between at most ``BUCKETS`` ranges of a column's
distinct values, found by one aggregate over a stored table that looks alike:
for a mart, the version that is about to be replaced.  The boundaries only
decide where rows lie, never which rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ranges that a column's values are divided in (a power of two)
BUCKETS = 64
#: distinct values that boundaries are taken from, those with the smallest hash
SAMPLE = 4096


def boundaries(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, sample: int = SAMPLE) -> dict[str, list]:
    """Per column the values that begin its ranges but the first, in order (none for a column without values)."""
    found = {}
    for c in columns:
        value = F.col(f"`{c}`")
        rows = df.select(value.alias("v")).filter("v is not null").distinct().orderBy(F.xxhash64("v"), "v").limit(sample).collect()
        values = sorted(r.v for r in rows)
        found[c] = [values[len(values) * i // buckets] for i in range(1, buckets)] if len(values) > buckets else values[1:]
    return found


def rank(column: Column, begins: Sequence) -> Column:
    """The number of ranges that begin at or before the value (NULL: 0)."""
    if not begins:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(b) for b in begins]), lambda b: b <= column)
    return F.coalesce(F.when(column.isNotNull(), F.size(below)), F.lit(0))


def key(bounds: dict[str, list], buckets: int = BUCKETS) -> Column:
    """The sort key of a row: its columns' ranks, bits interleaved, the first column's leading."""
    bits = max(1, (buckets - 1).bit_length())
    out = F.lit(0).cast("long")
    for i, (name, begins) in enumerate(bounds.items()):
        place = rank(F.col(f"`{name}`"), begins).cast("long")
        for bit in range(bits):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            out = out + F.shiftleft(one, bit * len(bounds) + len(bounds) - 1 - i)
    return out
