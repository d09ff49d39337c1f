"""Interleaved-rank layout: what a filter on each clustering column can skip."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from emporia.operators import layout, zorder
from emporia.plans import marts, warehouse
from emporia.session import fresh_dir
from emporia.sources import testdata

SF = "/root/testdata/sf0.001"
COLUMNS = ["a", "b", "c"]


def _touched(path, column, value):
    """The share of row groups whose statistics don't rule ``value`` out."""
    hit = total = 0
    for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    assert total >= 20
    return hit / total


@pytest.fixture(scope="module")
def layouts(spark):
    def word(seed):
        return F.concat(F.lit("v"), F.lpad((F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(90))).cast("string"), 3, "0"))

    rows = spark.range(240_000, numPartitions=1).select(*[word(i).alias(c) for i, c in enumerate(COLUMNS)], "id")
    bounds = zorder.boundaries(rows, COLUMNS)
    out = {}
    for name, order in (("sorted", COLUMNS), ("interleaved", [zorder.key(bounds)])):
        out[name] = fresh_dir(spark, name)
        small = rows.sortWithinPartitions(*order).write.option("parquet.block.size", 16 << 10).option("parquet.page.size", 4 << 10)
        small.option("parquet.page.size.row.check.min", 100).option("parquet.block.size.row.check.min", 100).parquet(out[name])
    return out


def test_a_filter_on_the_third_column_skips_row_groups(spark, layouts):
    share = {name: {c: _touched(path, c, "v041") for c in COLUMNS} for name, path in layouts.items()}
    assert share["sorted"]["c"] > 0.9
    for c in COLUMNS:
        assert share["interleaved"][c] < 0.6
    both = [sorted(map(tuple, spark.read.parquet(p).collect())) for p in layouts.values()]
    assert both[0] == both[1]


def test_keys_interleave_ranks(spark):
    df = spark.createDataFrame([(1, "x"), (5, "y"), (9, None), (None, "z")], "n int, s string")
    bounds = zorder.boundaries(df, ["n", "s"])
    assert bounds == {"n": [5, 9], "s": ["y", "z"]}
    got = [r[0] for r in df.select(zorder.key(bounds)).collect()]
    assert got == [0, 0b11, 0b1000, 0b0100]  # n's bits before s's
    assert zorder.boundaries(df.limit(0), ["n"]) == {"n": []}
    assert len(zorder.boundaries(spark.range(1000), ["id"])["id"]) == zorder.BUCKETS - 1


@pytest.mark.parametrize("named", [True, False])
def test_a_replaced_mart_keeps_its_rows(spark, named):
    wh = warehouse.Warehouse(fresh_dir(spark, "wh")).open(spark)
    name = "mart_user_activity"
    place = wh.mart(name) if named else fresh_dir(spark, "mart")
    mart = marts.MARTS[name](testdata.warehouse(spark, SF))
    marts.store(mart, place, name)
    first = sorted(map(str, marts.read_stored(spark, place, name).collect()))
    marts.store(mart, place, name)  # laid out by the first version's ranks
    assert sorted(map(str, marts.read_stored(spark, place, name).collect())) == first
    assert layout.exists(spark, place)
