"""Work that must not grow with ranges, formats, replays or joins that match nothing."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import functions as F

from emporia.functions import date_formats
from emporia.operators import layout, merge, versions
from emporia.operators.catalog import setting
from emporia.plans import registry, warehouse
from emporia.schemas import ENTITIES
from emporia.sources import csv_ranges, extract, raw_csv
from emporia.streaming import increments
from tests.conftest import SF, frame, ts


def test_a_task_takes_many_ranges(spark, tmp_path):
    rows = [("x" * 40 + ("\n" if i % 5 == 0 else ""), str(i)) for i in range(4000)]
    path = raw_csv.write_raw(spark.createDataFrame(rows, "a string, b string").coalesce(1), f"{tmp_path}/raw")
    with ExitStack() as stack:
        stack.enter_context(setting(spark, "spark.sql.files.maxPartitionBytes", "1000"))
        stack.enter_context(setting(spark, "spark.sql.files.openCostInBytes", "10"))
        stack.enter_context(csv_ranges.many_a_task(spark, path))
        lines = csv_ranges._lines(spark, path, None)
        assert lines.select("file", "range").distinct().count() > 150
        assert lines.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + 1
        got = raw_csv.read_raw(spark, path).collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_shapes_are_looked_up(spark):
    shapes = [s for _, s in date_formats.PLAIN] + [s for *_, s in date_formats.RIVALS]
    texts = ["2018-03-05 10:11:12", "2018-03-05T10:11:12.123", "2018-03-05X10:11:12", "5 Oct 2018", "5 TTT 2018", "5/3/2018 10:11"]
    texts += ["05-03-2018", "05.3.2018 10:11:12", "20180305", "2018/3/05", "5-Mar-2018", "5 M4r 2018", "x", "", None, "2018-03-05 10:11:12.1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.coalesce(*[F.when(F.col("t").rlike(f"^{s}$"), i) for i, s in enumerate(shapes)])
    shape = date_formats._shape(F.col("t"))
    assert "RLIKE" not in str(shape).upper()
    assert df.select(shape.eqNullSafe(by_pattern).alias("same"), "t").filter("not same").collect() == []


def _item(order, product, day):
    return {"order_id": order, "product_id": product, "seller_id": "s", "price": 1.0, "order_purchase_timestamp": ts(day)}


def test_a_replayed_epoch_reads_and_writes_nothing(spark, tmp_path, monkeypatch):
    e = ENTITIES["order_item"]
    wh = warehouse.Warehouse(f"{tmp_path}/wh").open(spark)
    rows = frame(spark, "order_item", [_item("1", "a", "2018-01-01"), {**_item("1", "b", "2018-01-02"), "seller_id": None}])
    extract.write_increments(rows, wh.export(e), e)
    written = []
    fresh = increments.fresh_dir
    monkeypatch.setattr(increments, "fresh_dir", lambda *a: written.append(a) or fresh(*a))
    for _ in range(2):
        report = increments.merge_stream(spark, wh.export(e), e, wh.final(e), f"{tmp_path}/checkpoint")
        assert (report.batches, report.rows_read, report.rows_inserted) == (1, 2, 2)
        versions.delete(spark, f"{tmp_path}/checkpoint/commits/0")
    assert len(written) == 1
    assert layout.read_entity(spark, wh.final(e), e).count() == 2


def test_days_that_a_target_lacks_are_not_joined(spark, tmp_path, monkeypatch):
    e = ENTITIES["order_item"]
    wh = warehouse.Warehouse(f"{tmp_path}/wh").open(spark)
    joins = []
    real = merge.new_rows
    monkeypatch.setattr(merge, "new_rows", lambda *a, **k: joins.append(a) or real(*a, **k))
    first = frame(spark, "order_item", [_item("1", "a", "2018-01-01"), _item("1", "a", "2018-01-01")])
    later = frame(spark, "order_item", [_item("2", "a", "2018-01-03")])
    assert [merge.merge_into(spark, df, wh.final(e), e).rows_inserted for df in (first, later)] == [2, 1]
    assert not joins
    both = first.unionByName(later).unionByName(frame(spark, "order_item", [_item("3", "a", "2018-01-02")]))
    assert merge.merge_into(spark, both, wh.final(e), e).rows_inserted == 1 and len(joins) == 1


def test_merge_queries_build_their_rows_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry, "merge_into", lambda spark, source, *rest: seen.append(source))
    registry.QUERIES["merge_order_item"](spark, SF)
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
