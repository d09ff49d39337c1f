"""Plan properties that matter at scale: what is broadcast, pushed down,
pruned and shuffled."""

from __future__ import annotations

import datetime as dt

from conftest import frame, ts
from pyspark.sql import functions as F

from emporia.operators import layout
from emporia.operators.increment import day_slice
from emporia.operators.joins import small_side
from emporia.operators.merge import new_rows
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir
from emporia.sources import extract, raw_csv


def _plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def test_small_side_broadcasts_only_within_the_bound(spark, capsys):
    big = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(10).withColumnRenamed("id", "k2")
    assert "BroadcastHashJoin" in _plan(big.join(small_side(dim), F.col("k") == F.col("k2")), capsys)
    # a bound smaller than the table: no broadcast hint, the planner may not
    # broadcast on its own estimate either (static threshold is off)
    plan = _plan(big.join(small_side(dim, max_bytes=64), F.col("k") == F.col("k2")), capsys)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_day_slice_pushes_a_range_to_the_scan(spark, capsys):
    path = fresh_dir(spark, "scan")
    frame(spark, "orders", [{"order_id": "a", "order_purchase_timestamp": ts("2018-03-09 10:00:00")}]).write.parquet(path)
    plan = _plan(day_slice(spark.read.parquet(path), "order_purchase_timestamp", "2018-03-09"), capsys)
    assert "GreaterThanOrEqual(order_purchase_timestamp,2018-03-09T00:00)" in plan
    assert "LessThan(order_purchase_timestamp,2018-03-10T00:00)" in plan


def test_increment_reads_only_its_day_folder(spark, capsys, monkeypatch):
    e = ENTITIES["orders"]
    path = fresh_dir(spark, "src")
    rows = [
        {"order_id": f"o{i}", "order_purchase_timestamp": ts(f"2018-03-{d:02d} 10:00:00")}
        for i, d in enumerate((7, 8, 9, 9, 10))
    ]
    raw_csv.write_source(frame(spark, "orders", rows), path, e)
    src = raw_csv.read_source(spark, path, e, with_partition=True)
    seen = {}
    real = extract._write

    def spy(df, *a, **kw):
        seen["plan"] = _plan(df, capsys)
        return real(df, *a, **kw)

    monkeypatch.setattr(extract, "_write", spy)
    res = extract.increment(src, fresh_dir(spark, "exp"), e, dt.date(2018, 3, 10))
    assert res.rows == 2
    assert f"({e.partition_column}#" in seen["plan"] and "= 2018-03-09)" in seen["plan"]
    assert "PartitionFilters: [isnotnull" in seen["plan"]


def test_item_merge_scans_only_the_source_days_without_shuffling_the_target(spark, capsys):
    e = ENTITIES["order_item"]
    items = frame(
        spark,
        "order_item",
        [
            {"order_id": f"o{i}", "product_id": "p", "seller_id": "s", "order_purchase_timestamp": ts(f"2018-03-{d:02d} 10:00:00")}
            for i, d in enumerate((1, 2, 3, 4, 5, 6))
        ],
    )
    path = fresh_dir(spark, "tgt")
    layout.write_table(items, path, mode="overwrite", partition_col=e.partition_column, partition_ts=e.partition_ts)
    target = layout.read_table(spark, path, layout.table_schema(e))
    source = items.filter(F.col("order_id").isin("o2", "o3"))
    plan = _plan(new_rows(source, target, e.merge_key, day_column=(e.partition_column, e.partition_ts)), capsys)
    assert ">= 2018-03-03)" in plan and "<= 2018-03-04)" in plan
    assert "Exchange hashpartitioning" not in plan  # broadcast semi + anti joins


def test_small_sides_checks_several_lookups_in_one_job(spark, capsys):
    from emporia.operators.joins import small_sides

    big = spark.range(1000).withColumnRenamed("id", "k")
    tiny = spark.range(10).withColumnRenamed("id", "a")
    large = spark.range(500).withColumnRenamed("id", "b")
    # a bound between the two sizes: only the tiny lookup is hinted
    a, b = small_sides(tiny, large, max_bytes=100 * 32)
    plan = _plan(big.join(a, F.col("k") == F.col("a")).join(b, F.col("k") == F.col("b")), capsys)
    tree = plan.split("\n\n")[0]  # the operator tree, before the per-node details
    assert tree.count("BroadcastHashJoin") == 1 and tree.count("SortMergeJoin") == 1
