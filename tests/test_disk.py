"""What a warehouse run keeps on disk: small raw files, no shuffle file after its write, parts that shuffle a share each."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import catalog, layout
from emporia.plans import marts, registry, warehouse
from emporia.schemas import ENTITIES
from emporia.sources import raw_csv
from tests.conftest import SF, frame, ts


def _shuffles(spark):
    """Shuffle files of the session's block manager."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def _item(order, product, day, seller="s"):
    return {
        "order_id": order, "order_item_id": 1.0, "product_id": product, "seller_id": seller,
        "price": 2.5, "freight_value": 1.0, "order_purchase_timestamp": ts(day),
    }


def _order(order, customer, day):
    return {"order_id": order, "customer_id": customer, "order_status": "delivered", "order_purchase_timestamp": ts(day)}


def test_no_shuffle_file_outlives_its_write(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id"), (F.col("id") % 7).cast("int").alias("day"))
    joined = rows.join(rows.withColumnRenamed("day", "other").hint("merge"), "id")
    before = _shuffles(spark)
    for target in (f"{tmp_path}/folder", "default.lean_writes"):
        layout.write_table(joined, target, mode="overwrite", partition_col="day", cluster=("id",))
    until = time.time() + 20
    while (left := _shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.table("default.lean_writes").count() == 2000


def test_raw_files_gzipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_csv, "GZIPPED_ROWS", 10)
    rows = [(str(i), 'a "b"\nc, ' if i % 3 else None) for i in range(35)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    path = raw_csv.write_raw(df, f"{tmp_path}/raw.csv", gzipped=True)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    assert sorted((r.a, r.b) for r in raw_csv.read_raw(spark, path).collect()) == sorted(rows)


def test_the_flow_keeps_its_raw_files_gzipped(spark, monkeypatch):
    made = []
    write = raw_csv.write_raw
    monkeypatch.setattr(raw_csv, "write_raw", lambda *a, **b: made.append(write(*a, **b)) or made[-1])
    monkeypatch.setattr(warehouse, "ingest_all", lambda *a, **b: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        registry.QUERIES["end_to_end_user_activity"](spark, SF)
    assert len(made) == len(ENTITIES)
    files = [f for path in made for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) >= len(made) and all(f.endswith(".csv.gz") for f in files)


def _items_warehouse(spark, tmp_path, rows):
    e = ENTITIES["order_item"]
    wh = warehouse.Warehouse(f"{tmp_path}/wh").open(spark)
    raw_csv.write_source(frame(spark, "order_item", rows), wh.source(e), e)
    return wh, e


def test_a_catch_up_of_items_shuffles_no_item(spark, tmp_path, monkeypatch):
    rows = [_item(str(i), "p", f"2018-01-0{1 + i % 3}", None if i % 2 else "s") for i in range(12)]
    wh, e = _items_warehouse(spark, tmp_path, rows)
    plans = []
    arrange = layout.arrange

    def seen(*a, **b):
        plans.append(arrange(*a, **b))
        return plans[-1]

    monkeypatch.setattr(layout, "arrange", seen)
    audit = warehouse.backfill(spark, wh, "order_item", *warehouse.run_dates(spark, wh, "order_item"))
    assert (audit.rows_read, audit.rows_inserted) == (12, 12) and len(plans) == 2
    assert not any("Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in plans)
    # where the rows to insert come from a join, they are balanced again
    again = warehouse.backfill(spark, wh, "order_item", *warehouse.run_dates(spark, wh, "order_item"))
    assert (again.rows_read, again.rows_inserted) == (12, 6)
    assert "Exchange" in plans[-1]._jdf.queryExecution().executedPlan().toString()
    got = layout.read_entity(spark, wh.final(e), e)
    assert got.count() == 18 and sorted(r.order_id for r in got.filter("seller_id IS NOT NULL").collect()) == sorted(str(i) for i in range(0, 12, 2))


def test_activity_mart_in_parts_equals_the_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "PART_ROWS", 4)
    days = ["2018-01-01", "2018-01-02", "2018-01-02", "2018-01-02", "2018-01-02", "2018-01-05", "2018-01-09"]
    items = [_item(str(i % 9), f"p{i % 4}", days[i % len(days)], (None, "s", "t")[i % 3]) for i in range(30)]
    orders = [_order(str(i % 8), ("c1", "c2", None)[i % 3], "2018-01-03") for i in range(10)]
    wh = warehouse.Warehouse(f"{tmp_path}/wh").open(spark)
    data = {
        "order_item": items,
        "orders": orders,
        "customer": [{"customer_id": "c1", "customer_state": "X", "first_purchase_date": ts("2018-01-01")}] * 2,
        "product": [{"product_id": "p1", "product_category_name_english": "toys"}],
        "seller": [{"seller_id": "s", "seller_state": "Y"}],
    }
    for name, rows in data.items():
        e = ENTITIES[name]
        layout.ensure_final(spark, wh.final(e), e)
        layout.write_table(frame(spark, name, rows), wh.final(e), partition_col=e.partition_column, partition_ts=e.partition_ts, load_id="x")
    parts = warehouse._item_parts(spark, wh)
    held = [{(str(r.order_purchase_timestamp)) for r in p.collect()} for p in parts]
    assert len(parts) > 2 and all(held) and sum(map(len, held)) == len(set.union(*held))
    for _ in range(2):  # the second time laid out by the first one's ranks
        warehouse.build_marts(spark, wh, ("mart_user_activity",))
        got = warehouse.read_mart(spark, wh, "mart_user_activity").drop("order_purchase_date")
        whole = marts.mart_user_activity(warehouse.final_tables(spark, wh)).select(*got.columns)
        assert got.count() > len(items) and got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_an_empty_item_table_is_one_part(spark, tmp_path):
    wh = warehouse.Warehouse(f"{tmp_path}/wh").open(spark)
    warehouse.build_marts(spark, wh, ("mart_user_activity",))
    assert warehouse.read_mart(spark, wh, "mart_user_activity").count() == 0


def test_a_replacement_in_parts_is_shown_whole_or_not_at_all(spark, tmp_path):
    database = "parts_shown"
    catalog.create_namespace(spark, database, f"{tmp_path}/db")
    part = spark.range(6).select(F.col("id"), (F.col("id") % 2).cast("int").alias("day"))
    for target in (f"{database}.t", f"{tmp_path}/folder"):
        layout.replace_table([part, part.withColumn("id", F.col("id") + 10)], target, partition_col="day")
        read = lambda: layout.read_table(spark, target, part.schema)
        assert sorted(r.id for r in read().collect()) == [*range(6), *range(10, 16)]
        lost = part.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("writer lost"))).otherwise(F.col("id")))
        with pytest.raises(Exception, match="writer lost"):
            layout.replace_table([part, lost.withColumn("id", F.col("id").cast("long"))], target, partition_col="day")
        assert read().count() == 12
    with pytest.raises(ValueError, match="in parts"):
        layout.write_table([part, part], f"{tmp_path}/folder")
    # a session that finds the folders takes the finished version
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.IntegerType())])
    catalog.attach(spark, "parts_found", f"{tmp_path}/db", {"t": (schema, ["day"])})
    assert spark.table("parts_found.t").count() == 12
