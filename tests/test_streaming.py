"""The availableNow increment stream: day-loop semantics and restart."""

from __future__ import annotations

from conftest import frame, ts

from emporia.operators import layout
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir
from emporia.sources import extract
from emporia.streaming.increments import merge_stream


def test_stream_merges_new_runs_once(spark):
    e = ENTITIES["orders"]
    root = fresh_dir(spark, "stream")
    first = frame(
        spark,
        "orders",
        [
            {"order_id": "o5", "order_status": "shipped", "order_purchase_timestamp": ts("2018-03-08 10:00:00")},
            {"order_id": "o5", "order_status": "delivered", "order_purchase_timestamp": ts("2018-03-09 10:00:00")},
        ],
    )
    extract.write_increments(first, f"{root}/exports", e)
    rep = merge_stream(spark, f"{root}/exports", e, f"{root}/fact", f"{root}/ckpt")
    assert rep.rows_inserted == 1
    got = layout.read_entity(spark, f"{root}/fact", e).collect()
    assert [(r.order_id, r.order_status) for r in got] == [("o5", "shipped")]
    # a later run arrives; the restarted stream only reads the new files
    later = frame(spark, "orders", [{"order_id": "o7", "order_purchase_timestamp": ts("2018-03-12 10:00:00")}])
    extract.write_increments(later, f"{root}/exports", e)
    rep2 = merge_stream(spark, f"{root}/exports", e, f"{root}/fact", f"{root}/ckpt")
    assert rep2.rows_read == 1 and rep2.rows_inserted == 1
    assert sorted(r.order_id for r in layout.read_entity(spark, f"{root}/fact", e).collect()) == ["o5", "o7"]


def test_files_of_one_day_meet_in_one_batch(spark):
    """Two units of one item, in two files of a day, share their key: both go in."""
    e = ENTITIES["order_item"]
    root = fresh_dir(spark, "stream2")
    rows = [
        {"order_id": "o", "order_item_id": n, "product_id": "p", "seller_id": "s", "order_purchase_timestamp": ts("2018-03-08 10:00:00")}
        for n in (1.0, 2.0)
    ]
    for i, row in enumerate(rows):
        part = f"{root}/part{i}"
        extract.write_increments(frame(spark, "order_item", [row]), part, e)
        spark.read.schema(e.table).options(**extract.csv_options()).csv(f"{part}/ds=2018-03-09").write.options(
            **extract.csv_options()
        ).mode("append").csv(f"{root}/exports/ds=2018-03-09")
    rep = merge_stream(spark, f"{root}/exports", e, f"{root}/fact", f"{root}/ckpt")
    assert rep.rows_inserted == 2
    assert sorted(r.order_item_id for r in layout.read_entity(spark, f"{root}/fact", e).collect()) == [1.0, 2.0]
