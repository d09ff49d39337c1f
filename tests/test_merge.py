"""Insert-only merge: rules 1-4 of the warehouse semantics."""

from __future__ import annotations

import pytest
from conftest import frame, ts

from emporia.operators import layout
from emporia.operators.merge import merge_into, new_rows
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir

T0 = ts("2018-01-05 10:00:00")


def _orders(spark, rows):
    base = {"order_purchase_timestamp": T0}
    return frame(spark, "orders", [{**base, **r} for r in rows])


def _target(spark, entity, df):
    e = ENTITIES[entity]
    path = fresh_dir(spark, f"t_{entity}")
    layout.write_table(
        layout.conform(df, e.table),
        path,
        mode="overwrite",
        partition_col=e.partition_column,
        partition_ts=e.partition_ts,
    )
    return path


def _read(spark, entity, path):
    return layout.read_entity(spark, path, ENTITIES[entity])


def test_rule1_matched_rows_are_never_updated(spark):
    path = _target(spark, "orders", _orders(spark, [{"order_id": "o1", "order_status": "shipped"}]))
    src = _orders(
        spark,
        [{"order_id": "o1", "order_status": "delivered"}, {"order_id": "o2", "order_status": "shipped"}],
    )
    res = merge_into(spark, src, path, ENTITIES["orders"])
    got = sorted((r.order_id, r.order_status) for r in _read(spark, "orders", path).collect())
    assert got == [("o1", "shipped"), ("o2", "shipped")]
    assert (res.rows_read, res.rows_inserted, res.rows_already_present) == (2, 1, 1)


def test_rule2_in_batch_duplicates_all_go_in(spark):
    path = fresh_dir(spark, "empty_target")  # created by the merge
    src = _orders(spark, [{"order_id": "o3"}, {"order_id": "o3"}])
    res = merge_into(spark, src, path, ENTITIES["orders"])
    assert res.rows_inserted == 2
    assert _read(spark, "orders", path).count() == 2


def _item(**kw):
    base = {
        "order_id": "o4",
        "order_item_id": 1.0,
        "product_id": "p",
        "seller_id": "s",
        "order_purchase_timestamp": T0,
        "price": 10.0,
        "freight_value": 1.0,
    }
    base.update(kw)
    return base


def test_rule3_null_key_part_never_matches(spark):
    path = fresh_dir(spark, "items")
    src = frame(spark, "order_item", [_item(seller_id=None)])
    merge_into(spark, src, path, ENTITIES["order_item"])
    merge_into(spark, src, path, ENTITIES["order_item"])
    assert _read(spark, "order_item", path).count() == 2


def test_rule4_item_key_omits_line_number(spark):
    path = fresh_dir(spark, "items4")
    e = ENTITIES["order_item"]
    merge_into(spark, frame(spark, "order_item", [_item(order_item_id=1.0), _item(order_item_id=2.0)]), path, e)
    res = merge_into(spark, frame(spark, "order_item", [_item(order_item_id=3.0)]), path, e)
    lines = sorted(r.order_item_id for r in _read(spark, "order_item", path).collect())
    assert lines == [1.0, 2.0]
    assert res.rows_inserted == 0


def test_merge_twice_equals_merge_once_for_non_null_keys(spark):
    src = _orders(spark, [{"order_id": f"o{i}", "order_status": "shipped"} for i in range(20)])
    once = fresh_dir(spark, "once")
    merge_into(spark, src, once, ENTITIES["orders"])
    twice = fresh_dir(spark, "twice")
    merge_into(spark, src, twice, ENTITIES["orders"])
    merge_into(spark, src, twice, ENTITIES["orders"])
    a = sorted(map(tuple, _read(spark, "orders", once).collect()))
    b = sorted(map(tuple, _read(spark, "orders", twice).collect()))
    assert a == b


def test_prefilter_does_not_change_the_result(spark):
    tgt = frame(spark, "order_item", [_item(order_id=f"x{i}", seller_id=None if i % 3 == 0 else "s") for i in range(12)])
    src = frame(
        spark,
        "order_item",
        [_item(order_id=f"x{i}", seller_id=None if i % 4 == 0 else "s") for i in range(6, 18)],
    )
    keys = ENTITIES["order_item"].merge_key
    with_pf = sorted(map(tuple, new_rows(src, tgt, keys).collect()))
    without = sorted(map(tuple, new_rows(src, tgt, keys, max_bytes=0).collect()))
    assert with_pf == without
    # x6..x11 match unless either side's seller is NULL (x6, x9 in the
    # target, x8 in the source); x12..x17 are new
    assert {r[0] for r in with_pf} == {"x6", "x8", "x9"} | {f"x{i}" for i in range(12, 18)}


def test_not_null_columns_of_the_table_are_enforced(spark):
    path = _target(spark, "orders", _orders(spark, [{"order_id": "o1"}]))
    with pytest.raises(Exception, match="NULL in REQUIRED column order_id"):
        merge_into(spark, _orders(spark, [{"order_id": None}]), path, ENTITIES["orders"])
    assert [r.order_id for r in _read(spark, "orders", path).collect()] == ["o1"]


def test_a_large_source_joins_plainly(spark, capsys):
    """Beyond the broadcast bound: one anti join, no semi join that would hide its skew."""
    target = _orders(spark, [{"order_id": "o1"}])
    new_rows(_orders(spark, [{"order_id": "o2"}]), target, ["order_id"], max_bytes=0).explain("formatted")
    tree = capsys.readouterr().out.split("\n\n")[0]
    assert "LeftAnti" in tree or "SortMergeJoin" in tree
    assert "LeftSemi" not in tree and "Broadcast" not in tree
