"""Timestamp formats found out from all rows; the stored audit and the reconciliation of layers."""

from __future__ import annotations

import pytest
from conftest import frame, ts

from emporia.functions import date_formats
from emporia.plans import warehouse
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir
from emporia.sources import raw_csv


def _texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def _read(spark, *values, **how):
    df = _texts(spark, *values)
    formats = date_formats.infer(df, ["t"], **how)["t"]
    return [r[0] for r in df.select(date_formats.read(df.t, formats)).collect()]


def test_one_telling_row_settles_day_and_month(spark):
    assert _read(spark, "05/03/2018", "25/03/2018", None) == [ts("2018-03-05"), ts("2018-03-25"), None]
    assert _read(spark, "05/03/2018", "03/25/2018") == [ts("2018-05-03"), ts("2018-03-25")]
    assert _read(spark, "5.3.2018 10:30", "05/03/2018", day_first=True) == [ts("2018-03-05 10:30:00"), ts("2018-03-05")]
    assert _read(spark, "05/05/2018") == [ts("2018-05-05")]  # reads the same either way


def test_formats_mix_and_bad_values_stay_null(spark):
    got = _read(spark, "2018-03-05 01:02:03.250000", "2018-03-05T01:02:03", "2018-03-05", "20180305", "5 Mar 2018", "31/02/2018", "25/12/2018", "x")
    assert got[:5] == [ts("2018-03-05 01:02:03.250000"), ts("2018-03-05 01:02:03"), *[ts("2018-03-05")] * 3]
    assert got[5:] == [None, ts("2018-12-25"), None]
    assert date_formats.infer(_texts(spark, "x", None), ["t"]) == {"t": ()}
    assert date_formats.infer(_texts(spark).limit(0), ["t"]) == {"t": ()} and date_formats.infer(_texts(spark, "x"), []) == {}


def test_ambiguous_orders_are_refused(spark):
    with pytest.raises(date_formats.AmbiguousDates, match="reads? (only|both)|read both"):
        _read(spark, "05/03/2018")
    with pytest.raises(date_formats.AmbiguousDates, match="only"):
        _read(spark, "25/03/2018", "03/25/2018", day_first=True)


def test_ingest_names_the_value_that_is_no_date(spark, tmp_path):
    head = ",".join(f.name for f in ENTITIES["customer"].source.fields)
    with open(f"{tmp_path}/c.csv", "w") as f:
        f.write(f"{head}\nc1,u1,1,x,SP,25/03/2018\nc2,u2,2,y,SP,05/03/2018\n")
    e = ENTITIES["customer"]
    raw_csv.ingest(spark, f"{tmp_path}/c.csv", e, f"{tmp_path}/out", raw_csv.INFER)
    got = {r.customer_id: r.first_purchase_date for r in raw_csv.read_source(spark, f"{tmp_path}/out", e).collect()}
    assert got == {"c1": ts("2018-03-25"), "c2": ts("2018-03-05")}
    with open(f"{tmp_path}/c.csv", "a") as f:
        f.write("c3,u3,3,z,SP,30/02/2018\n")
    with pytest.raises(Exception, match="first_purchase_date.*30/02/2018"):
        raw_csv.ingest(spark, f"{tmp_path}/c.csv", e, f"{tmp_path}/out", raw_csv.INFER)
    assert raw_csv.read_source(spark, f"{tmp_path}/out", e).count() == 2


def _orders(spark, days, status="new"):
    rows = [{"order_id": f"o{d}-{i}", "order_status": status, "order_purchase_timestamp": ts(f"2018-03-{d:02d} 08:00:00")} for d in days for i in range(3)]
    return frame(spark, "orders", rows)


def test_reconciliation_tells_late_changed_and_unmerged_rows(spark):
    wh, e = warehouse.Warehouse(fresh_dir(spark, "wh")).open(spark), ENTITIES["orders"]
    raw_csv.write_source(_orders(spark, [1, 2, 3, 4]), wh.source(e), e)
    warehouse.backfill(spark, wh, "orders", *warehouse.run_dates(spark, wh, "orders"))
    assert {r.status for r in warehouse.reconcile(spark, wh, "orders").collect()} == {"equal"}
    late = frame(spark, "orders", [{"order_id": "late", "order_purchase_timestamp": ts("2018-03-02 23:00:00")}])
    again = frame(spark, "orders", [{"order_id": "o1-0", "order_purchase_timestamp": ts("2018-03-05 08:00:00")}])
    changed = _orders(spark, [1, 2, 4]).unionByName(_orders(spark, [3], "other")).unionByName(late).unionByName(again)
    raw_csv.write_source(changed, wh.source(e), e)
    warehouse.load_entity(spark, wh, "orders", "2018-03-06")  # day 5: its key is there already
    got = {str(r.day)[-1]: (r.source_rows, r.staged_rows, r.final_rows, r.status) for r in warehouse.reconcile(spark, wh, "orders").collect()}
    assert got == {
        "1": (3, 3, 3, "equal"), "2": (4, 3, 3, "late rows"), "3": (3, 3, 3, "changed"), "4": (3, 3, 3, "equal"),
        "5": (1, 1, 0, "not merged"),
    }
    with pytest.raises(ValueError):
        warehouse.reconcile(spark, wh, "seller")


def test_audit_is_kept_over_runs(spark):
    wh, e = warehouse.Warehouse(fresh_dir(spark, "wh")).open(spark), ENTITIES["orders"]
    assert warehouse.audit_history(spark, wh).count() == 0
    raw_csv.write_source(_orders(spark, [1]), wh.source(e), e)
    for day in ("2018-03-02", "2018-03-02", "2018-03-03"):
        warehouse.run_day(spark, wh, day, entities=("orders",))
    got = sorted((str(r.run_date), r.rows_read, r.rows_inserted, r.rows_already_present, r.skipped) for r in warehouse.audit_history(spark, wh).collect())
    assert got == [("2018-03-02", 3, 0, 3, False), ("2018-03-02", 3, 3, 0, False), ("2018-03-03", 0, 0, 0, True)]
