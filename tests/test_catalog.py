"""Namespaces, registered day partitions, versions, loads that happen once."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import frame, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import catalog, layout, versions
from emporia.operators.merge import merge_into
from emporia.plans import marts, warehouse
from emporia.schemas import ENTITIES
from emporia.session import fresh_dir
from emporia.sources import extract, raw_csv, staging

E = ENTITIES["order_item"]
DAY = "order_purchase_timestamp_date"


def _items(spark, days, seller="s", n=1):
    rows = [
        {"order_id": f"o{d}", "order_item_id": float(i), "product_id": "p", "seller_id": seller,
         "order_purchase_timestamp": ts(f"2018-03-{d:02d} 10:00:00")}
        for d in days for i in range(n)
    ]
    return frame(spark, "order_item", rows)


@pytest.fixture
def wh(spark):
    return warehouse.Warehouse(fresh_dir(spark, "wh")).open(spark)


def _jobs(spark, fn):
    """The number of Spark jobs that ``fn`` starts."""
    sc, group = spark.sparkContext, f"probe-{id(fn)}"
    sc.setJobGroup(group, "probe")
    try:
        fn()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_reset_drops_everything_in_the_namespace(spark, wh):
    e = ENTITIES["seller"]
    raw_csv.write_source(frame(spark, "seller", [{"seller_id": "a"}]), wh.source(e), e)
    spark.sql(f"CREATE TABLE {wh.sources}.stray (x INT) USING parquet")
    wh.reset_sources(spark)
    found = {t.name for t in spark.catalog.listTables(wh.sources)}
    assert "stray" not in found and set(ENTITIES) <= found
    for entity in ENTITIES.values():
        df = raw_csv.read_source(spark, wh.source(entity), entity)
        assert df.count() == 0 and df.schema == T.StructType(entity.source.fields)
    assert spark.catalog.databaseExists(wh.namespace)


def test_one_day_of_many_is_read_without_listing(spark, wh):
    days = [dt.date(2012, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    rows = frame(spark, "orders", [{"order_id": str(d), "order_purchase_timestamp": dt.datetime.combine(d, dt.time(5))} for d in days])
    e = ENTITIES["orders"]
    staging.stage(spark, rows, wh.staging(e), e)
    assert catalog.days(spark, wh.staging(e), DAY) == days
    one = layout.read_entity(spark, wh.staging(e), e, with_partition=True).filter(F.col(DAY) == F.lit(days[60]))
    out = []
    # one job for the rows; a listing of 120 folders would be another
    assert _jobs(spark, lambda: out.extend(one.collect())) == 1
    assert [r.order_id for r in out] == [str(days[60])]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "CatalogFileIndex" in plan or "InMemoryFileIndex(1 paths)" in plan
    assert warehouse.Warehouse(wh.root).namespace == wh.namespace


def test_rows_without_a_day_have_a_partition(spark, wh):
    e = ENTITIES["customer"]
    rows = frame(spark, "customer", [{"customer_id": "a"}, {"customer_id": "b", "first_purchase_date": ts("2018-03-09 10:00:00")}])
    merge_into(spark, rows, wh.final(e), e)
    merge_into(spark, rows, wh.final(e), e)
    got = layout.read_entity(spark, wh.final(e), e, with_partition=True)
    assert sorted(r.customer_id for r in got.collect()) == ["a", "b"]
    assert catalog.days(spark, wh.final(e), e.partition_column) == [dt.date(2018, 3, 9)]


@pytest.mark.parametrize("named", [True, False])
def test_a_failed_replacement_changes_nothing(spark, wh, named):
    e = ENTITIES["product"]
    place = wh.staging(e) if named else fresh_dir(spark, "stg")
    old = frame(spark, "product", [{"product_id": str(i)} for i in range(20)])
    staging.stage(spark, old, place, e)
    reader = staging.read_staging(spark, place, e)  # planned before the replacement
    broken = old.repartition(4).withColumn(
        "product_id", F.when(F.col("product_id") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("product_id"))
    )
    with pytest.raises(Exception, match="lost"):
        staging.stage(spark, broken, place, e)
    assert staging.read_staging(spark, place, e).count() == 20
    staging.stage(spark, old.limit(3), place, e)
    assert staging.read_staging(spark, place, e).count() == 3
    assert reader.count() == 20  # its version stays until the replacement after next
    staging.stage(spark, old.limit(4), place, e)
    staging.stage(spark, old.limit(5), place, e)
    if named:
        assert len(catalog._versions(spark, place)) == 2
    else:
        assert len(versions.folders(spark, place)) == 2
    assert staging.read_staging(spark, place, e).count() == 5


def test_a_lost_snapshot_leaves_the_last_one(spark):
    e, base = ENTITIES["seller"], fresh_dir(spark, "snap")
    rows = frame(spark, "seller", [{"seller_id": str(i)} for i in range(9)])
    path = extract.snapshot(rows, base, e, "2018-03-10").path
    with pytest.raises(Exception, match="lost"):
        extract.snapshot(rows, base, e, "2018-03-11", transform=lambda df: df.withColumn("seller_city", F.raise_error(F.lit("lost"))))
    assert extract.read_snapshot(spark, path, e.table).count() == 9


def test_a_load_happens_once(spark, wh):
    place = wh.final(E)
    rows = _items(spark, [1, 2], seller=None, n=2)  # NULL sellers never match: merged again, they go in again
    first = merge_into(spark, rows, place, E, "epoch 1")
    again = merge_into(spark, rows, place, E, "epoch 1")
    assert (first.rows_inserted, again.rows_inserted, first.replayed, again.replayed) == (4, 4, False, True)
    assert layout.read_entity(spark, place, E).count() == 4
    merge_into(spark, rows, place, E, "epoch 2")
    assert layout.read_entity(spark, place, E).count() == 8
    with pytest.raises(ValueError):
        merge_into(spark, rows, fresh_dir(spark, "x"), E, "epoch 1")


@pytest.mark.parametrize("load", ["epoch 2", "stream file:/a b/c'd=e 2"])
def test_an_uncommitted_load_is_undone_and_done_again(spark, wh, monkeypatch, load):
    place = wh.final(E)
    merge_into(spark, _items(spark, [1]), place, E, "epoch 1")
    rows = _items(spark, [1, 2], n=2).unionByName(_items(spark, [2], seller=None))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(catalog, "commit", die)
        with pytest.raises(RuntimeError):
            merge_into(spark, rows, place, E, load)
    assert layout.read_entity(spark, place, E).count() == 4  # written, not committed
    done = merge_into(spark, rows, place, E, load)
    assert (done.rows_read, done.rows_inserted) == (5, 3)
    got = layout.read_entity(spark, place, E).collect()
    assert sorted((r.order_id, r.seller_id or "") for r in got) == [("o1", "s"), ("o2", ""), ("o2", "s"), ("o2", "s")]


def test_a_stopped_catch_up_goes_on(spark, wh, monkeypatch):
    e = ENTITIES["orders"]
    days = [1, 2, 3, 5, 6, 9, 10]
    rows = [{"order_id": f"o{d}", "order_status": "new", "order_purchase_timestamp": ts(f"2018-03-{d:02d} 08:00:00")} for d in days]
    rows += [{"order_id": f"o{d}", "order_status": "late", "order_purchase_timestamp": ts(f"2018-03-{d + 1:02d} 09:00:00")} for d in days]
    raw_csv.write_source(frame(spark, "orders", rows), wh.source(e), e)
    done, real = [], warehouse.merge_into

    def stops(*args):
        if len(done) == 2:
            raise RuntimeError("killed")
        done.append(args[-1])
        return real(*args)

    first, last = warehouse.run_dates(spark, wh, "orders")
    assert (first, last) == (dt.date(2018, 3, 2), dt.date(2018, 3, 12))
    with monkeypatch.context() as m:
        m.setattr(warehouse, "merge_into", stops)
        with pytest.raises(RuntimeError):
            warehouse.backfill(spark, wh, "orders", first, last, days_per_load=2, job="all of March")
    audit = warehouse.backfill(spark, wh, "orders", first, last, days_per_load=2, job="all of March")
    assert audit.rows_inserted == len(days) and audit.rows_read == audit.rows_inserted + audit.rows_already_present
    got = layout.read_entity(spark, wh.final(e), e).collect()
    assert sorted((r.order_id, r.order_status) for r in got) == sorted((f"o{d}", "new") for d in days)
    loads = spark.table(f"{wh.namespace}.{catalog.LEDGER}").collect()
    assert len(loads) == len({r.load_id for r in loads}) == 5  # nine days with rows, two a load
    again = warehouse.backfill(spark, wh, "orders", first, last, days_per_load=2, job="all of March")
    assert again.rows_inserted == audit.rows_inserted and layout.read_entity(spark, wh.final(e), e).count() == len(days)


def test_another_session_finds_the_tables(spark, wh):
    """A catalog that knows nothing (as a new in-memory one) registers what lies below the folder."""
    e = ENTITIES["product"]
    staging.stage(spark, frame(spark, "product", [{"product_id": "a"}]), wh.staging(e), e)
    staging.stage(spark, frame(spark, "product", [{"product_id": "b"}]), wh.staging(e), e)
    merge_into(spark, _items(spark, [1, 2]), wh.final(E), E, "epoch 1")
    marts.store(marts.mart_lost_revenue(warehouse.final_tables(spark, wh)), wh.mart("mart_lost_revenue"), "mart_lost_revenue")
    other = warehouse.Warehouse(wh.root, namespace="another_" + wh.namespace).open(spark)
    assert [r.product_id for r in staging.read_staging(spark, other.staging(e), e).collect()] == ["b"]
    assert layout.read_entity(spark, other.final(E), E).count() == 2
    assert warehouse.read_mart(spark, other, "mart_lost_revenue").count() == 0
