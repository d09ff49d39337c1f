"""Properties of the marts on the driver's sf0.001 tables."""

from __future__ import annotations

from conftest import SF
from pyspark.sql import functions as F

from emporia.plans import marts
from emporia.sources import testdata


def test_m2_units_equal_delivered_items(spark):
    t = testdata.warehouse(spark, SF)
    units = marts.mart_product_performances(t).agg(F.sum("total_units_sold")).first()[0]
    delivered = t["fact_order"].filter(F.col("order_status") == "delivered").select("order_id")
    items = t["fact_order_item"].filter(F.col("order_item_id").isNotNull()).join(delivered, "order_id", "left_semi")
    assert units == items.count() > 0


def test_m1_has_one_row_per_item_when_order_ids_are_unique(spark):
    t = testdata.warehouse(spark, SF)
    orders = t["fact_order"].select("order_id").unionByName(t["fact_order_fop"].select("order_id"))
    assert orders.count() == orders.distinct().count()
    assert marts.mart_user_activity(t).count() == t["fact_order_item"].count()


def test_m4_unique_orders_equal_failed_or_pending_orders(spark):
    t = testdata.warehouse(spark, SF)
    m4 = marts.mart_lost_revenue(t).agg(
        F.sum("total_unique_fop_orders").alias("orders"), F.sum("total_fop_orders").alias("rows")
    ).first()
    fop = t["fact_order_fop"]
    assert m4.orders == fop.count()
    joined_rows = fop.join(t["fact_order_item"], "order_id", "left").count()
    assert m4.rows == joined_rows
