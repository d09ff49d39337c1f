"""Stand-alone queries isolating the aggregate, set and scalar operators the
marts are built from, so each can be checked on its own.

All take the ``{table: DataFrame}`` mapping of the marts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.casts import lenient
from emporia.functions.numeric import mean, rounded_ratio, safe_divide
from emporia.functions.temporal import day_of, month_of
from emporia.operators import checks
from emporia.operators.joins import small_side, small_sides
from emporia.plans.marts import Tables
from emporia.schemas import BY_TABLE
from emporia.schemas import ORDER_COLUMNS


def union_orders(t: Tables) -> DataFrame:
    """``UNION ALL`` of the two order facts (no de-duplication)."""
    return t["fact_order"].select(*ORDER_COLUMNS).unionByName(
        t["fact_order_fop"].select(*ORDER_COLUMNS)
    )


def date_functions(t: Tables) -> DataFrame:
    """``DATE(ts)`` and ``DATE_TRUNC(DATE(ts), MONTH)`` on every order."""
    return union_orders(t).select(
        "order_id",
        "order_purchase_timestamp",
        day_of("order_purchase_timestamp").alias("order_date"),
        month_of("order_purchase_timestamp").alias("order_month"),
        day_of("order_estimated_delivery_date").alias("estimated_delivery_day"),
    )


def agg_count_nonnull_vs_distinct(t: Tables) -> DataFrame:
    """COUNT(col) skips NULLs; COUNT(DISTINCT dim key) skips facts without a match."""
    items = t["fact_order_item"].select(
        "order_id", "order_item_id", F.col("product_id").alias("i_product_id"),
        F.col("seller_id").alias("i_seller_id"),
    )
    prod, sell = small_sides(
        t["dim_product"].select(F.col("product_id").alias("p_product_id"), "product_category_name_english"),
        t["dim_seller"].select(F.col("seller_id").alias("s_seller_id")),
    )
    x = items.join(prod, F.col("i_product_id") == F.col("p_product_id"), "left").join(
        sell, F.col("i_seller_id") == F.col("s_seller_id"), "left"
    )
    return x.groupBy("product_category_name_english").agg(
        F.count("order_item_id").alias("total_units"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("s_seller_id").alias("seller_count"),
        F.count_distinct("p_product_id").alias("product_count"),
    )


def agg_sum_avg_min_max(t: Tables) -> DataFrame:
    """SUM / AVG / MIN / MAX on money and timestamps, per order status."""
    items = t["fact_order_item"].select("order_id", "price", "freight_value")
    orders = union_orders(t).select(
        F.col("order_id").alias("o_order_id"), "order_status", "order_purchase_timestamp"
    )
    x = items.join(orders, F.col("order_id") == F.col("o_order_id"), "left")
    return x.groupBy("order_status").agg(
        F.sum("price").cast("double").alias("total_revenue"),
        mean(F.col("freight_value")).alias("avg_shipping_cost"),
        mean(F.col("price")).alias("avg_price"),
        F.min("price").cast("double").alias("min_price"),
        F.max("price").cast("double").alias("max_price"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )


def agg_safe_ratio(t: Tables) -> DataFrame:
    """Rounded and unrounded ratios of aggregates; NULL on a zero divisor."""
    orders = t["fact_order"].select(F.col("order_id").alias("o_order_id"), "customer_id")
    cust = small_side(t["dim_customer"].select(F.col("customer_id").alias("c_customer_id"), "customer_unique_id"))
    oc = orders.join(cust, F.col("customer_id") == F.col("c_customer_id"), "left")
    items = t["fact_order_item"].select("order_id", "order_item_id", "seller_id", "price")
    x = items.join(oc, F.col("order_id") == F.col("o_order_id"), "left")
    units = F.count("order_item_id")
    revenue = F.sum("price")
    return x.groupBy("seller_id").agg(
        rounded_ratio(revenue, units).alias("revenue_per_unit"),
        rounded_ratio(revenue, F.count_distinct("customer_unique_id")).alias("revenue_per_customer"),
        safe_divide(units.cast("double"), F.count_distinct("o_order_id").cast("double")).alias(
            "items_per_order"
        ),
    )


def agg_group_by_month(t: Tables) -> DataFrame:
    """GROUP BY a column and a computed month (the output alias)."""
    orders = t["fact_order"].select("order_id", "customer_id", "order_purchase_timestamp")
    cust = t["dim_customer"].select(
        F.col("customer_id").alias("c_customer_id"), "customer_unique_id", "customer_state"
    )
    x = orders.join(cust, F.col("customer_id") == F.col("c_customer_id"), "left").withColumn(
        "order_month", month_of("order_purchase_timestamp")
    )
    return x.groupBy("customer_state", "order_month").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("total_customers"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )


def lenient_cast(lineitem: DataFrame) -> DataFrame:
    """Extract-layer parsing: text that does not parse becomes NULL.

    Every third line's number and date is replaced by a flag, text that does
    not parse and comes out NULL; the flag columns never parse.
    """
    junk = F.col("l_linenumber") % 3 == 0
    number = F.when(junk, F.col("l_returnflag")).otherwise(F.col("l_linenumber").cast("double").cast("string"))
    date = F.when(junk, F.col("l_linestatus")).otherwise(F.col("l_shipdate").cast("string"))
    return lineitem.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        lenient(number, "double").alias("order_item_id"),
        lenient(F.col("l_returnflag"), "double").alias("returnflag_as_number"),
        lenient(date, "timestamp_ntz").alias("shipping_limit_date"),
        lenient(F.col("l_linestatus"), "timestamp_ntz").alias("linestatus_as_timestamp"),
    )


def required_violations(t: Tables) -> DataFrame:
    """REQUIRED (staging) and VARCHAR(n) (source) checks of all six tables."""
    parts = []
    for name, df in t.items():
        e = BY_TABLE[name]
        v = checks.violations(df, e.required, e.max_length)
        parts.append(v.select(F.lit(name).alias("table_name"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
