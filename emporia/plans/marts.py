"""The four analytical marts, as pure functions of the dimension/fact tables.

Each takes a mapping ``{table name: DataFrame}`` (``dim_seller``,
``dim_product``, ``dim_customer``, ``fact_order``, ``fact_order_fop``,
``fact_order_item``) and returns a lazy DataFrame; writing is separate
(:func:`emporia.operators.layout.replace_table`).  The functions are
type-generic in the money columns (DOUBLE or exact DECIMAL) and return
DOUBLE measures.

Plan shape, chosen for data far larger than memory:

* The item table is the largest input; it is shuffled once, on
  ``order_id``.  Lookups that only depend on the order (customer) are
  joined onto the much smaller order side first.  For left joins whose
  condition rejects NULLs on the order side this regrouping is exact:
  ``(I ⟕ O) ⟕ C = I ⟕ (O ⟕ C)``.
* Where a mart aggregates items per order anyway (customer, lost
  revenue), items are pre-aggregated per ``order_id`` before the join.
  The aggregate partially combines map-side, its output is already
  hash-partitioned on ``order_id`` (the join reuses it without another
  exchange), and the join then handles one row per order instead of one
  per item.  Every measure is additive over the join's fan-out, so the
  result equals the row-level query, duplicates and NULLs included.
* Dimension lookups are broadcast only when their measured size is
  small (:func:`emporia.operators.joins.small_side`); otherwise they are
  sort-merge joins and AQE splits skewed join partitions (a hot product,
  seller or a NULL key on the item side).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.numeric import mean, rounded_ratio, safe_divide
from emporia.functions.temporal import day_of, month_of
from emporia.operators import layout
from emporia.operators.catalog import lean_writes
from emporia.operators.joins import small_side, small_sides

Tables = Mapping[str, DataFrame]

ORDER_LOOKUP_COLUMNS = (
    "customer_id",
    "order_status",
    "payment_type",
    "payment_installments",
    "order_estimated_delivery_date",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
)


def _customer_columns(t: Tables, *cols: str) -> DataFrame:
    return t["dim_customer"].select(F.col("customer_id").alias("c_customer_id"), *cols)


def _customers(t: Tables, *cols: str) -> DataFrame:
    return small_side(_customer_columns(t, *cols))


def mart_user_activity(t: Tables) -> DataFrame:
    """One row per item and matching order (orders ∪ failed/pending orders).

    Every join is a LEFT JOIN: items whose order, customer, product or
    seller is unknown keep NULLs in those columns.  ``customer_id`` and
    ``seller_id`` come from the dimensions, the purchase timestamp from
    the item.
    """
    return _activity(t["fact_order_item"], *_activity_lookups(t))


def user_activity_parts(t: Tables, items: Sequence[DataFrame], path: str) -> list[DataFrame]:
    """:func:`mart_user_activity` of each of ``items``, parts of the item table; together they are the mart.

    The orders with their customers are written to ``path`` once for all parts,
    where there are several.
    """
    oc, prod, sell = _activity_lookups(t)
    if len(items) > 1:
        with lean_writes(oc.sparkSession):
            oc.write.parquet(path)
        oc = oc.sparkSession.read.schema(oc.schema).parquet(path)
    return [_activity(part, oc, prod, sell) for part in items]


def _activity_lookups(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders with their customers, products and sellers, as the items of the activity mart meet them."""
    cols = ("order_id", *ORDER_LOOKUP_COLUMNS)
    orders = t["fact_order"].select(*cols).unionByName(t["fact_order_fop"].select(*cols))
    cust, prod, sell = small_sides(
        _customer_columns(t, "customer_unique_id", "customer_zip_code_prefix", "customer_state"),
        t["dim_product"].select(
            F.col("product_id").alias("p_product_id"), "product_category_name_english"
        ),
        t["dim_seller"].select(
            F.col("seller_id").alias("s_seller_id"), "seller_zip_code_prefix", "seller_state"
        ),
    )
    oc = orders.join(cust, orders.customer_id == cust.c_customer_id, "left").select(
        F.col("order_id").alias("o_order_id"),
        *ORDER_LOOKUP_COLUMNS[1:],
        F.col("c_customer_id").alias("customer_id"),
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_state",
    )
    return oc, prod, sell


def _activity(items: DataFrame, oc: DataFrame, prod: DataFrame, sell: DataFrame) -> DataFrame:
    items = items.select(
        "order_id",
        "order_item_id",
        F.col("product_id").alias("i_product_id"),
        F.col("seller_id").alias("i_seller_id"),
        "price",
        "freight_value",
        "order_purchase_timestamp",
        "shipping_limit_date",
    )
    joined = (
        items.join(oc, items.order_id == oc.o_order_id, "left")
        .join(prod, F.col("i_product_id") == prod.p_product_id, "left")
        .join(sell, F.col("i_seller_id") == sell.s_seller_id, "left")
    )
    return joined.select(
        F.col("order_id"),
        F.col("product_category_name_english"),
        F.col("order_item_id").cast("double").alias("order_item_id"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
        F.col("order_status"),
        F.col("payment_type"),
        F.col("payment_installments"),
        F.col("order_purchase_timestamp"),
        F.col("shipping_limit_date"),
        F.col("customer_id"),
        F.col("customer_unique_id"),
        F.col("customer_zip_code_prefix"),
        F.col("customer_state"),
        F.col("s_seller_id").alias("seller_id"),
        F.col("seller_zip_code_prefix"),
        F.col("seller_state"),
        F.col("order_estimated_delivery_date"),
        F.col("order_delivered_carrier_date"),
        F.col("order_delivered_customer_date"),
    )


def mart_product_performances(t: Tables) -> DataFrame:
    """Per product (dimension side) × purchase day, delivered orders only.

    The filter on the order's status turns the item→order LEFT JOIN into an
    inner join; product and seller stay LEFT, so items of unknown products
    form a NULL ``product_id`` group, and ``seller_count`` counts
    dimension-side sellers only.
    """
    orders = (
        t["fact_order"]
        .filter(F.col("order_status") == "delivered")
        .select(
            F.col("order_id").alias("o_order_id"),
            "customer_id",
            day_of("order_purchase_timestamp").alias("order_date"),
        )
    )
    cust, prod, sell = small_sides(
        _customer_columns(t, "customer_unique_id"),
        t["dim_product"].select(
            F.col("product_id").alias("p_product_id"), "product_category_name_english"
        ),
        t["dim_seller"].select(F.col("seller_id").alias("s_seller_id")),
    )
    oc = orders.join(cust, orders.customer_id == cust.c_customer_id, "left").select(
        "o_order_id", "order_date", "customer_unique_id"
    )
    items = t["fact_order_item"].select(
        "order_id",
        "order_item_id",
        F.col("product_id").alias("i_product_id"),
        F.col("seller_id").alias("i_seller_id"),
        "price",
        "freight_value",
    )
    x = (
        items.join(oc, items.order_id == oc.o_order_id, "inner")
        .join(prod, F.col("i_product_id") == prod.p_product_id, "left")
        .join(sell, F.col("i_seller_id") == sell.s_seller_id, "left")
    )
    units = F.count("order_item_id")
    orders_n = F.count_distinct("order_id")
    revenue = F.sum("price")
    return x.groupBy(
        F.col("p_product_id").alias("product_id"),
        F.col("product_category_name_english"),
        F.col("order_date"),
    ).agg(
        F.count_distinct("s_seller_id").alias("seller_count"),
        F.count_distinct("customer_unique_id").alias("unique_customer_count"),
        units.alias("total_units_sold"),
        orders_n.alias("total_orders"),
        revenue.cast("double").alias("total_revenue"),
        rounded_ratio(revenue, units).alias("avg_revenue_per_unit"),
        rounded_ratio(revenue, F.count_distinct("customer_unique_id")).alias(
            "avg_revenue_per_customer"
        ),
        F.sum("freight_value").cast("double").alias("total_shipping_cost"),
        mean(F.col("freight_value")).alias("avg_shipping_cost"),
        mean(F.col("price")).alias("avg_price"),
        F.min("price").cast("double").alias("min_price"),
        F.max("price").cast("double").alias("max_price"),
        safe_divide(units.cast("double"), orders_n.cast("double")).alias("avg_items_per_order"),
    ).select(
        "product_id",
        "product_category_name_english",
        "seller_count",
        "unique_customer_count",
        "total_units_sold",
        "total_orders",
        "total_revenue",
        "avg_revenue_per_unit",
        "avg_revenue_per_customer",
        "total_shipping_cost",
        "avg_shipping_cost",
        "avg_price",
        "min_price",
        "max_price",
        "avg_items_per_order",
        "order_date",
    )


def _items_per_order(t: Tables, *aggs) -> DataFrame:
    """Items pre-aggregated per order (partial aggregation runs map-side)."""
    return t["fact_order_item"].groupBy(F.col("order_id").alias("a_order_id")).agg(*aggs)


def mart_customer_characteristics(t: Tables) -> DataFrame:
    """Per person (customer_unique_id) × city × state × purchase month, delivered orders."""
    per_order = _items_per_order(
        t,
        F.count("order_item_id").alias("n_items"),
        F.sum("price").alias("revenue"),
    )
    orders = (
        t["fact_order"]
        .filter(
            (F.col("order_status") == "delivered")
            & F.col("order_purchase_timestamp").isNotNull()
        )
        .select("order_id", "customer_id", "order_purchase_timestamp")
    )
    o = orders.join(per_order, orders.order_id == per_order.a_order_id, "left")
    cust = _customers(t, "customer_unique_id", "customer_city", "customer_state")
    x = cust.join(o, cust.c_customer_id == o.customer_id, "inner")
    orders_n = F.count_distinct("order_id")
    revenue = F.sum("revenue")
    return x.groupBy(
        "customer_unique_id",
        "customer_city",
        "customer_state",
        month_of("order_purchase_timestamp").alias("order_month"),
    ).agg(
        orders_n.alias("total_orders"),
        F.coalesce(F.sum("n_items"), F.lit(0)).cast("bigint").alias("total_items_bought"),
        revenue.cast("double").alias("total_revenue"),
        rounded_ratio(revenue, orders_n).alias("avg_revenue_per_order"),
        F.min("order_purchase_timestamp").alias("first_purchase_date"),
        F.max("order_purchase_timestamp").alias("last_purchase_date"),
    )


def mart_lost_revenue(t: Tables) -> DataFrame:
    """Per purchase month × status over failed/pending orders.

    Measures keep the warehouse's definitions: ``total_fop_orders`` counts
    order×item rows (an order with three items counts three times, one
    without items once), ``total_unique_fop_orders`` counts orders, and
    ``total_fop_items`` adds the items' line *numbers* (1+2+3 = 6.0).
    """
    per_order = _items_per_order(
        t,
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("order_item_id").alias("line_number_sum"),
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("shipping"),
    )
    fop = t["fact_order_fop"].select("order_id", "order_status", "order_purchase_timestamp")
    x = fop.join(per_order, fop.order_id == per_order.a_order_id, "left")
    # rows the item join produces for this order; COUNT(o.order_id) skips a NULL id
    fanout = F.when(F.col("order_id").isNull(), F.lit(0)).otherwise(
        F.coalesce(F.col("n_rows"), F.lit(1))
    )
    return x.groupBy(
        month_of("order_purchase_timestamp").alias("order_month"), "order_status"
    ).agg(
        F.sum(fanout).cast("bigint").alias("total_fop_orders"),
        F.count_distinct("order_id").alias("total_unique_fop_orders"),
        F.sum("line_number_sum").cast("double").alias("total_fop_items"),
        F.sum("revenue").cast("double").alias("total_est_lost_revenue"),
        F.sum("shipping").cast("double").alias("total_est_lost_shipping_cost"),
    )


MARTS = {
    "mart_user_activity": mart_user_activity,
    "mart_product_performances": mart_product_performances,
    "mart_customer_characteristics": mart_customer_characteristics,
    "mart_lost_revenue": mart_lost_revenue,
}

#: partition column and clustering columns of each mart when written
MART_LAYOUT = {
    "mart_user_activity": (
        "order_purchase_date",
        ("customer_state", "seller_state", "product_category_name_english"),
    ),
    "mart_product_performances": ("order_date", ("product_category_name_english",)),
    "mart_customer_characteristics": ("order_month", ("customer_state",)),
    "mart_lost_revenue": ("order_month", ("order_status",)),
}

#: columns of each mart, in order
MART_SCHEMAS = {
    "mart_user_activity": (
        "order_id string, product_category_name_english string, order_item_id double, price double, freight_value double, "
        "order_status string, payment_type string, payment_installments double, order_purchase_timestamp timestamp_ntz, "
        "shipping_limit_date timestamp_ntz, customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
        "customer_state string, seller_id string, seller_zip_code_prefix bigint, seller_state string, "
        "order_estimated_delivery_date timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz"
    ),
    "mart_product_performances": (
        "product_id string, product_category_name_english string, seller_count bigint, unique_customer_count bigint, "
        "total_units_sold bigint, total_orders bigint, total_revenue double, avg_revenue_per_unit double, "
        "avg_revenue_per_customer double, total_shipping_cost double, avg_shipping_cost double, avg_price double, "
        "min_price double, max_price double, avg_items_per_order double, order_date date"
    ),
    "mart_customer_characteristics": (
        "customer_unique_id string, customer_city string, customer_state string, order_month date, total_orders bigint, "
        "total_items_bought bigint, total_revenue double, avg_revenue_per_order double, "
        "first_purchase_date timestamp_ntz, last_purchase_date timestamp_ntz"
    ),
    "mart_lost_revenue": (
        "order_month date, order_status string, total_fop_orders bigint, total_unique_fop_orders bigint, "
        "total_fop_items double, total_est_lost_revenue double, total_est_lost_shipping_cost double"
    ),
}


def store(df: DataFrame | Sequence[DataFrame], path: str, name: str) -> None:
    """Replace a stored mart, by its rows or by parts of them: day partitions, sorted by the clustering columns."""
    part, cluster = MART_LAYOUT[name]
    columns = (df if isinstance(df, DataFrame) else df[0]).columns
    ts = "order_purchase_timestamp" if part not in columns else None
    layout.replace_table(df, path, partition_col=part, cluster=cluster, partition_ts=ts)


def stored_schema(name: str) -> T.StructType:
    """A stored mart's columns as defined, then the partition column where it is an extra one."""
    part, _ = MART_LAYOUT[name]
    schema = T.StructType.fromDDL(MART_SCHEMAS[name])
    return schema if part in schema.names else schema.add(part, T.DateType())


def read_stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored mart, its columns in the order of :func:`stored_schema`."""
    schema = stored_schema(name)
    return layout.read_table(spark, path, schema).select(*schema.names)
