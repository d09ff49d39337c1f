"""Adapter: the driver's TPC-H-like parquet tables → the six warehouse entities.

Every entity is a projection (plus dimension lookups) over a *whole* input
table; nothing is sampled or filtered away, so the work grows with the
data.  Money columns are exposed as DECIMAL(18,2) so sums are exact (the
marts are type-generic and return DOUBLE either way).

Mapping (stated once, shared by the Spark side and the SQL oracle):

* dim_seller   ← supplier ⟕ nation ⟕ region
* dim_product  ← part
* dim_customer ← customer ⟕ nation ⟕ region ⟕ (first order date per customer);
  two customer ids per person (``c_custkey - c_custkey % 2``)
* fact_order     ← orders but those with status P: F delivered, all others shipped
* fact_order_fop ← orders with status P (even key canceled, odd unavailable)
* fact_order_item← lineitem ⟕ orders (purchase timestamp of the order)

So that unmatched keys and missing values occur, some keys are changed and
some values removed by rule, without dropping a row: customers of orders
(key % 43 = 0), products (% 37) and sellers (% 31) of items are unknown,
sellers (% 29) are NULL, and of items with (order + line) % 53 = 0 the
price, % 59 = 0 the line number is NULL.  A customer without any order has
1992-01-01 as the date of first purchase, which staging requires.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: first purchase of customers who have no order
NO_PURCHASE = "1992-01-01"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The column types of the driver's input tables.  Reading
# with a declared schema skips the schema-inference job Spark otherwise
# runs for every read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _plus_days(col: str, n: int):
    return F.col(col) + F.make_dt_interval(days=F.lit(n))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key → (nation name, region name), one row per key.

    Lookups are aggregated on their key, so Catalyst knows they are unique
    and drops the LEFT JOIN altogether when a query uses none of their
    columns.
    """
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .groupBy("n_nationkey")
        .agg(F.min("n_name").alias("n_name"), F.min("r_name").alias("r_name"))
    )


def dim_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    g = _geo(spark, sf_dir)
    return s.join(g, s.s_nationkey == g.n_nationkey, "left").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_nationkey").cast("bigint").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_category_name"),
        F.col("p_type").alias("product_category_name_english"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        F.lit(None).cast("double").alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("double").alias("product_photos_qty"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    g = _geo(spark, sf_dir)
    first = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_purchase_date"))
    )
    return (
        c.join(g, c.c_nationkey == g.n_nationkey, "left")
        .join(first, c.c_custkey == first.o_custkey, "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            (F.col("c_custkey") - F.col("c_custkey") % 2).cast("string").alias("customer_unique_id"),
            F.col("c_nationkey").cast("bigint").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
            F.coalesce("first_purchase_date", F.lit(NO_PURCHASE).cast("timestamp_ntz")).alias("first_purchase_date"),
        )
    )


def _orders(spark: SparkSession, sf_dir: str, chosen, status_expr) -> DataFrame:
    o = read(spark, sf_dir, "orders").filter(chosen)
    customer = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_custkey") % 43 == 0, F.concat(F.lit("unknown-"), customer)).otherwise(customer).alias("customer_id"),
        status_expr.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        _plus_days("o_orderdate", 1).alias("order_approved_at"),
        _plus_days("o_orderdate", 3).alias("order_delivered_carrier_date"),
        _plus_days("o_orderdate", 9).alias("order_delivered_customer_date"),
        _plus_days("o_orderdate", 14).alias("order_estimated_delivery_date"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 4 + 1).cast("double").alias("payment_installments"),
    )


def fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "delivered").otherwise("shipped")
    return _orders(spark, sf_dir, ~F.col("o_orderstatus").eqNullSafe("P"), status)


def fact_order_fop(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 2 == 0, "canceled").otherwise("unavailable")
    return _orders(spark, sf_dir, F.col("o_orderstatus") == "P", status)


def fact_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("order_id", F.col("l_orderkey").cast("string"))
    # purchase timestamp of the item's order, whose key is unique; joined on the
    # string order id, so a later join on order_id reuses this join's hash
    # partitioning, and with no operator between shuffle and sort, so AQE can
    # split a hot order
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_order_id"), "o_orderdate")
    place = F.col("l_orderkey") + F.col("l_linenumber")
    product, seller = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    return li.join(o, li.order_id == o.o_order_id, "left").select(
        F.col("order_id"),
        F.when(place % 59 != 0, F.col("l_linenumber").cast("double")).alias("order_item_id"),
        F.when(F.col("l_partkey") % 37 == 0, F.concat(F.lit("unknown-"), product)).otherwise(product).alias("product_id"),
        F.when(F.col("l_suppkey") % 31 == 0, F.concat(F.lit("unknown-"), seller))
        .when(F.col("l_suppkey") % 29 != 0, seller)
        .alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(place % 53 != 0, F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("freight_value"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


BUILDERS = {
    "dim_seller": dim_seller,
    "dim_product": dim_product,
    "dim_customer": dim_customer,
    "fact_order": fact_order,
    "fact_order_fop": fact_order_fop,
    "fact_order_item": fact_order_item,
}


class Tables(Mapping):
    """The six entities, each built on first access (a query that uses two
    tables does not plan the other four)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def warehouse(spark: SparkSession, sf_dir: str) -> Tables:
    """All six entities as lazy DataFrames."""
    return Tables(spark, sf_dir)
