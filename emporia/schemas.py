"""One registry for the six entities of the warehouse.

For each entity it records the typed source-table schema (what raw CSV is
ingested into), the staging/final schema, the REQUIRED columns, the
VARCHAR(n) limits of the source layer, the insert-only merge key, the day
partition column and the clustering columns.

Timestamps are stored as ``TIMESTAMP_NTZ`` holding UTC wall-clock values:
the raw files and the source tables carry no zone, and the session zone is
UTC, so an instant and its UTC wall clock are the same value.  This keeps
day/month derivations independent of any executor's zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
I = T.IntegerType()
L = T.LongType()
TS = T.TimestampNTZType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Table and column names, types, limits, keys and raw files.
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "payment_type",
    "payment_installments",
)
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _order_struct() -> T.StructType:
    types = {c: TS for c in ORDER_TIMESTAMPS}
    types["payment_installments"] = D
    return _struct(*[(c, types.get(c, S)) for c in ORDER_COLUMNS])


@dataclass(frozen=True)
class Entity:
    name: str
    #: typed source table (raw CSV is ingested into this)
    source: T.StructType
    #: staging and final (dimension / fact) table
    table: T.StructType
    #: REQUIRED in staging (load fails on a NULL)
    required: tuple[str, ...]
    #: NOT NULL in the dimension / fact table
    required_final: tuple[str, ...]
    #: VARCHAR(n) limits of the source layer
    max_length: dict[str, int] = field(default_factory=dict)
    #: insert-only merge key (plain equality, NULL never matches)
    merge_key: tuple[str, ...] = ()
    #: timestamp whose DATE partitions staging / final table
    partition_ts: str | None = None
    #: clustering columns (sort order inside each written partition)
    cluster: tuple[str, ...] = ()
    #: increment column: snapshot entities have none
    increment_ts: str | None = None
    #: extract file format of the increment ("parquet" or "csv")
    extract_format: str = "parquet"
    #: staging write disposition: "truncate" (snapshot) or "append"
    staging_mode: str = "truncate"
    #: raw file name
    raw_file: str = ""
    #: final table name
    final_name: str = ""

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.table.fields]

    @property
    def partition_column(self) -> str | None:
        return f"{self.partition_ts}_date" if self.partition_ts else None


SELLER = Entity(
    name="seller",
    source=_struct(
        ("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S)
    ),
    table=_struct(
        ("seller_id", S), ("seller_zip_code_prefix", L), ("seller_city", S), ("seller_state", S)
    ),
    required=("seller_id",),
    required_final=("seller_id",),
    max_length={"seller_city": 100, "seller_state": 25},
    merge_key=("seller_id",),
    cluster=("seller_state",),
    raw_file="raw_seller.csv",
    final_name="dim_seller",
)

_PRODUCT_DOUBLES = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
_PRODUCT = _struct(
    ("product_id", S),
    ("product_category_name", S),
    ("product_category_name_english", S),
    *[(c, D) for c in _PRODUCT_DOUBLES],
)
PRODUCT = Entity(
    name="product",
    source=_PRODUCT,
    table=_PRODUCT,
    required=("product_id",),
    required_final=("product_id",),
    merge_key=("product_id",),
    cluster=("product_category_name_english",),
    raw_file="raw_product.csv",
    final_name="dim_product",
)

CUSTOMER = Entity(
    name="customer",
    source=_struct(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", I),
        ("customer_city", S),
        ("customer_state", S),
        ("first_purchase_date", TS),
    ),
    table=_struct(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", L),
        ("customer_city", S),
        ("customer_state", S),
        ("first_purchase_date", TS),
    ),
    # staging declares first_purchase_date REQUIRED, the dimension does not
    required=("customer_id", "first_purchase_date"),
    required_final=("customer_id",),
    max_length={"customer_city": 100, "customer_state": 20},
    merge_key=("customer_id",),
    partition_ts="first_purchase_date",
    cluster=("customer_state",),
    raw_file="raw_customer.csv",
    final_name="dim_customer",
)

ORDERS = Entity(
    name="orders",
    source=_order_struct(),
    table=_order_struct(),
    required=("order_id", "order_purchase_timestamp"),
    required_final=("order_id", "order_purchase_timestamp"),
    max_length={"order_status": 100, "payment_type": 100},
    merge_key=("order_id",),
    partition_ts="order_purchase_timestamp",
    cluster=("payment_type",),
    increment_ts="order_purchase_timestamp",
    staging_mode="append",
    raw_file="raw_order.csv",
    final_name="fact_order",
)

ORDER_FOP = Entity(
    name="order_fop",
    source=_order_struct(),
    table=_order_struct(),
    required=("order_id", "order_purchase_timestamp"),
    required_final=("order_id", "order_purchase_timestamp"),
    max_length={"order_status": 100, "payment_type": 100},
    merge_key=("order_id",),
    partition_ts="order_purchase_timestamp",
    cluster=("payment_type", "order_status"),
    increment_ts="order_purchase_timestamp",
    staging_mode="append",
    raw_file="raw_order_failed_or_pending.csv",
    final_name="fact_order_fop",
)

ORDER_ITEM = Entity(
    name="order_item",
    source=_struct(
        ("order_id", S),
        ("order_item_id", S),  # VARCHAR in the source layer
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", TS),
        ("price", D),
        ("freight_value", D),
        ("order_purchase_timestamp", TS),
    ),
    table=_struct(
        ("order_id", S),
        ("order_item_id", D),  # FLOAT64 from staging on
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", TS),
        ("price", D),
        ("freight_value", D),
        ("order_purchase_timestamp", TS),
    ),
    required=("order_id", "product_id", "order_purchase_timestamp"),
    required_final=("order_id", "product_id", "order_purchase_timestamp"),
    # order_item_id is not part of the key: see the merge notes
    merge_key=("order_id", "product_id", "seller_id", "order_purchase_timestamp"),
    partition_ts="order_purchase_timestamp",
    increment_ts="order_purchase_timestamp",
    extract_format="csv",
    staging_mode="append",
    raw_file="raw_item.csv",
    final_name="fact_order_item",
)

ENTITIES: dict[str, Entity] = {
    e.name: e for e in (SELLER, PRODUCT, CUSTOMER, ORDERS, ORDER_FOP, ORDER_ITEM)
}

#: final table name -> entity
BY_TABLE: dict[str, Entity] = {e.final_name: e for e in ENTITIES.values()}
