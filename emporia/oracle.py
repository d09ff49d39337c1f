"""Independent SQL for the differential check (DuckDB dialect).

The Spark side builds its DataFrames with the DataFrame API; these
strings state the same results in SQL of their own, over the raw tables
the driver registers as views.

Exactness notes:
* money is DECIMAL(18,2) in the adapter, so sums are exact in both engines;
* averages are ``CAST(SUM(x) AS DOUBLE) / COUNT(x)`` on both sides;
* ``ROUND(SAFE_DIVIDE(s, n), 2)`` is computed half-up in whole cents:
  ``(2*cents + n) // (2*n)`` (money here is never negative);
* ``DATE_TRUNC`` returns a timestamp in DuckDB, hence the cast to DATE.
"""

from __future__ import annotations

ADAPTER_CTES = {
    "geo": """
        SELECT n.n_nationkey, MIN(n.n_name) AS n_name, MIN(r.r_name) AS r_name
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY n.n_nationkey""",
    "dim_seller": """
        SELECT CAST(s.s_suppkey AS VARCHAR) AS seller_id,
               CAST(s.s_nationkey AS BIGINT) AS seller_zip_code_prefix,
               g.n_name AS seller_city,
               g.r_name AS seller_state
        FROM supplier s LEFT JOIN geo g ON s.s_nationkey = g.n_nationkey""",
    "dim_product": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_name AS product_category_name,
               p_type AS product_category_name_english,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               CAST(NULL AS DOUBLE) AS product_description_lenght,
               CAST(p_size % 5 AS DOUBLE) AS product_photos_qty,
               CAST(p_size AS DOUBLE) AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size AS DOUBLE) AS product_height_cm,
               CAST(p_size AS DOUBLE) AS product_width_cm
        FROM part""",
    "dim_customer": """
        SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
               CAST(c.c_custkey - c.c_custkey % 2 AS VARCHAR) AS customer_unique_id,
               CAST(c.c_nationkey AS BIGINT) AS customer_zip_code_prefix,
               g.n_name AS customer_city,
               g.r_name AS customer_state,
               coalesce(f.first_purchase_date, TIMESTAMP '1992-01-01') AS first_purchase_date
        FROM customer c
        LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey
        LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_purchase_date
                   FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey""",
    "fact_order": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_custkey % 43 = 0 THEN 'unknown-' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               o_orderdate + INTERVAL 3 DAY AS order_delivered_carrier_date,
               o_orderdate + INTERVAL 9 DAY AS order_delivered_customer_date,
               o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date,
               o_orderpriority AS payment_type,
               CAST(o_orderkey % 4 + 1 AS DOUBLE) AS payment_installments
        FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'""",
    "fact_order_fop": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_custkey % 43 = 0 THEN 'unknown-' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'canceled' ELSE 'unavailable' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               o_orderdate + INTERVAL 3 DAY AS order_delivered_carrier_date,
               o_orderdate + INTERVAL 9 DAY AS order_delivered_customer_date,
               o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date,
               o_orderpriority AS payment_type,
               CAST(o_orderkey % 4 + 1 AS DOUBLE) AS payment_installments
        FROM orders WHERE o_orderstatus = 'P'""",
    "fact_order_item": """
        SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN (l.l_orderkey + l.l_linenumber) % 59 <> 0 THEN CAST(l.l_linenumber AS DOUBLE) END AS order_item_id,
               CASE WHEN l.l_partkey % 37 = 0 THEN 'unknown-' || l.l_partkey ELSE CAST(l.l_partkey AS VARCHAR) END AS product_id,
               CASE WHEN l.l_suppkey % 31 = 0 THEN 'unknown-' || l.l_suppkey
                    WHEN l.l_suppkey % 29 <> 0 THEN CAST(l.l_suppkey AS VARCHAR) END AS seller_id,
               l.l_shipdate AS shipping_limit_date,
               CASE WHEN (l.l_orderkey + l.l_linenumber) % 53 <> 0 THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS price,
               CAST(l.l_quantity AS DECIMAL(18,2)) AS freight_value,
               o.o_orderdate AS order_purchase_timestamp
        FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""",
}


def with_adapter(body: str, **steps: str) -> str:
    """``body`` over the adapter's tables and further named steps."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in (ADAPTER_CTES | steps).items())
    return f"WITH {ctes}\n{body}"


def half_up_cents(sum_expr: str, n_expr: str) -> str:
    """ROUND(SAFE_DIVIDE(sum, n), 2), half-up on the exact decimal quotient."""
    return (
        f"CASE WHEN ({n_expr}) = 0 THEN NULL "
        f"ELSE CAST((2 * CAST(({sum_expr}) * 100 AS BIGINT) + ({n_expr})) // (2 * ({n_expr})) AS DOUBLE) / 100.0 END"
    )


def avg_double(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / NULLIF(COUNT({col}), 0)"


# The marts, from their definitions: each in steps of its own, by other ways
# than the Spark plans take.

#: buyers are looked up once per order, in either fact, and then met by the items
_ACTIVITY_STEPS = {
    "purchase": """
        SELECT f.order_id AS ref, f.order_status AS state_of_order, f.payment_type AS paid_by,
               f.payment_installments AS instalments, f.order_estimated_delivery_date AS promised,
               f.order_delivered_carrier_date AS handed_over, f.order_delivered_customer_date AS arrived, who.*
        FROM (FROM fact_order UNION ALL FROM fact_order_fop) f
        LEFT JOIN (SELECT customer_id AS buyer, customer_unique_id AS person, customer_zip_code_prefix AS zip,
                          customer_state AS region FROM dim_customer) who
          ON who.buyer = f.customer_id""",
}
MART_USER_ACTIVITY = """
SELECT line.order_id, known.product_category_name_english,
       line.order_item_id, line.price::DOUBLE AS price, line.freight_value::DOUBLE AS freight_value,
       purchase.state_of_order AS order_status, purchase.paid_by AS payment_type,
       purchase.instalments AS payment_installments,
       line.order_purchase_timestamp, line.shipping_limit_date,
       purchase.buyer AS customer_id, purchase.person AS customer_unique_id,
       purchase.zip AS customer_zip_code_prefix, purchase.region AS customer_state,
       shop.seller_id, shop.seller_zip_code_prefix, shop.seller_state,
       purchase.promised AS order_estimated_delivery_date,
       purchase.handed_over AS order_delivered_carrier_date,
       purchase.arrived AS order_delivered_customer_date
FROM fact_order_item line
LEFT JOIN dim_product known ON known.product_id = line.product_id
LEFT JOIN dim_seller shop ON shop.seller_id = line.seller_id
LEFT JOIN purchase ON purchase.ref = line.order_id
"""

#: additive measures and distinct sets are worked out apart, then put together
_PERFORMANCE_STEPS = {
    "sold": """
        SELECT known.product_id AS product, known.product_category_name_english AS category,
               done.order_purchase_timestamp::DATE AS day, line.order_id, line.order_item_id,
               line.price, line.freight_value, line.seller_id IN (SELECT seller_id FROM dim_seller) AS shop_known,
               line.seller_id AS shop, person.customer_unique_id AS person
        FROM (SELECT * FROM fact_order WHERE order_status = 'delivered') done
        JOIN fact_order_item line ON line.order_id = done.order_id
        LEFT JOIN dim_product known ON known.product_id = line.product_id
        LEFT JOIN dim_customer person ON person.customer_id = done.customer_id""",
    "sums": """
        SELECT product, category, day, COUNT(order_item_id) AS units, SUM(price) AS revenue, COUNT(price) AS priced,
               MIN(price) AS lowest, MAX(price) AS highest, SUM(freight_value) AS shipping, COUNT(freight_value) AS shipped
        FROM sold GROUP BY product, category, day""",
    "members": """
        SELECT DISTINCT product, category, day, 'shop' AS kind, shop AS member FROM sold WHERE shop_known
        UNION ALL SELECT DISTINCT product, category, day, 'person', person FROM sold WHERE person IS NOT NULL
        UNION ALL SELECT DISTINCT product, category, day, 'order', order_id FROM sold WHERE order_id IS NOT NULL""",
    "reach": """
        SELECT product, category, day, COUNT(*) FILTER (kind = 'shop') AS shops,
               COUNT(*) FILTER (kind = 'person') AS persons, COUNT(*) FILTER (kind = 'order') AS orders_
        FROM members GROUP BY product, category, day""",
}
MART_PRODUCT_PERFORMANCES = f"""
SELECT sums.product AS product_id, sums.category AS product_category_name_english,
       reach.shops AS seller_count, reach.persons AS unique_customer_count,
       sums.units AS total_units_sold, reach.orders_ AS total_orders,
       sums.revenue::DOUBLE AS total_revenue,
       {half_up_cents('sums.revenue', 'sums.units')} AS avg_revenue_per_unit,
       {half_up_cents('sums.revenue', 'reach.persons')} AS avg_revenue_per_customer,
       sums.shipping::DOUBLE AS total_shipping_cost,
       sums.shipping::DOUBLE / NULLIF(sums.shipped, 0) AS avg_shipping_cost,
       sums.revenue::DOUBLE / NULLIF(sums.priced, 0) AS avg_price,
       sums.lowest::DOUBLE AS min_price, sums.highest::DOUBLE AS max_price,
       sums.units::DOUBLE / NULLIF(reach.orders_, 0) AS avg_items_per_order,
       sums.day AS order_date
FROM sums JOIN reach
  ON sums.day = reach.day AND sums.product IS NOT DISTINCT FROM reach.product
 AND sums.category IS NOT DISTINCT FROM reach.category
"""

#: orders with their lines, then the orders that have none
_CUSTOMER_STEPS = {
    "bought": """
        SELECT person.customer_unique_id AS person, person.customer_city AS city, person.customer_state AS region,
               done.order_id, done.order_purchase_timestamp AS moment
        FROM fact_order done JOIN dim_customer person USING (customer_id)
        WHERE done.order_status = 'delivered' AND done.order_purchase_timestamp IS NOT NULL""",
    "rows_": """
        SELECT bought.*, line.order_item_id AS line_no, line.price AS paid
        FROM bought JOIN fact_order_item line ON line.order_id = bought.order_id
        UNION ALL
        SELECT bought.*, NULL, NULL FROM bought
        WHERE NOT EXISTS (FROM fact_order_item line WHERE line.order_id = bought.order_id)""",
}
MART_CUSTOMER_CHARACTERISTICS = f"""
SELECT person AS customer_unique_id, city AS customer_city, region AS customer_state,
       make_date(year(moment), month(moment), 1) AS order_month,
       COUNT(DISTINCT order_id) AS total_orders, COUNT(line_no) AS total_items_bought,
       SUM(paid)::DOUBLE AS total_revenue,
       {half_up_cents('SUM(paid)', 'COUNT(DISTINCT order_id)')} AS avg_revenue_per_order,
       MIN(moment) AS first_purchase_date, MAX(moment) AS last_purchase_date
FROM rows_ GROUP BY person, city, region, year(moment), month(moment)
"""

_LOST_STEPS = {
    "lost": """
        SELECT failed.order_id, failed.order_status, failed.order_purchase_timestamp AS moment,
               line.order_item_id AS line_no, line.price AS missed, line.freight_value AS freight
        FROM fact_order_item line JOIN fact_order_fop failed ON failed.order_id = line.order_id
        UNION ALL
        SELECT order_id, order_status, order_purchase_timestamp, NULL, NULL, NULL FROM fact_order_fop
        WHERE order_id NOT IN (SELECT order_id FROM fact_order_item)""",
}
MART_LOST_REVENUE = """
SELECT make_date(year(moment), month(moment), 1) AS order_month, order_status,
       COUNT(order_id) AS total_fop_orders, COUNT(DISTINCT order_id) AS total_unique_fop_orders,
       SUM(line_no) AS total_fop_items, SUM(missed)::DOUBLE AS total_est_lost_revenue,
       SUM(freight)::DOUBLE AS total_est_lost_shipping_cost
FROM lost GROUP BY year(moment), month(moment), order_status
"""

MARTS = {
    "mart_user_activity": with_adapter(MART_USER_ACTIVITY, **_ACTIVITY_STEPS),
    "mart_product_performances": with_adapter(MART_PRODUCT_PERFORMANCES, **_PERFORMANCE_STEPS),
    "mart_customer_characteristics": with_adapter(MART_CUSTOMER_CHARACTERISTICS, **_CUSTOMER_STEPS),
    "mart_lost_revenue": with_adapter(MART_LOST_REVENUE, **_LOST_STEPS),
}


# ------------------------------------------------------------ operators

CUTOFF = "1998-01-01"
INCREMENT_DAY = "1998-10-03"
EMPTY_DAY = "1990-01-01"
PRUNE_FROM, PRUNE_TO = "1996-01-01", "1996-03-31"

_ORDER_COLS = (
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, "
    "payment_type, payment_installments"
)
_ITEM_COLS = (
    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
    "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, order_purchase_timestamp"
)


def _merge_sql(target_sql: str, source: str, source_cols: str, keys: list[str]) -> str:
    cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in ADAPTER_CTES.items())
    return f"""WITH {ctes},
tgt AS ({target_sql}),
src AS (SELECT {source_cols} FROM {source})
SELECT * FROM tgt
UNION ALL
SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE {cond})
"""


def _status_as(status: str) -> str:
    return _ORDER_COLS.replace("order_status", f"'{status}' AS order_status")


MERGES = {
    "merge_orders": _merge_sql(
        f"SELECT {_status_as('shipped')} FROM fact_order WHERE order_purchase_timestamp < TIMESTAMP '{CUTOFF}'",
        "fact_order",
        _ORDER_COLS,
        ["order_id"],
    ),
    "merge_order_fop": _merge_sql(
        f"SELECT {_status_as('created')} FROM fact_order_fop WHERE order_purchase_timestamp < TIMESTAMP '{CUTOFF}'",
        "fact_order_fop",
        _ORDER_COLS,
        ["order_id"],
    ),
    "merge_order_item": _merge_sql(
        f"SELECT {_ITEM_COLS} FROM fact_order_item WHERE order_purchase_timestamp < TIMESTAMP '{CUTOFF}'",
        "fact_order_item",
        _ITEM_COLS,
        ["order_id", "product_id", "seller_id", "order_purchase_timestamp"],
    ),
    "merge_customer": _merge_sql(
        "SELECT * REPLACE ('old' AS customer_city) FROM dim_customer WHERE CAST(customer_id AS BIGINT) % 2 = 0",
        "dim_customer",
        "*",
        ["customer_id"],
    ),
    "merge_product": _merge_sql(
        "SELECT * REPLACE ('old' AS product_category_name) FROM dim_product WHERE CAST(product_id AS BIGINT) % 2 = 0",
        "dim_product",
        "*",
        ["product_id"],
    ),
    "merge_seller": _merge_sql(
        "SELECT * REPLACE ('old' AS seller_city) FROM dim_seller WHERE CAST(seller_id AS BIGINT) % 2 = 0",
        "dim_seller",
        "*",
        ["seller_id"],
    ),
}

#: text that only quoting keeps: spaces at both ends, quotes, commas, a line break
ODD_PRODUCT = "CASE WHEN order_item_id = 1 THEN '  ' || product_id || ' \"q\", ' || chr(10) || 'x ' ELSE product_id END"

OPERATORS = {
    **MERGES,
    "incremental_extract": with_adapter(
        f"SELECT {_ORDER_COLS} FROM fact_order "
        f"WHERE CAST(order_purchase_timestamp AS DATE) = DATE '{INCREMENT_DAY}'"
    ),
    "incremental_extract_empty": with_adapter(
        f"SELECT {_ORDER_COLS} FROM fact_order "
        f"WHERE CAST(order_purchase_timestamp AS DATE) = DATE '{EMPTY_DAY}'"
    ),
    "extract_skips": with_adapter(
        f"SELECT day, COUNT(order_id) AS extracted_rows, COUNT(order_id) = 0 AS skipped "
        f"FROM (VALUES (DATE '{INCREMENT_DAY}'), (DATE '{EMPTY_DAY}')) AS days(day) "
        f"LEFT JOIN fact_order ON order_purchase_timestamp::DATE = day GROUP BY day"
    ),
    "ingest_transformed": with_adapter(
        "SELECT * REPLACE (CAST(customer_zip_code_prefix AS INTEGER) AS customer_zip_code_prefix, upper(customer_city) AS customer_city) "
        "FROM dim_customer WHERE customer_state <> 'ASIA'"
    ),
    "snapshot_extract": with_adapter("SELECT * FROM dim_customer"),
    "stage_truncate": with_adapter("SELECT * FROM dim_product"),
    "stage_append": with_adapter(f"SELECT {_ORDER_COLS} FROM fact_order"),
    "partition_prune": with_adapter(
        f"SELECT {_ITEM_COLS} FROM fact_order_item WHERE CAST(order_purchase_timestamp AS DATE) "
        f"BETWEEN DATE '{PRUNE_FROM}' AND DATE '{PRUNE_TO}'"
    ),
    "csv_roundtrip": with_adapter(f"SELECT * REPLACE ({ODD_PRODUCT} AS product_id) FROM (SELECT {_ITEM_COLS} FROM fact_order_item)"),
    "stage_truncate_customer": with_adapter("SELECT * FROM dim_customer WHERE CAST(customer_id AS BIGINT) % 2 = 0"),
    "snapshot_twice": with_adapter("SELECT * FROM dim_seller WHERE CAST(seller_id AS BIGINT) % 2 = 0"),
    "ingest_refresh_orders": with_adapter(
        f"SELECT {_ORDER_COLS} FROM fact_order WHERE order_purchase_timestamp >= TIMESTAMP '{CUTOFF}'"
    ),
    "merge_orders_twice": with_adapter(f"SELECT {_ORDER_COLS} FROM fact_order"),
    "ingest_csv_seller": with_adapter(
        """
SELECT seller_id, CAST(seller_zip_code_prefix AS INTEGER) AS seller_zip_code_prefix,
       CASE CAST(seller_id AS BIGINT) % 3
         WHEN 0 THEN NULL
         WHEN 1 THEN ' ' || seller_city || ' "x", y '
         ELSE seller_city || chr(10) || 'z' END AS seller_city,
       seller_state
FROM dim_seller"""
    ),
    "replace_mart": with_adapter(
        f"SELECT * FROM ({MART_LOST_REVENUE}) WHERE order_status = 'canceled' AND order_month >= DATE '{CUTOFF}'", **_LOST_STEPS
    ),
    "backfill_orders": with_adapter(f"SELECT {_ORDER_COLS} FROM fact_order"),
    "backfill_resumed": with_adapter(f"SELECT {_ORDER_COLS} FROM fact_order_fop"),
    "ingest_csv_ranges": with_adapter(
        f"SELECT * REPLACE ({ODD_PRODUCT} AS product_id, CAST(order_item_id AS VARCHAR) AS order_item_id) "
        f"FROM (SELECT {_ITEM_COLS} FROM fact_order_item)"
    ),
    "union_orders": with_adapter(
        f"SELECT {_ORDER_COLS} FROM fact_order UNION ALL SELECT {_ORDER_COLS} FROM fact_order_fop"
    ),
    "date_functions": with_adapter(
        """
SELECT order_id, order_purchase_timestamp,
       CAST(order_purchase_timestamp AS DATE) AS order_date,
       CAST(date_trunc('month', CAST(order_purchase_timestamp AS DATE)) AS DATE) AS order_month,
       CAST(order_estimated_delivery_date AS DATE) AS estimated_delivery_day
FROM (SELECT * FROM fact_order UNION ALL SELECT * FROM fact_order_fop) o"""
    ),
    "agg_count_nonnull_vs_distinct": with_adapter(
        """
SELECT p.product_category_name_english,
       COUNT(oi.order_item_id) AS total_units,
       COUNT(*) AS total_rows,
       COUNT(DISTINCT oi.order_id) AS total_orders,
       COUNT(DISTINCT s.seller_id) AS seller_count,
       COUNT(DISTINCT p.product_id) AS product_count
FROM fact_order_item oi
LEFT JOIN dim_product p ON oi.product_id = p.product_id
LEFT JOIN dim_seller s ON oi.seller_id = s.seller_id
GROUP BY p.product_category_name_english"""
    ),
    "agg_sum_avg_min_max": with_adapter(
        f"""
SELECT o.order_status,
       CAST(SUM(oi.price) AS DOUBLE) AS total_revenue,
       {avg_double('oi.freight_value')} AS avg_shipping_cost,
       {avg_double('oi.price')} AS avg_price,
       CAST(MIN(oi.price) AS DOUBLE) AS min_price,
       CAST(MAX(oi.price) AS DOUBLE) AS max_price,
       MIN(o.order_purchase_timestamp) AS first_purchase,
       MAX(o.order_purchase_timestamp) AS last_purchase
FROM fact_order_item oi
LEFT JOIN (SELECT * FROM fact_order UNION ALL SELECT * FROM fact_order_fop) o
  ON oi.order_id = o.order_id
GROUP BY o.order_status"""
    ),
    "agg_safe_ratio": with_adapter(
        f"""
SELECT oi.seller_id,
       {half_up_cents('SUM(oi.price)', 'COUNT(oi.order_item_id)')} AS revenue_per_unit,
       {half_up_cents('SUM(oi.price)', 'COUNT(DISTINCT c.customer_unique_id)')} AS revenue_per_customer,
       CAST(COUNT(oi.order_item_id) AS DOUBLE) / NULLIF(COUNT(DISTINCT o.order_id), 0) AS items_per_order
FROM fact_order_item oi
LEFT JOIN fact_order o ON oi.order_id = o.order_id
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
GROUP BY oi.seller_id"""
    ),
    "agg_group_by_month": with_adapter(
        """
SELECT c.customer_state,
       CAST(date_trunc('month', CAST(o.order_purchase_timestamp AS DATE)) AS DATE) AS order_month,
       COUNT(DISTINCT o.order_id) AS total_orders,
       COUNT(DISTINCT c.customer_unique_id) AS total_customers,
       MIN(o.order_purchase_timestamp) AS first_purchase,
       MAX(o.order_purchase_timestamp) AS last_purchase
FROM fact_order o
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
GROUP BY 1, 2"""
    ),
    "lenient_cast": """
SELECT l_orderkey AS order_key,
       l_linenumber AS line_number,
       CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS order_item_id,
       CAST(NULL AS DOUBLE) AS returnflag_as_number,
       CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_shipdate AS TIMESTAMP) END AS shipping_limit_date,
       CAST(NULL AS TIMESTAMP) AS linestatus_as_timestamp
FROM lineitem""",
}



def audit_stored() -> str:
    """The second run of a day finds all of its rows present."""
    day = f"(SELECT DATE '{INCREMENT_DAY}' + INTERVAL 1 DAY)::DATE AS run_date"
    orders = f"FROM fact_order WHERE order_purchase_timestamp::DATE = DATE '{INCREMENT_DAY}'"
    first = "COUNT(*) AS rows_read, COUNT(*) AS rows_inserted, 0::BIGINT AS rows_already_present, "
    again = "COUNT(*) AS rows_read, 0::BIGINT AS rows_inserted, COUNT(*) AS rows_already_present, "
    empty = "COUNT(*) = 0 AS skipped "
    parts = [f"SELECT 'product' AS entity, {day}, {c} false AS skipped FROM dim_product" for c in (first, again)]
    parts += [f"SELECT 'orders', {day}, {c} {empty} {orders}" for c in (first, again)]
    return with_adapter("\nUNION ALL\n".join(parts))


def audit_reconcile() -> str:
    """Days on which the source has orders that came after the day was loaded."""
    return with_adapter(
        """
SELECT 'order_fop' AS entity, order_purchase_timestamp::DATE AS day, COUNT(*) AS source_rows,
       COUNT(*) FILTER (order_id::BIGINT % 10 <> 6) AS staged_rows, COUNT(*) FILTER (order_id::BIGINT % 10 <> 6) AS final_rows,
       'late rows' AS status
FROM fact_order_fop GROUP BY 2 HAVING COUNT(*) FILTER (order_id::BIGINT % 10 = 6) > 0"""
    )


# The sources' namespace after a reset and the ingest of sellers.
RESET_NAMESPACE = with_adapter(
    """
SELECT 'seller' AS table_name, COUNT(*) AS table_rows FROM dim_seller
UNION ALL SELECT unnest(['product', 'customer', 'orders', 'order_fop', 'order_item']), 0"""
)

# Checks on a copy of the tables with values removed or made too long by rule.
VIOLATIONS = with_adapter(
    """
SELECT 'dim_seller' AS table_name, 'seller_id' AS column_name, 'required' AS check_name, (SELECT COUNT(*) FROM dim_seller WHERE seller_zip_code_prefix % 7 = 0) AS violations
UNION ALL SELECT 'dim_seller', 'seller_city', 'length>100', (SELECT COUNT(*) FROM dim_seller WHERE seller_zip_code_prefix % 5 = 0)
UNION ALL SELECT 'dim_seller', 'seller_state', 'length>25', (SELECT COUNT(*) FROM dim_seller WHERE seller_zip_code_prefix % 3 = 0)
UNION ALL SELECT 'dim_product', 'product_id', 'required', (SELECT COUNT(*) FROM dim_product WHERE product_weight_g % 7 = 0)
UNION ALL SELECT 'dim_customer', 'customer_id', 'required', (SELECT COUNT(*) FROM dim_customer WHERE customer_zip_code_prefix % 7 = 0)
UNION ALL SELECT 'dim_customer', 'first_purchase_date', 'required', (SELECT COUNT(*) FROM dim_customer WHERE first_purchase_date IS NULL)
UNION ALL SELECT 'dim_customer', 'customer_city', 'length>100', (SELECT COUNT(*) FROM dim_customer WHERE customer_zip_code_prefix % 5 = 0)
UNION ALL SELECT 'dim_customer', 'customer_state', 'length>20', (SELECT COUNT(*) FROM dim_customer WHERE customer_zip_code_prefix % 3 = 0)
UNION ALL SELECT 'fact_order', 'order_id', 'required', (SELECT COUNT(*) FROM fact_order WHERE payment_installments = 1)
UNION ALL SELECT 'fact_order', 'order_purchase_timestamp', 'required', (SELECT COUNT(*) FROM fact_order WHERE payment_installments = 2)
UNION ALL SELECT 'fact_order', 'order_status', 'length>100', (SELECT COUNT(*) FROM fact_order WHERE payment_installments = 3)
UNION ALL SELECT 'fact_order', 'payment_type', 'length>100', (SELECT COUNT(*) FROM fact_order WHERE payment_installments = 4)
UNION ALL SELECT 'fact_order_fop', 'order_id', 'required', (SELECT COUNT(*) FROM fact_order_fop WHERE payment_installments = 1)
UNION ALL SELECT 'fact_order_fop', 'order_purchase_timestamp', 'required', (SELECT COUNT(*) FROM fact_order_fop WHERE payment_installments = 2)
UNION ALL SELECT 'fact_order_fop', 'order_status', 'length>100', (SELECT COUNT(*) FROM fact_order_fop WHERE payment_installments = 3)
UNION ALL SELECT 'fact_order_fop', 'payment_type', 'length>100', (SELECT COUNT(*) FROM fact_order_fop WHERE payment_installments = 4)
UNION ALL SELECT 'fact_order_item', 'order_id', 'required', (SELECT COUNT(*) FROM fact_order_item WHERE freight_value % 2 = 0)
UNION ALL SELECT 'fact_order_item', 'product_id', 'required', (SELECT COUNT(*) FROM fact_order_item WHERE freight_value % 3 = 0)
UNION ALL SELECT 'fact_order_item', 'order_purchase_timestamp', 'required', (SELECT COUNT(*) FROM fact_order_item WHERE order_purchase_timestamp IS NULL)
"""
)
