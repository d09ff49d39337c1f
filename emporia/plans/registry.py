"""Named queries over the driver's tables, with their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  Queries that exercise a
write path (staging, merge, CSV) write into a fresh namespace below the shared
work folder (:func:`emporia.session.fresh_dir`) and return the table read back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia import oracle
from emporia.functions.temporal import previous_day
from emporia.operators import layout, versions
from emporia.operators.catalog import setting
from emporia.operators.merge import merge_into
from emporia.plans import aggregates, marts, warehouse
from emporia.schemas import BY_TABLE, ENTITIES, ORDER_TIMESTAMPS
from emporia.session import fresh_dir
from emporia.sources import csv_ranges, extract, raw_csv, staging, testdata

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _mart_query(name: str) -> Query:
    build = marts.MARTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(testdata.warehouse(spark, sf_dir))

    run.__name__ = name
    return run


for _name in marts.MARTS:
    register(_name, oracle.MARTS[_name])(_mart_query(_name))


# ------------------------------------------------------------ operators

CUTOFF = _dt.date.fromisoformat(oracle.CUTOFF)


def _before_cutoff(col: str):
    return F.col(col) < F.lit(_dt.datetime.combine(CUTOFF, _dt.time())).cast("timestamp_ntz")


def _fresh_warehouse(spark: SparkSession, label: str) -> warehouse.Warehouse:
    return warehouse.Warehouse(fresh_dir(spark, label)).open(spark)


def _merge_query(table: str, initial, label: str) -> Query:
    """Merge the whole adapter table (as staging) into a target that already
    holds an earlier load (``initial(tables)``); return the merged target."""
    e = BY_TABLE[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = testdata.warehouse(spark, sf_dir)
        wh = _fresh_warehouse(spark, label)
        place = wh.final(e)
        # written once: the earlier load, the merge's statistics and the merge read it
        t[table].write.parquet(f"{wh.root}/incoming")
        t = {table: spark.read.schema(t[table].schema).parquet(f"{wh.root}/incoming")}
        layout.ensure_final(spark, place, e)
        layout.write_table(
            layout.conform(initial(t), e.table),
            place,
            partition_col=e.partition_column,
            partition_ts=e.partition_ts,
            cluster=e.cluster,
            load_id="earlier",
        )
        merge_into(spark, t[table], place, e)
        return layout.read_entity(spark, place, e)

    run.__name__ = label
    return run


def _orders_as_of_cutoff(table: str, status: str):
    def initial(t):
        return t[table].filter(_before_cutoff("order_purchase_timestamp")).withColumn(
            "order_status", F.lit(status)
        )

    return initial


def _half_with(table: str, key: str, column: str):
    """An earlier load: the even keys, with another value in ``column``."""

    def initial(t):
        return t[table].filter(F.col(key).cast("bigint") % 2 == 0).withColumn(column, F.lit("old"))

    return initial


register("merge_orders", oracle.MERGES["merge_orders"])(
    _merge_query("fact_order", _orders_as_of_cutoff("fact_order", "shipped"), "merge_orders")
)
register("merge_order_fop", oracle.MERGES["merge_order_fop"])(
    _merge_query("fact_order_fop", _orders_as_of_cutoff("fact_order_fop", "created"), "merge_order_fop")
)
register("merge_order_item", oracle.MERGES["merge_order_item"])(
    _merge_query(
        "fact_order_item",
        lambda t: t["fact_order_item"].filter(_before_cutoff("order_purchase_timestamp")),
        "merge_order_item",
    )
)
for _name, _table, _key, _column in (
    ("merge_customer", "dim_customer", "customer_id", "customer_city"),
    ("merge_product", "dim_product", "product_id", "product_category_name"),
    ("merge_seller", "dim_seller", "seller_id", "seller_city"),
):
    register(_name, oracle.MERGES[_name])(_merge_query(_table, _half_with(_table, _key, _column), _name))


@register("merge_orders_twice", oracle.OPERATORS["merge_orders_twice"])
def merge_orders_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders merged again: nothing is inserted twice."""
    e = ENTITIES["orders"]
    path = _fresh_warehouse(spark, "merge_orders_twice").final(e)
    orders = testdata.fact_order(spark, sf_dir)
    merge_into(spark, orders, path, e)
    merge_into(spark, orders, path, e)
    return layout.read_entity(spark, path, e)


def _extract_day(day: str, label: str) -> Query:
    """Increment extract of run ``day + 1`` (the rows of ``day``), read back."""
    e = ENTITIES["orders"]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = fresh_dir(spark, label)
        ds = _dt.date.fromisoformat(day) + _dt.timedelta(days=1)
        assert previous_day(ds).isoformat() == day
        src = testdata.fact_order(spark, sf_dir)
        res = extract.increment(src, base, e, ds, transform=lambda d: staging.clean(d, e))
        if res.skipped:
            return spark.createDataFrame([], e.table)
        return extract.read_extract(spark, res.path, e.table, ds)

    run.__name__ = label
    return run


register("incremental_extract", oracle.OPERATORS["incremental_extract"])(
    _extract_day(oracle.INCREMENT_DAY, "incremental_extract")
)
register("incremental_extract_empty", oracle.OPERATORS["incremental_extract_empty"])(
    _extract_day(oracle.EMPTY_DAY, "incremental_extract_empty")
)


@register("extract_skips", oracle.OPERATORS["extract_skips"])
def extract_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increments of two days, one of them without orders: rows extracted, and whether the load is skipped."""
    e = ENTITIES["orders"]
    base, found = fresh_dir(spark, "extract_skips"), []
    for day in map(_dt.date.fromisoformat, (oracle.INCREMENT_DAY, oracle.EMPTY_DAY)):
        res = extract.increment(testdata.fact_order(spark, sf_dir), base, e, day + _dt.timedelta(days=1))
        found.append((day, res.rows, res.skipped))
    return spark.createDataFrame(found, "day date, extracted_rows long, skipped boolean")


@register("snapshot_extract", oracle.OPERATORS["snapshot_extract"])
def snapshot_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ENTITIES["customer"]
    base = fresh_dir(spark, "snapshot_extract")
    ds = _dt.date(1998, 10, 4)
    res = extract.snapshot(
        testdata.dim_customer(spark, sf_dir), base, e, ds, transform=lambda d: staging.clean(d, e)
    )
    return extract.read_snapshot(spark, res.path, e.table)


def _even(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).cast("bigint") % 2 == 0)


@register("snapshot_twice", oracle.OPERATORS["snapshot_twice"])
def snapshot_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot, of fewer rows: only they are left."""
    e = ENTITIES["seller"]
    base = fresh_dir(spark, "snapshot_twice")
    sellers = layout.conform(testdata.dim_seller(spark, sf_dir), e.table)
    extract.snapshot(sellers, base, e, _dt.date(1998, 10, 4))
    res = extract.snapshot(_even(sellers, "seller_id"), base, e, _dt.date(1998, 10, 5))
    return extract.read_snapshot(spark, res.path, e.table)


@register("stage_truncate_customer", oracle.OPERATORS["stage_truncate_customer"])
def stage_truncate_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a day-partitioned table; the days that only the first had are gone."""
    e = ENTITIES["customer"]
    path = _fresh_warehouse(spark, "stage_truncate_customer").staging(e)
    customers = testdata.dim_customer(spark, sf_dir)
    staging.stage(spark, customers, path, e)
    staging.stage(spark, _even(customers, "customer_id"), path, e)
    return staging.read_staging(spark, path, e)


@register("ingest_refresh_orders", oracle.OPERATORS["ingest_refresh_orders"])
def ingest_refresh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh with other days replaces the source table."""
    e = ENTITIES["orders"]
    path = _fresh_warehouse(spark, "ingest_refresh_orders").source(e)
    orders = testdata.fact_order(spark, sf_dir)
    raw_csv.write_source(orders.filter(_before_cutoff("order_purchase_timestamp")), path, e)
    raw_csv.write_source(orders.filter(~_before_cutoff("order_purchase_timestamp")), path, e)
    return raw_csv.read_source(spark, path, e)


@register("replace_mart", oracle.OPERATORS["replace_mart"])
def replace_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart stored again with fewer months and states."""
    path = _fresh_warehouse(spark, "replace_mart").mart("mart_lost_revenue")
    mart = marts.mart_lost_revenue(testdata.warehouse(spark, sf_dir))
    marts.store(mart, path, "mart_lost_revenue")
    late = (F.col("order_status") == "canceled") & (F.col("order_month") >= F.lit(CUTOFF))
    marts.store(mart.filter(late), path, "mart_lost_revenue")
    return marts.read_stored(spark, path, "mart_lost_revenue")


def _stored_mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _fresh_warehouse(spark, f"stored_{name}").mart(name)
        marts.store(marts.MARTS[name](testdata.warehouse(spark, sf_dir)), path, name)
        return marts.read_stored(spark, path, name)

    return run


for _name in ("mart_product_performances", "mart_customer_characteristics", "mart_lost_revenue"):
    register(f"stored_{_name}", oracle.MARTS[_name])(_stored_mart(_name))


@register("stage_truncate", oracle.OPERATORS["stage_truncate"])
def stage_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshot loads: the second replaces the first (WRITE_TRUNCATE)."""
    e = ENTITIES["product"]
    path = _fresh_warehouse(spark, "stage_truncate").staging(e)
    products = testdata.dim_product(spark, sf_dir)
    staging.stage(spark, products, path, e)
    staging.stage(spark, products, path, e)
    return staging.read_staging(spark, path, e)


@register("stage_append", oracle.OPERATORS["stage_append"])
def stage_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days staged in one write, then one day staged again (a retried
    load): the day's partition is replaced, nothing is duplicated."""
    e = ENTITIES["orders"]
    path = _fresh_warehouse(spark, "stage_append").staging(e)
    orders = testdata.fact_order(spark, sf_dir)
    staging.stage(spark, orders, path, e)
    again = orders.filter(F.to_date("order_purchase_timestamp") == F.lit(_dt.date.fromisoformat(oracle.INCREMENT_DAY)))
    staging.stage(spark, again, path, e)
    return staging.read_staging(spark, path, e)


@register("partition_prune", oracle.OPERATORS["partition_prune"])
def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items stored by purchase day; a day-range read touches only its folders."""
    e = ENTITIES["order_item"]
    path = _fresh_warehouse(spark, "partition_prune").staging(e)
    items = layout.conform(testdata.fact_order_item(spark, sf_dir), e.table)
    layout.write_table(items, path, partition_col=e.partition_column, partition_ts=e.partition_ts)
    lo, hi = (_dt.date.fromisoformat(d) for d in (oracle.PRUNE_FROM, oracle.PRUNE_TO))
    day = F.col(e.partition_column)
    return (
        layout.read_entity(spark, path, e, with_partition=True)
        .filter((day >= F.lit(lo)) & (day <= F.lit(hi)))
        .drop(e.partition_column)
    )


def _odd_products(items: DataFrame) -> DataFrame:
    """Product ids that only quoting keeps."""
    odd = F.concat(F.lit("  "), F.col("product_id"), F.lit(' "q", \nx '))
    return items.withColumn("product_id", F.when(F.col("order_item_id") == 1, odd).otherwise(F.col("product_id")))


@register("reset_namespace", oracle.RESET_NAMESPACE)
def reset_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources' namespace reset between two ingests: what it holds, table by table."""
    wh = _warehouse_with_sources(spark, sf_dir, "reset_namespace", ("seller", "product"))
    spark.sql(f"CREATE TABLE {wh.sources}.stray USING parquet AS SELECT * FROM {wh.source(ENTITIES['product'])}")
    wh.reset_sources(spark)
    raw_csv.write_source(testdata.dim_seller(spark, sf_dir), wh.source(ENTITIES["seller"]), ENTITIES["seller"])
    shown = sorted(t.name for t in spark.catalog.listTables(wh.sources) if "__v" not in t.name)
    counts = [spark.table(f"{wh.sources}.{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("table_rows")) for t in shown]
    return reduce(DataFrame.unionByName, counts)


@register("ingest_transformed", oracle.OPERATORS["ingest_transformed"])
def ingest_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers ingested through a feed's own cleaning: cities in capitals, a prefix off the ids, one region left out."""
    e = ENTITIES["customer"]
    wh = _fresh_warehouse(spark, "ingest_transformed")
    src = layout.conform(testdata.dim_customer(spark, sf_dir), e.source)
    raw = raw_csv.write_raw(src.withColumn("customer_id", F.concat(F.lit("C-"), F.col("customer_id"))), f"{wh.root}/raw/{e.raw_file}")

    def own(df: DataFrame) -> DataFrame:
        df = df.withColumn("customer_id", F.regexp_replace("customer_id", "^C-", ""))
        return df.withColumn("customer_city", F.upper("customer_city")).filter("customer_state <> 'ASIA'")

    raw_csv.ingest(spark, raw, e, wh.source(e), transform=own)
    return raw_csv.read_source(spark, wh.source(e), e)


@register("ingest_csv_ranges", oracle.OPERATORS["ingest_csv_ranges"])
def ingest_csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items from CSV files with line breaks in values, read in ranges that cut through them.

    A file takes what one task writes well (a million items or so; fewer are one file).
    """
    e = ENTITIES["order_item"]
    wh = _fresh_warehouse(spark, "ingest_csv_ranges")
    items = layout.conform(_odd_products(testdata.fact_order_item(spark, sf_dir)), e.source)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.parallelismFirst", "false"):
        raw = raw_csv.write_raw(items.hint("rebalance"), f"{wh.root}/raw/{e.raw_file}")
    with setting(spark, "spark.sql.files.maxPartitionBytes", "100KB"), setting(spark, "spark.sql.files.openCostInBytes", "64KB"):
        with csv_ranges.many_a_task(spark, raw):
            raw_csv.ingest(spark, raw, e, wh.source(e))
    return raw_csv.read_source(spark, wh.source(e), e)


def _stamps_in(fmt: str, bad: str | None = None):
    """Orders' timestamps as text: ISO, ISO with T, and ``fmt``, by order; ``bad`` in place of one of them."""

    def write(orders: DataFrame) -> DataFrame:
        kind = F.col("order_id").cast("bigint") % 3
        for c in ORDER_TIMESTAMPS:
            formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", fmt)
            text = F.coalesce(*[F.when(kind == i, F.date_format(c, f)) for i, f in enumerate(formats)])
            orders = orders.withColumn(c, F.when(F.col("order_id").cast("bigint") % 100 == 7, F.lit(bad)).otherwise(text) if bad else text)
        return orders

    return write


@register("ingest_mixed_dates", oracle.OPERATORS["backfill_orders"])
def ingest_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose timestamps come in three formats, day and month told apart by all rows; one that is none of them fails."""
    e = ENTITIES["orders"]
    wh = _fresh_warehouse(spark, "ingest_mixed_dates")
    orders = layout.conform(testdata.fact_order(spark, sf_dir), e.source)
    for folder, text in (("good", _stamps_in("dd/MM/yyyy HH:mm")), ("bad", _stamps_in("dd/MM/yyyy HH:mm", "31/02/1998"))):
        raw_csv.write_raw(text(orders), f"{wh.root}/{folder}")
    raw_csv.ingest(spark, f"{wh.root}/good", e, wh.source(e), raw_csv.INFER)
    try:
        raw_csv.ingest(spark, f"{wh.root}/bad", e, wh.source(e), raw_csv.INFER)
    except Exception as failure:
        if "31/02/1998" not in str(failure):
            raise
    else:
        raise AssertionError("a date that isn't one was ingested")
    return raw_csv.read_source(spark, wh.source(e), e)


@register("failed_replacement", oracle.OPERATORS["stage_truncate"])
def failed_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement that fails while it writes: the table holds its old rows."""
    e = ENTITIES["product"]
    path = _fresh_warehouse(spark, "failed_replacement").staging(e)
    products = testdata.dim_product(spark, sf_dir)
    staging.stage(spark, products, path, e)
    lost = F.when(F.col("product_id") == "100", F.raise_error(F.lit("writer lost"))).otherwise(F.lit("new"))
    try:
        staging.stage(spark, products.withColumn("product_category_name", lost), path, e)
    except Exception as failure:
        if "writer lost" not in str(failure):
            raise
    return staging.read_staging(spark, path, e)


@register("csv_roundtrip", oracle.OPERATORS["csv_roundtrip"])
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item through the CSV increment extract and its staging read."""
    e = ENTITIES["order_item"]
    path = fresh_dir(spark, "csv_roundtrip")
    extract.write_increments(_odd_products(layout.conform(testdata.fact_order_item(spark, sf_dir), e.table)), path, e)
    return extract.read_increments(spark, path, e.table, "csv")


def _odd_sellers(src: DataFrame) -> DataFrame:
    """Raw text as other tools write it: null tokens, leading zeros and decimals, quotes, commas, spaces, line breaks."""
    kind, city = F.col("seller_id").cast("bigint") % 3, F.col("seller_city")
    zip_ = F.col("seller_zip_code_prefix").cast("string")
    return src.withColumn(
        "seller_city",
        F.when(kind == 0, F.lit("NA"))
        .when(kind == 1, F.concat(F.lit(" "), city, F.lit(' "x", y ')))
        .otherwise(F.concat(city, F.lit("\nz"))),
    ).withColumn(
        "seller_zip_code_prefix",
        F.when(kind == 0, F.concat(zip_, F.lit(".0"))).when(kind == 1, F.concat(F.lit("0"), zip_)).otherwise(zip_),
    )


def _ingest_query(entity: str) -> Query:
    e = ENTITIES[entity]
    table = e.final_name

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _fresh_warehouse(spark, f"ingest_{entity}")
        raw = f"{wh.root}/raw/{e.raw_file}"
        src = testdata.BUILDERS[table](spark, sf_dir)
        if entity == "order_item":
            src = src.withColumn("order_item_id", F.col("order_item_id").cast("string"))
        src = layout.conform(src, e.source)
        raw_csv.write_raw(_odd_sellers(src) if entity == "seller" else src, raw)
        raw_csv.ingest(spark, raw, e, wh.source(e))
        return raw_csv.read_source(spark, wh.source(e), e)

    run.__name__ = f"ingest_csv_{entity}"
    return run


def _ingest_oracle(entity: str) -> str:
    e = ENTITIES[entity]
    cols = []
    for f in e.source.fields:
        t = f.dataType.simpleString()
        sql_type = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}[t]
        cols.append(f"CAST({f.name} AS {sql_type}) AS {f.name}")
    return oracle.with_adapter(f"SELECT {', '.join(cols)} FROM {e.final_name}")


for _entity in ENTITIES:
    register(f"ingest_csv_{_entity}", oracle.OPERATORS.get(f"ingest_csv_{_entity}") or _ingest_oracle(_entity))(
        _ingest_query(_entity)
    )


@register(
    "lenient_cast", oracle.OPERATORS["lenient_cast"]
)
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.lenient_cast(testdata.read(spark, sf_dir, "lineitem"))


def _spoiled(t) -> dict[str, DataFrame]:
    """The tables with values removed or made too long by rule."""

    def gone(df: DataFrame, column: str, when) -> DataFrame:
        return df.withColumn(column, F.when(~when, F.col(column)))

    def long(df: DataFrame, column: str, when) -> DataFrame:
        return df.withColumn(column, F.when(when, F.repeat(F.lit("x"), 120)).otherwise(F.col(column)))

    out = {"dim_product": gone(t["dim_product"], "product_id", F.col("product_weight_g") % 7 == 0)}
    for name, who in (("dim_seller", "seller"), ("dim_customer", "customer")):
        zip_ = F.col(f"{who}_zip_code_prefix")
        df = gone(t[name], f"{who}_id", zip_ % 7 == 0)
        out[name] = long(long(df, f"{who}_city", zip_ % 5 == 0), f"{who}_state", zip_ % 3 == 0)
    for name in ("fact_order", "fact_order_fop"):
        part = F.col("payment_installments")
        df = gone(gone(t[name], "order_id", part == 1), "order_purchase_timestamp", part == 2)
        out[name] = long(long(df, "order_status", part == 3), "payment_type", part == 4)
    freight = F.col("freight_value")
    out["fact_order_item"] = gone(gone(t["fact_order_item"], "order_id", freight % 2 == 0), "product_id", freight % 3 == 0)
    return out


@register("required_violations", oracle.VIOLATIONS)
def required_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.required_violations(_spoiled(testdata.warehouse(spark, sf_dir)))


def _tables_query(fn, label: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(testdata.warehouse(spark, sf_dir))

    run.__name__ = label
    return run


for _label in (
    "union_orders",
    "date_functions",
    "agg_count_nonnull_vs_distinct",
    "agg_sum_avg_min_max",
    "agg_safe_ratio",
    "agg_group_by_month",
):
    register(_label, oracle.OPERATORS[_label])(_tables_query(getattr(aggregates, _label), _label))


def _warehouse_with_sources(
    spark: SparkSession, sf_dir: str, label: str, entities: tuple[str, ...] = tuple(ENTITIES)
) -> warehouse.Warehouse:
    """A fresh warehouse whose source tables hold the adapter's entities."""
    wh = _fresh_warehouse(spark, label)
    for e in map(ENTITIES.get, entities):
        raw_csv.write_source(testdata.BUILDERS[e.final_name](spark, sf_dir), wh.source(e), e)
    return wh


@register("backfill_orders", oracle.OPERATORS["backfill_orders"])
def backfill_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping catch-up runs; every order lands exactly once."""
    wh = _warehouse_with_sources(spark, sf_dir, "backfill_orders", ("orders",))
    first, last = warehouse.run_dates(spark, wh, "orders")
    warehouse.backfill(spark, wh, "orders", first, CUTOFF)
    warehouse.backfill(spark, wh, "orders", CUTOFF - _dt.timedelta(days=45), last)
    return layout.read_entity(spark, wh.final(ENTITIES["orders"]), ENTITIES["orders"])


@register("backfill_resumed", oracle.OPERATORS["backfill_resumed"])
def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catch-up of the failed orders that ends after one of its loads, and is asked again."""
    e = ENTITIES["order_fop"]
    wh = _warehouse_with_sources(spark, sf_dir, "backfill_resumed", ("order_fop",))
    dates = warehouse.run_dates(spark, wh, "order_fop")
    for loads in (1, None):
        warehouse.backfill(spark, wh, "order_fop", *dates, days_per_load=900, job="catch-up", max_loads=loads)
    return layout.read_entity(spark, wh.final(e), e)


AUDIT_RUN = _dt.date.fromisoformat(oracle.INCREMENT_DAY) + _dt.timedelta(days=1)


def _audit_oracle() -> str:
    parts = []
    for name, e in ENTITIES.items():
        where = ""
        if e.increment_ts:
            where = f" WHERE CAST({e.increment_ts} AS DATE) = DATE '{oracle.INCREMENT_DAY}'"
        parts.append(
            f"SELECT '{name}' AS entity, DATE '{AUDIT_RUN.isoformat()}' AS run_date, "
            f"COUNT(*) AS rows_read, COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_already_present, "
            f"{'COUNT(*) = 0' if e.increment_ts else 'false'} AS skipped FROM {e.final_name}{where}"
        )
    return oracle.with_adapter("\nUNION ALL\n".join(parts))


@register("load_audit", _audit_oracle())
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First daily run of all six entities into an empty warehouse; its audit."""
    wh = _warehouse_with_sources(spark, sf_dir, "load_audit")
    return warehouse.run_day(spark, wh, AUDIT_RUN)


def _streamed(spark: SparkSession, sf_dir: str, entity: str, label: str, odd: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Every run extract of an entity streamed (availableNow) into an empty fact: the warehouse, its checkpoint, the report."""
    from emporia.streaming.increments import merge_stream

    e = ENTITIES[entity]
    wh = _fresh_warehouse(spark, label)
    rows = layout.conform(testdata.BUILDERS[e.final_name](spark, sf_dir), e.table)
    extract.write_increments(odd(rows), wh.export(e), e)
    checkpoint = f"{wh.root}/_checkpoint"
    return wh, checkpoint, merge_stream(spark, wh.export(e), e, wh.final(e), checkpoint)


@register("audit_stored", oracle.audit_stored())
def audit_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one day, the second with nothing new: the stored audit of both."""
    wh = _warehouse_with_sources(spark, sf_dir, "audit_stored", ("product", "orders"))
    for _ in range(2):
        warehouse.run_day(spark, wh, AUDIT_RUN, entities=("product", "orders"))
    return warehouse.audit_history(spark, wh)


@register("audit_reconcile", oracle.audit_reconcile())
def audit_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days caught up, then every tenth order arrives late in the source: the days that differ, and how."""
    e = ENTITIES["order_fop"]
    wh = _fresh_warehouse(spark, "audit_reconcile")
    orders = testdata.fact_order_fop(spark, sf_dir)
    raw_csv.write_source(orders.filter(~_late("order_id")), wh.source(e), e)
    warehouse.backfill(spark, wh, "order_fop", *warehouse.run_dates(spark, wh, "order_fop"))
    raw_csv.write_source(orders, wh.source(e), e)
    return warehouse.reconcile(spark, wh, "order_fop").filter("status <> 'equal'")


def _late(key: str):
    return F.col(key).cast("bigint") % 10 == 6


@register("stream_merge_orders", oracle.OPERATORS["backfill_orders"])
def stream_merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's run extract streamed (availableNow) into an empty fact."""
    wh, _, _ = _streamed(spark, sf_dir, "orders", "stream_merge_orders")
    return layout.read_entity(spark, wh.final(ENTITIES["orders"]), ENTITIES["orders"])


@register("stream_merge_order_item", oracle.OPERATORS["csv_roundtrip"])
def stream_merge_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item's CSV run extract streamed, values with quotes and line breaks included."""
    wh, _, _ = _streamed(spark, sf_dir, "order_item", "stream_merge_order_item", _odd_products)
    return layout.read_entity(spark, wh.final(ENTITIES["order_item"]), ENTITIES["order_item"])


@register("stream_replay_order_item", oracle.OPERATORS["csv_roundtrip"])
def stream_replay_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items' stream restarted as if it had ended before its batch was recorded: the epoch comes again."""
    from emporia.streaming.increments import merge_stream

    e = ENTITIES["order_item"]
    wh, checkpoint, _ = _streamed(spark, sf_dir, "order_item", "stream_replay_order_item", _odd_products)
    versions.delete(spark, f"{checkpoint}/commits/0")
    merge_stream(spark, wh.export(e), e, wh.final(e), checkpoint)
    return layout.read_entity(spark, wh.final(e), e)


@register("end_to_end_user_activity", oracle.MARTS["mart_user_activity"])
def end_to_end_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole warehouse flow, end to end, read back as the stored mart.

    raw CSV files → typed source tables → snapshot loads of the three
    dimensions → one catch-up run of the three facts over all their days →
    ``mart_user_activity`` written with its day partitions and clustering.
    """
    wh = _fresh_warehouse(spark, "end_to_end_user_activity")
    raw_dir = f"{wh.root}/raw"
    for table, build in testdata.BUILDERS.items():
        e = BY_TABLE[table]
        raw_csv.write_raw(layout.conform(build(spark, sf_dir), e.source), f"{raw_dir}/{e.raw_file}", gzipped=True)
    warehouse.ingest_all(spark, wh, raw_dir, reset=True)
    run = AUDIT_RUN
    for name in ("seller", "product", "customer"):
        warehouse.load_entity(spark, wh, name, run)
    for name in ("orders", "order_fop", "order_item"):
        warehouse.backfill(spark, wh, name, *warehouse.run_dates(spark, wh, name))
    warehouse.build_marts(spark, wh, ("mart_user_activity",))
    part, _ = marts.MART_LAYOUT["mart_user_activity"]
    return warehouse.read_mart(spark, wh, "mart_user_activity").drop(part)
