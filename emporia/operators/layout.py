"""Physical layout of stored tables: day partitions, clustering, create/replace.

A table's place is a name in the session's catalog (``namespace.table``, see
:mod:`emporia.operators.catalog`) or a folder of Parquet files:

* a *day partition* column ``<ts>_date`` (DATE) is derived from the
  partitioning timestamp; readers that filter on it prune whole folders.  In
  the catalog the days are registered, so no folder is listed to find them;
* *clustering* is a sort inside each written file, so Parquet row-group
  min/max statistics skip data for filters on the clustering columns; replaced
  tables with several of them are laid out by interleaved ranks, so that a
  filter on any of the columns skips;
* before a partitioned write the rows are ``REBALANCE``d on the partition
  column: AQE sizes the write tasks (splitting a hot day, merging small
  ones), so a day lands in a few files instead of one file per upstream
  task, without the extra sampling pass a range partitioning would need.
  Rows read from a table stored by the same days are there already and are
  written by the tasks that read them, without a shuffle;
* a whole-table replacement writes a new version and then swaps one pointer
  (a view, or a file in the folder), so readers never see half of it and a
  failed write leaves the old rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import catalog, versions, zorder
from emporia.schemas import Entity


def with_day_partition(df: DataFrame, partition_col: str | None, partition_ts: str | None) -> DataFrame:
    """Add ``partition_col = DATE(partition_ts)`` when both are given."""
    if partition_col and partition_ts and partition_col not in df.columns:
        return df.withColumn(partition_col, F.to_date(F.col(partition_ts)))
    return df


def arrange(
    df: DataFrame, partition_col: str | None, cluster: Sequence[str] = (), along: Column | None = None, balance: bool = True
) -> DataFrame:
    """Balance write tasks on the partition column and sort by the clustering columns, or by ``along`` instead."""
    order: list = [c for c in ([partition_col] if partition_col else []) + list(cluster) if c in df.columns]
    if along is not None:
        order = [c for c in order if c == partition_col] + [along]
    if balance:
        df = df.hint("rebalance", partition_col) if partition_col else df.hint("rebalance")
    return df.sortWithinPartitions(*order) if order else df


#: bytes that AQE leaves to a write task at least
_SMALLEST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def by_folder(spark: SparkSession):
    """For writes into many folders: tasks by folders, as each costs a few file operations however few its rows.

    Small loads are spread over all cores; large ones keep the advisory size.
    """
    return catalog.setting(spark, _SMALLEST, "1KB")


def _laid_out(
    df: DataFrame, partition_col: str | None, partition_ts: str | None, cluster: Sequence[str], along: Column | None, balance: bool
) -> DataFrame:
    df = with_day_partition(df, partition_col, partition_ts)
    if partition_col:  # a table's day column comes last
        df = df.select(*[c for c in df.columns if c != partition_col], partition_col)
    return arrange(df, partition_col, cluster, along, balance)


def write_table(
    df: DataFrame | Sequence[DataFrame],
    target: str,
    *,
    mode: str = "append",
    partition_col: str | None = None,
    partition_ts: str | None = None,
    cluster: Sequence[str] = (),
    replace_partitions: bool = False,
    load_id: str | None = None,
    along: Column | None = None,
    by_day: bool = False,
) -> None:
    """Write ``df`` with the table's layout.

    ``mode="overwrite"`` replaces the whole table by a new version, whatever
    the session's setting, and takes the rows in parts as well; ``replace_partitions=True`` replaces only the day
    partitions present in ``df``, so re-running a day is idempotent and a
    retried staging load is safe.  ``load_id`` marks rows appended to a final
    table of the catalog.  ``along``: a sort key in place of the clustering
    columns (see :mod:`emporia.operators.zorder`).  ``by_day``: the rows are
    read, and nothing but read, from a table stored by the same days.
    """
    parts = [df] if isinstance(df, DataFrame) else list(df)
    if len(parts) > 1 and (mode != "overwrite" or replace_partitions):
        raise ValueError("only a replacement of the whole table comes in parts")
    spark = parts[0].sparkSession
    parts = [_laid_out(part, partition_col, partition_ts, cluster, along, not by_day) for part in parts]
    partitions = [partition_col] if partition_col else []
    if load_id is not None:
        parts, partitions = [part.withColumn(catalog.LOAD, F.lit(load_id)) for part in parts], [catalog.LOAD, *partitions]
    with by_folder(spark) if partitions else nullcontext(), catalog.lean_writes(spark):
        if catalog.is_name(target):
            _write_named(parts, target, mode, partitions, replace_partitions)
        else:
            _write_folder(parts, target, mode, partitions, replace_partitions)


def _write_named(parts: list[DataFrame], target: str, mode: str, partitions: Sequence[str], replace_partitions: bool) -> None:
    if mode == "overwrite" and not replace_partitions:
        catalog.publish(parts, target, partitions)
        return
    (df,) = parts
    catalog.create_table(df.sparkSession, target, df.schema, partitions)
    (catalog.replace_days if replace_partitions else catalog.append)(df, target)


def _write_folder(parts: list[DataFrame], target: str, mode: str, partitions: Sequence[str], replace_partitions: bool) -> None:
    spark = parts[0].sparkSession

    def save(folder: str, how: str, overwrite: str, part: DataFrame = parts[0]) -> None:
        part.write.mode(how).option("partitionOverwriteMode", overwrite).partitionBy(*partitions).parquet(folder)

    if replace_partitions:
        save(versions.current(spark, target), "overwrite", "dynamic")
    elif mode == "overwrite":
        versions.replace(spark, target, lambda folder: [save(folder, "append" if i else "error", "static", p) for i, p in enumerate(parts)])
    else:
        save(versions.current(spark, target), mode, "static")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def table_schema(entity: Entity) -> T.StructType:
    """Stored schema of an entity's table: its columns plus the day partition."""
    fields = list(entity.table.fields)
    if entity.partition_column:
        fields.append(T.StructField(entity.partition_column, T.DateType(), True))
    return T.StructType(fields)


def partitions_of(entity: Entity, final: bool = False) -> list[str]:
    """Partition columns of an entity's table; a final table of the catalog has its rows' loads above the days."""
    return ([catalog.LOAD] if final else []) + ([entity.partition_column] if entity.partition_column else [])


def final_schema(entity: Entity) -> T.StructType:
    """Stored schema of a final table of the catalog."""
    return T.StructType([*table_schema(entity).fields, T.StructField(catalog.LOAD, T.StringType())])


def exists(spark: SparkSession, target: str) -> bool:
    """Whether there is such a table or folder."""
    return catalog.exists(spark, target) if catalog.is_name(target) else versions.path_exists(spark, target)


def ensure_table(
    spark: SparkSession, target: str, schema: T.StructType, partitions: Sequence[str] = (), replaced: bool = False
) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an empty table with the schema when there is none.

    ``replaced``: one that is only ever replaced as a whole.
    """
    if catalog.is_name(target):
        if not replaced:
            catalog.create_table(spark, target, schema, partitions)
        elif not catalog.exists(spark, target):
            catalog.publish([spark.createDataFrame([], schema)], target, partitions)
        return
    if not exists(spark, target):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*partitions).parquet(target)


def ensure_final(spark: SparkSession, target: str, entity: Entity) -> None:
    """The entity's dimension or fact table, created when there is none."""
    named = catalog.is_name(target)
    schema = final_schema(entity) if named else table_schema(entity)
    ensure_table(spark, target, schema, partitions_of(entity, final=named))


def read_table(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Read a stored table with its declared schema (no inference, no listing of types)."""
    if catalog.is_name(target):
        return spark.table(target).select(*schema.names)
    return spark.read.schema(schema).parquet(versions.current(spark, target))


def read_entity(spark: SparkSession, target: str, entity: Entity, with_partition: bool = False) -> DataFrame:
    df = read_table(spark, target, table_schema(entity))
    if entity.partition_column and not with_partition:
        df = df.drop(entity.partition_column)
    return df


def replace_table(
    df: DataFrame | Sequence[DataFrame],
    target: str,
    partition_col: str | None = None,
    cluster: Sequence[str] = (),
    partition_ts: str | None = None,
) -> None:
    """``CREATE OR REPLACE TABLE ... AS SELECT``: the whole table anew, shown at once.

    Rows in parts are written part by part: only one part's shuffle files are there at a time.
    With several clustering columns the rows are laid out by their interleaved
    ranks, as the version to be replaced has them; a first version is sorted.
    """
    along = None
    first = df if isinstance(df, DataFrame) else df[0]
    spark = first.sparkSession
    if len(cluster) > 1 and exists(spark, target):
        old = spark.table(target) if catalog.is_name(target) else spark.read.schema(first.schema).parquet(versions.current(spark, target))
        bounds = zorder.boundaries(old, [c for c in cluster if c in old.columns])
        along = zorder.key(bounds) if any(bounds.values()) else None
    write_table(
        df,
        target,
        mode="overwrite",
        partition_col=partition_col,
        partition_ts=partition_ts,
        cluster=cluster,
        along=along,
    )
