"""Tables in the session's catalog: namespaces, typed tables, registered day partitions.

A namespace is a database whose tables lie below one folder.  Its day
partitions are registered in the catalog, so a read of some days asks the
catalog for them and lists those folders only; no job lists the table's
thousands of others.  Two kinds of tables:

* *grown* tables (staging of increments, dimensions, facts) get rows appended,
  or some of their days replaced, in place;
* *replaced* tables (sources, truncated staging, marts) are views over a
  version table.  A replacement fills a new version and then changes the view,
  one entry of the catalog: readers see all old rows or all new ones, and a
  write that fails changes nothing.

Rows merged into a final table carry the *load* that brought them, as its first
partition column.  A load is committed by a row in the namespace's ledger; one
that was begun before and not committed is undone first, by dropping its own
partitions, so a replayed load leaves exactly what one run would have.

With a metastore all of this lasts.  Spark's in-memory catalog ends with its
session; :func:`attach` registers a namespace's folders again.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import versions

#: tasks that list the folders of a table, where the session doesn't say
LISTING_TASKS = "64"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_MARK = "__v"
#: whether a finished write leaves a _SUCCESS file
_MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"

#: partition column of final tables: the load that brought a row
LOAD = "load_id"
#: a namespace's table of committed loads
LEDGER = "load_ledger"
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
    ]
)


def is_name(target: str) -> bool:
    """Whether a table's place is a name in the catalog (else a folder)."""
    return "/" not in target


def split_name(name: str) -> tuple[str, str]:
    database, _, table = name.partition(".")
    return database, table


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set for the jobs started inside, and put back after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: of jobs that write: their shuffle files go when they end, not when the driver happens to collect its garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """For what is written inside: Parquet as small as zstd makes it, and no shuffle file outlives its write."""
    with ExitStack() as stack:
        for key, value in ((_CODEC, "zstd"), (_CLEANUP, "true")):
            stack.enter_context(setting(spark, key, value))
        yield


# ------------------------------------------------------------ namespaces


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    """The database ``name`` below ``location``, unless there is one."""
    if spark.conf.get(_LISTING, "10000") == "10000":
        # Spark's default is a task per folder
        spark.conf.set(_LISTING, LISTING_TASKS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def reset_namespace(spark: SparkSession, name: str, location: str) -> None:
    """Drop the namespace with all its tables and their files, and create it empty."""
    if spark.catalog.databaseExists(name):
        where = spark.catalog.getDatabase(name).locationUri
        spark.sql(f"DROP DATABASE `{name}` CASCADE")
        versions.delete(spark, where)  # attached tables' files aren't the catalog's to drop
    versions.delete(spark, location)
    create_namespace(spark, name, location)


def location_of(spark: SparkSession, name: str) -> str:
    """The folder of a table of the catalog (of a replaced one: its version's)."""
    database, table = split_name(current(spark, name))
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


# ---------------------------------------------------------------- tables


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partitions: Sequence[str] = (), location: str | None = None
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the schema, partitioned by its last columns when asked."""
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet{parted}{place}")


def append(df: DataFrame, name: str) -> None:
    """Add the rows of ``df``, matched by column name; new days are registered with the write."""
    spark = df.sparkSession
    with setting(spark, _OVERWRITE, "static"):
        df.select(*spark.table(name).columns).write.mode("append").insertInto(name)


def replace_days(df: DataFrame, name: str) -> None:
    """Replace the day partitions that ``df`` has rows of; the other days stay."""
    spark = df.sparkSession
    with setting(spark, _OVERWRITE, "dynamic"):
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)


def partition_values(spark: SparkSession, name: str, where: str = "") -> list[dict[str, str]]:
    """The registered partitions of a table, column to text; no file is touched."""
    found = spark.sql(f"SHOW PARTITIONS {current(spark, name)}{where}").collect()
    return [dict(step.partition("=")[::2] for step in r[0].split("/")) for r in found]


def days(spark: SparkSession, name: str, column: str) -> list[dt.date]:
    """The registered days of a partitioned table, in order (rows without a day: not told)."""
    values = {p[column] for p in partition_values(spark, name)}
    return sorted(dt.date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__" and v != "null")


# ----------------------------------------------------------------- loads


@dataclass(frozen=True)
class Load:
    """A committed load."""

    load_id: str
    rows_read: int
    rows_inserted: int


def _ledger(spark: SparkSession, target: str) -> str:
    name = f"{split_name(target)[0]}.{LEDGER}"
    create_table(spark, name, LEDGER_SCHEMA)
    return name


def committed(spark: SparkSession, target: str, load_id: str) -> Load | None:
    """What the ledger says of a load into ``target``; None: not committed."""
    rows = spark.table(_ledger(spark, target)).filter((F.col("target") == target) & (F.col("load_id") == load_id)).limit(1).collect()
    return Load(load_id, rows[0].rows_read, rows[0].rows_inserted) if rows else None


def commit(spark: SparkSession, target: str, load: Load) -> None:
    """Enter a load into the ledger: the last thing a load does."""
    row = (target, load.load_id, load.rows_read, load.rows_inserted)
    append(spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1), _ledger(spark, target))


def undo(spark: SparkSession, target: str, load_id: str) -> int:
    """Drop what an uncommitted load left in ``target``; the number of partitions dropped."""
    text = load_id.replace("\\", "\\\\").replace("'", "\\'")
    mine = partition_values(spark, target, f" PARTITION (`{LOAD}` = '{text}')")
    if mine:
        # names of partitions are escaped as paths are; only days are taken from them
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {', '.join(_spec(p, text) for p in mine)}")
    return len(mine)


def _spec(partition: dict[str, str], load: str) -> str:
    parts = {c: "NULL" if v in ("null", "__HIVE_DEFAULT_PARTITION__") else f"'{v}'" for c, v in partition.items()}
    parts[LOAD] = f"'{load}'"
    return "PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in parts.items()) + ")"


# ------------------------------------------------------- replaced tables


def current(spark: SparkSession, name: str) -> str:
    """The table that ``name`` reads: a replaced table's version, else the table itself."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'version'").collect()
    return found[0]["value"] if found else name


def _show(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{version}') AS SELECT * FROM {version}")


def _versions(spark: SparkSession, name: str) -> list[str]:
    database, table = split_name(name)
    found = spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table}{_MARK}*'").collect()
    return sorted(f"{database}.{r.tableName}" for r in found)


def publish(parts: Sequence[DataFrame], name: str, partitions: Sequence[str] = ()) -> None:
    """Replace ``name`` by the rows of all ``parts``, written one after the other, at once.

    The version in force before stays for readers that have begun; older ones
    go, as do leftovers of writes that failed.  The last part marks the version
    as finished.
    """
    spark = parts[0].sparkSession
    before = current(spark, name) if exists(spark, name) else None
    version = f"{name}{_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    create_table(spark, version, parts[0].schema, partitions)
    for left, part in zip(range(len(parts) - 1, -1, -1), parts):
        with setting(spark, _MARKED, "false") if left else nullcontext():
            append(part, version)
    _show(spark, name, version)
    for old in _versions(spark, name):
        if old not in (before, version):
            spark.sql(f"DROP TABLE IF EXISTS {old}")


# ---------------------------------------------------------------- attach


def attach(spark: SparkSession, name: str, location: str, tables: Mapping[str, tuple[T.StructType, Sequence[str]]]) -> list[str]:
    """Register the tables found below ``location`` in a catalog that doesn't know them.

    ``tables``: per table its schema and partition columns.  A grown table is the
    folder of its name; of a replaced one the last version whose write was
    finished is shown.  Day partitions are recovered by one listing a table.
    Returns the tables registered.
    """
    create_namespace(spark, name, location)
    there = versions.folders(spark, location)
    made = []
    for table, (schema, partitions) in tables.items():
        if exists(spark, f"{name}.{table}"):
            continue
        finished = [f for f in there if f.startswith(table + _MARK) and versions.path_exists(spark, f"{location}/{f}/_SUCCESS")]
        folder = finished[-1] if finished else table if table in there else None
        if folder is None:
            continue
        create_table(spark, f"{name}.{folder}", schema, partitions, f"{location}/{folder}")
        if partitions:
            spark.sql(f"ALTER TABLE {name}.{folder} RECOVER PARTITIONS")
        if folder != table:
            _show(spark, f"{name}.{table}", f"{name}.{folder}")
        made.append(f"{name}.{table}")
    return made
