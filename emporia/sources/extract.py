"""Extracts from the source tables: a full snapshot or one day's increment.

A snapshot is one folder that each run replaces.  Increments are datasets
partitioned by the run date ``ds`` (DATE); writing a run again replaces
only its own ``ds`` partition, so retries are idempotent.  The increment of run ``ds`` holds the rows whose increment
timestamp falls on the *previous* day (``DATE(ts) = ds - 1``); an empty
increment writes nothing and is reported as skipped.  Row counts are
taken from ``Observation`` metrics of the writing job itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.temporal import previous_day
from emporia.operators import catalog, layout, versions
from emporia.operators.increment import day_slice
from emporia.operators.merge import observed_rows
from emporia.schemas import Entity
from emporia.sources import csv_ranges
from emporia.sources.raw_csv import CSV_QUOTING, CSV_TIMESTAMP_FORMAT

Transform = Callable[[DataFrame], DataFrame]


@dataclass
class ExtractResult:
    path: str
    ds: dt.date
    rows: int

    @property
    def skipped(self) -> bool:
        return self.rows == 0


def _as_date(d: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def csv_options() -> dict[str, str]:
    return {
        "header": "true",
        **CSV_QUOTING,
        "timestampFormat": CSV_TIMESTAMP_FORMAT,
        "timestampNTZFormat": CSV_TIMESTAMP_FORMAT,
    }


def _write(df: DataFrame, path: str, ds: dt.date, fmt: str, label: str) -> int:
    seen = Observation(f"extract_{label}")
    # rebalance: a day's rows land in a few right-sized files, not one file
    # per scan task that happened to hold some of them
    out = df.withColumn("ds", F.lit(ds)).observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance")
    writer = (
        out.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
    )
    if fmt == "csv":
        writer = writer.options(**csv_options())
    with catalog.lean_writes(df.sparkSession):
        writer.save(path)
    return observed_rows(seen)


def snapshot(
    df: DataFrame,
    base: str,
    entity: Entity,
    ds: dt.date | str,
    transform: Transform | None = None,
) -> ExtractResult:
    """``SELECT *`` of the source table (optionally transformed): one stable copy, replaced by each run.

    Readers see the last run's copy whole until the new one is complete.
    """
    if transform is not None:
        df = df.transform(transform)
    path = f"{base}/{entity.name}"
    seen = Observation(f"snapshot_{entity.name}")
    out = df.observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance")
    with catalog.lean_writes(df.sparkSession):
        versions.replace(df.sparkSession, path, lambda folder: out.write.parquet(folder))
    return ExtractResult(path, _as_date(ds), observed_rows(seen))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The snapshot as the last run left it."""
    return layout.read_table(spark, path, schema)


def increment(
    df: DataFrame,
    base: str,
    entity: Entity,
    ds: dt.date | str,
    transform: Transform | None = None,
) -> ExtractResult:
    """Rows of day ``ds - 1`` by the entity's increment timestamp."""
    if entity.increment_ts is None:
        raise ValueError(f"{entity.name} is a snapshot entity")
    ds = _as_date(ds)
    day = previous_day(ds)
    if entity.partition_column in df.columns:
        # the source is stored by day: read only that day's folder
        df = df.filter(F.col(entity.partition_column) == F.lit(day)).drop(entity.partition_column)
    sliced = day_slice(df, entity.increment_ts, day)
    if transform is not None:
        sliced = sliced.transform(transform)
    path = f"{base}/{entity.name}"
    rows = _write(sliced, path, ds, entity.extract_format, entity.name)
    return ExtractResult(path, ds, rows)


def write_increments(df: DataFrame, path: str, entity: Entity) -> int:
    """Write many days at once: each row goes to the run ``ds = DATE(ts) + 1`` that extracts it.

    Used for catch-up runs; replaces exactly the run partitions present.
    """
    seen = Observation(f"extract_range_{entity.name}")
    out = (
        df.withColumn("ds", F.date_add(F.to_date(F.col(entity.increment_ts)), 1))
        .observe(seen, F.count(F.lit(1)).alias("n"))
        .hint("rebalance", "ds")
    )
    writer = (
        out.write.format(entity.extract_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
    )
    if entity.extract_format == "csv":
        writer = writer.options(**csv_options())
    with layout.by_folder(df.sparkSession), catalog.lean_writes(df.sparkSession):
        writer.save(path)
    return observed_rows(seen)


def read_increments(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Read the runs ``start..end`` (all when not given) of an extract.

    CSV is read in byte ranges, FAILFAST, and each file's header must name the
    schema's columns.  One run is read from its own folder.
    """
    day = T.StructField("ds", T.DateType(), True)
    if start is not None and start == end and versions.path_exists(spark, f"{path}/ds={_as_date(start).isoformat()}"):
        folder = f"{path}/ds={_as_date(start).isoformat()}"
        if fmt == "csv":
            return csv_ranges.read(spark, folder, schema, csv_options())
        return spark.read.schema(schema).format(fmt).load(folder)
    runs = F.lit(True)
    if start is not None:
        runs = runs & (F.col("ds") >= F.lit(_as_date(start)))
    if end is not None:
        runs = runs & (F.col("ds") <= F.lit(_as_date(end)))
    if fmt == "csv":
        return csv_ranges.read(spark, path, schema, csv_options(), day, runs).drop("ds")
    return spark.read.schema(T.StructType([*schema.fields, day])).format(fmt).load(path).filter(runs).drop("ds")


def read_extract(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ds: dt.date | str,
    fmt: str = "parquet",
) -> DataFrame:
    """Read run ``ds`` of an extract with an explicit schema (no autodetect).

    Only that run's folder is read.
    """
    return read_increments(spark, path, schema, fmt, ds, ds)
