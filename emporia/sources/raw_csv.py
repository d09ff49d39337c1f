"""Raw CSV files → typed source tables (the ingest job).

* columns are matched by the header's names (not by position);
* the missing-value tokens pandas uses by default become NULL;
* parsing is strict: a value that does not parse, a NULL in an integer
  column, or a string longer than its VARCHAR(n) limit fails the job with
  the column named — the checks are projections evaluated during the one
  pass that writes the table, not separate scans;
* the source table is replaced as a whole, shown when it is complete; tables
  with a daily increment are stored partitioned by the increment's day.

Nothing is read on the driver except the header line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions import date_formats
from emporia.functions.casts import PANDAS_NULL_TOKENS, nullify_tokens, required_parse, strict, strict_int_via_double
from emporia.operators import layout
from emporia.operators.catalog import lean_writes
from emporia.schemas import Entity
from emporia.sources import csv_ranges

#: format used for timestamps in CSV files this package writes
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

#: as ``timestamp_format``: find the formats out from the values
INFER = "infer"

#: rows of a gzipped raw file at most
GZIPPED_ROWS = 1_000_000

#: quoting as pandas reads and writes it: doubled quotes, spaces untouched
CSV_QUOTING = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_raw(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = True) -> DataFrame:
    """Headered CSV as all-string columns named by the header.

    Files of one folder must share their header; another one fails the
    read.  Quoted values may hold line breaks: files are read in byte ranges
    (:mod:`emporia.sources.csv_ranges`).  ``multi_line=False`` saves the pass
    that counts quotes for files known to hold none.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .options(**CSV_QUOTING)
        .option("mode", "FAILFAST")
    )
    if not multi_line:
        return reader.csv(path)
    # the header's names, from the first file's first record
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return csv_ranges.read(spark, path, schema, {"sep": sep, **CSV_QUOTING})


def typed_source(
    raw: DataFrame,
    entity: Entity,
    timestamp_format: str | None = None,
    null_tokens: tuple[str, ...] = PANDAS_NULL_TOKENS,
    day_first: bool | None = None,
) -> DataFrame:
    """Strictly typed source-layer table of ``entity`` from all-string ``raw``.

    ``timestamp_format``: one pattern, ``INFER`` (found out from all rows, one
    job; ``day_first`` as in :func:`emporia.functions.date_formats.infer`), or
    None for ISO text as Spark casts it.
    """
    missing = [f.name for f in entity.source.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{entity.raw_file}: header lacks column(s) {', '.join(missing)}")
    formats: dict[str, tuple[str, ...]] = {}
    if timestamp_format == INFER:
        stamps = [f.name for f in entity.source.fields if isinstance(f.dataType, T.TimestampNTZType)]
        texts = raw.select(*[nullify_tokens(F.col(c), null_tokens).alias(c) for c in stamps])
        formats = date_formats.infer(texts, stamps, day_first)
    out = []
    for f in entity.source.fields:
        text = nullify_tokens(F.col(f.name), null_tokens)
        name = f"{entity.name}.{f.name}"
        if f.name == "order_item_id":
            # float in the cleaning step, stored as text in the source table
            col = strict(text, "double", name).cast("string")
        elif isinstance(f.dataType, T.IntegerType):
            parsed = strict_int_via_double(text, name)
            col = F.when(
                parsed.isNull(),
                F.raise_error(F.lit(f"cannot convert a missing value to integer in {name}")),
            ).otherwise(parsed)
        elif isinstance(f.dataType, T.StringType):
            col = text
        elif f.name in formats:
            col = required_parse(text, date_formats.read(text, formats[f.name]), f.dataType, name)
        else:
            col = strict(text, f.dataType, name, timestamp_format)
        limit = entity.max_length.get(f.name)
        if limit is not None:
            col = F.when(
                F.length(col) > F.lit(limit),
                F.raise_error(
                    F.concat(F.lit(f"value too long for {name} (max {limit}): '"), col, F.lit("'"))
                ),
            ).otherwise(col)
        out.append(col.alias(f.name))
    return raw.select(*out)


def ingest(
    spark: SparkSession,
    raw_path: str,
    entity: Entity,
    target: str,
    timestamp_format: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    multi_line: bool = True,
    day_first: bool | None = None,
) -> str:
    """Replace the entity's source table with the typed rows of ``raw_path``.

    ``transform`` (DataFrame → DataFrame) runs on the all-string frame
    before typing, for feeds that need extra cleaning; ``multi_line`` as in
    :func:`read_raw`, ``timestamp_format`` and ``day_first`` as in
    :func:`typed_source`.
    """
    raw = read_raw(spark, raw_path, multi_line=multi_line)
    if transform is not None:
        raw = raw.transform(transform)
    write_source(typed_source(raw, entity, timestamp_format, day_first=day_first), target, entity)
    return target


def source_schema(entity: Entity) -> T.StructType:
    """Stored schema of a source table; increment entities have the day of their increment column."""
    day = [T.StructField(entity.partition_column, T.DateType())] if entity.increment_ts else []
    return T.StructType([*entity.source.fields, *day])


def write_source(df: DataFrame, target: str, entity: Entity) -> None:
    """Replace a source table; increment entities are stored by day of the increment column."""
    # by purchase day, so the daily increment reads one folder
    part = entity.partition_column if entity.increment_ts else None
    df = layout.conform(df, entity.source)
    layout.write_table(df, target, mode="overwrite", partition_col=part, partition_ts=entity.increment_ts)


def read_source(spark: SparkSession, target: str, entity: Entity, with_partition: bool = False) -> DataFrame:
    """A source table with its declared schema (and its day column when asked)."""
    df = layout.read_table(spark, target, source_schema(entity))
    return df.drop(entity.partition_column) if entity.increment_ts and not with_partition else df


def write_raw(df: DataFrame, path: str, gzipped: bool = False) -> str:
    """Write ``df`` as a headered CSV folder (how raw files are exchanged).

    ``gzipped``: about a fifth of the bytes; as such a file is read by one
    task, none has over ``GZIPPED_ROWS`` rows.
    """
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .options(**CSV_QUOTING)
        .option("timestampFormat", CSV_TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
    )
    if gzipped:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", GZIPPED_ROWS)
    with lean_writes(df.sparkSession):
        writer.csv(path)
    return path
