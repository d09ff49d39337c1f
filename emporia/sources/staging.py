"""Staging loads: extract → typed staging table.

* the extract-layer cleaning is lenient: text that does not parse into the
  staging type becomes NULL (``try_cast``), typed columns pass through;
* REQUIRED columns are checked while the rows are written (a projection,
  no extra pass); a NULL fails the job before it commits, so staging stays
  as it was, and only then one aggregation counts the NULLs per column for
  the error message;
* snapshot entities replace the whole staging table (truncate) by a new
  version shown at once, increment
  entities replace only the day partitions of the slice (dynamic partition
  overwrite): the same as an append for a first load, and a retried load
  does not duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.casts import lenient
from emporia.operators import checks, layout
from emporia.schemas import Entity


def clean(df: DataFrame, entity: Entity) -> DataFrame:
    """Extract-layer cleaning: lenient parse of text into the staging types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in entity.table.fields:
        col = F.col(f.name)
        if isinstance(have.get(f.name), T.StringType) and not isinstance(f.dataType, T.StringType):
            col = lenient(col, f.dataType)
        else:
            col = col.cast(f.dataType)
        out.append(col.alias(f.name))
    return df.select(*out)


def stage(spark: SparkSession, df: DataFrame, path: str, entity: Entity, check: bool = True, by_day: bool = False) -> None:
    """Load ``df`` (already cleaned) into the entity's staging table; ``by_day`` as in :func:`emporia.operators.layout.write_table`.

    Raises :class:`emporia.operators.checks.ConstraintViolation` (columns
    and counts) when a REQUIRED column holds NULLs; nothing is committed then.
    """
    df = layout.conform(df, entity.table)
    if not check:
        _write(df, path, entity, by_day)
        return
    try:
        _write(checks.require_inline(df, entity.required, entity.name), path, entity, by_day)
    except Exception as err:
        if checks.REQUIRED_MARK not in str(err):
            raise
        checks.enforce(df, entity, "staging")  # raises with per-column counts
        raise


def _write(df: DataFrame, path: str, entity: Entity, by_day: bool) -> None:
    if entity.staging_mode == "truncate":
        layout.write_table(
            df,
            path,
            mode="overwrite",
            partition_col=entity.partition_column,
            partition_ts=entity.partition_ts,
            cluster=entity.cluster,
            by_day=by_day,
        )
    else:
        layout.write_table(
            df,
            path,
            replace_partitions=True,
            partition_col=entity.partition_column,
            partition_ts=entity.partition_ts,
            cluster=entity.cluster,
            by_day=by_day,
        )


def read_staging(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    replaced = entity.staging_mode == "truncate"
    layout.ensure_table(spark, path, layout.table_schema(entity), layout.partitions_of(entity), replaced)
    return layout.read_entity(spark, path, entity)
