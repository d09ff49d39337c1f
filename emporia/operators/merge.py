"""Insert-only MERGE (``WHEN NOT MATCHED THEN INSERT``) on an equality key.

Semantics kept exactly:

1. matched target rows are never updated or deleted (type-0 tables);
2. source rows are compared with the target *as it was before the merge*,
   so two new source rows sharing a key are both inserted;
3. keys compare with plain ``=``: a NULL key part never matches, so such
   rows are inserted again by every merge (no null-safe equality).

Plan: the anti join needs only the key columns of the target (column
pruning reaches the Parquet scan).  One aggregate over the source gives its
row count, the bytes of its keys and, when the key holds the partitioning
timestamp, its range of days.  The range prunes a day-partitioned target
to those folders (equal timestamps have equal days, so the result is
unchanged).  Keys within the broadcast bound (a daily slice) are
broadcast in a LEFT SEMI join that reduces the target to the few hits, so
the large target is scanned once and never shuffled.  A larger source
joins directly: a plain sort-merge anti join, whose skewed keys AQE splits.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporia.operators import catalog, checks, layout
from emporia.operators.joins import DEFAULT_MAX_BYTES, measured_bytes
from emporia.schemas import Entity


@dataclass(frozen=True)
class SourceStats:
    """What one pass over a merge source tells."""

    rows: int
    key_bytes: int
    first_day: dt.date | None = None
    last_day: dt.date | None = None


def source_stats(source: DataFrame, keys: Sequence[str], ts_col: str | None = None) -> SourceStats:
    """Rows, bytes of the key columns and, with ``ts_col``, the range of its days."""
    aggs = [F.count(F.lit(1)).alias("n"), measured_bytes(source.select(*keys)).alias("size")]
    if ts_col is not None:
        day = F.to_date(F.col(ts_col))
        aggs += [F.min(day).alias("lo"), F.max(day).alias("hi")]
    row = source.agg(*aggs).first()
    return SourceStats(int(row.n), int(row["size"]), *((row.lo, row.hi) if ts_col is not None else ()))


def _key_condition(left: DataFrame, right_prefix: str, keys: Sequence[str]):
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"{right_prefix}{k}")
        cond = c if cond is None else cond & c
    return cond


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    day_column: tuple[str, str] | None = None,
    stats: SourceStats | None = None,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Rows of ``source`` whose key has no ``=`` match in ``target``.

    ``day_column=(partition_col, ts_col)``: the target's day partition
    column and the key timestamp it is derived from (enables partition
    pruning of the target when ``ts_col`` is part of ``keys``).
    ``stats``: of the source, when the caller has measured it.
    """
    keys = list(keys)
    by_day = day_column is not None and day_column[1] in keys and day_column[0] in target.columns
    stats = stats or source_stats(source, keys, day_column[1] if by_day else None)
    t_keys = [F.col(k).alias(f"__t_{k}") for k in keys]
    extra_t: list = []
    extra_cond = None
    if by_day:
        part_col, ts_col = day_column
        extra_t = [F.col(part_col).alias("__t___day")]
        extra_cond = F.to_date(F.col(ts_col)) == F.col("__t___day")
        # only these day folders can hold a match (a NULL timestamp never matches)
        if stats.first_day is None:
            target = target.where(F.lit(False))
        else:
            target = target.where(F.col(part_col).between(F.lit(stats.first_day), F.lit(stats.last_day)))
    tgt = target.select(*t_keys, *extra_t)
    if stats.key_bytes <= max_bytes:
        src_keys = source.select(*keys)
        cond = _key_condition(src_keys, "__t_", keys)
        if extra_cond is not None:
            cond = cond & extra_cond
        tgt = tgt.join(F.broadcast(src_keys), on=cond, how="left_semi")
    cond = _key_condition(source, "__t_", keys)
    return source.join(tgt, on=cond, how="left_anti")


@dataclass
class MergeResult:
    rows_read: int
    rows_inserted: int
    #: the load had been committed before: nothing was done
    replayed: bool = False

    @property
    def rows_already_present(self) -> int:
        return self.rows_read - self.rows_inserted


def observed_rows(obs: Observation) -> int:
    """The count ``n`` of an observed write.

    When a stage turns out empty, adaptive execution may drop the observing
    node with it; the metric is then an empty row, and no row was written.
    """
    try:
        return int(obs.get["n"])
    except Py4JJavaError as missing:
        if "toPyRow" not in str(missing):
            raise
        return 0


def _no_rows_of(spark: SparkSession, target: str, day_column: str, stats: SourceStats) -> bool:
    """Whether a table of the catalog has no registered day among the source's, so nothing can match and nothing is joined."""
    if stats.first_day is None:
        return True
    return not any(stats.first_day <= d <= stats.last_day for d in catalog.days(spark, target, day_column))


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    target_path: str,
    entity: Entity,
    load_id: str | None = None,
    by_day: bool = False,
) -> MergeResult:
    """Insert the source's unmatched rows into the entity's stored table (a name in the catalog, or a folder).

    Creates the table when absent (``CREATE TABLE IF NOT EXISTS``).  The
    new rows are appended as new files in their day partitions; existing
    files are never rewritten.  A NULL in a NOT NULL column of the table
    fails the write before anything is committed.  The inserted count is an
    ``Observation`` metric of the writing job (no pass over the target).

    ``load_id``, for tables of the catalog: the load happens once.  A load
    found in the ledger isn't done again; what an unfinished run of it left is
    dropped before.  Without one every call is a load of its own.  ``by_day``:
    the source is read from a table stored by the entity's days.
    """
    named = catalog.is_name(target_path)
    if load_id is not None and not named:
        raise ValueError("a load id needs a table of the catalog")
    layout.ensure_final(spark, target_path, entity)
    if load_id is not None:
        done = catalog.committed(spark, target_path, load_id)
        if done is not None:
            return MergeResult(done.rows_read, done.rows_inserted, True)
        catalog.undo(spark, target_path, load_id)
    target = layout.read_table(spark, target_path, layout.table_schema(entity))
    src = layout.conform(source, entity.table)
    day = (
        (entity.partition_column, entity.partition_ts)
        if entity.partition_ts and entity.partition_ts in entity.merge_key
        else None
    )
    stats = source_stats(src, entity.merge_key, day[1] if day else None)
    fresh = src
    joined = not (named and day and _no_rows_of(spark, target_path, day[0], stats))
    if joined:
        fresh = new_rows(src, target, entity.merge_key, day_column=day, stats=stats)
    inserted = Observation(f"merge_{entity.name}_{uuid.uuid4().hex[:8]}")
    fresh = fresh.observe(inserted, F.count(F.lit(1)).alias("n"))
    layout.write_table(
        checks.require_inline(fresh, entity.required_final, entity.final_name),
        target_path,
        mode="append",
        partition_col=entity.partition_column,
        partition_ts=entity.partition_ts,
        cluster=entity.cluster,
        load_id=(load_id or uuid.uuid4().hex) if named else None,
        by_day=by_day and not joined,
    )
    result = MergeResult(stats.rows, observed_rows(inserted))
    if load_id is not None:
        catalog.commit(spark, target_path, catalog.Load(load_id, result.rows_read, result.rows_inserted))
    return result
