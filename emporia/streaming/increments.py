"""The daily increment as a Structured Streaming job.

Extract folders (one ``ds=`` partition per run) are a file source: a stream
with ``trigger(availableNow=True)`` picks up every run that arrived since
the last one, as one micro-batch, and stops.  There is no cap on files: a
day's files must meet in one batch, or the merge would find the first
file's keys present and lose in-batch duplicates.  The micro-batch goes
through the same REQUIRED check and insert-only merge as the batch loads,
via ``foreachBatch``.  The stream's checkpoint (under the shared work folder)
records which files were processed, so a restarted job continues where it
stopped.  Into a table of the catalog a micro-batch is a load of its own, named
by stream and epoch and committed in the namespace's ledger: one that is
replayed after a failure is skipped when it was committed, else undone and done
again, so every row goes in once, those with NULL keys included.  A plain
folder has no ledger: there a replay skips keys already present only.

Per key only the rows of its first day in the micro-batch are merged, so a
micro-batch spanning several runs inserts what running those days one by
one would have inserted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emporia.operators import catalog, checks, layout
from emporia.operators.increment import first_day_rows
from emporia.operators.merge import merge_into
from emporia.schemas import Entity
from emporia.session import fresh_dir
from emporia.sources.extract import csv_options


@dataclass
class StreamReport:
    batches: int = 0
    rows_read: int = 0
    rows_inserted: int = 0
    per_batch: list[tuple[int, int, int]] = field(default_factory=list)


def increment_stream(spark: SparkSession, extract_path: str, entity: Entity) -> DataFrame:
    """A streaming DataFrame over an entity's extract folder."""
    full = T.StructType([*entity.table.fields, T.StructField("ds", T.DateType(), True)])
    reader = spark.readStream.schema(full).format(entity.extract_format)
    if entity.extract_format == "csv":
        # a run's files are read whole: values may hold line breaks
        reader = reader.options(**csv_options()).option("mode", "FAILFAST").option("enforceSchema", False).option("multiLine", True)
    return reader.load(extract_path)


def merge_stream(
    spark: SparkSession,
    extract_path: str,
    entity: Entity,
    target_path: str,
    checkpoint: str,
    stream: str | None = None,
) -> StreamReport:
    """Merge every not yet processed extract run into the entity's table, then stop.

    ``stream`` names the stream in the ledger (by default its checkpoint does).
    """
    report = StreamReport()
    named = catalog.is_name(target_path)

    def committed(session: SparkSession, load_id: str) -> bool:
        layout.ensure_final(session, target_path, entity)
        return catalog.committed(session, target_path, load_id) is not None

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        session, load_id = batch.sparkSession, f"stream {stream or checkpoint} {epoch_id}" if named else None
        rows = layout.conform(batch.drop("ds"), entity.table)
        if load_id is None or not committed(session, load_id):
            # written once, REQUIRED columns checked on the way; the merge reads that (a replay reads nothing)
            path = fresh_dir(session, "increment-batch")
            checks.require_inline(rows, entity.required, entity.name).write.parquet(path)
            rows = layout.read_table(session, path, entity.table)
            if entity.increment_ts not in (None, *entity.merge_key):
                rows = first_day_rows(rows, entity.merge_key, entity.increment_ts)
        res = merge_into(session, rows, target_path, entity, load_id)
        report.batches += 1
        report.rows_read += res.rows_read
        report.rows_inserted += res.rows_inserted
        report.per_batch.append((epoch_id, res.rows_read, res.rows_inserted))

    query = (
        increment_stream(spark, extract_path, entity)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return report
