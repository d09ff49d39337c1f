"""The two daily jobs as Spark jobs.

Job 1 (ingest): raw CSV files → typed source tables (full refresh).

Job 2 (warehouse), per entity and run date ``ds``:
extract (snapshot, or the rows of ``ds - 1``) → staging (explicit schema,
REQUIRED check) → insert-only merge into the dimension/fact table; then the
four marts are rebuilt from whatever the dimensions/facts hold.

Every step reads and writes shared storage below one root folder, so each
step is a separate, restartable Spark job and a lost executor only costs
the recomputation of its tasks.  Each step is idempotent for a given
``ds``: extracts and staging replace their own partitions, and the merge
re-inserts nothing that is already present (except NULL keys, by
definition of the merge).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.temporal import in_days
from emporia.operators import catalog, layout, versions
from emporia.operators.increment import first_day_rows
from emporia.operators.merge import MergeResult, merge_into
from emporia.plans import marts
from emporia.schemas import ENTITIES, Entity
from emporia.session import fresh_dir
from emporia.sources import extract, raw_csv, staging


@dataclass(frozen=True)
class Warehouse:
    """One warehouse: its tables in two namespaces of the catalog, and its extract files.

    Source tables have a namespace of their own, which the ingest may reset.
    """

    root: str
    #: name in the catalog (by default made from the folder)
    namespace: str = ""

    def __post_init__(self) -> None:
        if not self.namespace:
            digest = hashlib.sha256(self.root.encode()).hexdigest()[:10]
            object.__setattr__(self, "namespace", f"emporia_{digest}")

    @property
    def sources(self) -> str:
        return f"{self.namespace}_source"

    def _places(self) -> dict[str, str]:
        return {self.sources: f"{self.root}/source", self.namespace: f"{self.root}/warehouse"}

    def open(self, spark: SparkSession) -> Warehouse:
        """Create the namespaces where the catalog has none, and register tables that lie below the folder."""
        missing = {n: place for n, place in self._places().items() if not spark.catalog.databaseExists(n)}
        for name, place in missing.items():
            catalog.attach(spark, name, place, self._tables(name))
        return self

    def _tables(self, namespace: str) -> dict[str, tuple[T.StructType, list[str]]]:
        if namespace == self.sources:
            return {
                e.name: (raw_csv.source_schema(e), layout.partitions_of(e) if e.increment_ts else []) for e in ENTITIES.values()
            }
        found = {catalog.LEDGER: (catalog.LEDGER_SCHEMA, []), AUDIT_TABLE: (AUDIT_SCHEMA, [])}
        for e in ENTITIES.values():
            found[f"stg_{e.name}"] = (layout.table_schema(e), layout.partitions_of(e))
            found[e.final_name] = (layout.final_schema(e), layout.partitions_of(e, final=True))
        for name in marts.MARTS:
            found[name] = (marts.stored_schema(name), [marts.MART_LAYOUT[name][0]])
        return found

    def reset_sources(self, spark: SparkSession) -> None:
        """Drop the source namespace with all it holds, and create its typed tables, empty."""
        catalog.reset_namespace(spark, self.sources, self._places()[self.sources])
        for e in ENTITIES.values():
            parts = layout.partitions_of(e) if e.increment_ts else []
            layout.ensure_table(spark, self.source(e), raw_csv.source_schema(e), parts, replaced=True)

    def source(self, e: Entity) -> str:
        return f"{self.sources}.{e.name}"

    @property
    def exports(self) -> str:
        return f"{self.root}/exports"

    def export(self, e: Entity) -> str:
        return f"{self.exports}/{e.name}"

    def staging(self, e: Entity) -> str:
        return f"{self.namespace}.stg_{e.name}"

    def final(self, e: Entity) -> str:
        return f"{self.namespace}.{e.final_name}"

    def mart(self, name: str) -> str:
        return f"{self.namespace}.{name}"


@dataclass
class AuditRow:
    entity: str
    run_date: dt.date
    rows_read: int
    rows_inserted: int
    rows_already_present: int
    skipped: bool


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_already_present", T.LongType()),
        T.StructField("skipped", T.BooleanType()),
    ]
)


#: the table of all runs' audit rows
AUDIT_TABLE = "load_audit"


def _date(d: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


# ---------------------------------------------------------------- job 1


def ingest_all(
    spark: SparkSession,
    wh: Warehouse,
    raw_dir: str,
    entities: tuple[str, ...] = tuple(ENTITIES),
    timestamp_format: str | None = None,
    reset: bool = False,
    multi_line: bool = True,
) -> None:
    """Replace every source table with the typed rows of its raw file.

    Each table is shown when it is complete.  ``reset`` first drops the whole
    namespace of the sources, tables of other names included.
    """
    wh.open(spark)
    if reset:
        wh.reset_sources(spark)
    for name in entities:
        e = ENTITIES[name]
        raw_csv.ingest(spark, f"{raw_dir}/{e.raw_file}", e, wh.source(e), timestamp_format, multi_line=multi_line)


# ---------------------------------------------------------------- job 2


def _merge_source(spark: SparkSession, wh: Warehouse, e: Entity, staged: DataFrame, merge_source: str) -> DataFrame:
    if merge_source == "staging":
        # the whole staging table, as the warehouse defines the merge
        return staging.read_staging(spark, wh.staging(e), e)
    if merge_source == "slice":
        return staged
    raise ValueError(f"merge_source must be 'staging' or 'slice', not {merge_source!r}")


def load_entity(
    spark: SparkSession,
    wh: Warehouse,
    entity: str,
    ds: dt.date | str,
    merge_source: str = "staging",
) -> AuditRow:
    """Extract → stage → merge one entity for run date ``ds``."""
    wh.open(spark)
    e = ENTITIES[entity]
    ds = _date(ds)
    src = raw_csv.read_source(spark, wh.source(e), e, with_partition=True)

    def clean(df: DataFrame) -> DataFrame:
        return staging.clean(df, e)

    if e.increment_ts is None:
        ext = extract.snapshot(src, wh.exports, e, ds, transform=clean)
    else:
        ext = extract.increment(src, wh.exports, e, ds, transform=clean)
        if ext.skipped:
            return AuditRow(e.name, ds, 0, 0, 0, True)
    if e.increment_ts is None:
        staged = extract.read_snapshot(spark, ext.path, e.table)
    else:
        staged = extract.read_extract(spark, ext.path, e.table, ds, e.extract_format)
    staging.stage(spark, staged, wh.staging(e), e)
    result = merge_into(spark, _merge_source(spark, wh, e, staged, merge_source), wh.final(e), e)
    return AuditRow(e.name, ds, result.rows_read, result.rows_inserted, result.rows_already_present, False)


def run_day(
    spark: SparkSession,
    wh: Warehouse,
    ds: dt.date | str,
    merge_source: str = "staging",
    entities: tuple[str, ...] = tuple(ENTITIES),
) -> DataFrame:
    """Load all entities for ``ds``; stores the run's audit and returns it as a DataFrame."""
    rows = [load_entity(spark, wh, name, ds, merge_source) for name in entities]
    audit = audit_frame(spark, rows)
    catalog.create_table(spark, f"{wh.namespace}.{AUDIT_TABLE}", AUDIT_SCHEMA)
    catalog.append(audit.coalesce(1), f"{wh.namespace}.{AUDIT_TABLE}")
    return audit


def audit_frame(spark: SparkSession, rows: list[AuditRow]) -> DataFrame:
    """The audit records (one per entity and run) as a DataFrame."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in rows], AUDIT_SCHEMA)


def audit_history(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The stored audit rows of all runs."""
    wh.open(spark)
    catalog.create_table(spark, f"{wh.namespace}.{AUDIT_TABLE}", AUDIT_SCHEMA)
    return spark.table(f"{wh.namespace}.{AUDIT_TABLE}")


def reconcile(spark: SparkSession, wh: Warehouse, entity: str) -> DataFrame:
    """Per day of an increment entity: rows in source, staging and final table, and whether they are the same rows.

    Rows are compared by an order-free checksum, the sum of their hashes, so
    one aggregate a table is all that is shuffled: a row per task and day.
    ``status``: ``equal``; ``late rows`` where the source has rows more than
    were staged (they came after their day was loaded, and no daily run takes
    them any more); ``changed`` where as many or fewer are other rows;
    ``not merged`` where the final table differs from what was staged (rows
    whose key was there before are not merged, by the merge's definition).
    Rows without a day (NULL) are a day of their own.
    """
    wh.open(spark)
    e = ENTITIES[entity]
    if e.increment_ts is None:
        raise ValueError(f"{entity} is a snapshot entity")
    layout.ensure_final(spark, wh.final(e), e)
    layers = {
        "source": staging.clean(raw_csv.read_source(spark, wh.source(e), e), e),
        "staged": staging.read_staging(spark, wh.staging(e), e),
        "final": layout.read_entity(spark, wh.final(e), e),
    }
    day = F.to_date(F.col(e.increment_ts))
    sums = []
    for name, rows in layers.items():
        check = F.sum(F.xxhash64(*e.columns).cast("decimal(38,0)"))
        counted = rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"), check.alias("sum"))
        sums.append(counted.select("day", F.lit(name).alias("layer"), "n", "sum"))
    both = reduce(DataFrame.unionByName, sums)

    def of(layer: str, column: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col(column)))

    wide = both.groupBy("day").agg(*[of(name, c).alias(f"{name}_{c}") for name in layers for c in ("n", "sum")])
    rows = {name: F.coalesce(F.col(f"{name}_n"), F.lit(0)) for name in layers}
    status = (
        F.when(rows["source"] > rows["staged"], "late rows")
        .when(~F.col("source_sum").eqNullSafe(F.col("staged_sum")), "changed")
        .when(~F.col("staged_sum").eqNullSafe(F.col("final_sum")), "not merged")
        .otherwise("equal")
    )
    return wide.select(
        F.lit(entity).alias("entity"), "day", *[rows[name].alias(f"{name}_rows") for name in layers], status.alias("status")
    )


def run_dates(spark: SparkSession, wh: Warehouse, entity: str) -> tuple[dt.date, dt.date] | None:
    """First and last run date that finds rows in an increment entity's source; None if it has none.

    Asked of the source's registered days: no row is read.
    """
    wh.open(spark)
    e = ENTITIES[entity]
    found = catalog.days(spark, wh.source(e), e.partition_column)
    one = dt.timedelta(days=1)
    return (found[0] + one, found[-1] + one) if found else None


def _spans(days: list[dt.date], size: int | None) -> list[tuple[dt.date, dt.date]]:
    """Days in order, in runs of at most ``size`` days each: first and last day."""
    size = size or max(1, len(days))
    return [(days[i], days[min(i + size, len(days)) - 1]) for i in range(0, len(days), size)]


def backfill(
    spark: SparkSession,
    wh: Warehouse,
    entity: str,
    start: dt.date | str,
    end: dt.date | str,
    keep_extracts: bool = False,
    days_per_load: int | None = None,
    job: str | None = None,
    max_loads: int | None = None,
) -> AuditRow:
    """Catch up run dates ``start..end`` of an increment entity.

    The days that the source has rows of are loaded in spans of at most
    ``days_per_load`` days (all at once when not given): a cleaned and checked
    staging write (the span's day partitions are replaced), then a merge.

    ``job`` names a catch-up that can be resumed: each span is a load that the
    ledger commits.  Asked again after it was stopped, it goes on after the
    spans committed; the span it was stopped in is undone and done again.
    ``max_loads`` ends a call after so many new spans.

    Per key only the rows of its first day are merged, which is what running
    the days one by one inserts; NULL-key rows go in once.  The per-run extract
    files of the daily flow are a hand-off between systems and are skipped
    here; ``keep_extracts=True`` writes them as well (each row to the run that
    would have carried it).
    """
    wh.open(spark)
    e = ENTITIES[entity]
    if e.increment_ts is None:
        raise ValueError(f"{entity} is a snapshot entity")
    start, end = _date(start), _date(end)
    first, last = start - dt.timedelta(days=1), end - dt.timedelta(days=1)
    days = [d for d in catalog.days(spark, wh.source(e), e.partition_column) if first <= d <= last]
    read = inserted = new = 0
    for lo, hi in _spans(days, days_per_load):
        if max_loads is not None and new >= max_loads:
            break
        load_id = f"{job} {lo.isoformat()} {hi.isoformat()}" if job else None
        result = _backfill_span(spark, wh, e, lo, hi, keep_extracts, load_id)
        read, inserted, new = read + result.rows_read, inserted + result.rows_inserted, new + (not result.replayed)
    return AuditRow(e.name, end, read, inserted, read - inserted, not days)


def _backfill_span(
    spark: SparkSession, wh: Warehouse, e: Entity, lo: dt.date, hi: dt.date, keep_extracts: bool, load_id: str | None
) -> MergeResult:
    """One load of a catch-up: the source's rows of the days ``lo..hi``."""
    if load_id is not None:
        done = catalog.committed(spark, wh.final(e), load_id)
        if done is not None:
            return MergeResult(done.rows_read, done.rows_inserted, True)
    day = F.col(e.partition_column)
    src = (
        raw_csv.read_source(spark, wh.source(e), e, with_partition=True)
        .filter(day.between(F.lit(lo), F.lit(hi)))
        .filter(in_days(e.increment_ts, lo, hi))
    )
    cleaned = staging.clean(src, e)
    if keep_extracts:
        one = dt.timedelta(days=1)
        extract.write_increments(cleaned, wh.export(e), e)
        cleaned = extract.read_increments(spark, wh.export(e), e.table, e.extract_format, lo + one, hi + one)
    # the source is stored by day, as staging and the final table are
    staging.stage(spark, cleaned, wh.staging(e), e, by_day=not keep_extracts)
    batch = (
        layout.read_entity(spark, wh.staging(e), e, with_partition=True)
        .filter(day.between(F.lit(lo), F.lit(hi)))
        .drop(e.partition_column)
    )
    if e.increment_ts not in e.merge_key:
        # a key that holds the timestamp has one day anyway; else written once, as the merge reads it twice
        path = fresh_dir(spark, f"backfill-{e.name}")
        with catalog.lean_writes(spark):
            first_day_rows(batch, e.merge_key, e.increment_ts).write.parquet(path)
        result = merge_into(spark, layout.read_table(spark, path, e.table), wh.final(e), e, load_id)
        versions.delete(spark, path)
        return result
    return merge_into(spark, batch, wh.final(e), e, load_id, by_day=True)


# ---------------------------------------------------------------- marts

#: items that a part of the activity mart is built from at least, and its parts at most
PART_ROWS = 1_000_000
MOST_PARTS = 16


def final_tables(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    wh.open(spark)
    out = {}
    for e in ENTITIES.values():
        layout.ensure_final(spark, wh.final(e), e)
        out[e.final_name] = layout.read_entity(spark, wh.final(e), e)
    return out


def build_marts(spark: SparkSession, wh: Warehouse, names: tuple[str, ...] = tuple(marts.MARTS)) -> None:
    """Rebuild the marts (each fully replaced) from the current dims/facts.

    The activity mart, a row per item, is built from parts of the items.
    """
    tables = final_tables(spark, wh)
    for name in names:
        if name != "mart_user_activity":
            marts.store(marts.MARTS[name](tables), wh.mart(name), name)
            continue
        lookups = fresh_dir(spark, "activity-orders")
        marts.store(marts.user_activity_parts(tables, _item_parts(spark, wh), lookups), wh.mart(name), name)
        versions.delete(spark, lookups)


def _item_parts(spark: SparkSession, wh: Warehouse) -> list[DataFrame]:
    """All items in up to ``MOST_PARTS`` parts of about as many rows, cut between days.

    What joining a part shuffles is gone before the next part begins.  A day is
    in one part, as its folder of the mart is written once.
    """
    e = ENTITIES["order_item"]
    items = layout.read_entity(spark, wh.final(e), e, with_partition=True)
    day = F.col(e.partition_column)
    counts = sorted((r[0], r[1]) for r in items.filter(day.isNotNull()).groupBy(day).count().collect())
    total = sum(n for _, n in counts)
    n = max(1, min(MOST_PARTS, total // PART_ROWS))
    cuts, at, before = [], 0, 0
    for d, rows in counts:
        if before * n // total > at:
            cuts.append(d)
            at = before * n // total
        before += rows
    # the first part has the rows without a day too
    parts = [items.filter(day.isNull() | (day < F.lit(cuts[0])))] if cuts else [items]
    for lo, hi in zip(cuts, [*cuts[1:], None]):
        parts.append(items.filter(day >= F.lit(lo) if hi is None else (day >= F.lit(lo)) & (day < F.lit(hi))))
    return [part.drop(e.partition_column) for part in parts]


def read_mart(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame:
    """A stored mart, its columns as defined; one without rows reads as an empty table."""
    wh.open(spark)
    return marts.read_stored(spark, wh.mart(name), name)
