"""Reading CSV with line breaks in quoted values in byte ranges.

Whether a line break ends a record depends on the quotes before it, all the
way from the start of the file, so Spark's reader takes such a file in one
task.  Here a file is read in ranges:

1. lines are read by range, and the quotes of each range counted: an odd
   number turns "outside of a quoted value" into "inside" and back;
2. the counts are added up range by range within each file, which says whether
   a range starts inside a value;
3. each range joins its own lines into records, starting from what it was told.
   Lines before its first true record start, and those after its last one, are
   fragments of records that cross ranges.  Fragments, at most two a range, are
   put together per file; everything else never leaves its task.

Records then go through Spark's CSV parser one by one.  Quotes are doubled
inside quoted values and stand only around values, as pandas and Spark write
them; a file whose quotes don't pair up fails the read.  Compressed files are
read too, each in one range.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import versions
from emporia.operators.catalog import setting
from emporia.operators.joins import DEFAULT_MAX_BYTES, measured_bytes
from emporia.session import fresh_dir

#: what tasks make of lines: records (``place`` null), and fragments of records that cross ranges (``place`` 0 is a
#: range's head, 1 anything after it); ``own`` passes through
JOINED = pa.schema(
    [
        ("file", pa.int64()),
        ("range", pa.int64()),
        ("place", pa.int32()),
        ("first", pa.bool_()),
        ("own", pa.string()),
        ("record", pa.string()),
    ]
)
_JOINED_DDL = "file long, range long, place int, first boolean, own string, record string"


#: bytes of CSV that a task takes, in as many ranges as that is
TASK_BYTES = 64 << 20


@contextmanager
def many_a_task(spark: SparkSession, path: str) -> Iterator[None]:
    """Reads started inside deal the ranges of ``path`` to tasks of many ranges each, however short a range is.

    A task costs more than a short range does.  There are some tasks a core, and
    more where they would take over ``TASK_BYTES``.
    """
    fs, where = versions.file_system(spark, path)
    size = fs.getContentSummary(where).getLength()
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    with setting(spark, "spark.sql.files.maxPartitionNum", str(tasks)):
        yield


def _lines(spark: SparkSession, path: str, partition: T.StructField | None, where: Column | None = None) -> DataFrame:
    """(line, file, range, own): every line of every range, in order within its task."""
    fields = [T.StructField("value", T.StringType())] + ([partition] if partition else [])
    found = spark.read.schema(T.StructType(fields)).option("lineSep", "\n").text(path)
    if where is not None:
        found = found.filter(where)
    return found.select(
        F.col("value").alias("line"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        (F.col(f"`{partition.name}`") if partition else F.lit(None)).cast("string").alias("own"),
    )


def starts_inside(lines: DataFrame) -> DataFrame:
    """(file, range) of the ranges that start inside a quoted value; fails where a file ends inside one.

    One row per range is shuffled; the running sum is per file.
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "range").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    told = odd.select(
        "file",
        "range",
        (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        (F.sum("odd").over(Window.partitionBy("file")) % 2 == 1).alias("open"),
    )
    unpaired = F.raise_error(F.lit("CSV: a file's quotes don't pair up")).cast("boolean")
    return told.filter(F.when(F.col("open"), unpaired).otherwise(F.col("inside"))).select("file", "range")


class _Joiner:
    """Lines in order → whole records, and the fragments at a range's ends; lines stay in Arrow."""

    def __init__(self) -> None:
        self.at: tuple[int, int] | None = None
        self.own: str | None = None
        #: lines of the record not yet ended; whether they are a range's head, and lie inside a value
        self.pending: list[pa.Array] = []
        self.head = self.inside = False
        #: whether a record has begun in this range
        self.begun = False
        self.out: list[pa.RecordBatch] = []

    def _say(self, records: pa.Array, place: int | None) -> None:
        first = np.zeros(len(records), bool)
        if place != 0:
            first[0] = not self.begun and self.at[1] == 0
            self.begun = True
        same = [pa.repeat(pa.scalar(x, t), len(records)) for x, t in zip((*self.at, place, self.own), (*JOINED.types[:3], pa.string()))]
        columns = [*same[:3], pa.array(first), same[3], records.cast(pa.string())]
        self.out.append(pa.RecordBatch.from_arrays(columns, schema=JOINED))

    @staticmethod
    def _join(lines: pa.Array, ends: np.ndarray) -> pa.Array:
        """Runs of lines that end before ``ends``, each joined by line breaks."""
        if len(ends) == len(lines):
            return lines
        offsets = pa.array(np.r_[0, ends].astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), pa.scalar("\n", lines.type))

    def close(self) -> None:
        """The range ends; what is still open goes on in the next one."""
        if self.pending:
            lines = pa.concat_arrays(self.pending)
            self._say(self._join(lines, np.array([len(lines)])), 0 if self.head else 1)
        self.pending, self.head = [], False

    def range(self, at: tuple[int, int], own: str | None, inside: bool) -> None:
        if at != self.at:
            self.close()
            self.at, self.own, self.begun = at, own, False
            self.inside = self.head = inside

    def lines(self, lines: pa.Array, turns: np.ndarray) -> None:
        after = (np.cumsum(turns) + self.inside) & 1
        self.inside = bool(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        self.pending.append(lines)
        if not len(ends):
            return
        ends += sum(map(len, self.pending)) - len(lines)
        lines = pa.concat_arrays(self.pending) if len(self.pending) > 1 else lines
        self.pending = [lines.slice(ends[-1])] if ends[-1] < len(lines) else []
        records = self._join(lines.slice(0, ends[-1]), ends)
        if self.head:
            self._say(records.slice(0, 1), 0)
            self.head, records = False, records.slice(1)
        if len(records):
            self._say(records, None)

    def flush(self) -> Iterator[pa.RecordBatch]:
        yield from self.out
        self.out = []


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joiner = _Joiner()
    for batch in batches:
        if not batch.num_rows:
            continue
        line, file, begin, own, inside = batch.columns
        file, begin = file.to_numpy(), begin.to_numpy()
        turns = pc.count_substring(line, '"').to_numpy(zero_copy_only=False) & 1
        edges = (np.flatnonzero((file[1:] != file[:-1]) | (begin[1:] != begin[:-1])) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(file)]):
            joiner.range((int(file[lo]), int(begin[lo])), own[lo].as_py(), inside[lo].as_py())
            joiner.lines(line.slice(lo, hi - lo), turns[lo:hi])
        yield from joiner.flush()
    joiner.close()
    yield from joiner.flush()


def records(
    spark: SparkSession,
    path: str,
    partition: T.StructField | None = None,
    where: Column | None = None,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """(first, record, own): every CSV record, line breaks kept; ``first``: the first of its file.

    ``partition``: a column that the folders below ``path`` give, as text in
    ``own``, and ``where`` a condition on it.  The ranges that start inside a value are written once; they are
    broadcast when measured within ``max_bytes`` (at some 50 bytes each), else
    lines meet them by a join and are put in order again.
    """
    lines = _lines(spark, path, partition, where)
    told = fresh_dir(spark, "csv-ranges")
    starts_inside(lines).write.parquet(told)
    told = spark.read.schema("file long, range long").parquet(told)
    found = told.agg(F.count(F.lit(1)).alias("n"), measured_bytes(told).alias("size")).first()
    small = found["size"] <= max_bytes
    told = told.withColumn("inside", F.lit(True))
    numbered = lines if small else lines.withColumn("number", F.monotonically_increasing_id())
    met = numbered.join(F.broadcast(told) if small else told, ["file", "range"], "left")
    if not small:
        met = met.sortWithinPartitions("file", "range", "number")
    met = met.select("line", "file", "range", "own", F.coalesce("inside", F.lit(False)).alias("inside"))
    made = met.mapInArrow(_join_lines, _JOINED_DDL)
    if not found["n"]:
        return made.select("first", "record", "own")  # where no range starts inside a value, no record crosses ranges
    # written, as records and fragments are read apart
    joined = fresh_dir(spark, "csv-records")
    made.write.parquet(joined)
    made = spark.read.schema(_JOINED_DDL).parquet(joined)
    # a record across ranges: a tail, perhaps whole ranges, and a head
    order = Window.partitionBy("file").orderBy("range", "place")
    pieces = made.filter("place IS NOT NULL").withColumn("number", F.sum("place").over(order))
    parts = F.array_sort(F.collect_list(F.struct("range", "place", "record")))
    crossing = pieces.groupBy("file", "number").agg(
        F.max("first").alias("first"),
        F.concat_ws("\n", F.transform(parts, lambda x: x["record"])).alias("record"),
        F.max("own").alias("own"),
    )
    whole = made.filter("place IS NULL").select("first", "record", "own")
    return whole.unionByName(crossing.select("first", "record", "own"))


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    options: Mapping[str, str],
    partition: T.StructField | None = None,
    where: Column | None = None,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Headered CSV below ``path`` with ``schema``, read in byte ranges.

    Every file's header must name the schema's columns in order; another one,
    and a record that doesn't parse or has another number of values, fails the
    read.  Empty lines are no records.  ``partition`` comes last.
    """
    found = records(spark, path, partition, where, max_bytes)
    record = F.col("record")
    record = F.when(record.endswith("\r"), F.expr("substring(record, 1, length(record) - 1)")).otherwise(record)
    found = found.withColumn("record", record).filter("record != ''")
    opts = {k: str(v) for k, v in options.items() if k != "header"} | {"multiLine": "true"}
    texts = ", ".join(f"`c{i}` STRING" for i in range(len(schema.fields)))
    header = F.from_csv(F.regexp_replace("record", "^\ufeff", ""), F.lit(texts), {**opts, "mode": "PERMISSIVE"})
    same = F.lit(True)
    for i, f in enumerate(schema.fields):
        same = same & header[f"c{i}"].eqNullSafe(F.lit(f.name))
    wrong = F.raise_error(F.concat(F.lit(f"CSV header does not match {', '.join(schema.names)}: "), F.col("record"))).cast("boolean")
    rows = found.filter(F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    values = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = rows.select(F.from_csv("record", F.lit(values), {**opts, "mode": "FAILFAST"}).alias("row"), "own")
    own = [F.col("own").cast(partition.dataType).alias(partition.name)] if partition else []
    return parsed.select("row.*", *own)
