"""Helpers shared by the operators: staging, Arrow loops, small file access."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.session import fresh_dir

#: Rows of text sent to a Python worker at once.  Spark ends a batch at
#: ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB) as well, so long texts
#: come in batches of few rows.
TEXT_BATCH_ROWS = 1000


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few rows: texts may be long.

    The one place that touches the option, and it only lowers it: whatever was
    built last, a session's texts come in batches of at most that many rows.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key, "0"))
    if rows <= 0 or rows > TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and return it reread.

    Cuts lineage: what follows reads the written files, which survive lost
    executors.  The folder belongs to the caller of the job.
    """
    path = fresh_dir(session_of(df), label)
    df.write.option("compression", "zstd").parquet(path)
    return session_of(df).read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Only the id, the text (null text: empty) and ``keep``, whatever else ``docs`` holds."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in keep],
    )


def crc_split(id_col: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function from one batch to batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def record(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=types[n], from_pandas=False)
        for n, c in columns.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def spread(keys: np.ndarray) -> np.ndarray:
    """A 64-bit mix of integer keys (splitmix finaliser), for bucketing in numpy."""
    x = keys.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (``file:/x`` and ``file:///x`` alike)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def publish(path: str, attempt: int, write: Callable[[object], None]) -> None:
    """Write a file under a name of this attempt, then move it to ``path``.

    A retried or speculative task writes the same bytes again and replaces
    the file whole, so readers never see part of one.
    """
    store, name = open_store(path)
    folder = name.rsplit("/", 1)[0]
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name.rsplit('/', 1)[1]}.{attempt}"
    with store.open_output_stream(part) as out:
        write(out)
    store.move(part, name)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores added until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def append(df: DataFrame, fn: Callable[[list[str]], pa.Array], text_col: str, name: str, kind: str) -> DataFrame:
    """``df`` with one column more, computed from the whole texts of a batch (null: empty).

    All other columns pass through unread; ``name`` must be free.
    """
    work = free_name(df, "__text")
    own = df.columns

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = fn(texts(batch, work))
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], made], names=[*own, name])

    bounded_batches(session_of(df))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return arrow_map(df.withColumn(work, text), run, f"{schema}, `{name}` {kind}")
