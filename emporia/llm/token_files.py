"""Token ids of documents in binary files with a shared zstandard dictionary.

A shard file holds, in order: the magic, the dictionary's SHA-256, the width of
an id in bytes, one zstandard frame per document, then the index and a fixed
footer.  The index has each document's id, where its frame starts and how many
ids it holds, so one short document is read with two seeks.  The dictionary is
a file of its own beside the shards, trained on the serialized id arrays of a
bounded sample of short documents; a reader checks its hash.

Documents are dealt to shards by range of their id and sorted in each, so shard
order and document order agree, and a small table, the manifest, says how many
ids each shard holds.  A shard is written under a temporary name and moved into
place, so a lost task leaves nothing behind and its retry replaces the file.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm.common import bounded_batches, column, id_text, open_store, publish, record, session_of
from emporia.llm.tokens import Encoder, default_vocabulary

MAGIC = b"EMTOK001"
#: Where the index starts, how many documents it holds, the magic again.
FOOTER = "<QQ8s"
#: Documents of the dictionary's sample, and the longest text among them.
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 8000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 1
#: Id that ends a document.
END_ID = 0
#: Ids a reading task hands on at once.
READ_IDS = 1 << 22

MANIFEST = "shard int, file string, docs long, ids long, bytes long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def _serialize(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _restore(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, vocabulary: str, width: int, end_id: int = END_ID) -> bytes:
    """A zstandard dictionary from whole short documents (b"" if there are none).

    The sample: at most ``SAMPLE_DOCS`` rows, of the ids with the smallest hash
    among texts of at most ``SAMPLE_CHARS`` characters.
    """
    short = docs.filter(F.length("text") <= SAMPLE_CHARS)
    keys = short.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    # at most SAMPLE_DOCS ids are sent to the documents, and their texts back
    rows = short.join(F.broadcast(keys), "doc_id").orderBy("doc_id", "text").limit(SAMPLE_DOCS)
    picked = rows.select("text").toPandas()["text"]
    end = struct.pack("<I", end_id)
    samples = [_serialize(ids + end, width) for ids in Encoder.of(vocabulary).encode(list(picked))]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 4)
    if size < 256:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Write all documents below ``path`` and return the manifest, reread.

    Ascending id order, null ids first; rows of one id by their text's hash.  Null and
    empty texts hold the end id alone.  Repeated rows are written each.
    """
    spark = session_of(docs)
    vocabulary = vocabulary or default_vocabulary()
    docs = id_text(docs, id_col, text_col)
    width = 2 if Encoder.of(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    dictionary = train_dictionary(docs, vocabulary, width, end_id)
    digest = hashlib.sha256(dictionary).digest()
    path = path.rstrip("/")
    publish(f"{path}/dictionary.zdict", 0, lambda out: out.write(dictionary))
    shared = spark.sparkContext.broadcast(dictionary)
    end = struct.pack("<I", end_id)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        task = TaskContext.get()
        number, name = task.partitionId(), f"{path}/shard-{task.partitionId():06d}.tok"
        encoder = Encoder.of(vocabulary)
        zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        keys: list[pa.Array] = []
        counts: list[int] = []
        sizes: list[int] = []

        def fill(out) -> None:
            out.write(MAGIC + digest + bytes([width]))
            batch = first
            while batch is not None:
                keys.append(column(batch, "doc_id"))
                for ids in encoder.encode(column(batch, "text")):
                    frame = zip_.compress(_serialize(ids + end, width))
                    out.write(frame)
                    counts.append(len(ids) // 4 + 1)
                    sizes.append(len(frame))
                batch = next(batches, None)
            ids = pa.concat_arrays(keys)
            offsets = np.cumsum([len(MAGIC) + 33] + sizes, dtype=np.int64)
            index = b"".join(
                [
                    np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), np.uint8).tobytes(),
                    ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                    offsets[:-1].astype("<i8").tobytes(),
                    np.array(counts, "<u4").tobytes(),
                ]
            )
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(index)
            out.write(frame + struct.pack(FOOTER, int(offsets[-1]), len(counts), MAGIC))

        publish(name, task.taskAttemptId(), fill)
        row = {"shard": [number], "file": [name], "docs": [len(counts)], "ids": [sum(counts)], "bytes": [sum(sizes)]}
        types = {"shard": pa.int32(), "file": pa.string(), "docs": pa.int64(), "ids": pa.int64(), "bytes": pa.int64()}
        yield record(row, types)

    bounded_batches(spark)
    # by id and text, so that the rows of one id, however many, go to several shards
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = docs.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    dealt.mapInArrow(shard, MANIFEST).write.parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shards in order, with the ids of all shards before each (column ``start``)."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class Shard:
    """Random access to one shard file."""

    def __init__(self, file: str, dictionary: bytes | None = None):
        store, name = open_store(file)
        self.file = store.open_input_file(name)
        size, foot = self.file.size(), struct.calcsize(FOOTER)
        at, n, magic = struct.unpack(FOOTER, self._at(size - foot, foot))
        head = self._at(0, len(MAGIC) + 33)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{file} is not a token shard")
        if dictionary is None:
            with store.open_input_file(f"{name.rsplit('/', 1)[0]}/dictionary.zdict") as f:
                dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != head[len(MAGIC) : len(MAGIC) + 32]:
            raise ValueError(f"{file} was written with another dictionary")
        self.width = head[-1]
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        index = zstandard.ZstdDecompressor().decompress(self._at(at, size - foot - at), max_output_size=21 * n + 64)
        self.known = np.frombuffer(index, np.uint8, n).astype(bool)
        self.doc_ids = np.frombuffer(index, "<i8", n, n)
        self.offsets = np.append(np.frombuffer(index, "<i8", n, 9 * n), at)
        self.counts = np.frombuffer(index, "<u4", n, 17 * n).astype(np.int64)

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def ids(self, row: int) -> bytes:
        """Little-endian unsigned 32-bit ids of the document in that row of the index."""
        lo, hi = int(self.offsets[row]), int(self.offsets[row + 1])
        frame = self._at(lo, hi - lo)
        return _restore(self.unzip.decompress(frame, max_output_size=self.width * int(self.counts[row])), self.width)

    def find(self, doc_id: int) -> bytes | None:
        """Ids of the first document of that id, or None."""
        rows = np.flatnonzero(self.known & (self.doc_ids == doc_id))
        return self.ids(int(rows[0])) if len(rows) else None

    def close(self) -> None:
        self.file.close()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files below ``path``.

    ``ids`` are little-endian unsigned 32-bit, the end id included; ``start``
    counts the ids of all documents before.
    """
    path = path.rstrip("/")
    shards = manifest(spark, path)
    count = max(1, spark.read.schema(MANIFEST).parquet(f"{path}/manifest").count())
    types = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(column(batch, "file").to_pylist(), column(batch, "start").to_pylist()):
                shard = Shard(file)
                starts = start + np.concatenate(([0], np.cumsum(shard.counts)))
                lo = 0
                while lo < len(shard.counts):
                    hi = lo + 1 + int(np.searchsorted(np.cumsum(shard.counts[lo + 1 : lo + 4096]), READ_IDS))
                    hi = min(hi, len(shard.counts))
                    yield record(
                        {
                            "doc_id": pa.array(shard.doc_ids[lo:hi], mask=~shard.known[lo:hi]),
                            "start": starts[lo:hi],
                            "n_tokens": shard.counts[lo:hi],
                            "ids": [shard.ids(i) for i in range(lo, hi)],
                        },
                        types,
                    )
                    lo = hi
                shard.close()

    return shards.select("file", "start").repartition(count).mapInArrow(rows, DOCUMENT)
