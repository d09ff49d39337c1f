"""Packing documents into windows of fixed length by minimum bin slack.

Texts are tokenized once; each document is cut into full windows and one
remainder, and those pieces are written.  What is left to pack is a histogram
of at most ``window`` piece lengths.  Minimum bin slack fills one window at a
time: the longest remaining length goes in, and a subset-sum over the remaining
multiset, a bitset with one bit per reachable sum, finds the lengths that bring
the window closest to its capacity; going back through the bitsets gives how
often each length is used.  The same window is repeated while the counts last,
so the plan has at most a few thousand windows however many pieces there are.

Pieces of one length are interchangeable: ranking them, by length and a hashed
bucket so that a hot length is spread over many tasks, tells each piece its
window and offset.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import arrow_map, bounded_batches, column, crc32, free_name, id_text, record, session_of, stage
from emporia.llm.tokens import Encoder, default_vocabulary

WINDOW = 2048
#: Id that ends a document.
END_ID = 1
#: Buckets that the pieces of one length are ranked in.
BUCKETS = 256

PIECE = "piece_id long, doc_id long, start long, length int, doc_tokens long"


def pieces(
    docs: DataFrame,
    window: int = WINDOW,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    digest: bool = False,
) -> DataFrame:
    """One row per piece, its ids little-endian unsigned 32-bit, written and reread.

    ``piece_id`` is unique, whatever the documents' ids.  Null and empty texts
    are documents of the end id alone.  ``digest`` gives ``ids_crc32``, the
    unsigned crc32 of those bytes, in place of ``ids``: for those who need
    places and checks only, no id is written.
    """
    vocabulary = vocabulary or default_vocabulary()
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    types = {
        "piece_id": pa.int64(), "doc_id": pa.int64(), "start": pa.int64(),
        "length": pa.int32(), "doc_tokens": pa.int64(), last[0]: last[1],
    }

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            edges, ids = encoder.encode_array(column(batch, "text"))
            # each document with its end id
            data = memoryview(np.insert(ids, edges[1:], end_id).astype("<u4", copy=False)).cast("B")
            edges = edges + np.arange(len(edges))
            total = np.diff(edges)
            count = -(-total // window)
            doc = np.repeat(np.arange(len(total)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
            length = np.minimum(total[doc] - start, window)
            first = 4 * (edges[doc] + start)
            spans = [data[lo:hi] for lo, hi in zip(first.tolist(), (first + 4 * length).tolist())]
            values = (
                number + np.arange(len(doc)),
                column(batch, "doc_id").take(pa.array(doc)),
                start,
                length.astype(np.int32),
                total[doc],
                [crc32(span) for span in spans] if digest else [bytes(span) for span in spans],
            )
            number += len(doc)
            yield record(dict(zip(types, values)), types)

    bounded_batches(session_of(docs))
    kind = f"{PIECE}, ids_crc32 long" if digest else f"{PIECE}, ids binary"
    return stage(id_text(docs, id_col, text_col).mapInArrow(cut, kind), "packing-pieces")


@dataclass(frozen=True)
class Pattern:
    """A window's contents, length to count, and how many windows are filled so."""

    contents: tuple[tuple[int, int], ...]
    repeats: int


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of remaining lengths whose sum comes closest below ``capacity``.

    Bounded subset-sum: bit ``s`` of ``reach`` says that sum ``s`` can be made.
    Counts enter in powers of two; the states passed are walked back.
    """
    reach, limit, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, chunk = min(counts[length], capacity // length), 1
        while left and not reach >> capacity & 1:
            chunk = min(chunk, left)
            steps.append((length, chunk, reach))
            reach |= reach << length * chunk & limit
            left -= chunk
            chunk *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, chunk, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + chunk
            at -= length * chunk
    return used


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Windows by minimum bin slack, the longest remaining length first."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    patterns = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        used = fill({k: n for k, n in counts.items() if n}, window - longest)
        used[longest] = used.get(longest, 0) + 1
        counts[longest] += 1
        repeats = min(counts[k] // n for k, n in used.items())
        for k, n in used.items():
            counts[k] -= n * repeats
            if not counts[k]:
                del counts[k]
        patterns.append(Pattern(tuple(sorted(used.items(), reverse=True)), repeats))
    return patterns


def allocation(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Which ranks of each length go to which windows, sorted by length and rank."""
    rows, given, first = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, n in pattern.contents:
            rank = given.get(length, 0)
            rows.append((length, rank, n, first, offset))
            given[length] = rank + n * pattern.repeats
            offset += n * length
        first += pattern.repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "sequence", "offset"), table.T))


def pack(pieces: DataFrame, window: int = WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` (``piece_id``, ``length`` and any other columns) with ``sequence_id`` and ``offset``.

    Every piece gets a place; offsets in a sequence run from 0 without gaps.
    The histogram, at most ``window`` rows, is what the driver plans from.
    Other columns pass through; one named ``sequence_id`` or ``offset`` is
    kept, and the place gets the next free name (with an underscore).
    """
    own = pieces.columns
    bucket, before_, rank_, n_ = (free_name(pieces, x) for x in ("__bucket", "__before", "__rank", "__n"))
    sequence_id, offset_ = free_name(pieces, "sequence_id"), free_name(pieces, "offset")
    counts = pieces.groupBy("length").count().collect()
    table = allocation(plan({r["length"]: r["count"] for r in counts}, window))
    keyed = pieces.withColumn(bucket, F.pmod(F.xxhash64("piece_id"), F.lit(buckets)).cast("int"))
    # at most window x buckets rows
    sizes = keyed.groupBy("length", bucket).agg(F.count(F.lit(1)).alias(n_))
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", bucket, F.coalesce(F.sum(n_).over(before), F.lit(0)).alias(before_))
    inside = Window.partitionBy("length", bucket).orderBy("piece_id")
    ranked = (
        keyed.withColumn(rank_, F.row_number().over(inside) - 1)
        .join(sizes, ["length", bucket])
        .withColumn(rank_, (F.col(rank_) + F.col(before_)).cast("long"))
        .select(*[F.col(f"`{c}`") for c in own], rank_)
    )
    starts = {int(k): int(i) for i, k in reversed(list(enumerate(table["length"])))}
    stops = {int(k): int(i) + 1 for i, k in enumerate(table["length"])}

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length = column(batch, "length").to_numpy().astype(np.int64)
        rank = column(batch, rank_).to_numpy()
        row = np.zeros(len(rank), np.int64)
        for k in np.unique(length):
            lo, hi = starts[int(k)], stops[int(k)]
            at = np.flatnonzero(length == k)
            row[at] = lo + np.searchsorted(table["rank"][lo:hi], rank[at], "right") - 1
        turn, slot = np.divmod(rank - table["rank"][row], table["each"][row])
        columns = [column(batch, c) for c in own]
        columns += [pa.array(table["sequence"][row] + turn), pa.array(table["offset"][row] + slot * length)]
        yield pa.RecordBatch.from_arrays(columns, names=[*own, sequence_id, offset_])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return arrow_map(ranked, place, f"{schema}, `{sequence_id}` long, `{offset_}` long")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): whole sequences, padded unless their length is a power of two.

    A sequence has at most ``window`` pieces, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    types = {"sequence_id": pa.int64(), "length": pa.int64(), "ids": pa.binary()}

    def join(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, lengths = [], []
        for group in column(batch, "parts").to_pylist():
            data = b"".join(p["ids"] for p in group)
            n = len(data) // 4
            lengths.append(n)
            ids.append(data if n & (n - 1) == 0 else data + struct.pack("<I", pad_id) * (window - n))
        yield record({"sequence_id": column(batch, "sequence_id"), "length": lengths, "ids": ids}, types)

    return arrow_map(rows, join, "sequence_id long, length long, ids binary")
