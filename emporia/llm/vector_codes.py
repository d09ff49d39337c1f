"""Compressing vectors to product codes, their nearest entries found by bitmasks.

Vectors become integers, are cut into equal parts, and each part is replaced
by its nearest entry of that part's codebook; the codebooks are refined by a
few rounds of means.  All arithmetic is in integers, so the result doesn't
depend on how rows are dealt out.

Nearest entries (slice and intersect): per dimension the entries' coordinates
are sorted and each prefix of that order carries a bitmask of its entries, 64
to a word.  A point with a radius selects one range per dimension by two binary
searches; the range's entries are two prefix masks' difference, and the ranges'
masks ANDed are the entries inside the cube around the point.  Those are
compared exactly; where masks rule out little (many dimensions, no clusters), a
block's distances come from one matrix product of whole numbers below 2**53,
exact in doubles, and the masks choose among them.  An entry found within the radius is the nearest one, as
every entry that near lies in the cube; the other points are asked again with
the distance of the best entry seen, which bounds the nearest one's.

Each round is one scan: a task sums its points per entry, so what is shuffled
is one row per task, entry and position.  Only the codebooks (entries x
dimensions) pass through the driver and to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.llm.common import column, free_name, record, session_of, stage
from emporia.operators.joins import small_side

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Points searched at once; bounds a worker's memory at BLOCK x entries x part dimensions.
BLOCK = 512
LONG = (1 << 63) - 1
#: Share of entries left by the masks from which a block is compared by a matrix product.
DENSE = 0.1


def usable(vector: Column) -> Column:
    """Whether a vector is there, is not empty, and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers; what a long can't hold becomes the nearest long."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * scale)
    top = 2.0**63
    out = np.where(np.abs(scaled) < top, scaled, 0).astype(np.int64)
    out[scaled >= top] = LONG
    out[scaled <= -top] = -LONG - 1
    return out


def part_bounds(dimension: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts, equal when ``parts`` divides the dimension, else as equal as can be."""
    edges = [dimension * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


class Slices:
    """A codebook's entries, ready for exact nearest searches."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        #: for matrix products, and the largest component for which they are exact
        self.floats = entries.astype(np.float64) if entries.dtype != object else None
        self.exact = isqrt((1 << 53) // (4 * max(1, entries.shape[1])))
        self.largest = max((abs(int(x)) for x in (entries.max(), entries.min())), default=0) if entries.size else 0
        count = len(entries)
        words = -(-count // 64)
        self.order, self.prefix = [], []
        for values in entries.T:
            rank = np.argsort(values, kind="stable")
            masks = np.zeros((count + 1, words), np.uint64)
            for i, e in enumerate(rank):
                masks[i + 1] = masks[i]
                masks[i + 1, e // 64] |= np.uint64(1 << int(e) % 64)
            self.order.append(values[rank])
            self.prefix.append(masks)
        spread = [int(v[-1]) - int(v[0]) for v in self.order]
        #: the dimension that tells entries apart best, for a first guess
        self.widest = int(np.argmax(spread)) if spread else 0
        self.by_widest = np.argsort(entries[:, self.widest], kind="stable") if spread else None
        #: first radius, learned from the points already searched; None asks each point's guess
        self.radius: int | None = None
        #: points asked a second time, and candidates compared, so far
        self.again = self.compared = 0

    def inside(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bitmask words of the entries in the cube of ``radius`` around each point."""
        found = None
        for values, order, masks in zip(points.T, self.order, self.prefix):
            ranges = masks[np.searchsorted(order, values + radius, "right")] ^ masks[np.searchsorted(order, values - radius, "left")]
            found = ranges if found is None else found & ranges
        return found

    def best(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per point the nearest entry in its cube (ties to the lower) and its squared distance; -1 where the cube is empty."""
        words = np.ascontiguousarray(self.inside(points, radius)).astype("<u8")
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, : len(self.entries)]
        left = int(np.bitwise_count(words).sum())
        self.compared += left
        if left > DENSE * bits.size and self._whole(points):
            return self._dense(points, bits)
        row, entry = np.nonzero(bits)
        off = points[row] - self.entries[entry]
        distance = (off * off).sum(axis=1)
        nearest = np.full(len(points), -1, np.int64)
        least = np.zeros(len(points), points.dtype)
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            low = np.minimum.reduceat(distance, starts)
            hit = np.flatnonzero(distance == np.repeat(low, np.diff(np.r_[starts, len(row)])))
            who, first = np.unique(row[hit], return_index=True)
            nearest[who], least[who] = entry[hit][first], low
        return nearest, least

    def _whole(self, points: np.ndarray) -> bool:
        """Whether all that a matrix product of the points adds up stays a whole number in doubles."""
        if self.floats is None or not points.size:
            return False
        return max(self.largest, int(points.max()), -int(points.min())) < self.exact

    def _dense(self, points: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`best` by one matrix product."""
        floats = points.astype(np.float64)
        distance = (floats * floats).sum(axis=1)[:, None] - 2 * (floats @ self.floats.T) + (self.floats * self.floats).sum(axis=1)
        distance[bits == 0] = np.inf
        nearest = distance.argmin(axis=1)
        least = distance[np.arange(len(points)), nearest]
        found = np.isfinite(least)
        return np.where(found, nearest, -1), np.where(found, least, 0).astype(np.int64)

    def guess(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to an entry near it in the widest dimension."""
        order = self.order[self.widest]
        at = np.minimum(np.searchsorted(order, points[:, self.widest]), len(order) - 1)
        off = points - self.entries[self.by_widest[at]]
        return (off * off).sum(axis=1)

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every point, exactly."""
        nearest, least = np.zeros(len(points), np.int64), np.zeros(len(points), points.dtype)
        for lo in range(0, len(points), BLOCK):
            block = points[lo : lo + BLOCK]
            bound = self.guess(block)
            root = _roots(bound)
            radius = root if self.radius is None else np.minimum(root, self.radius)
            entry, distance = self.best(block, radius)
            # found within the radius: no entry outside the cube is nearer
            known = (entry >= 0) & ((distance <= radius * radius) | (radius == root))
            rest = np.flatnonzero(~known)
            if len(rest):
                self.again += len(rest)
                seen = np.where(entry[rest] >= 0, np.minimum(distance[rest], bound[rest]), bound[rest])
                entry[rest], distance[rest] = self.best(block[rest], _roots(seen))
            nearest[lo : lo + BLOCK], least[lo : lo + BLOCK] = entry, distance
            self.radius = isqrt(int(sorted(distance.tolist())[len(distance) * 3 // 4]))
        return nearest, least


def _roots(squares: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded down."""
    if squares.dtype == object:
        return np.array([isqrt(x) for x in squares], dtype=object)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


@dataclass
class Codebooks:
    """Per part its entries' integers (entries x part dimensions); ``dimension`` 0: no vector was kept."""

    dimension: int
    entries: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256, in hex, of all entries' components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def _small(arrays: list[np.ndarray]) -> bool:
    """Whether squared distances between the arrays' rows fit a long with room to spare."""
    width = max((a.shape[1] for a in arrays), default=0)
    most = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    return 4 * most * most * max(width, 1) < 1 << 60


class Assigner:
    """Assigns vectors to codebooks in a task; numbers too large for longs take Python's integers."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.bounds = part_bounds(books.dimension, len(books.entries))
        self.slices: dict[tuple[int, bool], Slices] = {}

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: the parts themselves, their entries and squared distances."""
        for i, (lo, hi) in enumerate(self.bounds):
            points, entries = vectors[:, lo:hi], self.books.entries[i]
            small = _small([points, entries])
            if (i, small) not in self.slices:
                self.slices[i, small] = Slices(entries if small else entries.astype(object))
            points = points if small else points.astype(object)
            yield points, *self.slices[i, small].search(points)


def _matrix(batch: pa.RecordBatch, name: str, dimension: int) -> np.ndarray:
    lists = column(batch, name)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return integers(values).reshape(len(lists), dimension)


def _kept(vectors: DataFrame, vector_col: str, dimension: int | None = None) -> DataFrame:
    vector = F.col(f"`{vector_col}`")
    kept = vectors.filter(usable(vector))
    return kept if dimension is None else kept.filter(F.size(vector) == dimension)


def first_codebooks(vectors: DataFrame, id_col: str, vector_col: str, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids (then smallest components; null ids last)."""
    own = _kept(vectors, vector_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = own.orderBy(*order).limit(1).collect()
    if not first:
        return Codebooks(0, [np.zeros((0, 0), np.int64)] * parts)
    dimension = len(first[0].vector)
    rows = own.filter(F.size("vector") == dimension).orderBy(*order).limit(entries).collect()
    values = integers(np.array([r.vector for r in rows], np.float64))
    return Codebooks(dimension, [values[:, lo:hi] for lo, hi in part_bounds(dimension, parts)])


SUMS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DecimalType(38, 0)),
    ]
)


def refine(vectors: DataFrame, vector_col: str, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every used entry to its parts' floored means."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(books)
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        totals = [np.zeros(e.shape, dtype=object) for e in books.entries]
        for batch in batches:
            for i, (points, entry, _) in enumerate(assigner.assign(_matrix(batch, "vector", books.dimension))):
                order = np.argsort(entry, kind="stable")
                who, starts = np.unique(entry[order], return_index=True)
                if len(who):
                    counts[i][who] += np.diff(np.r_[starts, len(entry)])
                    totals[i][who] += np.add.reduceat(points[order], starts, axis=0).astype(object)
        out = {name: [] for name in SUMS.names}
        for i, (count, total) in enumerate(zip(counts, totals)):
            for e in np.flatnonzero(count):
                for j, value in enumerate(total[e]):
                    for name, x in zip(SUMS.names, (i, int(e), j, int(count[e]), Decimal(int(value)))):
                        out[name].append(x)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        yield record(out, dict(zip(SUMS.names, kinds)))

    kept = _kept(vectors, vector_col, books.dimension).select(F.col(f"`{vector_col}`").alias("vector"))
    summed = kept.mapInArrow(sums, SUMS).groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    entries = [e.copy() for e in books.entries]
    for r in summed.collect():  # entries x dimensions rows at most
        entries[r.part][r.entry, r.position] = int(r.total) // r.n
    return Codebooks(books.dimension, entries)


def train(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks from the first vectors, refined over all of them."""
    books = first_codebooks(vectors, id_col, vector_col, parts, entries)
    for _ in range(rounds if books.dimension else 0):
        books = refine(vectors, vector_col, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding", name: str = "code") -> DataFrame:
    """The usable vectors' rows, without the vector, with ``name``: (codes, one number per part; error).

    Left out are vectors that are null, empty, hold null or non-finite
    components, or have another length than the first usable one (by id).
    ``error`` is the squared distance to the entries, over all parts; one that
    a long can't hold is the largest long.  All other columns pass through.
    """
    kept = _kept(vectors, vector_col, books.dimension)
    others = [c for c in kept.columns if c != vector_col]
    name = free_name(vectors, name)
    work = free_name(vectors, "__vector")
    kind = pa.struct([("codes", pa.list_(pa.int32())), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(assigner.assign(_matrix(batch, work, books.dimension)))
            codes = np.stack([entry for _, entry, _ in found], axis=1).astype(np.int32)
            error = [min(sum(map(int, d)), LONG) for d in zip(*(distance for _, _, distance in found))]
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
            made = pa.StructArray.from_arrays([codes, pa.array(error, pa.int64())], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], made], names=[*others, name])

    own = kept.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{vector_col}`").alias(work))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(others)])
    return own.mapInArrow(run, f"{schema}{', ' if others else ''}`{name}` struct<codes: array<int>, error: bigint>")


def with_group_error(encoded: DataFrame, group_col: str) -> DataFrame:
    """``encoded`` (written once) with ``group_error``: the errors summed over equal groups, nulls together."""
    encoded = stage(encoded, "vector-codes")
    group = F.col(f"`{group_col}`")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = encoded.groupBy(group.alias("__group")).agg(F.least(total, F.lit(LONG)).cast("long").alias("group_error"))
    return encoded.join(small_side(sums), group.eqNullSafe(F.col("__group")), "left").drop("__group")


def compressed(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row of ``embeddings``.

    Repeated rows are rows of their own; with fewer usable vectors than
    entries the codebooks have as many entries as there are vectors.  An empty
    table gives no rows.
    """
    books = train(vectors)
    codes = encode(vectors.select("vec_id", "label", "embedding"), books)
    codes = codes.select("vec_id", "label", "code.codes", "code.error")
    text = F.concat(*[F.lower(F.lpad(F.hex(F.get("codes", F.lit(i))), 2, "0")) for i in range(PARTS)])
    return with_group_error(codes, "label").select(
        "vec_id", text.alias("code"), "error", F.col("group_error").alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256")
    )
