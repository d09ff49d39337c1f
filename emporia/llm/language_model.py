"""A hierarchical Pitman-Yor language model over whole documents.

Each word that occurs before another is a restaurant; its customers are the
tokens that follow it, its dishes their words.  A new table in it sends one
customer to the parent restaurant, which all contexts share and whose own base
is uniform.  Seatings are sampled by Gibbs: a customer gets up and sits down
again at an old table, by its size less the discount, or at a new one, by the
strength and the parent's probability of the dish.  A sweep does so for all
customers of a dish at once: given a gamma variable per restaurant the dishes'
numbers of tables are independent, and each is drawn from its distribution
given the dish's count, so a dish takes the same room however often it occurs.
The levels are sampled in turn: the contexts with the smoothed unigram as base,
the parent, and both again with the parent's predictive probabilities as base.
Averages over the sweeps give the predictive probabilities.

Documents are encoded once, in blocks of bounded size that are files in the
shared folder.  What the corpus knows about a block's words and word pairs is
exchanged: a block sends its distinct words, or pairs with counts, to buckets
by hash; words are numbered by their buckets, and pairs name them by number; a bucket sees all counts of its keys, samples their seating, and
answers each block in the order asked.  No text is shuffled and nothing the size
of the vocabulary is gathered.  A frequent context is dealt over several
buckets by its followers; each samples with the context's table count scaled
from its own part at first, then with what the other parts had.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import bounded_batches, column, open_store, publish, record, session_of, spread, stage
from emporia.session import fresh_dir

#: UTF-8 bytes of text in a block (a longer document is a block of its own).
BLOCK_BYTES = 14 << 20
#: Tokens whose pairs, on average, one bucket holds.
BUCKET_TOKENS = 1_000_000
#: Occurrences of a context that one bucket holds.
HOT_CONTEXT = 500_000
#: Gibbs: sweeps over all customers, of which the first are not averaged.
SWEEPS, BURN = 4, 1
#: Customers of a dish up to which its tables are drawn from tabled numbers, and of more the tries in a sweep.
TABLED, TRIES = 256, 4
#: Entries of the distributions drawn from at once.
DRAWN = 1 << 19
SEED = 11


@dataclass(frozen=True)
class Restaurant:
    discount: float
    strength: float


PARENT = Restaurant(0.6, 10.0)
CONTEXT = Restaurant(0.75, 5.0)

_BLOCK = "block long, path string, tokens long"
_MESSAGE = "key long, source long, data binary"
_ANSWER = "key long, bucket long, data binary, total double, distinct double"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value."""
    parts = []
    for a in arrays:
        kind = a.dtype.str
        data = a.tobytes()
        parts.append(kind.encode().ljust(4) + struct.pack("<Q", len(data)) + data)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    while at < len(raw):
        kind, size = raw[at : at + 4].decode().strip(), struct.unpack_from("<Q", raw, at + 4)[0]
        at += 12
        dtype = np.dtype(kind)
        out.append(np.frombuffer(raw, dtype, size // dtype.itemsize, at))
        at += size
    return out


def _steps(numbers: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which compress well; ``_numbers`` is the way back."""
    steps = np.diff(numbers, prepend=0)
    return steps.astype(np.uint32 if steps.max(initial=0) < 1 << 32 else np.uint64)


def _numbers(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)


# -------------------------------------------------------------------- blocks


class _Words(dict):
    """Words to numbers in order of first sight; 0 is the end of a document."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def _key(word: bytes) -> int:
    """All 64 bits of the word's hash; 0 is the end of a document."""
    return xxhash.xxh64_intdigest(word, SEED) or 1


def encode(docs: DataFrame, path: str, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """Write the blocks' files below ``path``; returns (block, path, tokens), reread.

    ``learn`` is null or false for documents that are only scored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    types = {"block": pa.int64(), "path": pa.string(), "tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        number = task.partitionId() << 24
        words, ids, sizes, keys, train, held = _Words(), [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, words, ids, sizes, keys, train, held
            file = f"{path}/block-{number:015d}.bin"
            out = io.BytesIO()
            known = [k is not None for k in keys]
            np.savez(
                out,
                ids=np.concatenate(ids).astype("<u4"),
                sizes=np.array(sizes, np.int64),
                doc_ids=np.array([k or 0 for k in keys], np.int64),
                known=np.array(known, bool),
                learn=np.array(train, bool),
                words=np.array([0] + [_key(w) for w in words], np.uint64),
            )
            data = zstandard.ZstdCompressor(level=3).compress(out.getvalue())
            publish(file, task.taskAttemptId(), lambda f: f.write(data))
            made = record({"block": [number], "path": [file], "tokens": [sum(sizes)]}, types)
            number += 1
            words, ids, sizes, keys, train, held = _Words(), [], [], [], [], 0
            return made

        for batch in batches:
            data = column(batch, "text").cast(pa.binary()).to_pylist()
            for doc_id, text, teach in zip(column(batch, "doc_id").to_pylist(), data, column(batch, "learn").to_pylist()):
                found = text.lower().split()
                ids.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                ids.append(np.zeros(1, np.uint32))
                sizes.append(len(found) + 1)
                keys.append(doc_id)
                train.append(teach)
                held += len(text) + 64
                if held >= BLOCK_BYTES:
                    yield flush()
        if sizes:
            yield flush()

    bounded_batches(session_of(docs))
    return stage(rows.mapInArrow(run, _BLOCK), "lm-blocks")


class Block:
    """A block read back: its tokens, their contexts, and the keys they are asked by."""

    def __init__(self, path: str):
        store, name = open_store(path)
        with store.open_input_stream(name) as f:
            data = np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(f.read())))
        self.tokens = data["ids"].astype(np.int64)
        self.sizes, self.doc_ids, self.known, self.learn = data["sizes"], data["doc_ids"], data["known"], data["learn"]
        # words of one key are one word
        self.words, which = np.unique(data["words"], return_inverse=True)
        self.tokens = which[self.tokens]
        self.teaches = np.repeat(self.learn, self.sizes)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.teaches], minlength=len(self.words)).astype(np.int64)

    def word_buckets(self, buckets: int) -> np.ndarray:
        return (spread(self.words) % np.uint64(buckets)).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context, word, learned count) of distinct pairs, and the pair of each token.

        A document's first token has the end of a document as its context.
        """
        size = len(self.words)
        end = int(np.searchsorted(self.words, 0))  # key 0 is always there, and first
        context = np.concatenate(([end], self.tokens[:-1]))
        keys, which = np.unique(context * size + self.tokens, return_inverse=True)
        return keys // size, keys % size, np.bincount(which, self.teaches, len(keys)).astype(np.int64), which


def _pair_buckets(words: np.ndarray, seen: np.ndarray, context: np.ndarray, word: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each pair: by its context, a frequent one's followers over several."""
    parts = np.maximum(1, -(-seen // HOT_CONTEXT)).astype(np.uint64)
    part = spread(words[word] + np.uint64(17)) % parts[context]
    return (spread(words[context] * np.uint64(31) + part + np.uint64(5)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray, *order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its rows, sorted by ``order``)."""
    at = np.lexsort((*order[::-1], bucket))
    edges = np.flatnonzero(np.diff(bucket[at], prepend=-1))
    for lo, hi in zip(edges, np.append(edges[1:], len(at))):
        yield int(bucket[at[lo]]), at[lo:hi]


def _send(blocks: DataFrame, fn) -> DataFrame:
    """Messages (key, source, data) that ``fn(block number, Block)`` yields for each block."""
    types = {"key": pa.int64(), "source": pa.int64(), "data": pa.binary()}
    count = max(1, blocks.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(column(batch, "block").to_pylist(), column(batch, "path").to_pylist()):
                for key, data in fn(number, Block(path)):
                    yield record({"key": [key], "source": [number], "data": [data]}, types)

    return blocks.select("block", "path").repartition(count).mapInArrow(run, _MESSAGE)


# ------------------------------------------------------------------- seating


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of numbers from 1 on: Stirling's series, eight steps up."""
    z = x + 8.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7))


@lru_cache(maxsize=4)
def _tabled(d: float) -> np.ndarray:
    """Logs of the ways, weighted by ``d``, to seat c customers at t tables, for c and t up to TABLED."""
    ways = np.full((TABLED + 1, TABLED + 1), -np.inf)
    ways[0, 0], t = 0.0, np.arange(TABLED + 1)
    with np.errstate(divide="ignore"):
        for c in range(TABLED):
            stay = ways[c] + np.log(np.maximum(c - d * t, 0))
            ways[c + 1, 1:] = np.logaddexp(ways[c, :-1], stay[1:])
    return ways


def _saddle(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """The same by a saddle point of (1 - (1 - z)^d)^t / z^c, for 1 <= t < c."""
    ratio, low, high = np.log(c / t), np.full(c.shape, -40.0), np.full(c.shape, np.log(300.0))
    for _ in range(45):  # q = -log(1 - z), halved in its log
        mid = (low + high) / 2
        q = np.exp(mid)
        up = np.log(d) + np.log(-np.expm1(-q)) + (1 - d) * q - np.log(-np.expm1(-d * q)) < ratio
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    q = np.exp((low + high) / 2)
    z, g, h = -np.expm1(-q), -np.expm1(-d * q), c / t
    spread_ = t * h * np.maximum(1 + (1 - d) * z * np.exp(q) - h, 1e-300)
    left = c - t
    stirling = _log_gamma(left + 1) - (left * np.log(left) - left + 0.5 * np.log(2 * np.pi * left))
    return (
        _log_gamma(c + 1) - _log_gamma(t + 1) + t * (np.log(g) - np.log(d)) - c * np.log(z)
        - 0.5 * np.log(2 * np.pi * spread_) - stirling
    )


@lru_cache(maxsize=4)
def _saddle_errors(d: float) -> tuple[np.ndarray, np.ndarray]:
    """What the saddle point misses at TABLED customers, by log t / c^d: the same for more customers."""
    t = np.arange(1.0, TABLED)
    c = np.full(len(t), float(TABLED))
    return np.log(t) - d * np.log(c), _tabled(d)[TABLED, 1:TABLED] - _saddle(c, t, d)


def log_ways(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Logs of the ways, weighted by ``d``, to seat more than TABLED customers at t tables."""
    c, t = np.asarray(c, float), np.asarray(t, float)
    known, missed = _saddle_errors(d)
    at = np.log(t) - d * np.log(c)
    inner = np.minimum(t, c - 1)
    out = _saddle(c, inner, d) + np.interp(at, known, missed)
    out += np.maximum(known[0] - at, 0) * (d - 0.5) / (1 - d)
    return np.where(t == c, 0.0, out)


class Seating:
    """Chinese-restaurant seating of many dishes at once, as tables per dish.

    ``count`` customers eat each dish, in restaurant ``place``, whose parent
    gives the dish probability ``base``.  ``scale`` is what a restaurant's
    table count here stands for, if only part of it is; ``other`` are tables it
    is known to have elsewhere, ``start`` those it had here before.  Given a
    gamma variable of a restaurant's tables its dishes are independent: tables t
    of a dish with c customers have weight S(c, t) (discount variable base)^t,
    where S are generalised Stirling numbers.
    """

    def __init__(
        self,
        count: np.ndarray,
        place: np.ndarray,
        base: np.ndarray,
        scale: np.ndarray,
        law: Restaurant,
        rng: np.random.Generator,
        other: np.ndarray | None = None,
        start: np.ndarray | None = None,
    ):
        self.count, self.place, self.base, self.law, self.rng = count, place, base, law, rng
        self.scale = scale
        self.other = np.zeros(len(scale)) if other is None else other
        self.tables = (count > 0).astype(np.int64)
        self.at_tables = np.bincount(place, self.tables, len(scale)).astype(float)
        several = np.flatnonzero(count > 1)
        self.open = several[np.argsort(count[several], kind="stable")]
        self._seat()
        if start is not None:
            self.at_tables = start.astype(float)

    def _weight(self, at: np.ndarray) -> np.ndarray:
        """Of a new table for each dish."""
        where = self.place[at]
        return (self.law.strength + self.law.discount * (self.at_tables * self.scale + self.other)[where]) * self.base[at]

    def _seat(self) -> None:
        """First tables: those expected as customers come in doubling groups."""
        c = self.count[self.open].astype(float)
        new, t, seen = self._weight(self.open), np.ones(len(c)), np.ones(len(c))
        while len(c) and (seen < c).any():
            group = np.minimum(np.maximum(1, seen // 2), c - seen)
            t += group * (new / (new + np.maximum(seen - self.law.discount * t, 0.05)))
            seen += group
        self._put(np.clip(np.floor(t + self.rng.random(len(c))), 1, c).astype(np.int64))

    def _put(self, tables: np.ndarray) -> None:
        self.tables[self.open] = tables
        self.at_tables = np.bincount(self.place, self.tables, len(self.scale)).astype(float)

    def _sweep(self) -> None:
        """All customers of all dishes get up and sit down again."""
        d = self.law.discount
        drawn = self.rng.gamma(self.law.strength / d + self.at_tables * self.scale + self.other)
        at = self.open
        c, x = self.count[at], d * drawn[self.place[at]] * self.base[at]
        tables = self.tables[at]
        few = int(np.searchsorted(c, TABLED, "right"))
        edges = np.flatnonzero(np.diff(c[:few], prepend=0))
        for low, high in zip(edges, np.append(edges[1:], few)):
            n = int(c[low])
            ways, step = _tabled(d)[n, 1 : n + 1], max(1, DRAWN // n)
            for a in range(int(low), int(high), step):
                b = min(a + step, int(high))
                weight = ways + np.log(x[a:b])[:, None] * np.arange(1, n + 1)
                weight = np.exp(weight - weight.max(1, keepdims=True)).cumsum(1)
                tables[a:b] = 1 + (weight[:, :-1] < (self.rng.random(b - a) * weight[:, -1])[:, None]).sum(1)
        if few < len(c):
            tables[few:] = self._many(c[few:].astype(float), x[few:], tables[few:])
        self._put(tables)

    def _many(self, c: np.ndarray, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Tables of frequent dishes: proposals around the mode, taken or not by Metropolis and Hastings."""
        d, rng = self.law.discount, self.rng
        low, high = np.full(len(c), -40.0), np.full(len(c), np.log(300.0))
        for _ in range(45):  # x z (1 - z)^(d - 1) = c at the mode, q = -log(1 - z)
            mid = (low + high) / 2
            q = np.exp(mid)
            up = np.log(x) + np.log(-np.expm1(-q)) + (1 - d) * q < np.log(c)
            low, high = np.where(up, mid, low), np.where(up, high, mid)
        q = np.exp((low + high) / 2)
        centre = np.maximum(x / d * -np.expm1(-d * q), 1e-3)
        h = c / centre
        narrow = 1 / centre + h / np.maximum(centre * (1 + (1 - d) * -np.expm1(-q) * np.exp(q) - h), 1e-9)
        centre = np.clip(centre + 0.5, 1, c)
        width = 0.6 * np.sqrt(1 / narrow) + 0.3

        def below(t: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(np.clip((centre - t) / width, -700, 700)))

        def proposed(t: np.ndarray) -> np.ndarray:
            side = np.abs(t - centre)  # the same by symmetry, and no difference of two ones
            e = np.exp(-np.minimum(side / width, 600))
            up, down = np.exp(0.5 / width), np.exp(-0.5 / width)
            return np.log(e) + np.log(up - down) - np.log1p(e * up) - np.log1p(e * down)

        t = tables.astype(float)
        held = log_ways(c, t, d) + t * np.log(x) - proposed(t)
        floor, roof = below(np.full(len(c), 0.5)), below(c + 0.5)
        for _ in range(TRIES):
            u = np.clip(floor + (roof - floor) * rng.random(len(c)), 1e-300, 1 - 1e-16)
            new = np.clip(np.rint(centre + width * np.log(u / (1 - u))), 1, c)
            found = log_ways(c, new, d) + new * np.log(x) - proposed(new)
            better = np.log(rng.random(len(c))) < found - held
            t, held = np.where(better, new, t), np.where(better, found, held)
        return t.astype(np.int64)

    @property
    def first(self) -> np.ndarray:
        """Where each open dish's tables begin in ``size``."""
        return np.concatenate(([0], np.cumsum(self.tables[self.open])))

    @property
    def size(self) -> np.ndarray:
        """Customers at each table of the open dishes: one each, the others as they would choose, by size less the discount."""
        out = []
        for c, t in zip(self.count[self.open], self.tables[self.open]):
            size = np.ones(t, np.int64)
            for _ in range(c - t):
                size[np.searchsorted(np.cumsum(size - self.law.discount), self.rng.random() * (size.sum() - t * self.law.discount))] += 1
            out.append(size)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def run(self) -> np.ndarray:
        """Each dish's tables, averaged over the sweeps after the first."""
        total, used = np.zeros(len(self.count)), 0
        for sweep in range(SWEEPS):
            self._sweep()
            if sweep >= BURN:
                total += self.tables
                used += 1
        return total / max(1, used)


# ------------------------------------------------------------------- buckets


def _answer_words(key: int, asked: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Learned count of each word over all blocks, and its rank by key in the bucket, in the order each block asked."""
    words, which = np.unique(np.concatenate([w for _, w, _ in asked]), return_inverse=True)
    seen = np.bincount(which, np.concatenate([n for _, _, n in asked]), len(words)).astype(np.int64)
    ends = np.cumsum([len(w) for _, w, _ in asked])[:-1]
    rows = [(source, key, _pack(seen[part], _steps(part)), 0.0, 0.0) for (source, _, _), part in zip(asked, np.split(which, ends))]
    rows.append((-1, key, b"", float(seen.sum()), float((seen > 0).sum())))
    return pd.DataFrame(rows, columns=["key", "bucket", "data", "total", "distinct"])


def _merge_pairs(asked: list[tuple[int, list[np.ndarray]]]) -> dict[str, np.ndarray]:
    """A bucket's distinct pairs over all blocks, and where those of each block are, in the order it asked."""
    word = np.concatenate([_numbers(a[3])[a[5]] for _, a in asked])
    context = np.concatenate([np.repeat(_numbers(a[0]), a[1]) for _, a in asked])
    order = np.lexsort((word, context))
    new = np.concatenate(([True], (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0)))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    firsts = order[new]
    count = np.bincount(which, np.concatenate([a[6] for _, a in asked]), len(firsts)).astype(np.int64)
    base = np.exp(np.concatenate([a[4][a[5]] for _, a in asked])[firsts].astype(float))
    contexts, place = np.unique(context[firsts], return_inverse=True)
    dishes, dish = np.unique(word[firsts], return_inverse=True)
    whole = np.zeros(len(contexts), np.int64)
    for _, a in asked:
        whole[np.searchsorted(contexts, _numbers(a[0]))] = a[2]
    return {
        "source": np.array([s for s, _ in asked], np.int64),
        "rows": np.array([len(a[5]) for _, a in asked], np.int64),
        "which": np.diff(which, prepend=0).astype(np.int32),  # a block's ascend, so steps are small
        "count": count, "place": place.astype(np.int32), "dish": dish.astype(np.int32), "base": base,
        "contexts": contexts, "dishes": dishes, "whole": whole,
    }


def _tell(key: int, got: dict[str, np.ndarray], tables: np.ndarray, buckets: int) -> list[tuple]:
    """Messages to the word buckets: the tables of each dish and each context."""
    dishes, contexts = got["dishes"], got["contexts"]
    both = np.unique(np.concatenate([dishes, contexts]))
    as_dish, as_context = np.zeros(len(both)), np.zeros(len(both))
    as_dish[np.searchsorted(both, dishes)] = np.bincount(got["dish"], tables, len(dishes))
    as_context[np.searchsorted(both, contexts)] = np.bincount(got["place"], tables, len(contexts))
    used = (as_dish > 0) | (as_context > 0)
    both, as_dish, as_context = both[used], as_dish[used], as_context[used]
    rows = []
    for bucket, at in _by_bucket(both % buckets, both):
        data = _pack(_steps(both[at]), as_dish[at].astype(np.float32), as_context[at].astype(np.float32))
        rows.append((-1 - bucket, key, data, 0.0, 0.0))
    return rows


def _seat_pairs(key: int, asked: list[tuple[int, list[np.ndarray]]], buckets: int, folder: str) -> pd.DataFrame:
    """Seats the contexts of a bucket for the first time, and keeps the bucket in a file.

    Word buckets (negative keys) get the tables of each dish and each context.
    """
    from pyspark import TaskContext

    got = _merge_pairs(asked)
    here = np.bincount(got["place"], got["count"], len(got["contexts"]))
    scale = np.maximum(1.0, got["whole"] / np.maximum(here, 1.0))
    rng = np.random.default_rng((SEED, key))
    tables = Seating(got["count"], got["place"], got["base"], scale, CONTEXT, rng).run()
    data = _pairs_state(got, np.bincount(got["place"], tables, len(got["contexts"])))
    publish(_pairs_file(folder, key), TaskContext.get().taskAttemptId(), lambda f: f.write(data))
    rows = _tell(key, got, tables, buckets)
    rows.append((key, -1, _pack(), 0.0, 0.0))
    return pd.DataFrame(rows, columns=["key", "bucket", "data", "total", "distinct"])


def _pairs_state(got: dict[str, np.ndarray], at_tables: np.ndarray) -> bytes:
    """What the second pass needs of a bucket: all but the first base, and the tables of its contexts."""
    out = io.BytesIO()
    small = {k: got[k].astype(np.int32 if got[k].max(initial=0) < 2**31 else np.int64) for k in ("count", "whole")}
    steps = {k: _steps(got[k]) for k in ("contexts", "dishes")}
    kept = {k: got[k] for k in ("source", "rows", "which", "dish")}
    np.savez(out, **small, **steps, **kept, place=_steps(got["place"]), at_tables=at_tables.astype(np.float32))
    return zstandard.ZstdCompressor(level=3).compress(out.getvalue())


def _pairs_file(folder: str, key: int) -> str:
    return f"{folder}/pairs-{key:015d}.bin"


def _answer_pairs(
    key: int, replies: list[tuple[int, list[np.ndarray]]], buckets: int, folder: str, parent: tuple[float, float, float]
) -> pd.DataFrame:
    """Seats the contexts of a bucket again, with the parent's predictive probabilities as base.

    Each block gets, in the order it asked, a pair's count less its discounts;
    word buckets (negative keys) get the tables of each dish and each context.
    ``parent``: its customers, its tables and the uniform base.
    """
    store, name = open_store(_pairs_file(folder, key))
    with store.open_input_stream(name) as f:
        got = dict(np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(f.read()))))
    count, place = got["count"].astype(np.int64), _numbers(got["place"])
    got["contexts"], got["dishes"], got["place"] = _numbers(got["contexts"]), _numbers(got["dishes"]), place
    customers, parent_tables, uniform = parent
    back = (PARENT.strength + PARENT.discount * parent_tables) * uniform
    base = np.full(len(got["dishes"]), back / (PARENT.strength + customers))  # of words without customers
    at_tables, elsewhere = got["at_tables"].astype(float), np.zeros(len(got["contexts"]))
    for source, reply in replies:
        if source < 0:
            continue
        words, kept, as_context = _numbers(reply[0]), *reply[1:]
        for keys, into, value in (
            (got["dishes"], base, (kept + back) / (PARENT.strength + customers)), (got["contexts"], elsewhere, as_context)
        ):
            at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            mine = keys[at] == words
            into[at[mine]] = value[mine]
    other = np.maximum(elsewhere - at_tables, 0)
    # float32 sums: a context that is whole here has no tables elsewhere
    other[np.bincount(place, count, len(other)) >= got["whole"]] = 0
    rng = np.random.default_rng((SEED, key, 2))
    tables = Seating(count, place, base[got["dish"]], np.ones(len(other)), CONTEXT, rng, other, at_tables).run()
    kept = (count - CONTEXT.discount * tables).astype(np.float32)
    which = np.cumsum(got["which"], dtype=np.int64)
    parts = np.split(which, np.cumsum(got["rows"])[:-1])
    rows = [(int(source), key, _pack(kept[part]), 0.0, 0.0) for source, part in zip(got["source"], parts)]
    rows += _tell(key, got, tables, buckets)
    return pd.DataFrame(rows, columns=["key", "bucket", "data", "total", "distinct"])


def _answer_parent(
    key: int, asked: list[tuple[int, np.ndarray]], told: list[tuple[int, list[np.ndarray]]], uniform: float, buckets: int
) -> pd.DataFrame:
    """Seats the parent's dishes of a bucket; each block gets count less discounts, and its contexts' tables.

    If no block asked, each pair bucket gets the same of the words it told of.
    """
    ranks = [_numbers(a[0]) // buckets for _, a in told]
    if asked:  # all words of the bucket, so their places are the ranks they are told by
        words, which = np.unique(np.concatenate([w for _, w in asked]), return_inverse=True)
    else:
        words, which = np.unique(np.concatenate(ranks), return_inverse=True)
        ranks = np.split(which, np.cumsum([len(r) for r in ranks])[:-1])
    customers, as_context = np.zeros(len(words)), np.zeros(len(words))
    for at, (_, (_, dish, context)) in zip(ranks, told):
        customers[at] += dish
        as_context[at] += context
    count = np.rint(customers).astype(np.int64)
    seating = Seating(
        count, np.zeros(len(count), np.int64), np.full(len(count), uniform), np.array([float(buckets)]), PARENT,
        np.random.default_rng((SEED, key, 1 if asked else 3)),
    )
    tables = seating.run()
    kept, as_context = (count - PARENT.discount * tables).astype(np.float32), as_context.astype(np.float32)
    if asked:
        parts = np.split(which, np.cumsum([len(w) for _, w in asked])[:-1])
        rows = [(source, key, _pack(kept[part], as_context[part]), 0.0, 0.0) for (source, _), part in zip(asked, parts)]
    else:
        rows = [
            (-1 - source, key, _pack(w, kept[part], as_context[part]), 0.0, 0.0) for (source, (w, _, _)), part in zip(told, ranks)
        ]
    rows.append((-1, key, b"", float(count.sum()), float(tables.sum())))
    return pd.DataFrame(rows, columns=["key", "bucket", "data", "total", "distinct"])


def _groups(messages: DataFrame, answer) -> DataFrame:
    """Each bucket's messages in order of their source, answered and written."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", kind="stable")
        return answer(int(rows["key"].iloc[0]), [(int(s), _unpack(d)) for s, d in zip(rows["source"], rows["data"])])

    return stage(messages.groupBy("key").applyInPandas(run, _ANSWER), "lm-answers")


def _totals(answers: DataFrame) -> tuple[float, float]:
    row = answers.filter("key = -1 and length(data) = 0").agg(F.sum("total"), F.sum("distinct")).first()
    return float(row[0] or 0), float(row[1] or 0)


# ------------------------------------------------------------------- scoring


def score(
    docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): a row per row of ``docs``.

    Tokens are ASCII lower-cased words between ASCII white space, then one end.
    The model learns from rows for which ``learn`` is true (default: all).
    ``base_score`` is the smoothed unigram's log10 probability, ``score`` the
    model's.  Null texts count as empty: their only token is the end.  With
    nothing to learn from every token has the uniform base, which is 1.
    Repeated rows are learned from and scored each.
    """
    spark = session_of(docs)
    path = fresh_dir(spark, "lm-block-files")
    blocks = encode(docs, path, id_col, text_col, F.lit(True) if learn is None else learn)
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets = int(tokens // bucket_tokens) + 1

    def ask_words(_, block: Block):
        counts = block.word_counts()
        for bucket, at in _by_bucket(block.word_buckets(buckets), block.words):
            yield bucket, _pack(block.words[at], counts[at].astype(np.int32))

    seen = _groups(
        _send(blocks, ask_words),
        lambda key, got: _answer_words(key, [(s, a[0], a[1]) for s, a in got]),
    )
    learned, distinct = _totals(seen)
    floor = learned + 0.1 * (distinct + 1)
    types = {"key": pa.int64(), "source": pa.int64(), "data": pa.binary()}

    def known_words(rows: pd.DataFrame, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The words' counts over all blocks and their numbers, put back in the block's order."""
        counts, numbers = np.zeros(len(block.words), np.int64), np.zeros(len(block.words), np.int64)
        got = dict(zip(rows["bucket"], rows["data"]))
        for bucket, at in _by_bucket(block.word_buckets(buckets), block.words):
            counts[at], ranks = _unpack(got[bucket])
            numbers[at] = _numbers(ranks) * buckets + bucket
        return counts, numbers

    def ask_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows["path"].iloc[0])
        counts, numbers = known_words(rows, block)
        context, word, n, _ = block.pairs()
        log_base = np.log((counts + 0.1) / floor).astype(np.float16)  # of the first pass only
        out = []
        for bucket, at in _by_bucket(
            _pair_buckets(block.words, counts, context, word, buckets), numbers[context], numbers[word]
        ):
            own, places, lengths = np.unique(numbers[context[at]], return_index=True, return_counts=True)
            dishes, dish_places, dish = np.unique(numbers[word[at]], return_index=True, return_inverse=True)
            whole, first_base = counts[context[at][places]], log_base[word[at][dish_places]]
            index = dish.astype(np.uint16 if len(dishes) <= 1 << 16 else np.uint32)
            data = _pack(
                _steps(own), lengths.astype(np.int32), whole, _steps(dishes), first_base, index, n[at].astype(np.int32)
            )
            out.append((bucket, int(rows["key"].iloc[0]), data))
        return pd.DataFrame(out, columns=list(types))

    located = blocks.select(F.col("block").alias("key"), "path")
    asked = seen.filter("key >= 0").join(located, "key").groupBy("key").applyInPandas(ask_pairs, _MESSAGE)
    folder = fresh_dir(spark, "lm-pair-files")
    first = _groups(asked, lambda key, got: _seat_pairs(key, got, buckets, folder))
    uniform = 1.0 / (distinct + 1)

    def told(answers: DataFrame) -> DataFrame:
        return answers.filter("key < 0").select((-1 - F.col("key")).alias("key"), (-1 - F.col("bucket")).alias("source"), "data")

    replies = _groups(told(first), lambda key, got: _answer_parent(key, [], got, uniform, buckets))
    before = (*_totals(replies), uniform)
    # every pair bucket has a row of its own, whether or not a word bucket replies
    replied = first.unionByName(replies).filter("key >= 0").select("key", F.col("bucket").alias("source"), "data")
    pairs = _groups(replied, lambda key, got: _answer_pairs(key, got, buckets, folder, before))

    def ask_parent(_, block: Block):
        for bucket, at in _by_bucket(block.word_buckets(buckets), block.words):
            yield bucket, _pack(block.words[at])

    parent = _groups(
        _send(blocks, ask_parent).unionByName(told(pairs)),
        lambda key, got: _answer_parent(
            key, [(s, a[0]) for s, a in got if s >= 0], [(s, a) for s, a in got if s < 0], uniform, buckets
        ),
    )
    customers, tables = _totals(parent)

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows["path"].iloc[0])
        parts = dict(list(rows.groupby("part")))
        counts, numbers = known_words(parts["words"], block)
        kept, as_context = np.zeros(len(counts)), np.zeros(len(counts))
        got = dict(zip(parts["parent"]["bucket"], parts["parent"]["data"]))
        for bucket, at in _by_bucket(block.word_buckets(buckets), block.words):
            kept[at], as_context[at] = _unpack(got[bucket])
        back = (PARENT.strength + PARENT.discount * tables) * uniform
        parent_p = (kept + back) / (PARENT.strength + customers)
        context, word, _, which = block.pairs()
        own = np.zeros(len(context))
        got = dict(zip(parts["pairs"]["bucket"], parts["pairs"]["data"]))
        for bucket, at in _by_bucket(
            _pair_buckets(block.words, counts, context, word, buckets), numbers[context], numbers[word]
        ):
            own[at] = _unpack(got[bucket])[0]
        seats = CONTEXT.strength + counts[context]
        share = (CONTEXT.strength + CONTEXT.discount * as_context[context]) / seats
        p = np.where(counts[context] > 0, own / seats + share * parent_p[word], parent_p[word])
        starts = np.concatenate(([0], np.cumsum(block.sizes)[:-1]))
        base = np.log10((counts + 0.1) / floor)[block.tokens]
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(block.known, block.doc_ids, 0), "Int64").copy(),
                "known_id": block.known,
                "n_tokens": block.sizes,
                "n_known": np.add.reduceat((counts > 0)[block.tokens].astype(np.int64), starts),
                "train_tokens": np.full(len(block.sizes), int(learned)),
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(p)[which], starts),
            }
        )

    answers = None
    for name, frame in (("words", seen), ("pairs", pairs), ("parent", parent)):
        part = frame.filter("key >= 0").select("key", "bucket", "data", F.lit(name).alias("part"))
        answers = part if answers is None else answers.unionByName(part)
    scored = (
        answers.join(located, "key")
        .groupBy("key")
        .applyInPandas(
            finish,
            "doc_id long, known_id boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
    return scored.withColumn("doc_id", F.when(F.col("known_id"), F.col("doc_id"))).drop("known_id")
