"""Benchmark decontamination by greedy string tiling.

Benchmark items are the patterns, documents the texts.  Seeds are runs of
``min_match`` equal tokens, found by their Karp-Rabin fingerprints; a seed that
goes on along its diagonal makes a longer match.  Tiling marks the longest
match of a document and an item, searches again among the tokens not yet
marked, and stops when no match of ``min_match`` tokens is left, so passages
whose parts were reordered are still covered.  A document is contaminated by an
item if the tiles cover enough of the item's tokens.

Documents are read once per block of benchmark items.  A block's texts have a
bounded size; only that is sent to the tasks, and documents are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import append, free_name, session_of

#: Shortest tile, in tokens; shorter items match only texts that are nothing else.
MIN_MATCH = 4
#: Share of an item's tokens that tiles must cover.
MIN_COVERAGE = 0.6
#: UTF-8 bytes of benchmark texts in a block.
BLOCK_BYTES = 32 << 20
#: Pairs of equal places that a task looks at together.
PAIRS = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

MATCH = "array<struct<item_id: bigint, coverage: double, matched: bigint, item_tokens: bigint, tiles: bigint>>"
_MATCH = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()), ("coverage", pa.float64()), ("matched", pa.int64()),
            ("item_tokens", pa.int64()), ("tiles", pa.int64()),
        ]
    )
)


def tokens(text: str) -> list[bytes]:
    """Lower-case words; ASCII characters other than letters and digits separate."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin fingerprint, modulo 2**64, of every window of ``n`` ids."""
    size = len(ids) - n + 1
    out = np.zeros(max(0, size), np.uint64)
    for k in range(n):
        out *= _BASE
        out += ids[k : k + size].astype(np.uint64)
    return out


def tile(n_doc: int, n_item: int, runs: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length), the longest marked first.

    ``runs`` are the maximal matches, none shorter than ``n``.  Of equally long
    matches the earliest in the document, then in the item, goes first.  A
    match that a tile has cut comes again as its free parts, so memory is that
    of the runs.
    """
    heap = [(-length, x, y) for x, y, length in runs]
    heapify(heap)
    tiles = []
    free_doc, free_item = np.ones(n_doc, bool), np.ones(n_item, bool)
    left = n_item
    while heap and left >= n:
        size, x, y = heappop(heap)
        free = free_doc[x : x - size] & free_item[y : y - size]
        if free.all():
            tiles.append((x, y, -size))
            free_doc[x : x - size] = free_item[y : y - size] = False
            left += size
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= n:
                heappush(heap, (lo - hi, x + lo, y + lo))
    return tiles


def _runs(item: np.ndarray, a: np.ndarray, count: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of seeds joined where one goes on right after another of its item and diagonal."""
    order = np.lexsort((a, diagonal, item))
    item, a, count, diagonal = item[order], a[order], count[order], diagonal[order]
    new = np.ones(len(a), bool)
    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (a[1:] != a[:-1] + count[:-1])
    first = np.flatnonzero(new)
    return item[first], a[first], np.add.reduceat(count, first) if len(first) else count, diagonal[first]


@dataclass
class Block:
    """Benchmark items of one block, prepared for the tasks."""

    words: dict[bytes, int]
    item_ids: list[int | None]
    items: list[np.ndarray]
    #: seed length -> (sorted fingerprints, item and place of each)
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    #: all items' tokens in a row, and where each item's begin
    flat: np.ndarray
    starts: np.ndarray
    min_match: int

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]], min_match: int) -> "Block":
        words: dict[bytes, int] = {}
        item_ids, items = [], []
        for item_id, text in rows:
            found = [words.setdefault(w, len(words) + 1) for w in tokens(text or "")]
            if found:
                item_ids.append(item_id)
                items.append(np.array(found, np.int64))
        seeds = {}
        for n in sorted({min(min_match, len(x)) for x in items}):
            own = [i for i, x in enumerate(items) if min(min_match, len(x)) == n]
            prints = [rolling(items[i], n) for i in own]
            value = np.concatenate(prints)
            order = np.argsort(value, kind="stable")
            which = np.repeat(own, [len(p) for p in prints])
            place = np.concatenate([np.arange(len(p)) for p in prints])
            seeds[n] = (value[order], which[order], place[order])
        flat = np.concatenate(items) if items else np.zeros(0, np.int64)
        sizes = np.array([len(x) for x in items], np.int64)
        return cls(words, item_ids, items, seeds, flat, np.cumsum(sizes) - sizes, min_match)

    def _seeded(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Runs of places where ``n`` tokens of the text and an item agree: item, place, seeds in a row, diagonal.

        Pairs of places are made ``PAIRS`` at a time and kept as runs, so a
        text of one word repeated costs a run per diagonal.
        """
        value, which, place = self.seeds[n]
        nothing = np.zeros(0, np.int64)
        found = [(nothing, nothing, nothing, nothing)]
        known = np.concatenate(([0], np.cumsum(ids != 0)))
        at = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else nothing
        prints = rolling(ids, n)[at]
        lo = np.searchsorted(value, prints, "left")
        count = np.searchsorted(value, prints, "right") - lo
        at, lo, count = at[count > 0], lo[count > 0], count[count > 0]
        total = np.cumsum(count)
        begin = 0
        while begin < len(at):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, "right")))
            some = count[begin:end]
            a = np.repeat(at[begin:end], some)
            row = np.repeat(lo[begin:end], some) + np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some)
            item, b = which[row], place[row]
            flat = self.starts[item] + b
            same = np.ones(len(a), bool)
            for k in range(n):  # equal fingerprints of different tokens
                same &= ids[a + k] == self.flat[flat + k]
            a, b, item = a[same], b[same], item[same]
            found.append(_runs(item, a, np.ones(len(a), np.int64), a - b))
            begin = end
        return _runs(*map(np.concatenate, zip(*found)))

    def matches(self, text: str, min_coverage: float) -> list[dict]:
        """Items that the text covers enough of, by the order of the block.

        An item of fewer tokens than ``min_match`` is found in texts by chance
        ("the"); only a text that is nothing else gives it away.
        """
        words = tokens(text)
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        out = []
        for n in self.seeds:
            if n < self.min_match and len(ids) != n:
                continue
            item, a, count, diagonal = self._seeded(ids, n)
            edges = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1], [True]))) if len(item) else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                i = int(item[lo])
                size = len(self.items[i])
                x, y = a[lo:hi], a[lo:hi] - diagonal[lo:hi]
                # tokens that no match reaches can't be covered
                reach = np.zeros(size + 1, np.int64)
                np.add.at(reach, y, 1)
                np.add.at(reach, y + count[lo:hi] + n - 1, -1)
                if np.count_nonzero(np.cumsum(reach[:-1])) < min_coverage * size:
                    continue
                tiles = tile(len(ids), size, list(zip(x.tolist(), y.tolist(), (count[lo:hi] + n - 1).tolist())), n)
                matched = sum(t[2] for t in tiles)
                if matched >= min_coverage * size:
                    out.append(
                        {
                            "item_id": self.item_ids[i], "coverage": matched / size, "matched": matched,
                            "item_tokens": size, "tiles": len(tiles),
                        }
                    )
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark, dealt by hash of its text in blocks of about ``block_bytes``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    if n == 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "matches",
    text_col: str = "text",
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    item_col: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``name``: the items that each row's text gives away.

    Texts without any match have an empty array; null texts count as empty;
    items without a token never match; one of fewer than ``min_match`` tokens
    matches only a text that is nothing else; items that repeat are each reported.
    An empty benchmark leaves every array empty.
    """
    parts = []
    out = docs
    for rows in blocks(benchmark, item_col, item_text, block_bytes):
        block = session_of(docs).sparkContext.broadcast(
            Block.of(sorted(map(tuple, rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])), min_match)
        )
        parts.append(free_name(out, "__matches"))

        def find(found: list[str], block=block) -> pa.Array:
            return pa.array([block.value.matches(t, min_coverage) for t in found], _MATCH)

        out = append(out, find, text_col, parts[-1], MATCH)
    return out.select(*docs.columns, F.concat(*parts).alias(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(doc_id, item_id, coverage, matched, item_tokens, tiles): a row per contaminated document and item."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(options.get("text_col", "text")).alias("text"))
    found = annotate(rows, benchmark, **{k: v for k, v in options.items() if k != "text_col"})
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item is covered by."""
    name = free_name(docs, "matches")
    return annotate(docs, benchmark, name=name, **options).filter(F.size(F.col(name)) == 0).drop(name)
