"""SimHash near-duplicates, searched with vantage-point trees.

Fingerprints are compared by Hamming distance.  Two fingerprints at most ``d``
bits apart agree, in at least one of ``d // 2 + 1`` bands of their 64 bits, up
to one bit (pigeonhole), so each band is searched as a metric space of its own
with radius 1.  Per band a vantage-point tree, built from a bounded sample of
the distinct fingerprints, cuts the space into shards: a fingerprint is at home
in one shard, and the triangle inequality tells which other shards its ball of
radius 1 touches; it visits those.  Every pair meets in the home shard of
either side.  Inside a shard the same recursion goes on in memory until blocks
are small enough to compare exactly, on all 64 bits.

Equal fingerprints are collapsed before the search, and a shard returns a
spanning forest of its links, never all pairs.  Components come from alternate
large-star / small-star rounds over those links, each round written to the
shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import arrow_map, bounded_batches, column, free_name, id_text, record, session_of, stage

SEED = 42
BITS = 64
#: Distinct fingerprints the vantage-point trees are built from.
SAMPLE = 16384
#: Fingerprints a shard should hold; larger shards are dealt in slices.
SHARD_ROWS = 20000
#: Distances compared at once inside a shard.
BLOCK = 1 << 21


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """SimHash of UTF-8 bytes: ASCII lower case, words between ASCII white space.

    Empty or blank text has fingerprint 0; fewer words than ``shingle`` count
    as one shingle.
    """
    words = data.lower().split()
    if not words:
        return 0
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, n, 65536):
        part = hashes[lo : lo + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * ones > n)
    return int(sum(1 << int(b) for b in set_bits))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, keep: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, fp, columns to keep): the fingerprint's 64 bits as a signed long, one row per input row."""
    own = [docs.schema[c] for c in keep]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data = column(batch, "text").cast(pa.binary()).to_pylist()
        fps = np.fromiter((fingerprint(x, shingle) for x in data), np.uint64, len(data))
        columns = [column(batch, "doc_id"), pa.array(fps.view(np.int64)), *[column(batch, c) for c in keep]]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *keep])

    bounded_batches(session_of(docs))
    schema = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in own)
    return arrow_map(id_text(docs, id_col, text_col, keep), run, f"doc_id long, fp long{schema}")


def band_masks(max_distance: int) -> tuple[list[int], int]:
    """Masks of the bands and the radius that a linked pair keeps in one of them."""
    bands = max_distance // 2 + 1
    edges = [round(i * BITS / bands) for i in range(bands + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return masks, max_distance // bands


def _distance(fps: np.ndarray, point: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((fps ^ point) & mask).astype(np.int16)


def build_tree(sample: np.ndarray, mask: int, total: int, shard_rows: int) -> list[tuple]:
    """Nodes (vantage, split, inside, outside); a negative child is shard ``-1 - child``.

    ``inside`` holds distances up to ``split``.  Splitting stops when a
    node's share of ``total`` fits a shard, when the sample runs thin, or when
    no vantage point tells the points apart.
    """
    nodes: list[tuple] = []
    shards = 0
    mask64 = np.uint64(mask)

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        share = len(points) / max(1, len(sample)) * total
        if share > shard_rows and len(points) >= 32:
            for k in range(min(8, len(points))):
                vantage = points[(k * 7919) % len(points)]
                d = _distance(points, vantage, mask64)
                split = int(np.median(d))
                if (d <= split).all():
                    split -= 1
                if (d <= split).any():
                    at = len(nodes)
                    nodes.append(())
                    nodes[at] = (int(vantage), split, grow(points[d <= split]), grow(points[d > split]))
                    return at
        shards += 1
        return -shards

    root = grow(sample)
    return nodes if root == 0 else []


def route(nodes: list[tuple], mask: int, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, home) of every shard that each fingerprint's ball touches."""
    rows, shards, homes = [], [], []
    stack = [(0 if nodes else -1, np.arange(len(fps)), np.ones(len(fps), bool))]
    mask64 = np.uint64(mask)
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if node < 0:
            rows.append(at)
            shards.append(np.full(len(at), -1 - node, np.int32))
            homes.append(home)
            continue
        vantage, split, inside, outside = nodes[node]
        d = _distance(fps[at], np.uint64(vantage), mask64)
        near, far = d <= split + radius, d > split - radius
        stack.append((inside, at[near], home[near] & (d[near] <= split)))
        stack.append((outside, at[far], home[far] & (d[far] > split)))
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


class _Forest:
    """Union by smallest index over ``n`` items, fed with arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                return
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def link_shard(fps: np.ndarray, home: np.ndarray, mask: int, radius: int, max_distance: int) -> np.ndarray:
    """Smallest linked index (in its component) of each fingerprint of a shard.

    Links run between a home fingerprint and any other of the shard.
    """
    forest = _Forest(len(fps))
    full = np.uint64((1 << BITS) - 1)
    stack = [(np.flatnonzero(home), np.arange(len(fps)), np.uint64(mask), radius)]
    while stack:
        data, query, metric, r = stack.pop()
        if not len(data) or not len(query):
            continue
        if len(data) * len(query) > BLOCK:
            for k in range(4):
                vantage = fps[data[(k * 104729) % len(data)]]
                dd = _distance(fps[data], vantage, metric)
                split = int(np.median(dd))
                split -= int((dd <= split).all())
                if (dd <= split).any():
                    dq = _distance(fps[query], vantage, metric)
                    # worth the split only if it saves comparisons
                    near, far = dq <= split + r, dq > split - r
                    inside = dd <= split
                    work = int(inside.sum()) * int(near.sum()) + int((~inside).sum()) * int(far.sum())
                    if work < 0.95 * len(data) * len(query):
                        stack.append((data[inside], query[near], metric, r))
                        stack.append((data[~inside], query[far], metric, r))
                        break
            else:
                if metric != full:
                    stack.append((data, query, full, max_distance))
                    continue
                step = max(1, BLOCK // len(data))
                for lo in range(0, len(query), step):
                    _compare(fps, data, query[lo : lo + step], max_distance, forest)
            continue
        _compare(fps, data, query, max_distance, forest)
    return forest.label


def _compare(fps: np.ndarray, data: np.ndarray, query: np.ndarray, max_distance: int, forest: _Forest) -> None:
    near = np.bitwise_count(fps[query][:, None] ^ fps[data][None, :]) <= max_distance
    q, d = np.nonzero(near)
    forest.add(query[q], data[d])


def links(distinct: DataFrame, max_distance: int = 4, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b) with a > b: a spanning forest, per shard, of fingerprints at most ``max_distance`` apart.

    ``distinct`` has one row per fingerprint (column ``fp``).
    """
    spark = session_of(distinct)
    masks, radius = band_masks(max_distance)
    total = distinct.count()
    picked = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(np.int64)
    trees = [build_tree(picked.view(np.uint64), m, total, shard_rows) for m in masks]
    types = {"band": pa.int32(), "shard": pa.int32(), "fp": pa.int64(), "home": pa.bool_()}

    def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fps = column(batch, "fp").to_numpy().view(np.uint64)
        for band, (mask, nodes) in enumerate(zip(masks, trees)):
            rows, shard, home = route(nodes, mask, fps, radius)
            yield record(
                {"band": np.full(len(rows), band, np.int32), "shard": shard, "fp": fps[rows].view(np.int64), "home": home},
                types,
            )

    dealt = arrow_map(distinct.select("fp"), deal, "band int, shard int, fp long, home boolean")
    # one row per shard (the trees bound their number); a shard that is still
    # large holds fingerprints no vantage point of its band tells apart
    sizes = dealt.filter("home").groupBy("band", "shard").count().collect()
    slices = {(r["band"], r["shard"]): -(-r["count"] // (2 * shard_rows)) for r in sizes}
    slices = {k: n for k, n in slices.items() if n > 1}
    if slices:
        large = spark.createDataFrame([(b, s, n) for (b, s), n in slices.items()], "band int, shard int, parts int")
        salt = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        # home rows go to one slice; every row visits all slices as a query
        dealt = (
            dealt.join(F.broadcast(large), ["band", "shard"], "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("home", F.col("home") & (F.col("slice") == salt))
            .select("band", "shard", "slice", "fp", "home")
        )
    else:
        dealt = dealt.withColumn("slice", F.lit(0))

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("fp")
        signed = rows["fp"].to_numpy(np.int64)
        label = link_shard(signed.view(np.uint64), rows["home"].to_numpy(bool), masks[key[0]], radius, max_distance)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": signed[moved], "b": signed[label[moved]]})

    return dealt.groupBy("band", "shard", "slice").applyInPandas(solve, "a long, b long").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], int(row["h"] or 0)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): every node a of a component that isn't its smallest node b.

    ``edges`` has rows a > b.  Alternates large-star and small-star until
    nothing moves; each round is one written table.
    """

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        near = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            near = near.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(least, "u")
        if both:  # large star: hang larger neighbours below the smallest
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:  # small star: hang the node and its smaller neighbours below the smallest
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.filter("a <> b").distinct()

    edges = stage(edges, "simhash-links")
    before = _state(edges)
    while before[0]:
        edges = stage(star(star(edges, True), False), "simhash-stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_distance`` bits, the row's own included.  Null texts count as empty;
    empty texts share fingerprint 0 and link like any other; repeated rows
    each return; a null id takes part in links but is never a component's
    name (null only if all ids of a component are null).
    """
    return _grouped(docs, id_col, text_col, shingle, max_distance).select("doc_id", "fp", "component_id")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int, keep: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, fp, root, component_id, columns to keep): ``root`` is one fingerprint of the component."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle, keep), "simhash-prints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    star = stars(links(distinct, max_distance))
    rooted = distinct.join(star.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id", *keep)


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """One row of ``docs`` per group of near duplicates, all its columns: the one of the smallest id.

    Rows are told apart by all their columns, not by their id: rows of one id
    with different texts belong to different groups and each can stay.  Null
    ids come last; of equal ids the row with the smallest hash stays, of rows
    that are equal in all columns, one.
    """
    one, two = free_name(docs, "__h1"), free_name(docs, "__h2")
    every = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(one, F.xxhash64(*every)).withColumn(two, F.xxhash64(F.lit(1), *every))
    rows = _grouped(marked, id_col, text_col, shingle, max_distance, [one, two])
    alike = rows.groupBy("root", "doc_id", one, two).agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(one).alias("one"), F.col(two).alias("two"), "n")
    first = alike.groupBy("root").agg(F.min(order).alias("row"))
    count = free_name(marked, "__n")
    chosen = first.select(F.col("row.one").alias(one), F.col("row.two").alias(two), F.col("row.n").alias(count))
    chosen = stage(chosen, "simhash-chosen")
    kept = marked.join(chosen.filter(F.col(count) == 1), [one, two], "left_semi")
    more = chosen.filter(F.col(count) > 1)
    if not more.isEmpty():
        kept = kept.unionByName(marked.join(more, [one, two], "left_semi").dropDuplicates([one, two]))
    return kept.select(*every)
