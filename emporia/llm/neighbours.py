"""Nearest neighbours over low-dimensional stable projections in kd-trees.

A Gaussian projection to a few dimensions is 2-stable: the squared projected
distance of two vectors, over their squared distance, follows a chi-square law.
Vectors are dealt to shards by a kd-tree over projections, and each shard builds
its own kd-tree.  For a query the leaves come in order of projected distance,
their vectors are verified with the exact distance, and the search ends when
the chi-square test says that a vector nearer than the k-th found so far would,
with the wanted probability, have been met already.

Equal vectors are one entry with their smallest ids, so a hot vector costs what
any other does.  Queries first search the shard they fall in; the distance
found there tells which other shards the test lets them skip.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import arrow_map, column, record, session_of, stage

#: Projected dimensions.
DIMENSIONS = 16
#: Chance, by the stopping test, to have met every vector that is nearer.
CONFIDENCE = 0.97
SEED = 5
#: Vectors the shards' kd-tree is built from.
SAMPLE = 16384
#: Vectors of a shard's part, and queries that meet them at once.
PART_ROWS = 20000
QUERY_ROWS = 4096
LEAF = 64

ENTRY = "entry long, vec array<double>, ids array<long>"


def chi_square(x: float, m: int) -> float:
    """P(X <= x) of a chi-square variable with ``m`` degrees, by its series."""
    if x <= 0:
        return 0.0
    a, h = m / 2, x / 2
    term = total = 1 / a
    n = a
    while abs(term) > 1e-15 * abs(total):
        n += 1
        term *= h / n
        total += term
    return min(1.0, total * math.exp(-h + a * math.log(h) - math.lgamma(a)))


def chi_square_quantile(p: float, m: int) -> float:
    lo, hi = 0.0, 20.0 * m + 100
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < p else (lo, mid)
    return hi


def projection(size: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dimensions))


# ------------------------------------------------------------------- kd-trees


class Tree:
    """A kd-tree: points in leaves, and the box of each leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        order, bounds = [], []
        stack = [np.arange(len(points))]
        while stack:
            at = stack.pop()
            own = points[at]
            low, high = own.min(0), own.max(0)
            axis = int((high - low).argmax())
            if len(at) <= leaf or high[axis] == low[axis]:
                order.append(at)
                bounds.append((low, high))
                continue
            half = np.argpartition(own[:, axis], len(at) // 2)
            stack.append(at[half[len(at) // 2 :]])
            stack.append(at[half[: len(at) // 2]])
        self.leaves = order
        self.low, self.high = (np.array(b) for b in zip(*bounds))

    def away(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point to every leaf's box."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return (gap * gap).sum(1)


def search(
    tree: Tree, vectors: np.ndarray, weight: np.ndarray, query: np.ndarray, point: np.ndarray, k: int, stop: float, limit: float
) -> tuple[np.ndarray, np.ndarray]:
    """(row, squared distance) of entries among which the ``k`` nearest ids are.

    ``weight`` is how many ids an entry stands for, ``limit`` a squared distance
    within which ``k`` ids are known already, ``stop`` the chi-square quantile.
    """
    away = tree.away(point)
    order = np.argsort(away, kind="stable")
    rows, dist = np.empty(0, np.int64), np.empty(0)
    best, at = limit, 0
    step = 4
    while at < len(order) and away[order[at]] <= stop * best:
        new = np.concatenate([tree.leaves[i] for i in order[at : at + step]])
        at += step
        step = min(64, step * 2)
        if np.isfinite(best):  # a vector projected beyond the stopping radius needs no verifying
            gap = tree.points[new] - point
            new = new[(gap * gap).sum(1) <= stop * best]
        delta = vectors[new] - query
        d = (delta * delta).sum(1)
        keep = d <= best
        rows, dist = np.concatenate([rows, new[keep]]), np.concatenate([dist, d[keep]])
        by = np.argsort(dist, kind="stable")
        enough = int(np.searchsorted(np.cumsum(weight[rows[by]]), k))
        if enough < len(by):
            best = min(best, float(dist[by[enough]]))
            near = dist <= best  # ties stay
            rows, dist = rows[near], dist[near]
    return rows, dist


# -------------------------------------------------------------------- sharding


def shard_boxes(sample: np.ndarray, shards: int) -> list[tuple]:
    """A kd-tree over the sample with about ``shards`` leaves: (axis, cut, low, high); negative children are leaves."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(at: np.ndarray, want: int) -> int:
        nonlocal leaves
        own = sample[at]
        if want > 1 and len(at) >= 16:
            axis = int((own.max(0) - own.min(0)).argmax())
            cut = float(np.median(own[:, axis]))
            low = own[:, axis] <= cut
            if low.any() and not low.all():
                here = len(nodes)
                nodes.append(())
                nodes[here] = (axis, cut, grow(at[low], want // 2), grow(at[~low], want - want // 2))
                return here
        leaves += 1
        return -leaves

    root = grow(np.arange(len(sample)), shards)
    return nodes if root == 0 else []


def shard_of(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int32)
    stack = [(0, np.arange(len(points)))] if nodes else []
    while stack:
        node, at = stack.pop()
        if not len(at):
            continue
        if node < 0:
            out[at] = -1 - node
            continue
        axis, cut, low, high = nodes[node]
        left = points[at, axis] <= cut
        stack += [(low, at[left]), (high, at[~left])]
    return out


def shard_ranges(nodes: list[tuple], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every shard's region."""
    lows, highs = {}, {}
    stack = [(0 if nodes else -1, np.full(dimensions, -np.inf), np.full(dimensions, np.inf))]
    while stack:
        node, low, high = stack.pop()
        if node < 0:
            lows[-1 - node], highs[-1 - node] = low, high
            continue
        axis, cut, left, right = nodes[node]
        below, above = high.copy(), low.copy()
        below[axis] = min(below[axis], cut)
        above[axis] = max(above[axis], cut)
        stack += [(left, low, below), (right, above, high)]
    return np.array([lows[i] for i in range(len(lows))]), np.array([highs[i] for i in range(len(highs))])


# --------------------------------------------------------------------- search


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): vectors that take part, repeated rows once.

    Null ids, null, empty or zero vectors and those with null or non-finite
    components are left out, and so are vectors of another length than most
    (of equally frequent lengths the larger counts).
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")
    ).filter(
        F.col("vec_id").isNotNull()
        & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (size["n"] if size else 0)).distinct()


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(entry, vec, ids): distinct vectors with their ``k + 1`` smallest ids; the entry is the smallest.

    The rank limit is applied before the shuffle as well, so a hot vector
    sends few rows.  Beyond ``k + 1`` ids none can be among ``k`` neighbours.
    """
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    kept = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    return kept.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("entry"), "vec", "ids"
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, by Euclidean distance.

    ``is_query`` is a condition on ``vec_id``.  Candidates are all vectors that
    take part but the query's own; ties go to the smaller id.
    """
    spark = session_of(vectors)
    rows = usable(vectors, id_col, vec_col)
    index = stage(entries(rows, k), "nearest-entries")
    total = index.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)
    sample = index.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("vec").toPandas()["vec"]
    sample = np.stack(sample.to_list())
    matrix = projection(sample.shape[1], dimensions)
    dimensions = matrix.shape[1]
    nodes = shard_boxes(sample @ matrix, -(-total // part_rows))
    lows, highs = shard_ranges(nodes, dimensions)
    stop = chi_square_quantile(confidence, dimensions)

    def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
        vec = column(batch, "vec")
        return vec.flatten().to_numpy().reshape(len(vec), -1)

    def home(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        shard = shard_of(nodes, matrix_of(batch) @ matrix)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])

    placed = stage(arrow_map(index, home, f"{ENTRY}, shard int"), "nearest-shards")
    # a row per shard; its parts, dealt by hash, have a bounded size
    sizes = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    parts = np.array([max(1, -(-sizes.get(s, 0) // (2 * part_rows))) for s in range(len(lows))])

    # queries are distinct vectors; who asked comes back at the end
    asked = rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
    wanted = placed.join(asked.select("vec").distinct(), "vec", "left_semi").select("entry", "vec", "shard")
    wanted = stage(wanted, "nearest-queries")
    types = {
        "entry": pa.int64(), "vec": pa.list_(pa.float64()), "limit": pa.float64(),
        "shard": pa.int32(), "part": pa.int32(),
    }
    visit = "entry long, vec array<double>, limit double, shard int, part int"

    def visits(found: DataFrame, others: bool) -> DataFrame:
        """Queries (with ``limit``) by the parts they search: all of their own shard, or of the others."""

        def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            points = matrix_of(batch) @ matrix
            own = column(batch, "shard").to_numpy()
            limit = column(batch, "limit").to_numpy()
            key = column(batch, "entry").to_numpy()
            out: dict[str, list] = {"row": [], "shard": [], "part": []}
            for i, point in enumerate(points):
                if others:
                    gap = np.maximum(np.maximum(lows - point, point - highs), 0.0)
                    chosen = np.flatnonzero((gap * gap).sum(1) <= stop * limit[i])
                    chosen = chosen[chosen != own[i]]
                else:
                    chosen = own[i : i + 1]
                for shard in chosen:
                    for part in range(parts[shard]):
                        out["row"].append(i)
                        out["shard"].append(int(shard))
                        out["part"].append(part)
            at = np.array(out["row"], np.int64)
            yield record(
                {
                    "entry": key[at], "vec": column(batch, "vec").take(pa.array(at)), "limit": limit[at],
                    "shard": out["shard"], "part": out["part"],
                },
                types,
            )

        return arrow_map(found, deal, visit)

    def verify(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(points) and len(queries):
            points = points.sort_values("entry")
            vectors_, ids = np.stack(points["vec"].to_list()), points["ids"].to_list()
            weight = np.array([len(x) for x in ids])
            tree = Tree(vectors_ @ matrix)
            for entry, query, limit in zip(queries["entry"], queries["vec"], queries["limit"]):
                found, d = search(tree, vectors_, weight, query, query @ matrix, k + 1, stop, limit)
                # by distance, then id: of ties only the smallest ids can count
                near = sorted((float(x), int(i)) for r, x in zip(found, d) for i in ids[r])[: k + 1]
                out += [(int(entry), i, x) for x, i in near]
        return pd.DataFrame(out, columns=["entry", "vec_id", "squared"])

    def run(dealt: DataFrame) -> DataFrame:
        part = F.lit(0)
        for shard in np.flatnonzero(parts > 1):
            part = F.when(F.col("shard") == int(shard), F.pmod(F.xxhash64("entry"), F.lit(int(parts[shard])))).otherwise(part)
        data = placed.withColumn("part", part.cast("int"))
        # queries of a part beyond QUERY_ROWS come in blocks, each with a copy of that part; most parts have one
        dealt = stage(dealt, "nearest-visits")
        asked_of = dealt.groupBy("shard", "part").count().filter(F.col("count") > QUERY_ROWS).collect()
        blocks = [(r["shard"], r["part"], -(-r["count"] // QUERY_ROWS)) for r in asked_of]
        many = F.broadcast(spark.createDataFrame(blocks, "shard int, part int, blocks int"))
        copies = F.coalesce("blocks", F.lit(1))
        data = data.join(many, ["shard", "part"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), copies - 1)))
        block = F.pmod(F.xxhash64("entry", F.lit(1)), copies.cast("long")).cast("int")
        dealt = dealt.join(many, ["shard", "part"], "left").withColumn("block", block)
        keys = ["shard", "part", "block"]
        data, dealt = data.drop("blocks"), dealt.drop("blocks")
        return data.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(verify, "entry long, vec_id long, squared double")

    nearby = stage(run(visits(wanted.withColumn("limit", F.lit(float("inf"))), False)), "nearest-home")
    by_rank = Window.partitionBy("entry").orderBy("squared", "vec_id")
    bound = (
        nearby.withColumn("n", F.row_number().over(by_rank)).filter(F.col("n") == k + 1).select("entry", F.col("squared").alias("limit"))
    )
    limited = wanted.join(bound, "entry", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    found = nearby.unionByName(run(visits(limited, True)))
    found = found.withColumn("n", F.row_number().over(by_rank)).filter(F.col("n") <= k + 1)
    named = asked.join(wanted.select("entry", "vec"), "vec").select("query_id", "entry")
    answers = named.join(found, "entry").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("squared", "vec_id")).cast("int")
    return (
        answers.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.sqrt("squared").alias("score"))
    )
