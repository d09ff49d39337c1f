"""Interaction audit of five document filters by exact constrained least squares.

Each document fails a set of filters, one bit each.  Counting documents by
those bits gives, for every coalition of filters (32 of them), how many
documents the coalition removes.  That game determines everything:

* Shapley values are the solution of a least squares problem over coalitions,
  weighted by the Shapley kernel, under the constraint that the values add up
  to what all filters remove.  Its normal equations are solved in rationals, so
  the values are exact;
* what a filter removes at a step of an order is the difference of two
  coalitions: the filters so far, with and without it.

The texts are read once and never shuffled.  A document becomes its id, its
part, a digest of its text and four bits; the fifth filter (identical to an
earlier text) needs the smallest id per digest, an aggregate that collapses
copies map-side, met again on (digest, id), so a hot text is spread by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import arrow_map, column, record

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
SPACE = "[\\x20\\x09-\\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails.

    A: under 200 words; B: under half of the words are distinct; C: over 2 % of
    the code points are A-Z; D: holds one of ``#$%&*|``.
    """
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(trimmed, SPACE)
    empty = trimmed == ""
    n = F.when(empty, 0).otherwise(F.size(words))
    distinct = F.when(empty, 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    checks = (
        n < 200,
        F.lit(100).cast("long") * distinct < F.lit(50).cast("long") * n,
        F.lit(100).cast("long") * capitals > F.lit(2).cast("long") * F.length(text),
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(check, 1 << i).otherwise(0) for i, check in enumerate(checks)), F.lit(0))


def _any_label(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row per id that is one of them by any of its rows."""
    good = F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0))
    toxic = F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(good.alias("good"), toxic.alias("toxic"))
    return known.filter("good = 1 or toxic = 1")


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail exactly the filters of ``mask``.

    Null texts are empty, null parts the empty string.  Filter E fails a text
    that a smaller id has as well; a null id is neither smaller nor larger than
    another, so it neither fails nor makes fail.  Repeated rows are counted
    each, copies under one id don't fail each other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
        text_failures(text).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = (
        docs.filter(F.col("doc_id").isNotNull())
        .groupBy(F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"))
        .agg(F.min(F.col("doc_id").cast("long")).alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(first, ["key", "doc_id"], "left")
        .join(_any_label(labels), "doc_id", "left")
        .withColumn("mask", F.col("mask") + F.when(copied, 1 << FILTERS.index("E")).otherwise(0))
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def coalitions(failed: DataFrame) -> DataFrame:
    """(part, total, removed, good, toxic): per part, what each coalition removes, indexed by its bits."""

    def table(measure: str) -> Column:
        hit = [F.col("mask").bitwiseAND(F.lit(s)) != 0 for s in range(1 << len(FILTERS))]
        return F.array(*[F.sum(F.when(h, F.col(measure)).otherwise(0)) for h in hit])

    return failed.groupBy("part").agg(
        F.sum("n").alias("total"), table("n").alias("removed"), table("good").alias("good"), table("toxic").alias("toxic")
    )


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular square system, by elimination in rationals."""
    rows = [[*line, value] for line, value in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(j for j in range(i, len(rows)) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j in range(len(rows)):
            if j != i and rows[j][i]:
                rows[j] = [x - rows[j][i] * y for x, y in zip(rows[j], rows[i])]
    return [line[-1] for line in rows]


@cache
def kernel(players: int) -> list[tuple[int, Fraction]]:
    """The coalitions that are neither empty nor everyone, with their Shapley kernel weights."""
    sizes = ((s, s.bit_count()) for s in range(1, (1 << players) - 1))
    return [(s, Fraction(players - 1, comb(players, k) * k * (players - k))) for s, k in sizes]


def shapley(game: list[int], players: int = len(FILTERS)) -> list[Fraction]:
    """Exact Shapley values of ``game`` (a value per coalition, 0 for the empty one).

    Weighted least squares over the coalitions, ``sum(values) = game[-1]``
    enforced by a multiplier.
    """
    members = range(players)
    system = [
        [sum((w for s, w in kernel(players) if s >> i & s >> j & 1), Fraction(0)) for j in members] + [Fraction(1)] for i in members
    ]
    system.append([Fraction(1)] * players + [Fraction(0)])
    right = [sum((w * game[s] for s, w in kernel(players) if s >> i & 1), Fraction(0)) for i in members]
    return solve(system, [*right, Fraction(game[-1])])[:players]


def with_shapley(games: DataFrame) -> DataFrame:
    """``games`` with ``shapley``: per filter, what it removes summed over all orders (120 times its value)."""
    orders = factorial(len(FILTERS))
    types = {"part": pa.string(), "shapley": pa.list_(pa.int64())}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = [[int(orders * x) for x in shapley(game)] for game in column(batch, "removed").to_pylist()]
        made = record({"part": column(batch, "part"), "shapley": values}, types)
        yield pa.RecordBatch.from_arrays([*batch.columns, made.column(1)], names=[*batch.schema.names, "shapley"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in games.schema.fields)
    return arrow_map(games, run, f"{kinds}, shapley array<bigint>")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """Per part, order of the filters and step: what the step removes, and how.

    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.  An empty table has no parts.  Columns of
    ``docs`` besides ``doc_id``, ``text`` and ``part_col`` are never read.
    """
    games = with_shapley(coalitions(failures(docs, labels, part_col)))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = games.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )

    def bits(letters: Column) -> Column:
        """The coalition of some letters."""
        return sum((F.when(F.contains(letters, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))

    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    steps = steps.withColumn("before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))).withColumn("own", bits(letter))
    after, everyone = F.col("before") + F.col("own"), (1 << len(FILTERS)) - 1

    def at(game: str, coalition: Column) -> Column:
        return F.get(game, coalition)

    def gain(game: str) -> Column:
        return at(game, after) - at(game, F.col("before"))

    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at("removed", after)).alias("kept"),
        gain("removed").alias("removed"),
        (at("removed", F.col("own")) - gain("removed")).alias("redundant"),
        (at("removed", F.lit(everyone)) - at("removed", F.lit(everyone) - F.col("own"))).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        F.get("shapley", F.instr(F.lit(FILTERS), letter) - 1).alias("shapley"),
    )


#: DuckDB: the orders are played document by document, without the game.
AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
words AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS first_id FROM texts),
failing AS (
  SELECT doc_id, part, [x[1] FOR x IN [
           ('A', len(words) < 200),
           ('B', 100 * len(list_distinct(words)) < 50 * len(words)),
           ('C', 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body)),
           ('D', regexp_matches(body, '[#$%&*|]')),
           ('E', coalesce(doc_id > first_id, false))] IF x[2]] AS fails
  FROM words),
marked AS (
  SELECT part, fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM failing),
tallied AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
turns AS (
  SELECT filter_order, step, filter_order[step] AS own, string_split(filter_order[:step - 1], '') AS earlier,
         string_split(filter_order[:step], '') AS so_far
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
played AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT list_has_any(fails, so_far) THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN list_contains(fails, own) AND list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM tallied, turns GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM played
"""
