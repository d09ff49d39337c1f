"""Quality classifier: a sparse ensemble of rules.

Statistics of whole texts are Spark column expressions.  On a bounded sample of
labelled rows, small boosted trees are grown over them; every path from a root
to a node is a conjunctive rule.  A logistic regression with lasso penalty over
the rules keeps few of them, and those are compiled back to one Spark column
expression, so scoring is a projection: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import free_name

#: Labelled rows the rules are learned from, the smallest by hash of their id.
FIT_ROWS = 20000
TREES, DEPTH, CUTS = 40, 3, 32
MIN_NODE = 20
#: Lasso penalty, per row.
LASSO = 3e-4
THRESHOLD = 0.7


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text that isn't null; all are 0 for the empty text.

    Characters are counted by what is left when all others are removed.
    """
    chars = F.length(text)
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    n_words = F.size(words)
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n_lines = F.size(lines)

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    return {
        "log_words": F.log1p(n_words.cast("double")),
        "log_lines": F.log1p(n_lines.cast("double")),
        "word_length": share(chars, n_words),
        "line_words": share(n_words, n_lines),
        "capitals": share(kept(r"[^\p{Lu}]+"), chars),
        "digits": share(kept("[^0-9]+"), chars),
        "symbols": share(kept("[^#$%&*|<>{}=_~^@/\\\\]+"), chars),
        "shouts": share(kept("[^!?]+"), chars),
        "stops": share(kept("[^.,;:]+"), n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)).cast("double"),
        "short_words": share(F.size(F.filter(words, lambda w: F.length(w) <= 3)), n_words),
    }


def with_statistics(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with a struct ``name`` of the statistics (null text: empty)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.withColumn(name, F.struct(*[c.cast("double").alias(k) for k, c in statistics(text).items()]))


# --------------------------------------------------------------------- rules

#: (feature, cut, True: at most the cut / False: above it)
Condition = tuple[str, float, bool]


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    weight: float = 0.0


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights; the score is the logistic of their sum."""

    intercept: float
    rules: tuple[Rule, ...]

    def expression(self, struct: str) -> Column:
        """The score as a column over a struct of statistics."""

        def test(c: Condition) -> Column:
            value = F.col(f"`{struct}`.`{c[0]}`")
            return value <= F.lit(c[1]) if c[2] else value > F.lit(c[1])

        total = F.lit(self.intercept)
        for rule in self.rules:
            holds = reduce(lambda a, b: a & b, [test(c) for c in rule.conditions])
            total = total + F.when(holds, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, y: np.ndarray, names: list[str], depth: int) -> list[tuple]:
    """(conditions, rows, mean) of every node below the root of a regression tree."""
    out: list[tuple] = []

    def split(at: np.ndarray, path: tuple[Condition, ...]) -> None:
        if len(path):
            out.append((path, at, float(y[at].mean())))
        if len(path) == depth or len(at) < 2 * MIN_NODE:
            return
        best, total = (1e-9, None), y[at].sum()
        for j, edges in enumerate(cuts):
            if not len(edges):
                continue
            bins = np.searchsorted(edges, x[at, j], "left")  # bin b: at most edges[b]
            n = np.bincount(bins, minlength=len(edges) + 1).cumsum()[:-1]
            s = np.bincount(bins, y[at], len(edges) + 1).cumsum()[:-1]
            ok = (n >= MIN_NODE) & (len(at) - n >= MIN_NODE)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, s**2 / n + (total - s) ** 2 / (len(at) - n) - total**2 / len(at), -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (j, float(edges[k])))
        if best[1] is None:
            return
        j, cut = best[1]
        low = x[at, j] <= cut
        split(at[low], (*path, (names[j], cut, True)))
        split(at[~low], (*path, (names[j], cut, False)))

    split(rows, ())
    return out


def extract(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> list[Rule]:
    """Distinct rules: the paths of boosted trees, each grown on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, CUTS))) for j in range(x.shape[1])]
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        rest = y - 1 / (1 + np.exp(-margin))
        rows = rng.permutation(len(y))[: max(2 * MIN_NODE, len(y) // 2)]
        for path, _, mean in _grow(x, cuts, rows, rest, names, depth):
            found.setdefault(tuple(sorted(path)))
            if len(path) == depth:
                margin = margin + np.where(covers(x, names, path), mean, 0.0)
    return [Rule(path) for path in found]


def covers(x: np.ndarray, names: list[str], conditions: tuple[Condition, ...]) -> np.ndarray:
    at = np.ones(len(x), bool)
    for name, cut, low in conditions:
        value = x[:, names.index(name)]
        at &= value <= cut if low else value > cut
    return at


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = LASSO, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an l1 penalty, by accelerated proximal gradient; the intercept is free."""
    scale = np.maximum(z.std(0), 0.05)
    z = np.hstack([np.ones((len(z), 1)), (z - 0.0) / scale])
    step = 4.0 / max(1e-9, np.linalg.norm(z.T @ z / len(z), 2))
    w = v = np.zeros(z.shape[1])
    w[0] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        new = v - step * (z.T @ (p - y) / len(y))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:] / scale


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Ensemble:
    """Rules and weights from statistics and labels; one class only gives a constant."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Ensemble(float(np.log(share / (1 - share))), ())
    rules = extract(x, y, names)
    if not rules:
        return Ensemble(float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), ())
    z = np.stack([covers(x, names, r.conditions) for r in rules], 1).astype(float)
    intercept, weights = lasso(z, y)
    kept = [Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-4]
    return Ensemble(intercept, tuple(kept))


def train(
    docs: DataFrame,
    labels: DataFrame,
    split: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Ensemble:
    """Learn from at most ``fit_rows`` labelled rows for which ``split`` (on column doc_id) holds.

    The sample is the rows with the smallest hash of their id.  A repeated
    label counts by its maximum; null ids and labels are left out.
    """
    split = F.lit(True) if split is None else split
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("label is not null and doc_id is not null")
        .filter(split)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # the sample's size is bounded by fit_rows, so it is sent to the documents
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(known), "doc_id"
    )
    names = list(statistics(F.lit("")))
    got = with_statistics(rows, "text", "s").select("doc_id", "label", "s.*").toPandas().sort_values(["doc_id", *names])
    got = got.drop_duplicates("doc_id")
    return fit(got[names].to_numpy(float), (got["label"].to_numpy() > 0).astype(float), names)


def annotate(docs: DataFrame, model: Ensemble, name: str = "quality_score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score ``name`` of each row's whole text (null: empty)."""
    struct = free_name(docs, "__statistics")
    scored = with_statistics(docs, text_col, struct)
    return scored.withColumn(name, model.expression(struct)).select(*docs.columns, name)
