"""Toxic passages as maximal scoring segments of token log-odds.

Every token has a log-odds of the toxic against the clean class.  Counts come
from the labelled documents of the training split, at most ``FIT_ROWS`` of them.  The Dirichlet prior of a
word is the distribution of its stem, the first letters, and a stem's prior is
that of the corpus, so rare and unseen words are judged by what they begin
with.  Tables have a fixed number of hashed slots.

Along a text each token adds its log-odds less a drift, so the expected sum on
clean text is negative.  A linear scan (all maximal scoring segments: no
extension and no cut of a segment scores more) finds the passages.  Segment
scores of clean text follow an extreme-value law; its two constants are fitted
on segments of clean calibration documents, held apart from the counts, and
turn a score into an expected number of equally good chance segments.  Bits
above chance, summed over a document's significant passages, are what a
logistic curve maps to the final score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import append, arrow_map, bounded_batches, column, crc_split, id_text, record, session_of, stage, texts

#: Hashed slots of words and of stems.
WORD_SLOTS = 1 << 20
STEM_SLOTS = 1 << 18
#: Letters of a stem.
STEM = 5
#: Weight of the prior, in documents.
PRIOR = 8.0
#: What each token costs.
DRIFT = 0.7
#: Labelled rows the model is fitted on, the smallest by hash of their id.
FIT_ROWS = 40000
#: Calibration documents: crc32 of the id modulo this is 0, among the training split.
CALIBRATION = 5
#: Words whose log-odds a worker keeps.
KEPT_WORDS = 300_000
#: Segment scores are counted in this many bins of this width.
BINS, BIN = 400, 0.25

THRESHOLD = 0.7

_EDGES = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^…«»“”‘’¿¡"

SEGMENT = "array<struct<start: int, stop: int, score: double, bits: double>>"


def words(text: str) -> list[str]:
    """Lower-case words between white space, punctuation at their ends removed.

    A word that repeats the one before it counts once: saying it again is no
    further evidence.
    """
    found = [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]
    return [w for w, before in zip(found, [None, *found]) if w != before]


def _slots(word: str) -> tuple[int, int]:
    return (
        xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1) % WORD_SLOTS,
        xxhash.xxh64_intdigest(word[:STEM].encode("utf-8", "surrogatepass"), 2) % STEM_SLOTS,
    )


def segments(scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, after last, score) of ``scores - drift``.

    Linear time: only tokens above the drift can begin or end a segment; each
    is put on a stack of candidates with the sums left and right of it and
    merged with those it extends.
    """
    gain = scores - drift
    up = np.flatnonzero(gain > 0)
    if not len(up):
        return []
    sums = np.concatenate(([0.0], np.cumsum(gain)))
    stack: list[list] = []  # start, stop, left, right, place of the nearest lower left
    for at, left, right in zip(up.tolist(), sums[up].tolist(), sums[up + 1].tolist()):
        new = [at, at + 1, left, right, -1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
            j = len(stack) - 1
        new[4] = j
        stack.append(new)
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


@dataclass
class Model:
    """Counts by slot, the extreme-value constants and the logistic curve."""

    word: np.ndarray  # clean and toxic occurrences by word slot
    stem: np.ndarray  # toxic share by stem slot
    base: float  # toxic share of all occurrences
    lam: float = 1.0
    k: float = 0.1
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.0, 1.0, 0.0]))

    def odds(self, word: str) -> float:
        """Log-odds of the word over the corpus', its stem's share being the prior."""
        w, s = _slots(word)
        clean, toxic = self.word[w]
        share = (toxic + PRIOR * self.stem[s]) / (clean + toxic + PRIOR)
        return float(np.log(share / (1 - share)) - np.log(self.base / (1 - self.base)))

    def found(self, text: str, kept: dict[str, float]) -> tuple[int, list[tuple[int, int, float]]]:
        found = words(text)
        try:
            scores = [kept[w] for w in found]
        except KeyError:
            if len(kept) > KEPT_WORDS:
                kept.clear()
            for w in found:
                if w not in kept:
                    kept[w] = self.odds(w)
            scores = [kept[w] for w in found]
        return len(found), segments(np.array(scores, float), DRIFT)

    def bits(self, score: float, n: int) -> float:
        """Bits by which a segment beats the best that chance offers in ``n`` tokens."""
        return (self.lam * score - np.log(max(self.k * n, 1e-12))) / np.log(2)

    def features(self, n: int, found: list[tuple[int, int, float]]) -> np.ndarray:
        bits = [b for b in (self.bits(s, n) for _, _, s in found) if b > 0]
        total = sum(bits)
        return np.array([1.0, np.log1p(max(bits, default=0.0)), np.log1p(total), np.log1p(1000 * total / max(n, 50))])

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


# ------------------------------------------------------------------- training


def labelled(
    docs: DataFrame, labels: DataFrame, split: Column, id_col: str, text_col: str, label_col: str, fit_rows: int
) -> DataFrame:
    """(doc_id, text, label) of at most ``fit_rows`` labelled rows of the split, written and reread.

    A repeated label counts by its maximum.  The picked ids, bounded by
    ``fit_rows``, are sent to the documents, so no text is shuffled.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("label is not null and doc_id is not null")
        .filter(split)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    return stage(id_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id"), "toxicity-labelled")


def _count(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents by slot and class, of words and of stems: tables of fixed size."""
    types = {"slot": pa.int32(), "clean": pa.int64(), "toxic": pa.int64()}
    slots = WORD_SLOTS + STEM_SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((slots, 2), np.int64)
        kept: dict[str, tuple[int, int]] = {}
        for batch in batches:
            for text, label in zip(texts(batch), column(batch, "label").to_pylist()):
                at = []
                for w in set(words(text)):
                    pair = kept.get(w)
                    if pair is None:
                        if len(kept) > KEPT_WORDS:
                            kept.clear()
                        pair = kept[w] = _slots(w)
                    at.append(pair)
                if at:
                    both = np.array(at, np.int64)
                    np.add.at(table[:, int(label > 0)], both[:, 0], 1)
                    np.add.at(table[:, int(label > 0)], WORD_SLOTS + both[:, 1], 1)
        used = np.flatnonzero(table.any(1))
        yield record({"slot": used.astype(np.int32), "clean": table[used, 0], "toxic": table[used, 1]}, types)

    bounded_batches(session_of(rows))
    counts = rows.mapInArrow(run, "slot int, clean long, toxic long")
    summed = counts.groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # at most WORD_SLOTS + STEM_SLOTS rows, packed in parts on the executors
    part = summed.groupBy(F.expr("slot div 65536").alias("part")).agg(
        F.collect_list("slot").alias("slot"), F.collect_list("clean").alias("clean"), F.collect_list("toxic").alias("toxic")
    )
    table = np.zeros((slots, 2))
    for row in part.toLocalIterator():
        at = np.array(row["slot"], np.int64)
        table[at, 0], table[at, 1] = row["clean"], row["toxic"]
    return table[:WORD_SLOTS], table[WORD_SLOTS:]


def _summaries(rows: DataFrame, model: Model) -> tuple[np.ndarray, float]:
    """Clean documents' segment scores by bin, and the tokens scanned."""
    shared = session_of(rows).sparkContext.broadcast(model)
    types = {"bin": pa.int32(), "n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, float] = {}
        seen, total = np.zeros(BINS + 1, np.int64), 0
        for batch in batches:
            for text in texts(batch):
                n, found = shared.value.found(text, kept)
                total += n
                if found:
                    at = np.minimum(np.array([s for _, _, s in found]) / BIN, BINS - 1).astype(int)
                    np.add.at(seen, at, 1)
        seen[BINS] = total
        yield record({"bin": np.arange(BINS + 1, dtype=np.int32), "n": seen}, types)

    bounded_batches(session_of(rows))
    got = rows.mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BINS + 1)
    for row in got:
        out[row["bin"]] = row["n"]
    return out[:BINS], out[BINS]


def _extreme_value(seen: np.ndarray, tokens: float) -> tuple[float, float]:
    """(lambda, K): of clean text, segments of score s or more number K n exp(-lambda s).

    A line through the logarithms of the survival counts, weighted by count.
    Chance is the lower part of the curve; its far tail holds mislabelled
    documents, so bins beyond the 99.9 % quantile are left out.
    """
    above = seen[::-1].cumsum()[::-1]
    use = np.flatnonzero((above >= max(20, above[0] / 1000)) & (np.arange(len(above)) >= 2))
    if len(use) < 3 or not tokens:
        return 1.0, 0.1
    s, y, w = use * BIN, np.log(above[use] / tokens), np.sqrt(above[use])
    slope, level = np.polyfit(s, y, 1, w=w)
    return (float(-slope), float(np.exp(level))) if slope < -0.05 else (1.0, 0.1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge on all weights but the first."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    split: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Learn from at most ``fit_rows`` labelled rows for which ``split`` (on column doc_id) holds.

    Token counts take all of them but the calibration fifth; segment statistics
    take that fifth's clean rows, the final curve all of its rows.  Without
    labels, or with one class only, the curve falls back to fixed weights.
    """
    split = F.lit(True) if split is None else split
    fold = crc_split(F.concat(F.col("doc_id").cast("string"), F.lit("c")), CALIBRATION) == 0
    rows = labelled(docs, labels, split, id_col, text_col, label_col, fit_rows)
    word, stem = _count(rows.filter(~fold))
    total = stem.sum(0)
    base = min(max(float((total[1] + 0.5) / (total.sum() + 1.0)), 1e-4), 0.5)
    share = (stem[:, 1] + PRIOR * base) / (stem.sum(1) + PRIOR)
    model = Model(word.astype(np.float32), share.astype(np.float32), base)
    seen, tokens = _summaries(rows.filter(fold & (F.col("label") == 0)), model)
    model.lam, model.k = _extreme_value(seen, tokens)
    shared = session_of(docs).sparkContext.broadcast(model)
    types = {"label": pa.int32(), "x": pa.list_(pa.float64())}

    def features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept: dict[str, float] = {}
        x = [shared.value.features(*shared.value.found(t, kept)) for t in texts(batch)]
        yield record({"label": column(batch, "label"), "x": [v.tolist() for v in x]}, types)

    got = arrow_map(rows.filter(fold), features, "label int, x array<double>").toPandas()
    y = (got["label"].to_numpy() > 0).astype(float)
    if 0 < y.sum() < len(y):
        model.weights = _logistic(np.array(got["x"].tolist()), y)
    return model


# -------------------------------------------------------------------- scoring


def annotate(docs: DataFrame, model: Model, name: str = "toxicity", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``name``: score, and the significant passages by token place, score and bits.

    Every row is scored on its whole text; null and empty texts have no passage
    and the score of a document without any.
    """
    shared = session_of(docs).sparkContext.broadcast(model)
    kind = pa.struct(
        [
            ("score", pa.float64()),
            ("passages", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("bits", pa.float64())]))),
        ]
    )
    kept: dict[str, float] = {}

    def run(found: list[str]) -> pa.Array:
        out = []
        for text in found:
            n, parts = shared.value.found(text, kept)
            score = float(shared.value.score(shared.value.features(n, parts)))
            passages = [
                {"start": a, "stop": b, "score": s, "bits": bits}
                for a, b, s in parts
                if (bits := float(shared.value.bits(s, n))) > 0
            ]
            out.append({"score": score, "passages": passages})
        return pa.array(out, kind)

    return append(docs, run, text_col, name, f"struct<score: double, passages: {SEGMENT}>")
