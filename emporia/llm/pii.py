"""Personal data by weak supervision.

Base spans follow fixed rules and always stay.  Loose patterns propose further
candidates: obfuscated addresses, numbers in national or odd notation.  On
every candidate labelers vote yes, no or nothing: the strict pattern, a
checksum or range, a gazetteer, the words before it and the characters around
it.  How often each combination of votes occurs, over all documents, is a
small table; expectation-maximisation over it estimates how reliable each
labeler is and how likely each candidate is true.  Those probabilities train
the final span classifier, a logistic regression over votes and shape, and the
candidates it accepts become spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import append, free_name, session_of

KINDS = ("email", "ip", "card", "phone")
#: A candidate becomes a span from this probability on.
ACCEPT = 0.5

# Base patterns (fixed values).  A match of theirs begins where its run of
# characters begins, which the look-behinds and the search for "@" below use to
# keep the scan linear on long runs.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LONG_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){12}")

# Candidates beyond the base patterns.
LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?:\s?[\[({]\s?at\s?[\])}]\s?|\s?@\s?)[A-Za-z0-9-]{1,63}"
        r"(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\.)[A-Za-z0-9-]{1,63})+",
        re.IGNORECASE,
    ),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}([ ./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(
        r"(?<![0-9+])(?:\([0-9]{2,4}\)\s?|0[0-9]{1,4}[ ./-]|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
    ),
}
#: What every match of a loose pattern holds: texts without it need no try, and no match is missed.
_HINT = {
    "email": re.compile(r"@|[\[({]\s?at\s?[\])}]", re.IGNORECASE),
    "ip": re.compile(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    "card": re.compile(r"[0-9]{4}[ ./_-]{1,2}[0-9]{4}[ ./_-]{1,2}[0-9]{4}"),
    "phone": re.compile(r"[0-9](?:\)\s?|[ ./-])[0-9]{3,4}[ .-][0-9]{3,4}"),
}

# Gazetteers (fixed values).
DOMAINS = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "co"}
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36")
CUES = {
    "email": {"email", "e-mail", "mail", "contact", "write", "correo", "courriel", "reach"},
    "ip": {"ip", "ipv4", "ipv6", "address", "host", "server", "adresse", "from", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone", "handy"},
}
AGAINST = {
    "version", "v", "order", "invoice", "isbn", "issn", "sha", "sha1", "sha256", "md5", "hash", "token", "key",
    "serial", "page", "pages", "chapter", "section", "id", "no", "nr", "number", "ticket", "build", "release", "password",
}

LABELERS = ("pattern", "valid", "gazetteer", "context", "edges")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: the run before an "@" and the domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; ends exclusive, in code points.

    Per kind the leftmost non-overlapping matches; those that fail the kind's
    check are dropped without another try.
    """
    out = []
    out += [("email", *span) for span in emails(text)]
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    if _LONG_NUMBER.search(text):
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    shape: str

    @property
    def key(self) -> str:
        """What the tables count: kind, votes and shape."""
        return f"{self.kind}|{','.join(map(str, self.votes))}|{self.shape}"


def _valid(kind: str, found: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.search(r"[A-Za-z]{2,}\W*$", found) and not re.search(r"\.\.|^[.]", found) else -1
    if kind == "ip":
        if ":" in found:
            return 1 if len(found.split(":")) == 8 else -1
        return 1 if all(map(_byte, found.split("."))) else -1
    if kind == "card":
        return 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
    return 1 if 9 <= len(digits) <= 15 else -1


def _gazetteer(kind: str, found: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9]+", found.rstrip(" )]}"))[-1].lower() in DOMAINS else 0
    if kind == "ip":
        first = found.split(".")[0]
        return 0 if ":" in found else (-1 if int(first[:4]) == 0 or int(first[:4]) > 239 else 1)
    if kind == "card":
        return 1 if digits.startswith(CARD_PREFIXES) else -1
    if found.startswith(("+", "0", "(0")):
        return 1
    return 1 if digits[:1] in "23456789" and len(digits) == 10 else -1


def _context(kind: str, before: str) -> int:
    words = [w.strip(".,:;=#()\"'").lower() for w in before.split()[-3:]]
    if any(w in CUES[kind] for w in words):
        return 1
    return -1 if before.rstrip(" \"'").endswith(("=", "#")) or any(w in AGAINST for w in words[-1:]) else 0


def _edges(text: str, start: int, end: int) -> int:
    left, right = text[start - 1 : start], text[end : end + 1]
    return -1 if left.isalnum() or right.isalnum() or left in ("_", "/") or right in ("_", "/") else 1


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint intervals that the spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[Candidate]]:
    """Base spans, and all candidates: the base spans and what the loose patterns add beside them."""
    base = base_spans(text)
    found = [(kind, a, b, True) for kind, a, b in base]
    starts, ends = _union([(a, b) for _, a, b in base])
    for kind in KINDS:
        if not _HINT[kind].search(text):
            continue
        # matches of one pattern never overlap each other
        for m in LOOSE[kind].finditer(text):
            a, b = m.span()
            before = bisect_left(starts, b)  # spans that start before the match ends
            if not before or ends[before - 1] <= a:
                found.append((kind, a, b, False))
    out = []
    for kind, a, b, strict in found:
        inside = text[a:b]
        digits = _digits(inside)
        votes = (
            1 if strict else 0,
            _valid(kind, inside, digits),
            _gazetteer(kind, inside, digits),
            _context(kind, text[max(0, a - 40) : a]),
            _edges(text, a, b),
        )
        marks = "".join(sorted({c for c in inside if not c.isalnum()}))[:3]
        out.append(Candidate(kind, a, b, strict, votes, f"{min(len(digits), 20)}{'s' if marks else 'p'}"))
    return base, out


# ------------------------------------------------------------------ training


@dataclass(frozen=True)
class Reliability:
    """Per kind: share of true candidates, and P(vote | true), P(vote | false) by labeler and vote (-1, 0, 1)."""

    share: dict[str, float]
    given: dict[str, np.ndarray]  # [labeler, truth, vote + 1]


def estimate(keys: list[str], counts: np.ndarray, steps: int = 100) -> tuple[Reliability, np.ndarray]:
    """Expectation-maximisation over counted vote patterns; returns P(true) of each key as well.

    Starts from the majority of votes; one added count per vote keeps every
    probability off 0 and 1.
    """
    share, given, truth = {}, {}, np.full(len(keys), 0.5)
    split = [k.split("|") for k in keys]
    for kind in KINDS:
        rows = np.flatnonzero([s[0] == kind for s in split])
        if not len(rows):
            continue
        votes = np.array([[int(v) for v in split[r][1].split(",")] for r in rows])
        n = counts[rows].astype(float)
        p = 1 / (1 + np.exp(-1.5 * votes.sum(1)))
        for _ in range(steps):
            prior = (n @ p + 1) / (n.sum() + 2)
            table = np.zeros((votes.shape[1], 2, 3))
            for j in range(votes.shape[1]):
                for v in (-1, 0, 1):
                    at = votes[:, j] == v
                    table[j, 1, v + 1] = n[at] @ p[at] + (2.0 if v == 1 else 1.0)
                    table[j, 0, v + 1] = n[at] @ (1 - p[at]) + (2.0 if v == -1 else 1.0)
            table /= table.sum(2, keepdims=True)
            odds = np.log(prior / (1 - prior)) + sum(
                np.log(table[j, 1, votes[:, j] + 1] / table[j, 0, votes[:, j] + 1]) for j in range(votes.shape[1])
            )
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            moved = np.abs(new - p).max()
            p = new
            if moved < 1e-7:
                break
        share[kind], given[kind], truth[rows] = float(prior), table, p
    return Reliability(share, given), truth


def _features(keys: list[str]) -> np.ndarray:
    """Per kind its own weights: bias, each labeler's yes and no, no votes at all, length and separators."""
    out = np.zeros((len(keys), len(KINDS) * (2 * len(LABELERS) + 4)))
    width = out.shape[1] // len(KINDS)
    for i, key in enumerate(keys):
        kind, votes, shape = key.split("|")
        at = KINDS.index(kind) * width
        out[i, at] = 1
        for j, v in enumerate(votes.split(",")):
            out[i, at + 1 + 2 * j] = v == "1"
            out[i, at + 2 + 2 * j] = v == "-1"
        digits = int(shape[:-1])
        out[i, at + width - 3 : at + width] = (digits >= 9, digits >= 13, shape[-1] == "s")
    return out


@dataclass(frozen=True)
class Classifier:
    """The final span classifier, with what it was learned from."""

    weights: np.ndarray
    reliability: Reliability

    def probability(self, keys: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(keys) @ self.weights, -30, 30)))


def _pairs(batch_texts: list[str]) -> pa.Array:
    return pa.array([[c.key for c in candidates(t)[1]] for t in batch_texts], pa.list_(pa.string()))


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """Count candidates' votes over all documents, estimate reliabilities, fit the classifier.

    The table has at most kinds x votes x shapes rows.  Without candidates the
    classifier accepts nothing.
    """
    rows = append(docs.select(F.col(text_col).alias("text")), _pairs, "text", "keys", "array<string>")
    got = rows.select(F.explode("keys").alias("key")).groupBy("key").count().orderBy("key").collect()
    keys, counts = [r["key"] for r in got], np.array([r["count"] for r in got], float)
    reliability, truth = estimate(keys, counts)
    x, n = _features(keys), counts
    w = np.zeros(x.shape[1] if len(keys) else _features(["email|0,0,0,0,0|0p"]).shape[1])
    ridge = np.full(len(w), 0.1)
    for _ in range(60 if len(keys) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - truth)) + ridge * w
        hess = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    if not len(keys):
        w[:] = -10.0
    return Classifier(w, reliability)


# ----------------------------------------------------------------- detection

FOUND = "struct<base: array<struct<kind: string, start: bigint, end: bigint>>, added: array<struct<kind: string, start: bigint, end: bigint, probability: double>>>"
_BASE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_ADDED = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
_FOUND = pa.struct([("base", pa.list_(_BASE)), ("added", pa.list_(_ADDED))])


def annotate(docs: DataFrame, model: Classifier, name: str = "pii", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with a struct ``name``: base spans, and the spans the classifier adds.

    Whole texts; null and empty ones have no spans.  Offsets count code points,
    ends are exclusive; spans come by kind as listed, then by start.
    """
    shared = session_of(docs).sparkContext.broadcast(model)
    known: dict[str, float] = {}

    def run(found: list[str]) -> pa.Array:
        out = []
        for text in found:
            base, more = candidates(text)
            added = []
            for c in more:
                if not c.base:
                    if c.key not in known:
                        known[c.key] = float(shared.value.probability([c.key])[0])
                    if known[c.key] >= accept:
                        added.append({"kind": c.kind, "start": c.start, "end": c.end, "probability": known[c.key]})
            added.sort(key=lambda s: (KINDS.index(s["kind"]), s["start"]))
            out.append({"base": [{"kind": k, "start": a, "end": b} for k, a, b in base], "added": added})
        return pa.array(out, _FOUND)

    return append(docs, run, text_col, name, FOUND)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    order = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("k"),
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            ),
        )
    )
    return F.concat_ws(",", F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def every_span(found: Column) -> Column:
    """Base and added spans of an annotation, as one array."""
    added = F.transform(found["added"], lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.concat(found["base"], added)


def redact(docs: DataFrame, model: Classifier, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in angle brackets.

    Where spans overlap, the earlier and then longer one names the stretch.
    Null texts stay null.
    """
    shared = session_of(docs).sparkContext.broadcast(model)
    known: dict[str, float] = {}
    name = free_name(docs, "__redacted")

    def run(found: list[str]) -> pa.Array:
        out = []
        for text in found:
            _, more = candidates(text)
            spans = []
            for c in more:
                if not c.base and c.key not in known:
                    known[c.key] = float(shared.value.probability([c.key])[0])
                if c.base or known[c.key] >= accept:
                    spans.append((c.start, -c.end, c.kind))
            parts, at = [], 0
            for start, end, kind in sorted(spans):
                if start >= at:
                    parts += [text[at:start], f"<{kind.upper()}>"]
                at = max(at, -end)
            out.append("".join([*parts, text[at:]]) if spans else text)
        return pa.array(out, pa.string())

    marked = append(docs, run, text_col, name, "string")
    text = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(name)).alias(text_col)
    return marked.select(*[text if c == text_col else F.col(f"`{c}`") for c in docs.columns])

