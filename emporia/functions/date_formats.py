"""Finding out how a column of text writes its timestamps.

Each value votes for the format that it has the shape of (one lookup, no
parsing); the votes of all rows of all columns are counted in one
aggregate of a few dozen groups.  Formats that differ only in the order of day
and month are *rivals*: a value such as 25/03/2018 is evidence for one of them,
while 05/03/2018 reads both ways.  The rival with evidence wins; evidence for
both, or values that read differently and no evidence at all, is an error, as
a guess would move dates by months.  Every other format that has votes is
accepted, so a column may mix formats.  What no accepted format parses fails
the strict parse, with column and value named.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark date patterns and the shape of what they write.
PLAIN = (
    ("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{3}|\.\d{6})?"),
    ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3}|\.\d{6})?"),
    ("yyyy-MM-dd HH:mm", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}"),
    ("yyyy-MM-dd", r"\d{4}-\d{2}-\d{2}"),
    ("yyyy/M/d HH:mm:ss", r"\d{4}/\d{1,2}/\d{1,2} \d{2}:\d{2}:\d{2}"),
    ("yyyy/M/d", r"\d{4}/\d{1,2}/\d{1,2}"),
    ("yyyyMMdd", r"\d{8}"),
    ("d MMM yyyy", r"\d{1,2} [A-Za-z]{3} \d{4}"),
    ("d-MMM-yyyy", r"\d{1,2}-[A-Za-z]{3}-\d{4}"),
)
_TIMES = ((" HH:mm:ss", r" \d{2}:\d{2}:\d{2}"), (" HH:mm", r" \d{2}:\d{2}"), ("", ""))
#: (day first, month first, shape)
RIVALS = tuple(
    (f"d{sep}M{sep}yyyy{time}", f"M{sep}d{sep}yyyy{time}", rf"\d{{1,2}}[{sep}]\d{{1,2}}[{sep}]\d{{4}}{shape}")
    for sep in "/.-"
    for time, shape in _TIMES
)


class AmbiguousDates(ValueError):
    """A column's values don't tell day from month."""


def parsed(text: Column, fmt: str) -> Column:
    """``text`` read by ``fmt`` as a wall-clock timestamp; NULL where it doesn't parse."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


_DIGITS, _LETTERS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _written(shape: str) -> list[str]:
    """All that values of a shape look like with each digit a ``0`` and each letter but T an ``a``."""
    found = [""]
    for piece, choices in re.findall(r"(\\d\{[^}]+\}|\[A-Za-z\]\{3\}|\(.*?\)\?|\[[/.-]\]|\\?.)()", shape):
        if piece.startswith("("):
            choices = [""] + [w for option in piece[1:-2].split("|") for w in _written(option)]
        elif piece.startswith(r"\d"):
            low, _, high = piece[3:-1].partition(",")
            choices = ["0" * n for n in range(int(low), int(high or low) + 1)]
        elif piece.startswith("[A"):
            choices = ["".join(x) for x in product("aT", repeat=3)]
        else:
            choices = [piece.strip("[]\\")]
        found = [w + c for w in found for c in choices]
    return found


def _shape(text: Column) -> Column:
    """The number of the format (plain ones, then rivals) that a value has the shape of; NULL for none.

    One lookup of what the value looks like, however many formats there are.
    """
    shapes = [shape for _, shape in PLAIN] + [shape for *_, shape in RIVALS]
    numbers = {w: i for i, shape in reversed([*enumerate(shapes)]) for w in _written(shape)}
    looks = F.translate(text, _DIGITS + _LETTERS, "0" * 10 + "".join("T" if c == "T" else "a" for c in _LETTERS))
    known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return F.try_element_at(known, looks)


def infer(df: DataFrame, columns: Sequence[str], day_first: bool | None = None) -> dict[str, tuple[str, ...]]:
    """The formats of each text column, by all its rows, in one job.

    ``day_first`` settles columns whose values leave it open; it never
    overrules evidence.  A column without any value of a known shape has no
    format.
    """
    if not columns:
        return {}

    def field(n: int) -> Column:
        found = F.regexp_extract("text", r"^(\d{1,2})[/.\-](\d{1,2})[/.\-]\d{4}", n).try_cast("int")
        return F.when(F.col("shape") >= len(PLAIN), found)

    values = [F.struct(F.lit(c).alias("name"), F.col(c).alias("text")) for c in columns]
    a, b = F.col("a"), F.col("b")
    votes = (
        df.select(F.explode(F.array(*values)).alias("value"))
        .select("value.*", _shape(F.col("value.text")).alias("shape"))
        .filter("shape IS NOT NULL")
        .select("name", "shape", field(1).alias("a"), field(2).alias("b"))
        .groupBy("name", "shape")
        .agg(
            F.count_if((a > 12) & (a <= 31) & (b <= 12)).alias("only_day"),
            F.count_if((b > 12) & (b <= 31) & (a <= 12)).alias("only_month"),
            F.count_if((a <= 12) & (b <= 12) & (a != b)).alias("differ"),
        )
        .orderBy("name", "shape")
        .collect()
    )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in votes:
        plain = row["shape"] < len(PLAIN)
        fmt = PLAIN[row["shape"]][0] if plain else _winner(row["name"], RIVALS[row["shape"] - len(PLAIN)], row, day_first)
        found[row["name"]].append(fmt)
    return {c: tuple(formats) for c, formats in found.items()}


def _winner(column: str, pair: tuple[str, str, str], votes, day_first: bool | None) -> str:
    """The rival that a column's values speak for."""
    if votes["only_day"] and votes["only_month"]:
        raise AmbiguousDates(
            f"{column}: {votes['only_day']} value(s) read as {pair[0]} only and {votes['only_month']} as {pair[1]} only"
        )
    if votes["only_day"] or votes["only_month"]:
        return pair[0] if votes["only_day"] else pair[1]
    if votes["differ"] and day_first is None:
        raise AmbiguousDates(f"{column}: {votes['differ']} value(s) read both as {pair[0]} and as {pair[1]}")
    return pair[0] if day_first else pair[1]


def read(text: Column, formats: Sequence[str]) -> Column:
    """``text`` by the first of ``formats`` that parses it; NULL if none does.

    The format that it has the shape of comes first: no other one reads such a
    text, and a failed parse costs many times what one that succeeds does.
    """
    if not formats:
        return F.lit(None).cast("timestamp_ntz")
    shapes = dict(PLAIN) | {fmt: shape for *pair, shape in RIVALS for fmt in pair}
    own = [F.when(text.rlike(f"^{shapes[f]}$"), parsed(text, f)) for f in formats]
    return F.coalesce(*(own if len(formats) > 1 else []), *[parsed(text, f) for f in formats])
