"""Load-time constraints: REQUIRED (NOT NULL) columns and VARCHAR(n) limits.

Spark does not enforce ``nullable = false`` on file reads, so the checks
are explicit.  All of a table's checks run in ONE aggregation (a single
column-pruned scan with map-side partial counts); only the one-row
result reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.schemas import Entity


#: text of the error raised by :func:`require_inline`
REQUIRED_MARK = "NULL in REQUIRED column"


class ConstraintViolation(ValueError):
    """A load would break a REQUIRED column or a length limit."""

    def __init__(self, table: str, problems: list[tuple[str, str, int]]):
        self.table = table
        self.problems = problems
        text = "; ".join(f"{col} {check}: {n} row(s)" for col, check, n in problems)
        super().__init__(f"{table}: {text}")


def _checks(required: Sequence[str], max_length: Mapping[str, int]):
    out = []
    for c in required:
        out.append((c, "required", F.count_if(F.col(c).isNull())))
    for c, n in max_length.items():
        out.append((c, f"length>{n}", F.count_if(F.length(F.col(c)) > F.lit(n))))
    return out


def violations(
    df: DataFrame,
    required: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per check: ``column_name, check_name, violations`` (a long count)."""
    checks = _checks(required, max_length or {})
    if not checks:
        raise ValueError("no checks requested")
    wide = df.agg(*[expr.alias(f"c{i}") for i, (_, _, expr) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(col).alias("column_name"),
                F.lit(check).alias("check_name"),
                F.col(f"c{i}").cast("bigint").alias("violations"),
            )
            for i, (col, check, _) in enumerate(checks)
        ]
    )
    return wide.select(F.inline(rows))


def enforce(df: DataFrame, entity: Entity, layer: str = "staging") -> None:
    """Raise :class:`ConstraintViolation` naming each failed column and its count."""
    required = entity.required if layer == "staging" else entity.required_final
    limits = entity.max_length if layer == "source" else {}
    if layer == "source":
        required = ()
    if not required and not limits:
        return
    found = violations(df, required, limits).filter(F.col("violations") > 0).collect()
    if found:
        raise ConstraintViolation(
            entity.name, [(r.column_name, r.check_name, int(r.violations)) for r in found]
        )


def require_inline(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Fail the job that consumes ``df`` at the first NULL in ``columns``.

    No extra pass: the check is a projection evaluated while the rows are
    written.  Use :func:`enforce` when the error must carry counts.
    """
    out = []
    for f in df.columns:
        c = F.col(f)
        if f in columns:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{table}: {REQUIRED_MARK} {f}"))).otherwise(c)
        out.append(c.alias(f))
    return df.select(*out)
