"""Data-quality gates (Q1-Q3).

A gate names what a good result looks like: non-empty (Q1), no row matching a "bad"
predicate (Q2), unique key lists (Q3).  ``check`` runs them with as few Spark jobs as
possible: one aggregate computes the row count and every Q2 count together, and each key
list costs one grouped scan that stops at the first duplicate it reports.  Run it on a
checkpointed result, so the plan behind the result is not recomputed per gate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialstat.functions.scalars import predicate
from dialstat.operators.aggregate import row_counts


class GateError(Exception):
    """A result failed one or more gates."""


@dataclass(frozen=True)
class Gate:
    non_empty: bool = True
    bad: Mapping[str, Column | str] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()


def violation_counts(df: DataFrame, bad: Mapping[str, Column | str], rows_column: str = "rows_checked") -> DataFrame:
    """One row: the row count and, per named predicate, how many rows match it (Q2, A5).

    A predicate that is null for a row does not count as a match.
    """
    return df.agg(
        F.count(F.lit(1)).alias(rows_column),
        *[F.count_if(predicate(p)).alias(name) for name, p in bad.items()],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_column: str = "count") -> DataFrame:
    """The key combinations that occur more than once, with their counts."""
    return row_counts(df, keys, count_column).filter(F.col(count_column) > 1)


def require_non_empty(df: DataFrame, what: str = "result") -> None:
    """Raise when ``df`` has no row (Q1); reads at most one row."""
    if df.isEmpty():
        raise GateError(f"{what} is empty")


def check(df: DataFrame, gate: Gate, what: str = "result") -> dict[str, int]:
    """Run every gate of ``gate`` on ``df``; raise ``GateError`` listing all failures.

    :return: the row count and the count of each bad predicate
    """
    counts = violation_counts(df, gate.bad, "__rows").first().asDict()
    failures = []
    if gate.non_empty and counts["__rows"] == 0:
        failures.append("no rows")
    for name in gate.bad:
        if counts[name]:
            failures.append(f"{counts[name]} rows with {name}")
    for keys in gate.unique:
        if not duplicate_keys(df, list(keys)).isEmpty():
            failures.append(f"duplicate keys on {list(keys)}")
    if failures:
        raise GateError(f"{what}: " + "; ".join(failures))
    counts["rows"] = counts.pop("__rows")
    return counts
