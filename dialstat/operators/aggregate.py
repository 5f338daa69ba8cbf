"""Grouped aggregates.

All are hash aggregates with a partial (map-side) step, so a key that holds a third of the
rows is already reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialstat.functions.scalars import percentage


def _agg_expr(name: str, expr: Column | str) -> Column:
    return (F.sum(expr) if isinstance(expr, str) else expr).alias(name)


def sums_by(df: DataFrame, keys: str | Sequence[str], sums: Mapping[str, Column | str]) -> DataFrame:
    """One row per key with named totals (A1 one sum, A2 several, A3 two keys).

    :param sums: output name -> input column (summed) or a ready aggregate expression
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[_agg_expr(n, e) for n, e in sums.items()])


def row_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key combination (A4)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def ratio_of_sums(
    df: DataFrame,
    keys: str | Sequence[str],
    part: str,
    whole: str,
    name: str,
    part_total: str,
    whole_total: str,
    digits: int = 2,
) -> DataFrame:
    """Per key: both totals and ``round(100 * sum(part) / sum(whole), digits)``.

    A ratio of sums, not a mean of per-row ratios; a zero total gives a null rate.
    """
    return sums_by(df, keys, {part_total: part, whole_total: whole}).withColumn(
        name, percentage(part_total, whole_total, digits)
    )


def join_aggregates(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join two per-key aggregates on their key (J6), keeping ``left``'s key only.

    Keys compare with ``=``, so a null key never finds a partner: a null group of ``left``
    keeps its row with nulls from ``right``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        raise ValueError("no key to join on")
    tmp = [f"__jk{i}" for i in range(len(keys))]
    side = right.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k] == side[t] for k, t in zip(keys, tmp)])
    return left.join(side, cond, how).drop(*tmp)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*columns).distinct()
