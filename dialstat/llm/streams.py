"""Helpers of operators over numbered rows and sorted streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.staging import broadcast_within

SEGMENT = 1 << 20  # row numbers that meet their group's entry under one key


def with_entry(rows: DataFrame, entries: DataFrame, key: str, broadcast_rows: int) -> DataFrame:
    """``rows`` with a ``row_number`` in order of ``key``, joined to the ``entries`` (key, start, size,
    ...) of their groups, null keys included.

    ``start`` and ``size`` tell the row numbers of a group.  An entry meets its rows segment by
    segment, so a group with any share of the rows is no hot key; up to ``broadcast_rows`` of
    them are broadcast.
    """
    segments = F.sequence(F.expr(f"start div {SEGMENT}L"), F.expr(f"(start + size - 1) div {SEGMENT}L"))
    spread = entries.withColumn("_segment", F.explode(segments)).withColumnRenamed(key, "_key")
    spread = broadcast_within(spread, broadcast_rows)
    meets = F.col(key).eqNullSafe(F.col("_key")) & (F.expr(f"row_number div {SEGMENT}L") == F.col("_segment"))
    return rows.join(spread, meets).drop("_key", "_segment")
