"""Writing results (K1).

``single_file`` is for results whose rows the report's own parameters bound (a top-k, a row per
department): one sorted part file with a header.  ``repartition(1)`` moves only the final rows to
one task, so everything upstream stays parallel (``coalesce(1)`` would pull the whole plan into
one task).  A result that grows with the input is written in parallel: in ranges of its order if
one is given, so the files read in name order are sorted, else one file per task, optionally
partitioned by columns.  Staged inputs can be written as parquet partitioned by a filter column
(the sales table by country): a report filtering on it then reads one folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from dialstat.operators.ranking import sort_expr


def write_result(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    order: Sequence[Column | str] = (),
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "csv",
) -> None:
    """Write ``df`` as CSV with a header (or as parquet).

    :param single_file: one part file, for results of bounded size
    :param order: sort order of the rows (``"x"``, ``"-x"`` or Columns)
    :param partition_by: folder columns for a parallel write
    :param fmt: ``csv`` (reports) or ``parquet`` (staged inputs; with ``partition_by`` a
        later filter on those columns reads only the matching folders)
    """
    if single_file and partition_by:
        raise ValueError("single_file and partition_by exclude each other")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt!r}")
    keys = [sort_expr(o) for o in order]
    out = df.repartition(1) if single_file else df
    if keys:
        out = (out if single_file else out.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
