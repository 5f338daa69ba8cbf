"""Global top-k (O1) and top-n per group (O2, with W1/W2 orderings).

Every ordering ends in a tie-break on further columns, so equal sort keys always give the
same rows.  By default the tie-break is every remaining column: rows that still tie are then
identical, and which of them is kept does not change the result.

Plans at scale:

* ``top_k``: ``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject, a bounded heap per
  task and one merge of k rows per task; nothing else is shuffled.
* ``top_n_per_group``: ``row_number() <= n`` lets Catalyst insert a partial group limit
  (WindowGroupLimit) before the shuffle, so each task ships at most n rows per group; a group
  holding a third of all rows is cut down where it is read.  Spark applies that rule up to
  ``spark.sql.optimizer.windowGroupLimitThreshold``; raise it where n is larger and n rows per
  group and task are still few.  Above it the rows are cut twice.  First, before any shuffle, by
  cut-offs: one aggregate with map-side partial counts makes a histogram of the leading sort key of
  every group, on bins that keep its order, and a row whose bin lies behind the bins that already
  hold n rows cannot be among the first n (:func:`within_cutoffs`).  Then we keep the top n level by
  level: first inside salted sub-groups, then inside ever fewer sub-groups, each made of ``FAN_IN`` of those below.
  Every level is an exact superset of the group's top n, and no task sorts more than a
  sub-group's share of the rows or ``FAN_IN`` x n rows of a group.  The salt mixes the input
  partition into a hash of the row, so even identical rows spread out; there are at least as
  many sub-groups as the session has shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN_IN = 8
SALT_BUCKETS = 64  # at least so many sub-groups on the first level; a power of the fan-in
BINS_PER_OCTAVE = 1024  # bins of the leading sort key: 0.07 % wide
CUTOFF_CELLS = 1 << 16  # groups share cut-offs by hash, so that no more than these are broadcast
_LAST = 1 << 40  # beyond every bin
_RANK = "__rank"
_SALT = "__salt"


def sort_expr(item: Column | str) -> Column:
    """``"x"`` ascending (nulls first), ``"-x"`` descending (nulls last), or a sort Column."""
    if isinstance(item, Column):
        return item
    if item.startswith("-"):
        return F.col(item[1:]).desc_nulls_last()
    return F.col(item).asc_nulls_first()


def _order_names(order: Sequence[Column | str]) -> set[str]:
    return {o.lstrip("-") for o in order if isinstance(o, str)}


def ordering(
    df: DataFrame,
    order: Sequence[Column | str],
    tie_break: Sequence[str] | None,
    exclude: Sequence[str] = (),
) -> list[Column]:
    """The sort expressions: ``order`` then the tie-break columns ascending."""
    if tie_break is None:
        used = _order_names(order) | set(exclude)
        tie_break = [c for c in df.columns if c not in used]
    return [sort_expr(o) for o in order] + [F.col(c).asc_nulls_first() for c in tie_break]


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The first ``k`` rows by ``order`` (O1), e.g. ``top_k(df, ["-sales_amount"], 100)``.

    Each task keeps a heap of ``k`` rows, so ``k`` should be a report size, not a table size;
    for a very large ``k`` lower ``spark.sql.execution.topKSortFallbackThreshold`` and Spark
    sorts and spills instead.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*ordering(df, order, tie_break)).limit(k)


def _group_limit_threshold(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    return int(value)


def _leading_bin(df: DataFrame, item: Column | str) -> Column | None:
    """A number that is greater the earlier a row comes by ``item``, equal for equal values, null for
    none; or None where ``item`` is no plain number, date or time column.

    The bin of a number grows with its logarithm, so it keeps the numbers' order: a greater bin
    means strictly earlier.
    """
    if not isinstance(item, str):
        return None
    descending, name = item.startswith("-"), item.lstrip("-")
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, (T.NumericType, T.TimestampType)):
        return None
    value = value.cast("double")
    size = F.floor(F.log2(F.least(F.abs(value), F.lit(1e300)) + 1) * BINS_PER_OCTAVE).cast("long")
    place = F.when(F.isnan(value), _LAST).when(value < 0, -size).when(value >= 0, size)  # NaN is the greatest
    return F.coalesce(place, F.lit(-_LAST - 1)) if descending else F.coalesce(-place, F.lit(_LAST + 1))


def within_cutoffs(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The rows of ``df`` that can be among the first ``n`` of their group; the others leave where
    they are read.

    Cut-offs are broadcast: a table of at most ``CUTOFF_CELLS`` rows however many groups there are.
    Groups that share a cell share the weakest of their cut-offs.  Rows whose leading keys fall into
    one bin with the n-th stay, so a group of equal keys is not cut; ``df`` as it is where the
    leading key has no bins.
    """
    place = _leading_bin(df, order[0]) if order else None
    if place is None:
        return df
    counts = df.groupBy(*by, place.alias("__bin")).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*by).orderBy(F.desc("__bin"))
    enough = counts.withColumn("__upto", F.sum("__rows").over(earlier))
    cell = F.pmod(F.xxhash64(*by), F.lit(CUTOFF_CELLS))
    cutoff = F.coalesce(F.max(F.when(F.col("__upto") >= n, F.col("__bin"))), F.lit(-_LAST - 1))
    cells = enough.groupBy(*by).agg(cutoff.alias("__cutoff")).groupBy(cell.alias("__cell")).agg(F.min("__cutoff").alias("__cutoff"))
    return df.join(F.broadcast(cells), (cell == cells["__cell"]) & (place >= cells["__cutoff"]), "left_semi")


def top_n_per_group(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[Column | str],
    n: int,
    tie_break: Sequence[str] | None = None,
    rank_column: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group by ``order`` (O2).

    :param by: group columns; a null group value forms a group of its own
    :param order: W1 ``["-total"]``; W2 ``["-sales_amount", "percentage"]``
    :param rank_column: keep the 1-based rank under this name (dropped by default)
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    by = [by] if isinstance(by, str) else list(by)
    sort = ordering(df, order, tie_break, exclude=by)
    if n > _group_limit_threshold(df):
        df = within_cutoffs(df, by, order, n)
        buckets = SALT_BUCKETS
        while buckets < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            buckets *= FAN_IN
        salt_source = [F.col(c) for c in df.columns if c not in by] + [F.spark_partition_id()]
        df = df.withColumn(_SALT, F.pmod(F.xxhash64(*salt_source), F.lit(buckets)))
        while buckets > 1:
            level = Window.partitionBy(*by, _SALT).orderBy(*sort)
            df = df.withColumn(_RANK, F.row_number().over(level)).filter(F.col(_RANK) <= n).drop(_RANK)
            buckets //= FAN_IN
            df = df.withColumn(_SALT, F.col(_SALT) % buckets)
        df = df.drop(_SALT)
    window = Window.partitionBy(*by).orderBy(*sort)
    ranked = df.withColumn(_RANK, F.row_number().over(window)).filter(f"{_RANK} <= {n}")
    if rank_column:
        return ranked.withColumnRenamed(_RANK, rank_column)
    return ranked.drop(_RANK)
