"""Key lookups (J1-J5): enrich rows of one table with columns of another by an equal key.

The join method is left to Catalyst and adaptive execution: a side whose size is known to be
under ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics before the run, or from
the measured shuffle output during it) is broadcast, anything larger is joined by shuffle.
So no side is broadcast without a size check.

Hot keys: the adaptive skew-join rule splits an oversized shuffle partition into several
tasks, but for a LEFT OUTER join only on the left side.  When the lookup table itself may
hold many copies of one key (a third of its rows, say), ``split_hot_keys=True`` writes the
left join as the inner join (both sides splittable) plus the unmatched left rows (a left
anti join on the distinct keys, padded with nulls).  The result is exactly the left join's.
``salt_hot_keys=True`` reads each side once instead: a sketch of the lookup table's keys (one
aggregate of bounded size, run when the lookup is built) finds those with many times a task's
share of the rows.  Where there are none, and that is the common case, the join is a plain left
join.  Otherwise only the heavy keys are salted: their rows are dealt over so many pieces, and a left
row meets every piece of its key.  A heavy key is in the lookup table, so a left row that
some piece leaves unmatched is dropped there; the others pad theirs with nulls, as ever.
Semi and anti lookups also use distinct keys: deduplicated map-side, a key with many copies
reaches the join as at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_KEYS = 1000  # most keys that are salted
TRACKED_KEYS = 20_000  # counters of the sketch: keys with a hundredth of a percent of the rows are seen
LEAST_HEAVY = 100_000  # rows of a key that one task takes in its stride


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    how: str = "left",
    columns: Sequence[str] | None = None,
    keep_right_key: bool = False,
    split_hot_keys: bool = False,
    salt_hot_keys: bool = False,
) -> DataFrame:
    """Join ``right``'s columns onto ``left`` by key.

    :param on: key column(s) of ``left``
    :param right_on: key column(s) of ``right`` when named differently (J2, J4, J5)
    :param how: ``left`` keeps unmatched left rows with nulls (J1, J2, J4); ``inner`` keeps
        matched rows only (J3, J5); ``left_semi`` / ``left_anti`` filter ``left``
    :param columns: the ``right`` columns to bring along (default: all but the key)
    :param keep_right_key: keep ``right``'s key columns as well (J4 keeps ``caller_id``)
    :param split_hot_keys: ``how="left"`` only: plan the join so a key with many copies in
        ``right`` is spread over several tasks (see the module notes)
    :param salt_hot_keys: ``how="left"`` with one key: the same by salting the keys that a sketch finds
    :return: ``left``'s columns, then the brought columns; one key column unless kept
    """
    left_keys = _as_list(on)
    right_keys = _as_list(right_on) if right_on is not None else list(left_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("key lists differ in length")
    wanted = [c for c in (columns if columns is not None else right.columns) if c not in right_keys]
    clash = [c for c in wanted if c in left.columns]
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; select or rename first")
    if how in ("left_semi", "left_anti"):
        # Only key existence matters: distinct keys (deduplicated map-side) cannot be hot.
        keys_only = right.select(*[F.col(r).alias(lk) for r, lk in zip(right_keys, left_keys)]).distinct()
        return left.join(keys_only, on=left_keys, how=how)

    if keep_right_key:
        # Rename the right keys apart so the condition never depends on column lineage.
        tmp = [f"__rk{i}" for i in range(len(right_keys))]
        side = right.select(*[F.col(r).alias(t) for r, t in zip(right_keys, tmp)], *wanted)
        key_cols = tmp
        brought = tmp + wanted

        def join(other: DataFrame, kind: str) -> DataFrame:
            cond = reduce(lambda a, b: a & b, [left[lk] == other[t] for lk, t in zip(left_keys, tmp)])
            return left.join(other, cond, kind)
    else:
        side = right.select(*[F.col(r).alias(lk) for r, lk in zip(right_keys, left_keys)], *wanted)
        key_cols = left_keys
        brought = wanted

        def join(other: DataFrame, kind: str) -> DataFrame:
            return left.join(other, on=left_keys, how=kind)

    pieces = heavy_keys(side, key_cols[0]) if salt_hot_keys and how == "left" and len(key_cols) == 1 else {}
    if pieces:
        out = _salted_left(left, side, left_keys[0], key_cols[0], pieces)
    elif split_hot_keys and how == "left":
        # Unmatched rows: an anti join against the distinct keys, padded with nulls.
        unmatched = join(side.select(*key_cols).distinct(), "left_anti")
        padded = unmatched.select(
            *unmatched.columns, *[F.lit(None).cast(side.schema[c].dataType).alias(c) for c in brought]
        )
        out = join(side, "inner").unionByName(padded)
    else:
        out = join(side, how)
    if keep_right_key:
        renamed = [F.col(t).alias(r) for t, r in zip(tmp, right_keys)]
        return out.select(*left.columns, *renamed, *wanted)
    return out


def _planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate, the one that it plans broadcasts by."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def heavy_keys(df: DataFrame, key: str) -> dict[object, int]:
    """Keys of ``df`` with more than two tasks' fair share of its rows -> pieces of such a share.

    One aggregate: a sketch with ``TRACKED_KEYS`` counters sees every key that is heavy enough to
    matter, and never a key that does not occur.  At most ``HEAVY_KEYS`` keys come back.  A table
    that Spark broadcasts by its size has no heavy keys.
    """
    spark = df.sparkSession
    if not isinstance(df.schema[key].dataType, (T.IntegralType, T.StringType)):
        return {}
    threshold = df._jdf.queryExecution().optimizedPlan().conf().autoBroadcastJoinThreshold()
    if 0 <= _planned_bytes(df.select(key)) <= threshold:
        return {}
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(HEAVY_KEYS), F.lit(TRACKED_KEYS))
    row = df.filter(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("rows"), sketch.alias("top")).first()
    tasks = max(2, min(HEAVY_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = {}
    for item, count in row["top"] or []:
        count = min(count, row["rows"])  # the sketch's upper bound
        if count >= LEAST_HEAVY and count * tasks > 2 * row["rows"]:
            found[item] = -(-count * tasks // row["rows"])
    return found


def _salted_left(left: DataFrame, side: DataFrame, left_key: str, side_key: str, pieces: dict[object, int]) -> DataFrame:
    """``left`` left-joined to ``side``, whose keys in ``pieces`` (bounded, and all of them occur in
    ``side``) are dealt over so many pieces."""
    spark = left.sparkSession
    kind = side.schema[side_key].dataType
    schema = T.StructType([T.StructField("__heavy", kind), T.StructField("__pieces", T.IntegerType())])
    heavy = F.broadcast(spark.createDataFrame(list(pieces.items()), schema))
    marked = left.join(heavy, left[left_key] == heavy["__heavy"], "left").drop("__heavy")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))
    marked = marked.withColumn("__salt", each)
    own = F.pmod(F.xxhash64(*side.columns, F.spark_partition_id()), F.coalesce("__pieces", F.lit(1))).cast("int")
    dealt = side.join(heavy, side[side_key] == heavy["__heavy"], "left").withColumn("__salt_of", own).drop("__heavy", "__pieces")
    dealt = dealt.withColumn("__hit", F.lit(True)).withColumnRenamed(side_key, "__key_of")
    joined = marked.join(dealt, (marked[left_key] == dealt["__key_of"]) & (marked["__salt"] == dealt["__salt_of"]), "left")
    kept = joined.filter(F.col("__pieces").isNull() | F.col("__hit").isNotNull())
    brought = [c for c in side.columns if c != side_key]
    key_out = [] if side_key == left_key else [F.col("__key_of").alias(side_key)]
    return kept.select(*left.columns, *key_out, *brought)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only after checking it holds at most ``max_rows`` rows.

    For a small dimension table joined on a key of few values (a nation, a department),
    where a shuffle join would put the whole large side into as many tasks as there are
    key values.  The check reads at most ``max_rows + 1`` rows; above the bound the table
    is returned as is and the planner chooses the join by size.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
