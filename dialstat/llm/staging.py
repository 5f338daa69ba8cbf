"""Written tables in the shared folder, used to cut lineage.

A staged table is Parquet below the session's ``spark.checkpoint.dir``: every executor can read
it, so a lost executor costs a re-read and never a re-run of what came before.  Staged tables
live as long as the DataFrames built on them may be read: until :func:`release` or the end of
Spark's process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.session import release_scratch, shared_scratch_path


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return shared_scratch_path(spark, name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every staged table of this session; returns how many there were."""
    return release_scratch(spark)


def broadcast_within(df: DataFrame, bound: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows; else as it is."""
    return F.broadcast(df) if rows_within(df, bound) else df


def rows_within(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows (for a staged table its files' footers tell)."""
    return df.count() <= bound
