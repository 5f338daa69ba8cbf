"""Reading input tables.

Inputs are read with *declared* column types, wide ones: ids and counts as ``bigint``, amounts as
``double``, and quantities as ``number``, which is ``bigint`` if every value is a whole number and
``double`` otherwise.  Columns are matched by name, without regard to case, as Spark does; other
columns of the file are skipped.

Nothing is lost in reading: values that do not fit their declared type are counted, and any such
value raises :class:`InputError` with the counts.  A CSV table is read once: its wanted columns are
staged as Parquet in the shared scratch folder, and the counts are observed while they are
written; what is built on the table then reads the staged columns.  A Parquet table is counted by
one aggregate over the columns whose types differ from the declared ones; where none does, nothing
is read.  The header of
every CSV file of a folder is compared with that of the first: a file with other columns or
another order of columns fails the read instead of being read by position.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.session import file_paths, shared_scratch_path

# Declared types of the three report inputs (column -> Spark SQL type or ``number``).
CALLS_COLUMNS = {"id": "bigint", "area": "string", "calls_made": "bigint", "calls_successful": "bigint"}
PEOPLE_COLUMNS = {"id": "bigint", "name": "string", "address": "string", "sales_amount": "double"}
SALES_COLUMNS = {"caller_id": "bigint", "country": "string", "product_sold": "string", "quantity": "number"}

NUMBER = "number"


class InputError(ValueError):
    """Input values that do not fit the declared types."""


def format_of(spark: SparkSession, path: str, fmt: str | None = None) -> str:
    """``csv`` or ``parquet``: as given, by the path's ending, or by all files below it; a folder with
    both kinds raises."""
    if fmt:
        return fmt
    if path.rstrip("/").lower().endswith(".parquet"):
        return "parquet"
    kinds = {"parquet" if file.endswith(".parquet") else "csv" for file in file_paths(spark, path)}
    if len(kinds) > 1:
        raise ValueError(f"{path}: holds parquet files and others; name the format")
    return kinds.pop() if kinds else "csv"


def _resolve(columns: Mapping[str, str], found: list[str], path: str) -> dict[str, str]:
    """Wanted column -> the table's own spelling of it."""
    names: dict[str, list[str]] = {}
    for c in found:
        names.setdefault(c.lower(), []).append(c)
    missing = [c for c in columns if c.lower() not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}; found {found}")
    doubled = [c for c in columns if len(names[c.lower()]) > 1]
    if doubled:
        raise ValueError(f"{path}: columns {doubled} occur more than once; found {found}")
    return {c: names[c.lower()][0] for c in columns}


def _lost(source: Column, kind: T.DataType, target: str) -> Column:
    """Whether a value of ``kind`` is lost or changed by reading it as ``target``."""
    cast = source.try_cast(target)
    changed = F.lit(False)
    if isinstance(kind, T.NumericType) and target in ("tinyint", "smallint", "int", "bigint"):
        changed = cast.cast(kind) != source  # a fraction, or wrapped around
    return source.isNotNull() & (cast.isNull() | changed)


def _as_whole(c: str) -> Column:
    """A number or its text as ``bigint``, null unless it is whole (``4.0E9`` is)."""
    number = F.col(c).try_cast("double")
    exact = (F.abs(number) < F.lit(2.0**53)) & (number == F.floor(number))
    return F.coalesce(F.when(exact, number.try_cast("bigint")), F.col(c).cast("string").try_cast("bigint"))


def _typed(
    df: DataFrame, columns: Mapping[str, str], path: str, staged: bool, scratch: list[str] | None
) -> DataFrame:
    """``df``'s columns (already named as wanted) as the declared types; raises on loss.

    :param staged: write ``df`` once, count while it is written, and go on with the written table
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    whole = ("tinyint", "smallint", "int", "bigint")
    counts = {}
    for c, target in columns.items():
        same = kinds[c].simpleString() == target or (target == NUMBER and kinds[c].simpleString() in whole)
        if not same:
            counts[f"{c} as {target}"] = F.count_if(_lost(F.col(c), kinds[c], "double" if target == NUMBER else target))
            if target == NUMBER:
                counts[f"{c} not whole"] = F.count_if(_as_whole(c).isNull() & F.col(c).isNotNull())
    found: Mapping[str, int] = {}
    if counts and staged:
        observation = Observation()
        target_path = shared_scratch_path(df.sparkSession, "input")
        if scratch is not None:
            scratch.append(target_path)
        df.observe(observation, *[e.alias(n) for n, e in counts.items()]).write.parquet(target_path)
        found = observation.get
        df = df.sparkSession.read.schema(df.schema).parquet(target_path)
    elif counts:
        found = df.agg(*[e.alias(n) for n, e in counts.items()]).first().asDict()
    lost = {n: k for n, k in found.items() if k and not n.endswith(" not whole")}
    if lost:
        raise InputError(f"{path}: values that do not fit: " + ", ".join(f"{k} of {n}" for n, k in lost.items()))
    final = {
        c: ("double" if found.get(f"{c} not whole") else "bigint") if target == NUMBER else target
        for c, target in columns.items()
    }
    return df.select(
        *[
            (_as_whole(c) if columns[c] == NUMBER and t == "bigint" else F.col(c).cast(t)).alias(c)
            for c, t in final.items()
        ]
    )


def read_table(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] | None = None,
    fmt: str | None = None,
    infer: bool = False,
    scratch: list[str] | None = None,
) -> DataFrame:
    """Read one input table.

    :param path: file or folder; see ``format_of``
    :param columns: wanted columns and their types; other columns in the file are skipped
    :param fmt: force ``csv`` or ``parquet``
    :param infer: CSV only: infer types from the data when no columns are given
    :param scratch: gets the path of a staged copy, which the caller may delete once it has read the
        table (``release_scratch`` deletes it otherwise)
    :return: DataFrame with the wanted columns, in the given order
    """
    kind = format_of(spark, path, fmt)
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "csv":
        reader = spark.read.option("header", True)
        if infer and columns is None:
            reader = reader.option("inferSchema", True)
        df = reader.csv(path)
        if columns is not None:
            # Read again as text columns under the first file's header, checked in every file.
            names = T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
            df = spark.read.option("header", True).option("enforceSchema", False).schema(names).csv(path)
    else:
        raise ValueError(f"unsupported format {kind!r}")
    if columns is None:
        return df
    spelled = _resolve(columns, df.columns, path)
    return _typed(df.select(*[F.col(f"`{s}`").alias(c) for c, s in spelled.items()]), columns, path, kind == "csv", scratch)
