"""Reproducible shuffle into shards by a Feistel permutation (operator 2).

Rows are numbered 0 to n - 1 in order of their id.  A Feistel network over pairs (left, right)
below ``side = ceil(sqrt(n))`` permutes the numbers below ``side * side``; a number that leaves
the range 0 to n - 1 is permuted again until it is back (cycle walking), which permutes exactly
the row numbers.  The permuted number gives shard (modulo) and slot (quotient), so the counts of
shards are at most one apart (law ``rows``) and slots have no gap.  :func:`locate` and
:func:`row_at` compute the same on the driver for a single row, in either direction, without
data.

Numbering takes one range shuffle of narrow rows (id, size, crc32; never the text): the row's
position inside its sorted partition plus the rows of the partitions before it.  The ids, sizes
and positions are a written table, since ranges are drawn anew in every run of the plan.

Defined results for odd rows: a null text has size 1 and the crc32 of no bytes, 0; null ids come
first; rows with equal ids are ordered by crc32 and size, equal rows in any order (their results
are a permutation of each other); an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.staging import stage

ROUNDS = 6
PRIME = 2147483647
WALK = 64  # steps before a row that is still outside would raise an error (never seen: < 1e-70)
_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, position below


def round_keys(seed: int) -> list[list[int]]:
    """[a, b, c] of every round, below the prime."""
    state, out = seed & (2**64 - 1), []
    for _ in range(ROUNDS):
        key = []
        for _ in range(3):
            state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
            z = (state ^ (state >> 30)) * 0xBF58476D1CE4E5B9 & (2**64 - 1)
            z = (z ^ (z >> 27)) * 0x94D049BB133111EB & (2**64 - 1)
            key.append((z ^ (z >> 31)) % (PRIME - 1) + 1)
        out.append(key)
    return out


def _round(right, key, side: int):
    """The round function on numbers or columns: a quadratic modulo a prime, below 2**63."""
    mixed = (right * key[0] + key[1]) % PRIME
    return (mixed * mixed + key[2]) % PRIME % side


def side_of(rows: int) -> int:
    return math.isqrt(max(rows - 1, 0)) + 1


def locate(row: int, rows: int, shards: int, seed: int) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    side, keys, value = side_of(rows), round_keys(seed), row
    while True:
        left, right = divmod(value, side)
        for key in keys:
            left, right = right, (left + _round(right, key, side)) % side
        value = left * side + right
        if value < rows:
            return value % shards, value // shards


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """The row number that lies in a slot of a shard."""
    side, keys, value = side_of(rows), round_keys(seed), slot * shards + shard
    while True:
        left, right = divmod(value, side)
        for key in reversed(keys):
            left, right = (right - _round(left, key, side)) % side, left
        value = left * side + right
        if value < rows:
            return value


def _permuted(value: Column, side: int, keys: list[list[int]]) -> Column:
    long = lambda x: F.lit(x).cast("long")
    rounds = F.array(*[F.array(*[long(x) for x in key]) for key in keys])
    start = F.struct(F.call_function("div", value, long(side)).alias("left"), (value % side).alias("right"))
    return F.aggregate(
        rounds,
        start,
        lambda s, key: F.struct(
            s["right"].alias("left"),
            ((s["left"] + _round(s["right"], [key[0], key[1], key[2]], side)) % side).alias("right"),
        ),
        lambda s: s["left"] * side + s["right"],
    )


def feistel_numbers(row: Column, rows: int, seed: int) -> Column:
    """The permuted number of a row number column, as one JVM expression."""
    if rows <= 1:
        return row
    side, keys = side_of(rows), round_keys(seed)
    first = _permuted(row, side, keys)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda v, _: F.when(v < rows, v).otherwise(_permuted(v, side, keys)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walking did not return")))


def number_rows(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """(``df`` as a written table with a ``row_number`` from 0 in the given order, row count).

    Only for narrow tables: every column is shuffled and written once.
    """
    keys = [*order, "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _INDEX_BITS)
    # one row per shuffle partition
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).selectExpr(
        "_part", "sum(_rows) OVER (ORDER BY _part) - _rows AS _before", "_rows"
    )
    parts = stage(parts, "partition_sizes")
    rows = parts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    inside = F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(parts), "_part")
    return numbered.withColumn("row_number", F.col("_before") + inside).drop("_part", "_before", "_rows", "_at"), rows


def shard_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, seed: int = 20
) -> DataFrame:
    """Id, size, crc32, row number, shard and slot of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, rows = number_rows(narrow, "doc_id", "text_crc32", "size")
    placed = numbered.withColumn("permuted", feistel_numbers(F.col("row_number"), rows, seed))
    return placed.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        "row_number",
        (F.col("permuted") % shards).cast("int").alias("shard"),
        F.call_function("div", "permuted", F.lit(shards).cast("long")).alias("slot"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of the shards 0 to 7, counts at most one apart."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return shard_rows(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_KEYS = ", ".join("[" + ", ".join(f"{x}::BIGINT" for x in key) + "]" for key in round_keys(20))
_F = f"((((s[2] * k[1] + k[2]) % {PRIME}) * ((s[2] * k[1] + k[2]) % {PRIME}) + k[3]) % {PRIME}) % side"


def _permuted_sql(value: str) -> str:
    reduced = f"list_reduce([{_KEYS}], lambda s, k: [s[2], (s[1] + {_F}) % side, 0], [{value} // side, {value} % side, 0])"
    return f"list_sum(list_transform([{reduced}], lambda q: q[1] * side + q[2]))::BIGINT"


OP2_SQL = f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents),
k AS (
  SELECT doc_id, CAST(octet_length(b) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_concat([4294967295], bytes), lambda c, x: xor(c >> 8, crc[1 + (xor(c, x) & 255)])), 4294967295) AS text_crc32
  FROM d, t),
n AS (SELECT count(*) AS rows, CAST(floor(sqrt(greatest(count(*) - 1, 0))) AS BIGINT) + 1 AS side FROM k),
r AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row FROM k),
walk AS (
  SELECT doc_id, size, text_crc32, rows, side, CAST({_permuted_sql('row')} AS BIGINT) AS v FROM r, n
  UNION ALL
  SELECT doc_id, size, text_crc32, rows, side, CAST({_permuted_sql('v')} AS BIGINT) AS v FROM walk WHERE v >= rows)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(v % 8 AS INTEGER) AS shard, CAST(v // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM walk WHERE v < rows
"""
