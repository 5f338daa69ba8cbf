"""Connected components of a link table, as DataFrame rounds.

Alternating large-star and small-star rounds: every node's neighbours are re-linked to the
smallest of them, first the larger ones, then the smaller ones, until nothing changes.  A round
is a ``min`` per node (partial sums map-side, so a hub costs one row per task) and a join back
that AQE can split; links never reach the driver, and each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.staging import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links(u, v) with u > v -> links to the smallest neighbour.

    Large star: every node links its larger neighbours (and not itself) to its minimum.
    Small star: every node links its smaller neighbours and itself to its minimum.
    """
    if large:
        around = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links.select("u", "v")
    lowest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(lowest, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            lowest.select("u", F.col("m").alias("v"))
        )
    return out.filter(F.col("u") != F.col("v")).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """links(a, b) of any orderable type -> (node, label), label the smallest node reachable.

    Only nodes that have a link to another node appear.  Self links and nulls are ignored; an
    empty table gives an empty result.
    """
    current = stage(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    seen = _digest(current)
    while seen[0]:
        current = stage(_star(_star(current, large=True), large=False), "stars")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
