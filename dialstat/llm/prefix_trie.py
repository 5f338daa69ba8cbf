"""Prefix trie of rebuilt conversations (operator 12).

Conversation ``c`` is rebuilt from the first ``h`` turns of its base (``c - c % 100``) and its own
turns after its first ``h``.  Every distinct sequence of first turns is a node of the trie.

No rebuilt text is made.  A stored turn is known by its reference, 120 bits of the SHA-256 of role
and text, and by its row number.  A turn is also an element of a monoid, four affine maps modulo a
prime drawn from the reference; the product over a sequence is composable, so a rebuilt prefix is
the product of the base's head (computed once for each base) with the product of the conversation's
own suffix, and its fingerprint is what the product makes of a fixed state, 124 bits.  Suffix
products are scans over chunks of ``CHUNK`` turns whose totals are scanned in the same way, so a
conversation with any share of the turns is spread over many tasks.

Rows with one depth and one fingerprint are a node.  Their equality is verified through the stored
references: all members of a node have to name the same last turn and the same parent.  By induction
over depth the sequences are then equal; otherwise the fingerprints are drawn anew from another seed.

Subtrees need no rounds over the depth.  A node's smallest member represents it, and whoever
represents a node represents the nodes below it on its own path.  So every node is counted at its
representative: a conversation carries the sum of its nodes, and a subtree is the sum over the
members that a node does not represent itself, plus the rest of its representative's own path.

Ids of the members that end at a node are joined in pieces of neighbouring conversations and hashed as
a stream, never gathered.

Defined results for odd rows: null roles and texts are empty; turns go by turn number, null first,
rows of one number by their reference; rows without a conv_id belong to no conversation and are
left out; repeated rows are turns of their own; an empty table has no nodes, not even a root.
Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialstat.llm.merkle import _CRC_TABLE, crc32_sql
from dialstat.llm.sharding import number_rows
from dialstat.llm.staging import stage
from dialstat.llm.streams import with_entry

PRIME = 2147483647
MASK = (1 << 31) - 1
MAPS = 4
STATE = [1, 2, 3, 4]  # the state of an empty sequence
CHUNK = 4096
MOST_HEAD = 5  # h is below 6
SPAN = 8192  # turn rows whose conversations' ids are joined as one piece
DEPTHS = 1 << 20  # depths of a conversation that meet its totals under one key
BROADCAST_CONVS = 100_000  # 100 bytes each

M, E, S = ([f"{c}{i}" for i in range(MAPS)] for c in "mes")
KEY = ["depth", "f_hi", "f_lo"]


def _reference(role: Column, text: Column) -> list[Column]:
    """Two numbers of 60 bits that name a turn's role and text."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(2)]


def _element(i: int, seed: int) -> Column:
    """The map of a turn, ``a * 2**31 + b`` for x -> a x + b, a not 0."""
    drawn = F.xxhash64("q0", "q1", F.lit(MAPS * seed + i))
    a = F.shiftrightunsigned(drawn, 32) % (PRIME - 1) + 1
    return F.shiftleft(a, 31).bitwiseOR(drawn.bitwiseAND(F.lit(0xFFFFFFFF)) % PRIME)


def _a(m: Column) -> Column:
    return F.shiftright(m, 31)


def _b(m: Column) -> Column:
    return m.bitwiseAND(F.lit(MASK))


def _then(first: Column, second: Column) -> Column:
    """The product of two maps."""
    return F.shiftleft(_a(first) * _a(second) % PRIME, 31).bitwiseOR((_a(second) * _b(first) + _b(second)) % PRIME)


def _applied(m: Column, state: Column) -> Column:
    return (_a(m) * state + _b(m)) % PRIME


def _packed(states: list[Column], hi: str, lo: str) -> list[Column]:
    pair = lambda x, y: F.shiftleft(x, 31).bitwiseOR(y)
    return [pair(states[0], states[1]).alias(hi), pair(states[2], states[3]).alias(lo)]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the maps m of every run of equal (conv, chunk) in a sorted stream: m becomes the
    product up to the row, e the one before it."""
    one = np.array([1] * MAPS, dtype=np.uint64), np.zeros(MAPS, dtype=np.uint64)
    held_key, held = None, one
    p, low = np.uint64(PRIME), np.uint64(MASK)
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        conv, chunk = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv", "chunk"))
        packed = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in M]).astype(np.uint64)
        a, b = packed >> np.uint64(31), packed & low
        at = np.arange(n)
        new = np.ones(n, dtype=bool)
        new[1:] = (conv[1:] != conv[:-1]) | (chunk[1:] != chunk[:-1])
        place = at - np.maximum.accumulate(np.where(new, at, 0))
        if (conv[0], chunk[0]) != held_key:
            held = one
        a[:, 0], b[:, 0] = held[0] * a[:, 0] % p, (a[:, 0] * held[1] + b[:, 0]) % p
        off = 1
        while off <= place.max():
            now = at[place >= off]
            before = now - off
            made = a[:, before] * a[:, now] % p, (a[:, now] * b[:, before] + b[:, now]) % p
            a[:, now], b[:, now] = made
            off *= 2
        ea, eb = np.ones_like(a), np.zeros_like(b)
        ea[:, 1:] = np.where(new[1:], np.uint64(1), a[:, :-1])
        eb[:, 1:] = np.where(new[1:], np.uint64(0), b[:, :-1])
        ea[:, 0], eb[:, 0] = held
        held_key, held = (conv[-1], chunk[-1]), (a[:, -1].copy(), b[:, -1].copy())
        columns = {name: batch.column(name) for name in batch.schema.names}
        for i in range(MAPS):
            columns[M[i]] = pa.array((a[i] << np.uint64(31) | b[i]).astype(np.int64))
            columns[E[i]] = pa.array((ea[i] << np.uint64(31) | eb[i]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def prefix_products(rows: DataFrame, longest: int) -> DataFrame:
    """``rows`` (conv, at, m0.., others) with m as the product of the maps of a conversation up to
    ``at`` (numbered from 0) and e as the product before it; ``longest``: rows of any one at most."""
    chunked = rows.withColumn("chunk", F.expr(f"at div {CHUNK}L"))
    dealt = chunked.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "at")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema) + "".join(f", {e} long" for e in E)
    scanned = dealt.mapInArrow(_scanned, ddl)
    if longest <= CHUNK:
        return scanned.drop("chunk")
    scanned = stage(scanned, "chunk_products")
    totals = scanned.filter(F.pmod(F.col("at"), F.lit(CHUNK)) == CHUNK - 1).select("conv", F.col("chunk").alias("at"), *M)
    carry = prefix_products(totals, longest // CHUNK)
    carry = carry.select("conv", (F.col("at") + 1).alias("chunk"), *[F.col(m).alias(f"c{i}") for i, m in enumerate(M)])
    later = scanned.filter("chunk > 0").join(carry, ["conv", "chunk"])
    later = later.withColumns({c: _then(F.col(f"c{i}"), F.col(c)) for names in (M, E) for i, c in enumerate(names)})
    return scanned.filter("chunk = 0").union(later.select(*scanned.columns)).drop("chunk")


def rebuilt_prefixes(
    turns: DataFrame, seed: int, conv_col: str, turn_col: str, role_col: str, text_col: str, base_every: int
) -> DataFrame:
    """One row for every conversation and depth, 0 included: conv, depth, the fingerprints f of the
    sequence and p of the one before, the reference q and length of the last turn, its row among
    the stored turns, whether the conversation ends there, and the piece of its id."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    q0, q1 = _reference(text(role_col), text(text_col))
    narrow = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        q0.alias("q0"),
        q1.alias("q1"),
        F.char_length(text(text_col)).cast("long").alias("chars"),
    )
    stored, _ = number_rows(narrow, "conv", "turn", "q0", "q1")
    stored = stored.drop("turn")
    convs = stored.groupBy("conv").agg(F.min("row_number").alias("start"), F.count("*").alias("size"))
    convs = stage(
        convs.withColumns(
            {"h": F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_HEAD + 1), "base": F.col("conv") - F.col("conv") % base_every}
        ),
        "conversations",
    )
    if not (longest := convs.agg(F.max("size")).first()[0]):
        longest = 0

    # Heads of bases: at most five turns, and the states after each of them.
    bases = convs.filter("conv = base").select("conv", "start", "size")
    first = with_entry(stored, bases, "conv", BROADCAST_CONVS).filter(F.col("row_number") < F.col("start") + MOST_HEAD)
    turn = F.struct("row_number", "q0", "q1", "chars", *[_element(i, seed).alias(m) for i, m in enumerate(M)])
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))
    start = F.struct(*[F.lit(x).cast("long").alias(s) for x, s in zip(STATE, S)])
    step = lambda s, t: F.struct(*[_applied(t[m], s[x]).alias(x) for m, x in zip(M, S)])
    after = lambda d: F.aggregate(F.slice("head", F.lit(1), d), start, step)
    heads = heads.withColumn("states", F.transform(F.sequence(F.lit(0), F.size("head")), after))
    known = convs.join(heads, "base", "left").withColumns(
        {"head": F.coalesce("head", F.expr("array()").cast(heads.schema["head"].dataType)), "states": F.coalesce("states", F.array(start))}
    )
    known = known.withColumn("k", F.least(F.col("h").cast("int"), F.size("head")))
    own_size = F.greatest(F.col("size") - F.col("h"), F.lit(0).cast("long"))
    known = stage(
        known.select(
            "conv", "start", "size", "h", "k", (F.col("k") + own_size).alias("ends_at"), F.expr(f"start div {SPAN}L").alias("piece"),
            F.slice("head", F.lit(1), F.col("k")).alias("head"), F.slice("states", F.lit(1), F.col("k") + 1).alias("states"),
        ),
        "known",
    )

    ends = (F.col("depth") == F.col("ends_at")).alias("ends")
    shared = ["conv", "depth", ends, "piece"]
    states = lambda s: [s[x] for x in S]
    none = F.lit(None).cast("long")
    # Depth 0 and the head: states of the base, as they are.
    depths = known.select("conv", "ends_at", "piece", "head", F.posexplode("states").alias("at", "state"), "states").withColumn(
        "depth", F.col("at").cast("long")
    )
    last, parent = F.get("head", F.col("at") - 1), F.get("states", F.col("at") - 1)
    heading = depths.select(
        *shared,
        *_packed(states(F.col("state")), "f_hi", "f_lo"),
        *_packed(states(parent), "p_hi", "p_lo"),
        *[F.coalesce(last[c], F.lit(0)).alias(c) for c in ("q0", "q1", "chars")],
        F.coalesce(last["row_number"], none).alias("turn_row"),
    )
    # The own suffix: its products, applied to the state after the head.
    entries = known.select("conv", "start", "size", "h", "k", "ends_at", "piece", F.element_at("states", -1).alias("after"))
    entries = entries.filter("size > h")
    own = with_entry(stored, entries, "conv", BROADCAST_CONVS).withColumn("at", F.col("row_number") - F.col("start") - F.col("h"))
    own = own.filter("at >= 0").select(
        "conv", "at", "q0", "q1", "chars", F.col("row_number").alias("turn_row"), "ends_at", "piece",
        (F.col("k") + F.col("at") + 1).alias("depth"), *[F.col("after")[s].alias(s) for s in S],
        *[_element(i, seed).alias(m) for i, m in enumerate(M)],
    )
    products = prefix_products(own, longest)
    result = lambda names: [_applied(F.col(m), F.col(s)) for m, s in zip(names, S)]
    suffix = products.select(
        *shared, *_packed(result(M), "f_hi", "f_lo"), *_packed(result(E), "p_hi", "p_lo"), "q0", "q1", "chars", "turn_row"
    )
    return stage(heading.union(suffix), "prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame:
    """One row for every (depth, fingerprint): smallest member, members, ends, length of the last turn;
    ``sound`` if all members agree in the last turn and the parent."""
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("q0", "q1", "chars", "p_hi", "p_lo")]
    return stage(
        prefixes.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.count_if("ends").alias("n_ends"),
            F.max("chars").alias("chars"),
            F.max("p_hi").alias("p_hi"),
            F.max("p_lo").alias("p_lo"),
            functools.reduce(lambda a, b: a & b, same).alias("sound"),
        ),
        "nodes",
    )


def _own_paths(nodes: DataFrame, deepest: int) -> DataFrame:
    """For every node with several members: the nodes that its representative represents from here
    on, as ``saved`` and ``leaves``; and a row at no depth for the nodes it has alone."""
    weight = (F.col("n_convs") - 1) * F.col("chars")
    alone = nodes.filter("n_convs = 1").select("conv_id").distinct()
    rows = (
        nodes.filter("n_convs > 1")
        .select("conv_id", *KEY, weight.alias("w"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
        .union(alone.selectExpr("conv_id", f"{deepest + 1}L", "NULL", "NULL", "0L", "1L"))
        .withColumn("chunk", F.expr(f"depth div {CHUNK}L"))
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.desc("depth"))
    rows = rows.withColumns({"saved": F.sum("w").over(inside), "leaves": F.sum("leaf").over(inside)})
    if deepest + 1 >= CHUNK:
        totals = rows.groupBy("conv_id", "chunk").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf"))
        below = Window.partitionBy("conv_id").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
        deeper = totals.select(
            "conv_id", "chunk", F.coalesce(F.sum("w").over(below), F.lit(0)).alias("dw"), F.coalesce(F.sum("leaf").over(below), F.lit(0)).alias("dl")
        )
        rows = rows.join(deeper, ["conv_id", "chunk"]).withColumns({"saved": F.col("saved") + F.col("dw"), "leaves": F.col("leaves") + F.col("dl")})
    return rows.select("conv_id", *KEY, "w", "leaf", "saved", "leaves")


_ENDS_DDL = "depth long, f_hi long, f_lo long, ends_sha256 string"


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, f_hi, f_lo, piece, ids) in order -> the digest of each node's joined ids."""
    key, state = None, None
    for batch in batches:
        out = []
        for *own, _, ids in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            if own != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], names=[*KEY, "ends_sha256"])


def _ends(prefixes: DataFrame) -> DataFrame:
    pieces = prefixes.filter("ends").groupBy(*KEY, "piece").agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    joined = pieces.select(*KEY, "piece", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "piece").mapInArrow(_hashed_ends, _ENDS_DDL)


def prefix_trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    base_every: int = 100,
) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves,
    saved_tokens, ends_sha256; a node is named by conv_id and depth.
    """
    for seed in itertools.count():
        prefixes = rebuilt_prefixes(turns, seed, conv_col, turn_col, role_col, text_col, base_every)
        nodes = _nodes(prefixes)
        if nodes.filter(~F.col("sound")).isEmpty():
            break
    summary = nodes.agg(F.max("depth"), F.min("conv_id")).first()
    deepest, lowest = summary[0] or 0, summary[1]

    paths = stage(_own_paths(nodes, deepest), "paths")
    # What a conversation adds to the nodes above the first that it represents.
    first = nodes.groupBy("conv_id").agg(F.min("depth").alias("first_depth"))
    totals = paths.groupBy("conv_id").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf"))
    totals = first.join(totals, "conv_id").filter("first_depth > 0 AND (w > 0 OR leaf > 0)")
    totals = totals.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(first_depth - 1) div {DEPTHS}L"))))
    of_others = (
        prefixes.select("conv", *KEY, F.expr(f"depth div {DEPTHS}L").alias("part"))
        .join(totals.withColumnRenamed("conv_id", "conv"), ["conv", "part"])
        .filter("depth < first_depth")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    own = ["conv_id", "n_convs", "n_ends", "p_hi", "p_lo"]
    parts = nodes.select(
        *KEY, *own, zero.alias("saved"), F.when(F.col("n_convs") == 1, 1).otherwise(0).cast("long").alias("leaves"), zero.alias("children")
    )
    nothing = [none.alias(c) for c in own]
    parts = parts.union(paths.filter("f_hi IS NOT NULL").select(*KEY, *nothing, "saved", "leaves", zero))
    parts = parts.union(of_others.select(*KEY, *nothing, "w", "leaf", zero))
    parts = parts.union(
        nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p_hi"), F.col("p_lo"), *nothing, zero, zero, F.lit(1).cast("long"))
    )
    counted = parts.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in own],
        F.sum("saved").alias("saved_tokens"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("children").alias("n_children"),
    )
    counted = counted.join(_ends(prefixes), KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))

    # The parent's representative: the lowest of all for the first turns, else by the parent's fingerprint.
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f_hi").alias("p_hi"), F.col("f_lo").alias("p_lo"), F.col("conv_id").alias("parent_conv_id")
    )
    top = counted.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(lowest).cast("long")))
    deep = counted.filter("depth > 1").join(parents.filter("depth > 1"), ["depth", "p_hi", "p_lo"])
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return top.select(*names).union(deep.select(*names))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")).drop("n_ends")


OP12_SQL = f"""
WITH t AS (SELECT {_CRC_TABLE} AS crc),
turns AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(part)) AS pos, part, chars
  FROM (SELECT conv_id, turn, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS part,
               length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL)),
convs AS MATERIALIZED (SELECT DISTINCT c, c - c % 100 AS base, {crc32_sql("c::VARCHAR")} % 6 AS h FROM turns, t),
again AS (
  SELECT v.c, 0 AS own, pos, part, chars FROM convs v JOIN turns b ON b.c = v.base AND b.pos <= v.h
  UNION ALL
  SELECT v.c, 1, pos, part, chars FROM convs v JOIN turns o ON o.c = v.c AND o.pos > v.h),
d AS (SELECT c, row_number() OVER w AS depth, chars,
             string_agg(octet_length(encode(part)) || ';' || part, '') OVER w AS key
      FROM again WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
p AS MATERIALIZED (
  SELECT c, depth, chars, sha256(key) AS key, max(depth) OVER (PARTITION BY c) AS len, lag(sha256(key), 1, '') OVER (PARTITION BY c ORDER BY depth) AS up
  FROM (SELECT * FROM d UNION ALL SELECT c, 0, 0, '' FROM convs)),
node AS MATERIALIZED (
  SELECT depth, key, min(c) AS conv_id, any_value(up) AS up, count(*) AS n_convs, any_value(chars) AS chars,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = len), '') AS ends FROM p GROUP BY depth, key),
tree AS MATERIALIZED (
  SELECT n.*, q.conv_id AS parent, (SELECT count(*) FROM node k WHERE k.depth = n.depth + 1 AND k.up = n.key) AS kids
  FROM node n LEFT JOIN node q ON q.depth = n.depth - 1 AND q.key = n.up),
-- every node and the nodes below it, along the path of the lower one's smallest member
below AS (
  SELECT a.depth, a.key, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (WHERE n.kids = 0) AS leaves
  FROM tree n JOIN p a ON a.c = n.conv_id AND a.depth <= n.depth GROUP BY a.depth, a.key)
SELECT conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs, kids::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM tree JOIN below USING (depth, key)
"""
