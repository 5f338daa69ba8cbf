"""Merkle manifest of a dataset with octopus multiproofs (operator 11).

Every row is a leaf, the SHA-256 of its fields.  The leaves of a group (a source) are ordered by
id; three neighbours at a time become the digest of their joined digests until one node, the
group's subroot, is left; the subroots, ordered by group, make a tree of their own, whose last
node is the root of the dataset.

Nothing but narrow rows (group, id, digests) is shuffled; texts are hashed where they are read.  A
range shuffle numbers the leaves, so a leaf's place in its group is its row number less the
group's first.  Trees are built by blocks of ``3 ** LEVELS`` neighbours: one pass folds every block
``LEVELS`` levels up, the next pass does so with the nodes that are left.  So a group with any
share of the rows is spread over many tasks, and the passes number log(rows) / log(2187).

Proofs are octopus multiproofs: for the wanted leaves that it holds, a block computes the smallest
set of coordinates of nodes that none of its leaves gives (:func:`missing`), all blocks fetch
theirs with one join, and each block derives the nodes its leaves share and expands the single
proofs from them.  A proof is the siblings of a leaf, level by level up to the root, left to right.
:func:`fold` is the check of one proof, without data.

Both the passes and the proofs read their blocks as a sorted stream, one block in memory at a time.

Defined results for odd rows: a null field is hashed as ``-``; the null group is one of its own and
comes first; null ids come first in a group, and rows with equal ids are ordered by leaf (equal
rows in any order: their places differ, their results are a permutation of each other); an empty
table has no rows and no root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dialstat.llm.sharding import number_rows
from dialstat.llm.staging import broadcast_within, stage

ARITY = 3
LEVELS = 7  # levels that one pass folds: blocks of 2,187 neighbours
BLOCK = ARITY**LEVELS
TOP = -1  # the tree of subroots; the groups' trees are numbered from 0
SEGMENT = 1 << 20  # row numbers that meet their group's entry under one key
BROADCAST_BYTES = 8 << 20
BROADCAST_REQUESTS = 100_000  # 40 bytes each
_OUT_ROWS = 4096

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of the fields' values, each with its length in UTF-8 bytes, or ``-`` for null."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def missing(known: Sequence[int], size: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the nodes that a proof of all ``known`` leaves of a tree of ``size`` leaves
    needs besides them: siblings on their ways up that no known leaf gives."""
    level, known = 0, sorted(set(known))
    while size > 1:
        have, parents = set(known), sorted({i // ARITY for i in known})
        for p in parents:
            for i in range(ARITY * p, min(ARITY * p + ARITY, size)):
                if i not in have:
                    yield level, i
        known, size, level = parents, -(-size // ARITY), level + 1


def path_of(index: int, size: int) -> list[tuple[int, int]]:
    """(place in its run, length of the run) of a leaf and of the nodes above it, but the last."""
    out = []
    while size > 1:
        first = index - index % ARITY
        out.append((index - first, min(ARITY, size - first)))
        index, size = index // ARITY, -(-size // ARITY)
    return out


def fold(leaf: str, path: Sequence[tuple[int, int]], proof: Sequence[str]) -> str:
    """The root that a leaf and the siblings of its proof give."""
    digest, at = leaf, 0
    for place, length in path:
        siblings = proof[at : at + length - 1]
        at += length - 1
        digest = digest_of("".join([*siblings[:place], digest, *siblings[place:]]))
    return digest


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (id, tree, index, leaf, claim), ``nodes`` (tree, level, index, digest, size) from
    level 0 of the subroots' tree and level 1 of the groups', ``groups`` (group, tree, start, size),
    and the root."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    n_groups: int
    root: str | None


def _blocks(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of the runs with equal keys of a sorted stream; ``key`` are its first columns."""
    held_key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            own = row[: len(key)]
            if own != held_key:
                if held:
                    yield held_key, held
                held_key, held = own, []
            held.append(row[len(key) :])
    if held:
        yield held_key, held


_NODE = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])
_NODE_DDL = "tree long, level int, index long, digest string, size long"


def _written(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, block, index, digest, size, level) -> the nodes up to LEVELS above every block."""

    def nodes():
        for (tree, block), rows in _blocks(batches, "tree", "block"):
            digests, (_, _, size, level), first = [r[1] for r in rows], rows[0], block * BLOCK
            for _ in range(LEVELS):
                if size <= 1:
                    break
                digests = [digest_of("".join(digests[i : i + ARITY])) for i in range(0, len(digests), ARITY)]
                size, level, first = -(-size // ARITY), level + 1, first // ARITY
                for i, digest in enumerate(digests):
                    yield tree, level, first + i, digest, size

    return _written(nodes(), _NODE)


def _in_blocks(rows: DataFrame, *order: str) -> DataFrame:
    """Sorted streams of whole blocks."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def _grown(start: DataFrame) -> DataFrame:
    """All nodes above ``start`` (tree, level, index, digest, size), a level of whole trees."""
    found, current = None, start.filter("size > 1")
    while True:
        blocks = current.select("tree", F.expr(f"index div {BLOCK}L").alias("block"), "index", "digest", "size", "level")
        made = stage(_in_blocks(blocks, "index").mapInArrow(_folded, _NODE_DDL), "merkle_nodes")
        found = made if found is None else found.union(made)
        base = made.agg(F.max("level")).first()[0]
        # only a block that ends LEVELS up can have a neighbour there
        current = made.filter((F.col("level") == (base or 0)) & (F.col("size") > 1))
        if base is None or current.isEmpty():
            return found


def build_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
    claim: Column | None = None,
) -> Manifest:
    """Trees over all rows of ``docs``.

    :param claim: another leaf digest of the row, carried along to be checked (null: its own)
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    narrow = docs.select(
        F.col(group_col).alias("grp"),
        F.col(id_col).alias("id"),
        leaf.alias("leaf"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
    )
    numbered, _ = number_rows(narrow, "grp", "id", "leaf")
    numbered = stage(numbered, "merkle_leaves")
    groups = numbered.groupBy("grp").agg(F.min("row_number").alias("start"), F.count("*").alias("size"))
    groups, n_groups = number_rows(groups, "grp")
    groups = stage(groups.withColumnRenamed("row_number", "tree"), "merkle_groups")

    # A group's entry meets its rows segment by segment, so a hot group is no hot key.
    last = F.expr(f"(start + size - 1) div {SEGMENT}L")
    entries = groups.select(
        F.col("grp").alias("of"), "tree", "start", "size", F.explode(F.sequence(F.expr(f"start div {SEGMENT}L"), last)).alias("segment")
    )
    entry_bytes = entries.agg(F.sum(F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 40)).first()[0] or 0
    if entry_bytes <= BROADCAST_BYTES:
        entries = F.broadcast(entries)
    at = F.expr(f"row_number div {SEGMENT}L")
    leaves = numbered.join(entries, F.col("grp").eqNullSafe(F.col("of")) & (at == F.col("segment"))).select(
        "id", "tree", (F.col("row_number") - F.col("start")).alias("index"), "leaf", "claim", "size"
    )
    leaves = stage(leaves, "merkle_placed")

    lowest = leaves.select("tree", F.lit(0).alias("level"), "index", F.col("leaf").alias("digest"), "size")
    nodes = _grown(lowest)
    last_nodes = nodes.union(lowest).filter("size = 1")
    subroots = last_nodes.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("index"), "digest", F.lit(n_groups).cast("long").alias("size")
    )
    subroots = stage(subroots, "merkle_subroots")
    top = _grown(subroots)
    root = top.union(subroots).filter("size = 1").select("digest").first()
    return Manifest(leaves, nodes.union(subroots).union(top), groups, n_groups, root["digest"] if root else None)


_REQUEST = pa.schema(
    [("tree", pa.int64()), ("block", pa.int64()), ("node_tree", pa.int64()), ("level", pa.int32()), ("index", pa.int64())]
)
_REQUEST_DDL = "tree long, block long, node_tree long, level int, index long"


def _requests(n_groups: int):
    """(tree, block, index, size) -> the coordinates that every block of wanted leaves has to fetch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def coordinates():
            for (tree, block), rows in _blocks(batches, "tree", "block"):
                for level, index in missing([r[0] for r in rows], rows[0][1]):
                    yield tree, block, tree, level, index
                for level, index in missing([tree], n_groups):
                    yield tree, block, TOP, level, index

        return _written(coordinates(), _REQUEST)

    return run


class _Shared:
    """The nodes of one block's multiproof: fetched ones and those that its leaves give."""

    def __init__(self, tree: int, size: int, n_groups: int, fetched: dict, leaves: dict[int, str]):
        self.tops: list[str] = []  # the last node of the group's tree, then of the top tree
        self.suffixes: dict = {}  # siblings from a node upwards, joined
        self.levels = []  # (tree, level, size) from the leaves to the root
        self.nodes = dict(fetched)
        known = leaves
        for own, count, wanted in ((tree, size, None), (TOP, n_groups, tree)):
            if wanted is not None:
                known = {wanted: self.tops[0]}
            level = 0
            while True:
                for i, digest in known.items():
                    self.nodes[own, level, i] = digest
                if count <= 1:
                    break
                self.levels.append((own, level, count))
                parents = {i // ARITY for i in known}
                known = {p: digest_of("".join(self.nodes[own, level, i] for i in self.run(p, count))) for p in parents}
                count, level = -(-count // ARITY), level + 1
            self.tops.append(next(iter(known.values())))
        self.in_tree = sum(1 for own, *_ in self.levels if own != TOP)
        self.tree = tree

    @staticmethod
    def run(parent: int, count: int) -> range:
        return range(ARITY * parent, min(ARITY * parent + ARITY, count))

    def siblings(self, step: int, index: int) -> list[str]:
        """The siblings of a node, and those of its ancestors up to the root."""
        key = (step, index)
        if key not in self.suffixes:
            if step == self.in_tree:
                index = self.tree
            if step == len(self.levels):
                return []
            own, level, count = self.levels[step]
            here = [self.nodes[own, level, i] for i in self.run(index // ARITY, count) if i != index]
            self.suffixes[key] = here + self.siblings(step + 1, index // ARITY)
        return self.suffixes[key]


def _expanded(n_groups: int, keep_proof: bool, id_type: pa.DataType):
    schema = pa.schema(
        [
            ("id", id_type),
            ("tree", pa.int64()),
            ("index", pa.int64()),
            ("leaf", pa.string()),
            ("subroot", pa.string()),
            ("derived_root", pa.string()),
            ("proof_sha256", pa.string()),
            ("folded_root", pa.string()),
        ]
        + ([("proof", pa.list_(pa.string()))] if keep_proof else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs():
            # fetched nodes come first in a block
            for (tree, _), rows in _blocks(batches, "tree", "block"):
                fetched = {(r[1], r[2], r[3]): r[4] for r in rows if r[0] == 0}
                wanted = [r[3:] for r in rows if r[0] == 1]
                size = wanted[0][2]
                shared = _Shared(tree, size, n_groups, fetched, {r[0]: r[1] for r in wanted})
                top_path = path_of(tree, n_groups)
                for index, leaf, _, row_id, claim in wanted:
                    proof = shared.siblings(0, index)
                    folded = shared.tops[1]
                    if claim is not None and claim != leaf:
                        folded = fold(claim, path_of(index, size) + top_path, proof)
                    row = (row_id, tree, index, leaf, shared.tops[0], shared.tops[1], digest_of("".join(proof)), folded)
                    yield row + ((proof,) if keep_proof else ())

        return _written(proofs(), schema)

    return run


def prove(manifest: Manifest, wanted: DataFrame | None = None, keep_proof: bool = False) -> DataFrame:
    """Proofs of the ``wanted`` rows of ``manifest.leaves`` (all of them by default).

    Columns: id, tree, index, leaf, subroot, derived_root (of the block's multiproof), proof_sha256
    (of the joined siblings), folded_root (of the claim, or of the leaf) and, if kept, proof.
    """
    leaves = manifest.leaves if wanted is None else wanted
    leaves = leaves.withColumn("block", F.expr(f"index div {BLOCK}L"))
    asked = _in_blocks(leaves.select("tree", "block", "index", "size"), "index")
    asked = stage(asked.mapInArrow(_requests(manifest.n_groups), _REQUEST_DDL), "merkle_requests")
    store = manifest.nodes.select("tree", "level", "index", "digest").union(
        manifest.leaves.select("tree", F.lit(0).alias("level"), "index", F.col("leaf").alias("digest"))
    )
    store = store.withColumnsRenamed({"tree": "node_tree"})
    fetched = broadcast_within(asked, BROADCAST_REQUESTS).join(store, ["node_tree", "level", "index"])
    id_type = leaves.schema["id"].dataType
    none = F.lit(None)
    rows = fetched.select(
        "tree", "block", F.lit(0).alias("kind"), "node_tree", "level", "index", "digest",
        none.cast("long").alias("size"), none.cast(id_type).alias("id"), none.cast("string").alias("claim"),
    ).union(
        leaves.select(
            "tree", "block", F.lit(1).alias("kind"), F.col("tree").alias("node_tree"), F.lit(0).alias("level"), "index",
            F.col("leaf").alias("digest"), "size", "id", "claim",
        )
    )
    ddl = (
        f"id {id_type.simpleString()}, tree long, index long, leaf string, subroot string, derived_root string, "
        f"proof_sha256 string, folded_root string" + (", proof array<string>" if keep_proof else "")
    )
    run = _expanded(manifest.n_groups, keep_proof, to_arrow_type(id_type))
    return _in_blocks(rows, "kind", "node_tree", "level", "index").mapInArrow(run, ddl)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, with a check of its tampered or original leaf."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    id_, text = F.col("doc_id"), F.col("text")
    tampered = (F.crc32(id_.cast("string").cast("binary")) % 2 == 0) & text.contains("\n")
    changed = leaf_digest([F.replace(text, F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    manifest = build_manifest(docs, claim=F.when(tampered, changed))
    root = F.lit(manifest.root).cast("string")
    return prove(manifest).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS) + ")"
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text, beside a table with a column ``crc``."""
    codes = f"list_transform(string_split({text}, ''), lambda h: ord(h)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, x: xor(c >> 8, crc[1 + (xor(c, x) & 255)])), 4294967295)"


_PROOF_LEVEL = """SELECT d.rid, {stage} AS stage, n.lvl, n.idx, n.digest FROM d JOIN grp USING (src)
  JOIN node n ON {tree} AND n.cnt > 1 AND n.idx // 3 = ({at} // (3 ** n.lvl)::BIGINT) // 3 AND n.idx <> {at} // (3 ** n.lvl)::BIGINT"""
_SRC = "coalesce('=' || source, '-')"
OP11_SQL = f"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
raw AS (SELECT row_number() OVER () AS rid, doc_id, {_SRC} AS src, text, {_LEAF} AS leaf,
               coalesce({crc32_sql("doc_id::VARCHAR")} % 2 = 0, FALSE) AS picked, source, lang, n_chars FROM documents, t),
d AS MATERIALIZED (
  SELECT rid, doc_id, src, leaf, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY src) AS cnt,
         CASE WHEN picked THEN {_LEAF.replace("text::VARCHAR", "replace(text, chr(10), '')")} ELSE leaf END AS claim
  FROM raw WINDOW w AS (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf)),
up AS (
  SELECT src, 0 AS lvl, idx::BIGINT AS idx, leaf AS digest, cnt::BIGINT AS cnt FROM d
  UNION ALL
  SELECT src, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(cnt) + 2) // 3
  FROM up WHERE cnt > 1 GROUP BY src, lvl, idx // 3),
grp AS MATERIALIZED (
  SELECT src, digest AS subroot, row_number() OVER (ORDER BY src <> '-', encode(src)) - 1 AS g, count(*) OVER () AS groups FROM up WHERE cnt = 1),
topup AS (
  SELECT 0 AS lvl, g::BIGINT AS idx, subroot AS digest, groups::BIGINT AS cnt FROM grp
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(cnt) + 2) // 3
  FROM topup WHERE cnt > 1 GROUP BY lvl, idx // 3),
node AS MATERIALIZED (SELECT 0 AS stage, src, lvl, idx, digest, cnt FROM up UNION ALL SELECT 1, NULL, lvl, idx, digest, cnt FROM topup),
sib AS MATERIALIZED ({_PROOF_LEVEL.format(stage=0, tree="n.stage = 0 AND n.src = d.src", at="d.idx")}
  UNION ALL {_PROOF_LEVEL.format(stage=1, tree="n.stage = 1", at="grp.g")}),
proof AS (SELECT rid, sha256(string_agg(digest, '' ORDER BY stage, lvl, idx)) AS p FROM sib GROUP BY rid),
step AS MATERIALIZED (
  SELECT d.rid, row_number() OVER (PARTITION BY d.rid ORDER BY n.stage, n.lvl) AS k,
         coalesce((SELECT string_agg(s.digest, '' ORDER BY s.idx) FROM sib s WHERE s.rid = d.rid AND s.stage = n.stage AND s.lvl = n.lvl AND s.idx < n.idx), '') AS l,
         coalesce((SELECT string_agg(s.digest, '' ORDER BY s.idx) FROM sib s WHERE s.rid = d.rid AND s.stage = n.stage AND s.lvl = n.lvl AND s.idx > n.idx), '') AS r
  FROM d JOIN grp USING (src) JOIN node n ON n.cnt > 1 AND CASE WHEN n.stage = 0
    THEN n.src = d.src AND n.idx = d.idx // (3 ** n.lvl)::BIGINT ELSE n.idx = grp.g // (3 ** n.lvl)::BIGINT END),
folding AS (
  SELECT rid, 0 AS k, claim AS digest FROM d
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(l || digest || r) FROM folding f JOIN step s ON s.rid = f.rid AND s.k = f.k + 1),
folded AS (SELECT rid, arg_max(digest, k) AS folded_root FROM folding GROUP BY rid),
root AS (SELECT digest AS root FROM topup WHERE cnt = 1)
SELECT doc_id, leaf, subroot, root, coalesce(p, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN grp USING (src) JOIN folded USING (rid) LEFT JOIN proof USING (rid), root
"""
