"""N-gram Jaccard join by prefix trees (operator 1).

A text's set is its distinct 3-word shingles as 64-bit hashes; the hash value is the global
order.  Texts link when ``den * |A and B| >= num * |A or B|``, by default a Jaccard of 0.9.

How the sets are dealt out without losing a link: two linked sets differ in at most D elements
(D follows from their sizes).  The ordered universe is cut into D + s ranges, so linked sets
agree *wholly* on at least s of them (s is larger than the empty ranges that a set of this size
has, but for rare sets, whose empty ranges are keys too); every set is sent to one key per range,
the hash of its run of elements there.  A set that shares fewer keys than s less its empty ranges
has no link and leaves, and so on until few do (:func:`_pruned`).  What stays is near copies and
little else, so a line, passage or phrase that many texts share gathers nobody.  Equal
sets are one node from the start, within each task and then by digest.

Sets meet in prefix trees (:func:`trie_links`): members are stored by their ordered elements, a
probe walks the tree once, overlap counted on a shared prefix is counted once for all members
below it, and a subtree is left as soon as the elements that remain on either side cannot lift
the overlap to the bound.

1. Sets that share keys, directly or through others, form clusters: components of the pairs
   (smallest node of a key, other node of the key).  Links lie inside clusters.
2. A cluster of up to ``BLOCK_ELEMENTS`` elements is one prefix tree in one task; a set travels
   once.  Pairs that other links connect already are skipped, and so are pairs that differ in
   more ranges than linked sets can (:class:`Agreement`, which looks only at members listed under
   one of a probe's rarest ranges).
3. Larger clusters are taken key by key: a key's smallest node probes the key's others, in
   blocks of bounded size; then, for keys whose members are still in different components, all
   members in pairs of blocks, skipping connected pairs.  No step writes all pairs of a group.

Defined results for odd rows: a null or wordless text has an empty set and links with nothing;
a text of one or two words has its whole word sequence as its one shingle; rows whose sets are
equal link whatever their ids; a null id takes part like any other but is never a component id
(a component of null ids has a null id); an id that occurs twice gets a row for each.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm import bytescan as B
from dialstat.llm.components import connected_components
from dialstat.llm.staging import rows_within, stage
from dialstat.operators.lookup import heavy_keys

BLOCK_ELEMENTS = 4_000_000  # elements of the sets that meet in one task: 32 MB
BROADCAST_IDS = 1_000_000  # ids of candidate texts: 8 MB at most
_U = np.uint64

PROFILE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("node", pa.binary()),
        ("keys0", pa.list_(pa.int64())),
        ("keys1", pa.list_(pa.int64())),
        ("need0", pa.int32()),
        ("need1", pa.int32()),
    ]
)


def size_classes(num: int, den: int, upto: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower size, number of ranges, ranges that linked sets agree on) of each class; a class
    without ranges has only equal sets that link.

    Sets that link have sizes in one class or in two neighbouring ones.  The ranges of a class
    serve pairs whose smaller set lies in it.
    """
    lows = [1]
    while lows[-1] < upto:
        lows.append(max(lows[-1] + 1, den * (lows[-1] - 1) // num + 1))
    lows = np.array(lows, dtype=np.int64)
    largest = lows[1:] - 1
    both = largest + den * largest // num
    # overlap >= num * (x + y) / (num + den), so they differ in x + y - 2 * overlap at most
    differ = (den - num) * both // (num + den)
    spare = np.full(len(differ), 3)
    for _ in range(8):  # more than the empty ranges of nearly every set: mean and six deviations
        ranges = differ + spare
        empty = ranges * np.exp(-lows[:-1] / ranges)
        spare = np.clip(np.ceil(empty + 6 * np.sqrt(empty) + 2), 3, 10 + differ // 20).astype(np.int64)
        spare = np.maximum(spare, 3 + differ * 3 // 20)
    return lows, np.where(differ > 0, differ + spare, 0), spare


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row of one chunk."""
    words, at = B.lowered_words(raw, bounds, B.SPACED)
    grams = B.gram_hashes(words, n)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= n:
            out.append(np.unique(grams[lo : hi - n + 1]))
        elif hi > lo:
            out.append(B.gram_hashes(words[lo:hi], hi - lo))
        else:
            out.append(words[:0])
    return out


def set_digest(elements: np.ndarray) -> bytes:
    """96-bit digest of a set, from two independent sums of mixed elements."""
    one = int(B.mix(elements ^ _U(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64))
    two = int(B.mix(elements * _U(0x9FB21C651E98DF25) + _U(len(elements))).sum(dtype=np.uint64))
    return one.to_bytes(8, "big") + (two >> 32).to_bytes(4, "big")


def range_keys(elements: np.ndarray, classes: tuple[np.ndarray, ...]) -> list[tuple[np.ndarray, int]]:
    """(keys, keys that a linked set has in common with this one at least) of the set's own class
    and of the class below."""
    lows, ranges, spare = classes
    own = int(np.searchsorted(lows, len(elements), side="right")) - 1
    sums = np.zeros(len(elements) + 1, dtype=np.uint64)
    np.cumsum(B.mix(elements + _U(0x632BE59BD9B4E019)), out=sums[1:])
    out = []
    for c in (own, own - 1):
        m = int(ranges[c]) if c >= 0 else 0
        if not m or not len(elements):
            out.append((elements[:0], 0))
            continue
        edges = np.append(
            elements.searchsorted((np.arange(m, dtype=np.uint64)) * _U(2**64 // m)), len(elements)
        )
        counts = np.diff(edges)
        tags = B.mix(np.arange(m, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(c + 1))
        key = B.mix(sums[edges[1:]] - sums[edges[:-1]] + tags + counts.astype(np.uint64))
        empty = int((counts == 0).sum())
        # The ranges that linked sets agree on may all be empty only if a set has that many.
        if empty >= spare[c]:
            out.append((key, 1))  # a partner with fewer empty ranges does not give them
        else:
            out.append((key[counts > 0], int(spare[c]) - empty))
    return out


def _profiles(n: int, num: int, den: int):
    classes = size_classes(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # sets whose keys this task has already given
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, raw, bounds in B.chunks(texts):
                columns = {name: [] for name in PROFILE.names[1:]}
                for elements in shingle_sets(raw, bounds, n):
                    node = set_digest(elements)
                    columns["n"].append(len(elements))
                    columns["node"].append(node)
                    found = [(None, None)] * 2 if node in seen else range_keys(elements, classes)
                    seen.add(node)
                    for side, (keys, need) in enumerate(found):
                        columns[f"keys{side}"].append(keys.view(np.int64) if need else None)
                        columns[f"need{side}"].append(need or None)
                arrays = [pa.array(v, PROFILE.field(k).type) for k, v in columns.items()]
                yield pa.record_batch([ids.slice(lo, hi - lo), *arrays], schema=PROFILE)

    return run


def _wanted_sets(n: int):
    schema = pa.schema([("node", pa.binary()), ("elements", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, bounds in B.chunks(batch.column(0)):
                sets = shingle_sets(raw, bounds, n)
                yield pa.record_batch(
                    [
                        pa.array([set_digest(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return run


def tree_order(members: list[np.ndarray]) -> list[int]:
    """The order of a prefix tree's leaves: lexicographic in the sets' elements."""
    return sorted(range(len(members)), key=lambda i: members[i].astype(">u8").tobytes())


def trie_links(probe: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """Positions of the sets that link with the probe.

    ``sets`` are sorted arrays in tree order.  A node of the tree is a range of sets with a
    common prefix, its segment the part that they share beyond their parent.
    """
    sizes = np.array([len(s) for s in sets])
    size, total = len(probe), num + den
    found = []
    todo = [(0, len(sets), 0, 0)] if sets else []
    while todo:
        lo, hi, depth, overlap = todo.pop()
        first, last = sets[lo], sets[hi - 1]
        end = min(len(first), len(last))
        if hi - lo > 1:
            apart = np.flatnonzero(first[depth:end] != last[depth:end])
            end = depth + int(apart[0]) if len(apart) else end
        segment, passed = first[depth:end], 0
        if len(segment):
            at = probe.searchsorted(segment)
            overlap += int((probe[np.minimum(at, size - 1)] == segment).sum())
            passed = int(probe.searchsorted(segment[-1], side="right"))
        elif depth:
            passed = int(probe.searchsorted(first[depth - 1], side="right"))
        within = sizes[lo:hi]
        # The most that any member below can still reach, against the least that any needs.
        if total * (overlap + min(int(within.max()) - end, size - passed)) < num * (size + int(within.min())):
            continue
        while lo < hi and len(sets[lo]) == end:  # members that end here come first
            if total * overlap >= num * (size + end):
                found.append(lo)
            lo += 1
        while lo < hi:
            branch = sets[lo][end]
            stop = lo + 1
            while stop < hi and sets[stop][end] == branch:
                stop += 1
            todo.append((lo, stop, end, overlap))
            lo = stop
    return found


def _as_set(values) -> np.ndarray:
    return np.asarray(values, dtype=np.int64).view(np.uint64)


def _probe_block(num: int, den: int):
    """One probe against the members of its block."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        probe = block[block["node"] == block["probe"]]
        others = block[block["node"] != block["probe"]]
        sets = [_as_set(e) for e in others["elements"]]
        order = tree_order(sets)
        hits = trie_links(_as_set(probe["elements"].iloc[0]), [sets[i] for i in order], num, den)
        linked = others["node"].to_numpy()[[order[h] for h in hits]]
        return pd.DataFrame({"a": [block["probe"].iloc[0]] * len(hits), "b": linked}, dtype=object)

    return run


class Postings:
    """An index of a matrix of range hashes, one row for each set: the rows that have a hash in a column.

    Linked sets differ in at most ``most`` columns, so among any ``most + 1`` there is one in which they
    agree: a row's candidates are the rows listed under its hashes in the columns where the lists
    are shortest.
    """

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.order = matrix.argsort(axis=0, kind="stable").astype(np.int32)
        ranked = np.take_along_axis(matrix, self.order, 0)
        at = np.arange(len(matrix), dtype=np.int32)[:, None]
        new = np.ones(matrix.shape, dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        first = np.maximum.accumulate(np.where(new, at, 0), axis=0)
        ends = np.ones(matrix.shape, dtype=bool)
        ends[:-1] = new[1:]
        last = np.minimum.accumulate(np.where(ends, at, len(matrix))[::-1], axis=0)[::-1]
        self.starts, self.stops = np.empty_like(self.order), np.empty_like(self.order)
        np.put_along_axis(self.starts, self.order, first.astype(np.int32), 0)
        np.put_along_axis(self.stops, self.order, last.astype(np.int32) + 1, 0)

    def candidates(self, r: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows that may differ from row r in ``most`` columns or fewer, columns in which each does)."""
        starts, stops = self.starts[r], self.stops[r]
        lengths = stops - starts
        needed = most + 1
        columns = np.argpartition(lengths, needed - 1)[:needed] if needed < len(lengths) else np.arange(len(lengths))
        lists = [self.order[starts[c] : stops[c], c] for c in columns[lengths[columns] > 1].tolist()]
        rows = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int32)
        return rows, (self.matrix[rows] != self.matrix[r]).sum(1)


class Agreement:
    """Which members of a block may link, from hashes of the runs in ranges of the order.

    For each size class the universe is cut into twice as many ranges as linked sets may differ
    in elements; sets that differ in more ranges than that cannot link.
    """

    def __init__(self, sets: list[np.ndarray], classes: tuple[np.ndarray, ...], num: int, den: int):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.num, self.den = num, den
        self.own = np.searchsorted(classes[0], self.sizes, side="right") - 1
        self.schemes: dict[int, tuple[np.ndarray, Postings]] = {}
        for c in set(self.own.tolist()) | set((self.own - 1).tolist()):
            rows = np.flatnonzero((self.own == c) | (self.own == c + 1))
            m = 2 * int(classes[1][c]) if c >= 0 else 0
            if m and len(rows) > 1:
                self.schemes[c] = (rows, Postings(np.stack([range_hashes(sets[r], m) for r in rows.tolist()])))

    def candidates(self, p: int) -> np.ndarray:
        """Members, in ascending order, that are not ruled out against member p."""
        found = []
        own = int(self.own[p])
        for c in (own, own - 1):
            rows, postings = self.schemes.get(c, (None, None))
            if rows is None:
                continue
            largest = int(self.sizes[p] + self.sizes[rows].max())
            most = largest - 2 * -(-self.num * largest // (self.num + self.den)) + 1  # grows with the sizes, but for 1
            listed, differ = postings.candidates(int(np.searchsorted(rows, p)), most)
            rows = rows[listed]
            both = self.sizes[rows] + self.sizes[p]
            may = differ <= both - 2 * -(-self.num * both // (self.num + self.den))
            # the scheme of a class serves pairs whose smaller set lies in it
            may &= (self.own[rows] >= own) if c == own else (self.own[rows] == c)
            found.append(rows[may])
        out = np.concatenate(found) if found else np.zeros(0, np.int64)
        return np.sort(out[out != p])


def range_hashes(elements: np.ndarray, m: int) -> np.ndarray:
    """32-bit hash of the elements in each of m equal ranges of the universe."""
    sums = np.zeros(len(elements) + 1, dtype=np.uint64)
    np.cumsum(B.mix(elements + _U(0x632BE59BD9B4E019)), out=sums[1:])
    edges = np.append(elements.searchsorted(np.arange(m, dtype=np.uint64) * _U(2**64 // m)), len(elements))
    return (B.mix(sums[edges[1:]] - sums[edges[:-1]]) >> _U(32)).astype(np.uint32)


def _meet_block(num: int, den: int):
    """All members of a block, or of two blocks, but for pairs already connected."""
    classes = size_classes(num, den)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        i, j = int(block["i"].iloc[0]), int(block["j"].iloc[0])
        sets = [_as_set(e) for e in block["elements"]]
        order = tree_order(sets)
        sets = [sets[k] for k in order]
        nodes, labels, home = (block[c].to_numpy()[order].tolist() for c in ("node", "label", "home"))
        parent = {label: label for label in labels}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out, apart = [], len(parent)
        near = Agreement(sets, classes, num, den)
        for p in range(len(nodes)):
            if apart == 1:
                break
            if home[p] != i:
                continue
            own = root(labels[p])
            others = [
                q for q in near.candidates(p).tolist() if (q > p or i != j) and home[q] == j and root(labels[q]) != own
            ]
            for hit in trie_links(sets[p], [sets[q] for q in others], num, den):
                out.append((nodes[p], nodes[others[hit]]))
                met = root(labels[others[hit]])
                if met != own:
                    parent[met] = own
                    apart -= 1
        return pd.DataFrame(out, columns=["a", "b"], dtype=object)

    return run


def _cluster_links(clusters: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside the clusters of ``clusters(node, label)``, each met in one task."""
    members = clusters.join(sets, "node").select(
        "label", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("home"), "node", "elements"
    )
    own = members.withColumn("cluster", F.col("label")).withColumn("label", F.col("node"))
    return own.groupBy("cluster").applyInPandas(_meet_block(num, den), "a binary, b binary")


def _pruned(keyed: DataFrame, needs: DataFrame, rounds: int = 2) -> DataFrame:
    """keyed(key, node, side) -> (key, node, side, center): keys of two nodes and more, without
    the nodes that share too few of them to have a link.

    The nodes of a key are looked at together by a window.  Heavy keys, which a sketch finds and of
    which there are at most a thousand, are summed up map-side instead, and their smallest and
    largest nodes are broadcast: no task gets a heavy key's rows.

    :param needs: (node, side, need): the keys that a node shares with any linked one, at least
    """
    low = F.expr("min(node) OVER (PARTITION BY key)")
    high = F.expr("max(node) OVER (PARTITION BY key)")
    heavy = [(key,) for key in heavy_keys(keyed, "key")]
    marks = F.broadcast(keyed.sparkSession.createDataFrame(heavy, "key long")) if heavy else None

    def shared(rows: DataFrame) -> DataFrame:
        light = rows.join(marks, "key", "left_anti") if heavy else rows
        met = light.select("key", "node", "side", low.alias("center"), high.alias("top"))
        if heavy:
            weighty = rows.join(marks, "key", "left_semi")
            ends = weighty.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("top"))
            met = met.union(weighty.join(F.broadcast(ends), "key").select("key", "node", "side", "center", "top"))
        return met.filter("center <> top").drop("top")

    rows = stage(shared(keyed).distinct(), "shared")
    for _ in range(rounds):
        enough = (
            rows.groupBy("node", "side")
            .agg(F.count("*").alias("keys"))
            .join(needs, ["node", "side"])
            .filter("keys >= need")
            .select("node", "side")
        )
        rows = stage(shared(rows.drop("center").join(enough, ["node", "side"])), "pruned")
    return rows


def _first_round(shared: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    pairs = shared.filter(F.col("node") != F.col("center")).select(F.col("center").alias("probe"), "node").distinct()
    members = pairs.join(sets, "node").withColumn("size", F.size("elements"))
    blocks = pairs.join(sets.select("node", F.size("elements").alias("size")), "node").groupBy("probe").agg(
        F.ceil(F.sum("size") / BLOCK_ELEMENTS).alias("blocks")
    )
    dealt = members.join(blocks, "probe").select(
        "probe", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "node", "elements"
    )
    # Every block gets the probe's own set beside its members.
    own = (
        blocks.select("probe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        .join(sets.withColumnRenamed("node", "probe"), "probe")
        .select("probe", "block", F.col("probe").alias("node"), "elements")
    )
    return dealt.union(own).groupBy("probe", "block").applyInPandas(_probe_block(num, den), "a binary, b binary")


def _second_round(shared: DataFrame, labels: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of a key, its centre aside, that are still in different components."""
    rest = (
        shared.filter(F.col("node") != F.col("center"))
        .join(labels, "node", "left")
        .select("key", "node", F.coalesce("label", "node").alias("label"))
    )
    per_key = rest.groupBy("key").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count("*").alias("many"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.pmod(F.xxhash64(F.lit(7), "node"), F.lit(1 << 40))).alias("s"),
    )
    # Keys with one and the same member list are looked at once.
    once = per_key.filter("low <> high").groupBy("many", "x", "s").agg(F.min("key").alias("key")).select("key")
    members = rest.join(once, "key").join(sets, "node")
    blocks = members.groupBy("key").agg(F.ceil(F.sum(F.size("elements")) / BLOCK_ELEMENTS).cast("int").alias("blocks"))
    placed = members.join(blocks, "key").withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = placed.withColumn("other", F.explode(other)).select(
        "key",
        F.least("home", "other").alias("i"),
        F.greatest("home", "other").alias("j"),
        "home",
        "node",
        "label",
        "elements",
    )
    return met.groupBy("key", "i", "j").applyInPandas(_meet_block(num, den), "a binary, b binary")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 3,
    num: int = 90,
    den: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """Membership and links of the n-gram Jaccard join.

    :param num: with ``den``: the least Jaccard similarity as a fraction, above a half
    :return: (``id_col``, n_shingles, node, component_id) with one row per input row, and the links
        (a, b) between nodes that the components rest on; a pair of nodes that other links
        connect already may be missing among them
    """
    if not den // 2 < num < den:
        raise ValueError("the similarity must be above 1/2 and below 1")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prof = stage(
        texts.mapInArrow(
            _profiles(n, num, den),
            "doc_id long, n long, node binary, keys0 array<bigint>, keys1 array<bigint>, need0 int, need1 int",
        ),
        "profiles",
    )
    sides = [
        prof.filter(f"need{side} IS NOT NULL").withColumn("side", F.lit(side).cast("byte")) for side in (0, 1)
    ]
    keyed = sides[0].select(F.explode("keys0").alias("key"), "node", "side").union(
        sides[1].select(F.explode("keys1").alias("key"), "node", "side")
    )
    needs = sides[0].select("node", "side", F.col("need0").alias("need")).union(sides[1].select("node", "side", "need1"))
    shared = _pruned(keyed, needs.dropDuplicates(["node", "side"])).drop("side")
    wanted = shared.select("node").distinct()
    # One row of every such set names the text to read again.
    ids = prof.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    ids = stage(
        ids.select(F.explode(F.when(F.col("nulls") > 0, F.array("id", F.lit(None).cast("long"))).otherwise(F.array("id"))).alias("id")).distinct(),
        "wanted",
    )
    if rows_within(ids, BROADCAST_IDS):
        ids = F.broadcast(ids)
    candidates = texts.join(ids, texts["doc_id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    sets = stage(
        candidates.mapInArrow(_wanted_sets(n), "node binary, elements array<bigint>")
        .join(wanted, "node", "left_semi")
        .dropDuplicates(["node"]),
        "sets",
    )
    clusters = connected_components(shared.select(F.col("center").alias("a"), F.col("node").alias("b")))
    sized = clusters.join(sets.select("node", F.size("elements").alias("size")), "node")
    large = sized.groupBy("label").agg(F.sum("size").alias("size")).filter(F.col("size") > BLOCK_ELEMENTS).select("label")
    large = stage(clusters.join(large, "label").select("node", "label"), "large")
    links = stage(_cluster_links(clusters.join(large.select("node"), "node", "left_anti"), sets, num, den), "links")
    if large.limit(1).count():
        hot = shared.join(large.select("node"), "node", "left_semi")
        first = stage(_first_round(hot, sets, num, den), "hot_links")
        second = _second_round(hot, connected_components(first), sets, num, den)
        links = stage(links.union(first).union(second), "all_links")
    labels = connected_components(links)
    named = prof.select("doc_id", "n", "node").join(labels, "node", "left")
    label = F.coalesce("label", "node")
    smallest = named.groupBy(label.alias("label")).agg(F.min("doc_id").alias("component_id"))
    # A row without words is its own component.
    member = named.filter("n > 0").select("doc_id", "n", "node", label.alias("label")).join(smallest, "label").select(
        "doc_id", "n", "node", "component_id"
    )
    alone = prof.filter("n = 0").select("doc_id", "n", "node", F.col("doc_id").alias("component_id"))
    rows = member.union(alone).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "node", "component_id")
    return rows, links


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (3-word shingles, Jaccard 0.9)."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    rows, _ = jaccard_components(docs)
    return rows.select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE
      WHEN len(words) = 0 THEN []
      WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_distinct(list_transform(range(1, len(words) - 1),
             lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS s
  FROM w),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
class AS (SELECT doc_id, n, list_sort(s) AS s FROM sized),
rep AS (SELECT s, n, min(doc_id) AS r FROM class WHERE n > 0 GROUP BY s, n),
e AS (SELECT r, n, unnest(s) AS g FROM rep),
ranked AS (
  SELECT r, n, g, row_number() OVER (PARTITION BY r ORDER BY df, g) AS pos
  FROM e JOIN (SELECT g, count(*) AS df FROM e GROUP BY g) USING (g)),
pre AS (SELECT * FROM ranked WHERE pos <= n - ceil(0.9 * n) + 1),
cand AS (
  SELECT DISTINCT a.r AS a, b.r AS b FROM pre a JOIN pre b
    ON a.g = b.g AND a.r < b.r AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
link AS (
  SELECT a, b FROM cand c JOIN rep x ON x.r = c.a JOIN rep y ON y.r = c.b
  WHERE 190 * len(list_intersect(x.s, y.s)) >= 90 * (x.n + y.n)),
sides AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(r, to_r) AS (
  SELECT r, r FROM rep UNION SELECT reach.r, sides.b FROM reach JOIN sides ON sides.a = reach.to_r),
comp AS (SELECT r, min(to_r) AS c FROM reach GROUP BY r)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(comp.c, k.doc_id) AS component_id
FROM class k LEFT JOIN rep ON rep.s = k.s AND rep.n = k.n LEFT JOIN comp ON comp.r = rep.r
"""
