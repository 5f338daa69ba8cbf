"""Benchmark decontamination by winnowing (operator 8).

A window is 13 consecutive words of a benchmark item (an item of fewer words is one window).
Winnowing keeps the smallest 5-gram hash of every 9 consecutive ones, the rightmost of equal
ones.  Two texts that share 13 words share such a stretch of nine 5-grams, so they keep the same
fingerprint there: a document's window is worth a look only if its fingerprint is one of the
benchmark's.  Such hits are extended to the full window, whose hash must be a benchmark window's.

The benchmark is reduced to distinct windows, each with a *set number*: windows that stand in
the same items share one, so a passage of many items is one entry and a document carries set
numbers, not items.  Item lists are made once per distinct combination of set numbers.

Up to ``BROADCAST_WINDOWS`` windows the table goes to every task and a document
is decided where it is read, without a shuffle.  Beyond that the tasks keep a bit map of the
benchmark's hashes, of sixteen bits a window up to 128 MB, and emit the windows that pass; these
are joined with the window table by hash and merged per document.  Documents without a hit take
part in no join.

Defined results for odd rows: null and wordless texts have no words, no hits and no items; an
item without words has no window; rows with the same item id are one item, an item with a null
id hits but is not counted or listed; an empty benchmark hits nothing; document rows with equal
ids are judged each by itself.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm import bytescan as B
from dialstat.llm.staging import rows_within, stage

GRAM, SPAN = 5, 9  # GRAM + SPAN - 1 = 13 words: the shortest shared span that is always found
WINDOW = GRAM + SPAN - 1
BROADCAST_WINDOWS = 2_000_000  # 24 bytes each: 48 MB
LEAST_MAP, MOST_MAP = 20, 30  # the bit map of the join path has 2 ** 20 to 2 ** 30 bits: 128 KB to 128 MB
_U = np.uint64
_NO = _U(0xFFFFFFFFFFFFFFFF)


def window_minima(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts inside one row, position of each window's fingerprint, all gram hashes)."""
    grams = B.gram_hashes(words, GRAM)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    best, where = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, SPAN):
        later = grams[j : j + n]
        lower = later <= best
        best[lower] = later[lower]
        where[lower] = j
    whole = np.ones(n, dtype=bool)  # a window may not run over the end of its row
    for end in at[1:-1].tolist():
        whole[max(0, end - WINDOW + 1) : end] = False
    starts = np.flatnonzero(whole)
    return starts, starts + where[starts], grams


def stretch_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` words from each start."""
    out = np.full(len(starts), length, dtype=np.uint64)
    for j in range(length):
        out += words[starts + j] * B._GRAM[j]
    return B.mix(out)


def short_starts(at: np.ndarray, length: int) -> np.ndarray:
    """Starts of every run of ``length`` words inside one row."""
    parts = [np.arange(lo, hi - length + 1) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()) if hi - lo >= length]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, window hash, its length in words, fingerprint hash; 0 for a short item)."""
    for batch in batches:
        for lo, hi, raw, bounds in B.chunks(batch.column(1)):
            words, at = B.lowered_words(raw, bounds, B.ALNUM)
            ids = batch.column(0).slice(lo, hi - lo)
            starts, marks, grams = window_minima(words, at)
            hashes, lengths, prints = [stretch_hashes(words, starts, WINDOW)], [np.full(len(starts), WINDOW)], [grams[marks]]
            rows = [np.searchsorted(at, starts, side="right") - 1]
            for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                if 0 < b - a < WINDOW:
                    hashes.append(stretch_hashes(words, np.array([a]), b - a))
                    lengths.append(np.array([b - a]))
                    prints.append(np.zeros(1, np.uint64))
                    rows.append(np.array([row]))
            yield pa.record_batch(
                [
                    ids.take(pa.array(np.concatenate(rows))),
                    pa.array(np.concatenate(hashes).view(np.int64)),
                    pa.array(np.concatenate(lengths).astype(np.int32)),
                    pa.array(np.concatenate(prints).view(np.int64)),
                ],
                names=["item_id", "window", "length", "mark"],
            )


class Lookup:
    """Benchmark windows as sorted arrays; ``find`` gives set numbers, -1 for none."""

    def __init__(self, rows):
        self.marks = np.unique(rows["mark"][rows["length"] == WINDOW]).view(np.uint64)
        self.marks.sort()
        self.tables = {}
        for length in np.unique(rows["length"]).tolist():
            own = rows["length"] == length
            hashes = rows["window"][own].view(np.uint64)
            order = np.argsort(hashes)
            self.tables[length] = (hashes[order], rows["set_id"][own][order])

    def marked(self, hashes: np.ndarray) -> np.ndarray:
        return _at(self.marks, hashes)[0]

    def find(self, length: int, hashes: np.ndarray) -> np.ndarray:
        found, at = _at(self.tables[length][0], hashes)
        return np.where(found, self.tables[length][1][at], -1)


class BitMap:
    """Which hashes may be in the benchmark; ``find`` gives 0 for maybe, -1 for no."""

    def __init__(self, words: np.ndarray, lengths: list[int]):
        self.words, self.tables = words, dict.fromkeys(lengths)
        self.mask = _U(64 * len(words) - 1)

    def marked(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        return (self.words[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) == _U(1)

    def find(self, length: int, hashes: np.ndarray) -> np.ndarray:
        return np.where(self.marked(hashes), 0, -1)


def _at(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(table.searchsorted(values), len(table) - 1)
    return table[at] == values, at


def window_hits(words: np.ndarray, at: np.ndarray, lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, window hashes, set numbers) of the benchmark windows in the rows."""
    out = []
    for length in lookup.tables:
        if length == WINDOW:
            starts, marks, grams = window_minima(words, at)
            kept = np.unique(marks)  # the winnowed fingerprints, each looked up once
            shared = np.zeros(len(grams) + 1, dtype=bool)
            shared[kept] = lookup.marked(grams[kept])
            starts = starts[shared[marks]]
        else:
            starts = short_starts(at, length)
        hashes = stretch_hashes(words, starts, length)
        sets = lookup.find(length, hashes)
        hit = sets >= 0
        out.append((starts[hit], np.full(int(hit.sum()), length), hashes[hit], sets[hit]))
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return tuple(np.concatenate(part) for part in zip(*out))


def _judge(lookup):
    """Rows (n_words, n_hit, sets and what is carried) decided where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Lookup(lookup.value)
        for batch in batches:
            for lo, hi, raw, bounds in B.chunks(batch.column(0)):
                words, at = B.lowered_words(raw, bounds, B.ALNUM)
                starts, lengths, _, sets = window_hits(words, at, table)
                covered = np.zeros(len(words) + 1, dtype=bool)
                for length in np.unique(lengths).tolist():
                    covered[starts[lengths == length][:, None] + np.arange(length)] = True
                so_far = np.concatenate([[0], np.cumsum(covered[:-1])])
                rows = np.searchsorted(at, starts, side="right") - 1
                named = [None] * (hi - lo)
                for row in np.unique(rows).tolist():
                    named[row] = np.unique(sets[rows == row])
                yield pa.record_batch(
                    [
                        pa.array(np.diff(at)),
                        pa.array(so_far[at[1:]] - so_far[at[:-1]]),
                        pa.array(named, pa.list_(pa.int64())),
                        *(c.slice(lo, hi - lo) for c in batch.columns[1:]),
                    ],
                    names=["n_words", "n_hit", "sets", *batch.schema.names[1:]],
                )

    return run


_HITS = "n_words long, n_hit long, sets array<bigint>"
_MAYBE = "n_words long, hits array<struct<start:bigint,length:bigint,window:bigint>>, row long"


def _maybe(lookup):
    """Rows with the windows that pass the bit map, for the join path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = BitMap(*lookup.value)
        for batch in batches:
            for lo, hi, raw, bounds in B.chunks(batch.column(0)):
                words, at = B.lowered_words(raw, bounds, B.ALNUM)
                starts, lengths, hashes, _ = window_hits(words, at, table)
                rows = np.searchsorted(at, starts, side="right") - 1
                order = np.argsort(rows, kind="stable")
                starts, lengths, hashes, rows = starts[order], lengths[order], hashes[order], rows[order]
                hits = pa.StructArray.from_arrays(
                    [pa.array(starts - at[rows]), pa.array(lengths), pa.array(hashes.view(np.int64))],
                    names=["start", "length", "window"],
                )
                cuts = np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        pa.array(np.diff(at)),
                        pa.ListArray.from_arrays(pa.array(cuts), hits),
                        *(c.slice(lo, hi - lo) for c in batch.columns[1:]),
                    ],
                    names=["n_words", "hits", *batch.schema.names[1:]],
                )

    return run


def bit_map(windows: DataFrame, rows: int) -> np.ndarray:
    """The 64-bit words of the map of all window and fingerprint hashes, its size by their number."""
    bits = min(MOST_MAP, max(LEAST_MAP, (16 * rows - 1).bit_length()))
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    hashes = windows.select(F.explode(F.array("window", "mark")).alias("hash"))
    touched = hashes.select(F.shiftright(slot, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    held = touched.toPandas()  # at most a sixty-fourth of the map's bits
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return out


def _joined(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The join path: candidate windows of all documents against the window table, by hash."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # 13 values at most
    bits = bit_map(windows, windows.count())
    table = spark.sparkContext.broadcast((bits, lengths))
    kinds = _kinds(docs)
    numbered = docs.select("text", F.monotonically_increasing_id().alias("row"), *docs.columns[1:])
    maybe = stage(numbered.mapInArrow(_maybe(table), _MAYBE + kinds), "maybe_hits")
    found = (
        maybe.select("row", F.inline("hits"))
        .join(windows.select("window", F.col("length").cast("long").alias("length"), "set_id"), ["window", "length"])
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("hits"),
            F.array_sort(F.collect_set("set_id")).alias("sets"),
        )
    )
    # Union of intervals in order of start: each adds what reaches beyond those before it.
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, h: F.struct(
            (s["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(s["to"], h["start"]))).alias("n"),
            F.greatest(s["to"], h["end"]).alias("to"),
        ),
        lambda s: s["n"],
    )
    found = found.select("row", covered.alias("n_hit"), "sets")
    carried = docs.columns[1:]
    # Only rows with candidate windows are joined.
    candidates = maybe.filter(F.size("hits") > 0).join(found, "row", "left")
    met = candidates.select("n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "sets", *carried)
    clean = maybe.filter(F.size("hits") == 0)
    return met.union(
        clean.select("n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(None).cast("array<bigint>").alias("sets"), *carried)
    )


def _kinds(docs: DataFrame) -> str:
    """The carried columns of ``docs``, those after its text, as part of a schema."""
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[1:])


def _benchmark_windows(benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """(windows with the items in which they stand, distinct windows with their set numbers)."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    )
    standing = stage(
        items.mapInArrow(_item_windows, "item_id string, window long, length int, mark long").distinct(), "item_windows"
    )
    # The set number of a window: a digest of the ids of the items in which it stands.
    sets = standing.groupBy("window", "length", "mark").agg(
        F.coalesce(F.bit_xor(F.xxhash64("item_id")), F.lit(0)).alias("x"),
        F.sum(F.pmod(F.xxhash64(F.lit(1), "item_id"), F.lit(1 << 40))).alias("s"),
        F.count("item_id").alias("c"),
    )
    windows = stage(
        sets.select("window", "length", "mark", F.xxhash64("x", "s", "c").bitwiseAND(F.lit((1 << 63) - 1)).alias("set_id")),
        "windows",
    )
    return standing, windows


def _hit_rows(docs: DataFrame, windows: DataFrame, text_col: str, carry: Sequence[str], share: int, most: int) -> DataFrame:
    """n_words, n_hit, sets and contaminated of every row, then carried_0, ... as they are."""
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    texts = docs.select(F.col(text_col).cast("string").alias("text"), *carried)
    if rows_within(windows, most):
        rows = windows.toPandas()
        lookup = docs.sparkSession.sparkContext.broadcast({c: rows[c].to_numpy() for c in rows.columns})
        judged = texts.mapInArrow(_judge(lookup), _HITS + _kinds(texts))
    else:
        judged = _joined(texts, windows)
    contaminated = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return judged.withColumn("contaminated", contaminated)


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: int = 20,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are; the text stays beside its verdict,
    so nothing is joined back."""
    _, windows = _benchmark_windows(benchmark, item_col, item_text_col)
    judged = _hit_rows(docs, windows, text_col, docs.columns, share, broadcast_windows).filter(~F.col("contaminated"))
    return judged.select(*[F.col(f"carried_{i}").alias(c) for i, c in enumerate(docs.columns)])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: int = 20,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per document: words, words hit, benchmark items met and the verdict.

    :param share: contaminated if ``share * n_hit >= n_words`` and there is a hit
    :param broadcast_windows: most benchmark windows that go to every task; beyond, a join
    """
    standing, windows = _benchmark_windows(benchmark, item_col, item_text_col)
    judged = _hit_rows(docs, windows, text_col, [id_col], share, broadcast_windows)
    judged = stage(judged.withColumnRenamed("carried_0", "doc_id"), "judged")
    # Items of each distinct combination of set numbers, listed once.
    lists = judged.filter(F.col("sets").isNotNull()).select("sets").distinct()
    one = windows.groupBy("set_id").agg(F.min(F.struct("window", "length")).alias("w")).select("set_id", "w.*")
    members = one.join(standing, ["window", "length"]).select("set_id", "item_id").distinct()
    named = (
        lists.select("sets", F.explode("sets").alias("set_id"))
        .join(members, "set_id")
        .groupBy("sets")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    none = F.array().cast("array<string>")
    listed = judged.filter(F.col("sets").isNotNull()).join(named, "sets", "left").unionByName(
        judged.filter(F.col("sets").isNull()).withColumn("items", none)
    )
    return listed.select(
        F.col("doc_id").alias(id_col),
        "n_words",
        "n_hit",
        F.coalesce("items", none).alias("items"),
        "contaminated",
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against all benchmark items: 13-word windows, contaminated from 5 % hit."""
    root = sf_dir.rstrip("/")
    found = decontaminate(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, len(w) AS n, array_to_string(w, ' ') AS g FROM b WHERE len(w) BETWEEN 1 AND 12
  UNION
  SELECT DISTINCT item_id, 13 AS n, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM b WHERE len(w) >= 13),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM d, lens WHERE len(w) >= n),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
