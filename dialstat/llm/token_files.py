"""Token-id files with directly addressable codes (operator 10).

A container holds the ids of consecutive documents as variable-length codes that can be read at
any place: an id is cut into chunks of ``CHUNK_BITS``; level 0 holds the lowest chunk of every
id, a bitmap says which ids go on, level 1 holds the next chunk of those, and so on.  A rank
directory (ones before every ``RANK_BITS`` bits) gives an id's place on the next level, so token i
is read with one step per level and nothing around it is decoded.

Container, all numbers little-endian::

    magic 8 bytes, container length u64, partition u64, first token inside the partition u64,
    documents u64, tokens u64, levels u64,
    document ids i64 each, validity of ids (packed bits), tokens of each document u64,
    per level: entries u64, chunks u8 each, and but for the last level
               bitmap (packed bits, low bit first), rank directory u32 each

Documents are ranged by id over Spark's partitions and sorted inside them; a task packs them into
containers of about ``CONTAINER_TOKENS`` and Spark's text writer puts the bytes into files, a fixed
end mark after each container (so any store that Spark writes to will do, and a lost task's file
is discarded by the committer).  Reading back takes each document's ids by its place.  A
document's global start is its start inside the partition plus the tokens of the partitions
before, which the containers name.

Texts are encoded by the tokenizers library.  Merges never cross the pieces of the file's
splitter, so a worker gives the library each distinct piece once; a text with characters outside
the basic plane or newer than Unicode 3.2, or with a special token's string, goes to the library
whole.

Defined results for odd rows: a null or empty text is the end id alone; null ids come first;
rows with equal ids follow each other in order of their texts' crc32, equal rows in any order;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.bpe import text_groups, tokenizer_source
from dialstat.llm.pretokens import (
    CLASS,
    SETTLED,
    SPACE,
    IdPool,
    PieceTable,
    code_points,
    joined_lines,
    seal_odd_rows,
    split_blank_prefixed,
    worker_keeps,
)
from dialstat.llm.staging import stage, stage_path

CHUNK_BITS = 8
RANK_BITS = 512
CONTAINER_TOKENS = 1 << 20
CONTAINERS_PER_FILE = 8  # a file is read whole: about 16 MB, or one very long document
KEPT_PIECES = 1_000_000  # pieces whose ids a worker keeps: about 50 MB
JOINED_PIECES = 4096
MAGIC = b"DACTOK1\n"
END_MARK = "\nDACTOK-END\n"
_HEAD = "<8s6Q"
_HEAD_BYTES = struct.calcsize(_HEAD)


def pack_levels(ids: np.ndarray) -> list[bytes]:
    """Levels of directly addressable codes, each as its bytes."""
    out, rest = [], ids.astype(np.uint64)
    while True:
        chunks = (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint64(CHUNK_BITS)
        goes_on = rest > 0
        if not goes_on.any():
            out.append(struct.pack("<Q", len(chunks)) + chunks.tobytes())
            return out
        blocks = np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK_BITS), dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4")
        bitmap = np.packbits(goes_on, bitorder="little")
        out.append(struct.pack("<Q", len(chunks)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes())
        rest = rest[goes_on]


def pack_container(part: int, first: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    levels = pack_levels(ids)
    keys = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    valid = np.packbits([d is not None for d in doc_ids], bitorder="little")
    body = b"".join([keys.tobytes(), valid.tobytes(), counts.astype("<u8").tobytes(), *levels])
    return struct.pack(_HEAD, MAGIC, _HEAD_BYTES + len(body), part, first, len(keys), len(ids), len(levels)) + body


class Container:
    """One container over a buffer; nothing is decoded until it is asked for."""

    def __init__(self, data: memoryview):
        magic, self.length, self.part, self.first, docs, self.tokens, levels = struct.unpack_from(_HEAD, data)
        if magic != MAGIC or self.length > len(data):
            raise ValueError("not a token container, or cut off")
        self._data, self._at = data, _HEAD_BYTES
        keys, valid = self._take("<i8", docs), self._take("u1", (docs + 7) // 8)
        valid = np.unpackbits(valid, count=docs, bitorder="little")
        self.doc_ids = [k if v else None for k, v in zip(keys.tolist(), valid.tolist())]
        self.counts = self._take("<u8", docs).astype(np.int64)
        self.levels = []
        for level in range(levels):
            n = int(self._take("<u8", 1)[0])
            chunks = self._take("u1", n)
            if level == levels - 1:
                self.levels.append((chunks, None, None))
            else:
                self.levels.append((chunks, self._take("u1", (n + 7) // 8), self._take("<u4", -(-n // RANK_BITS))))

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, dtype=kind, count=n, offset=self._at)
        self._at += out.nbytes
        return out

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i: the directory's entry and the bits after it."""
        block = min(i // RANK_BITS, len(ranks) - 1)
        bits = np.unpackbits(bitmap[block * RANK_BITS // 8 : (i + 7) // 8], bitorder="little")
        return int(ranks[block]) + int(bits[: i - block * RANK_BITS].sum())

    def token(self, i: int) -> int:
        """Token i of the container."""
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            i, shift = self._rank(bitmap, ranks, i), shift + CHUNK_BITS
        return value

    def tokens_between(self, lo: int, hi: int) -> np.ndarray:
        """Tokens lo to hi - 1: on each level a stretch that starts at the rank of lo."""
        out = np.zeros(hi - lo, dtype="<u4")
        where = np.arange(hi - lo)
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            out[where] |= chunks[lo:hi].astype("<u4") << np.uint32(level * CHUNK_BITS)
            if bitmap is None or lo == hi:
                break
            begin = lo // 8 * 8
            bits = np.unpackbits(bitmap[begin // 8 : (hi + 7) // 8], bitorder="little")[lo - begin : hi - begin]
            where = where[bits.astype(bool)]
            lo = self._rank(bitmap, ranks, lo)
            hi = lo + len(where)
        return out


def containers_of(data: bytes) -> Iterator[Container]:
    """The containers of one file."""
    view, at = memoryview(data), 0
    while at < len(view):
        box = Container(view[at:])
        yield box
        at += box.length
        if bytes(view[at : at + len(END_MARK)]) != END_MARK.encode():
            raise ValueError("a container does not end with the end mark")
        at += len(END_MARK)


class TextEncoder:
    """Ids of whole texts by the tokenizers library, each distinct piece encoded once."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(source)
        self.cut = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.line_break = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.pieces = PieceTable()
        self._clear()

    def _clear(self) -> None:
        self.pieces.clear()
        self.pool = IdPool()

    def _learn(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Encode new pieces, most of them as lines of larger texts.

        A line break after a piece is a piece of its own if the next one has no white space but a
        leading blank; such pieces go to the library joined and are told apart by its id.
        """
        simple = CLASS[points[end - 1]] != SPACE
        text, cuts = joined_lines(points, begin[simple], end[simple])
        lines = len(cuts) - 1
        edges = [*range(0, lines, JOINED_PIECES), lines]
        joined = [text[cuts[a] : cuts[b] - 1] for a, b in zip(edges, edges[1:])]
        rest, ends_at = joined_lines(points, begin[~simple], end[~simple])
        lone = [rest[a : b - 1] for a, b in zip(ends_at.tolist(), ends_at[1:].tolist())]
        parts = [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(joined + lone, add_special_tokens=False)]
        sizes = np.zeros(len(begin), dtype=np.int64)
        seam = np.concatenate([np.append(p, self.line_break) for p in parts[: len(joined)]] or [np.zeros(0, np.uint32)])
        ends = np.flatnonzero(seam == self.line_break)
        if len(ends) != lines:
            raise ValueError("the tokenizer does not keep a line break apart")
        sizes[simple] = np.diff(np.concatenate([[-1], ends])) - 1
        sizes[~simple] = [len(p) for p in parts[len(joined) :]]
        ids = np.empty(int(sizes.sum()), dtype=np.uint32)
        from_lines = np.repeat(simple, sizes)
        ids[from_lines] = seam[seam != self.line_break]
        ids[~from_lines] = np.concatenate(parts[len(joined) :] or [np.zeros(0, np.uint32)])
        self.pool.add(ids, sizes)

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, ids per text), ``end`` after each text if given."""
        if len(self.pieces) > KEPT_PIECES:
            self._clear()
        points, bounds = code_points(texts)
        easy = seal_odd_rows(points, bounds, [self.cut.search(t) is not None for t in texts], SETTLED)
        begin, stop = split_blank_prefixed(points)
        numbers, new = self.pieces.number(points, begin, stop)
        if len(new):
            self._learn(points, begin[new], stop[new])
        ids, total = self.pool.gather(numbers)
        at = total[np.searchsorted(begin, bounds)].tolist()
        tail = np.array([] if end is None else [end], dtype=np.uint32)
        parts = []
        for text, plain, a, b in zip(texts, easy.tolist(), at, at[1:]):
            own = ids[a:b] if plain else np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            parts += [own, tail]
        counts = np.array([len(p) for p in parts], dtype=np.int64).reshape(-1, 2).sum(1)
        return np.concatenate(parts), counts


def _containers(source, end: int, container_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first = TaskContext.get().partitionId(), 0
        coder = worker_keeps("text encoder", source.value, TextEncoder)
        held_ids, held_counts, held_docs, size = [], [], [], 0

        def flush():
            box = pack_container(part, first, held_docs, np.concatenate(held_counts), np.concatenate(held_ids))
            return pa.record_batch([pa.array([box], pa.binary())], names=["container"])

        for batch in batches:
            for row, texts in text_groups(batch, 1):
                ids, counts = coder.encode(texts, end)
                held_ids.append(ids)
                held_counts.append(counts)
                held_docs += batch.column(0).slice(row, len(texts)).to_pylist()
                size += len(ids)
                if size >= container_tokens:
                    yield flush()
                    first += size
                    held_ids, held_counts, held_docs, size = [], [], [], 0
        if held_docs:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = 0,
    container_tokens: int = CONTAINER_TOKENS,
) -> None:
    """Write the ids of all documents, in ascending order of id, below ``path``."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumns({"order": F.crc32("text"), "row": F.monotonically_increasing_id()})
    ranged = texts.repartitionByRange("doc_id", "order", "row").sortWithinPartitions("doc_id", "order", "row")
    boxes = ranged.select("doc_id", "text").mapInArrow(
        _containers(tokenizer_source(docs.sparkSession, tokenizer), end, container_tokens), "container binary"
    )
    (
        boxes.select(F.col("container").cast("string"))
        .write.option("lineSep", END_MARK)
        .option("maxRecordsPerFile", CONTAINERS_PER_FILE)
        .text(path)
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(partition, doc_id, start inside the partition, tokens, crc32 of the ids)."""
    for batch in batches:
        for content in batch.column(0):
            for box in containers_of(content.as_buffer()):
                ends = np.cumsum(box.counts)
                starts = ends - box.counts
                checks = [zlib.crc32(box.tokens_between(a, b).tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(ends), box.part, dtype=np.int64)),
                        pa.array(box.doc_ids, pa.int64()),
                        pa.array(starts + box.first),
                        pa.array(box.counts),
                        pa.array(checks, pa.int64()),
                    ],
                    names=["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = stage(
        files.mapInArrow(_documents, "part long, doc_id long, local_start long, n_tokens long, ids_crc32 long"), "token_rows"
    )
    # One row per partition of the writer: a bounded table.
    before = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).selectExpr(
        "part", "sum(tokens) OVER (ORDER BY part) - tokens AS before"
    )
    return rows.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op10_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's ids by byte_bpe_50k.json written to files and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    path = stage_path(spark, "token-files")
    write_token_files(docs, path, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)
