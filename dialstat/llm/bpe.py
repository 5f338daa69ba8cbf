"""BPE encoding and decoding in batched numpy merge rounds (operator 7).

The words of a batch lie in one flat array of symbols.  A round looks up every neighbouring pair
by binary search over the sorted pair keys of the merge list, takes each word's lowest rank and
merges its places, leftmost first; words without a mergeable pair leave the array.  A task keeps
the results of the words it has met (up to ``KEPT_WORDS``, then it starts afresh), so a word is
merged once per task.

The words come from the tokenizer file's own rules: special tokens are cut out of the raw text,
the rest is composed (NFC), lower-cased and split into contractions, runs of letters, single
numbers and runs of other characters; white space is dropped and a word's last symbol carries
the end mark.  Decoding joins the tokens by blanks, as a file without a decoder asks for.

Defined results for odd rows: a null or empty text has no tokens (the digests of an empty
string); very long words are merged like any other; ids may be null or repeated, every input row
gives one row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.pretokens import (
    COMPOSED,
    IdPool,
    PieceTable,
    byte_characters,
    code_points,
    joined_lines,
    seal_odd_rows,
    split_words,
    worker_keeps,
)

KEPT_WORDS = 1_000_000  # words whose ids a worker keeps: about 50 MB
GROUP_CHARS = 1 << 20
_NONE = np.int64(1 << 40)  # rank of a pair that does not merge


class MergeTable:
    """Sorted pair keys of a merge list, with each pair's rank and merged id."""

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.merged = merged[order]
        # A merge is made after the merges that form its parts, so merging every place of the
        # lowest rank at once is the same as merging place by place.
        made = {}
        for rank, (a, b) in enumerate(pairs):
            made.setdefault(a + b, rank)
        if any(made.get(a, -1) >= rank or made.get(b, -1) >= rank for rank, (a, b) in enumerate(pairs)):
            raise ValueError("the merge list uses a token before it is made")
        shown = byte_characters()
        self.inner = np.array([vocab[c] for c in shown], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in shown], dtype=np.int64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one array, word bounds) of non-empty words."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.inner[np.frombuffer(b"".join(words), dtype=np.uint8)]
        tails = np.cumsum(lengths) - 1
        symbols[tails] = self.last[np.frombuffer(bytes(w[-1] for w in words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner = [], []
        while len(symbols):
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(self.keys.searchsorted(keys), len(self.keys) - 1)
            hit = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(hit, self.ranks[at], _NONE), _NONE)
            begins = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(symbols)))
            low = np.repeat(lowest, sizes)
            chosen = (rank == low) & (low < _NONE)
            # In a run of one symbol the chosen places overlap: take every other one.
            places = np.flatnonzero(chosen)
            touch = np.concatenate([[False], (np.diff(places) == 1)]) if len(places) else np.zeros(0, bool)
            if touch.any():
                run = np.maximum.accumulate(np.where(touch, 0, np.arange(len(places))))
                places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.merged[at[places]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            still = low < _NONE
            over = keep & ~still
            done_symbols.append(symbols[over])
            done_owner.append(owner[over])
            keep &= still
            symbols, owner = symbols[keep], owner[keep]
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


class WordEncoder:
    """Texts to token ids; a worker keeps the ids of the words that it has met."""

    def __init__(self, source: str):
        spec = json.loads(source)
        self.source = source
        self.table = MergeTable(spec["model"])
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names |= {i: t for t, i in self.special.items()}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], dtype=object)
        self.digits = np.array([str(i) for i in range(len(self.names))], dtype=object)
        self.cut = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self._library = None
        self._clear()

    def _clear(self) -> None:
        self.pieces, self.pool = PieceTable(), IdPool()

    def _odd_ids(self, text: str) -> np.ndarray:
        """Ids of a text that is not served by the vectorised splitter, cut up by the tokenizer
        library's normaliser and splitter."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
            self._bytes = {c: b for b, c in enumerate(byte_characters())}
        out, at = [np.zeros(0, dtype=np.int64)], 0
        for m in [*self.cut.finditer(text), None]:
            plain = text[at : m.start() if m else len(text)]
            split = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(plain)) if plain else []
            words = [bytes(self._bytes[c] for c in shown) for shown, _ in split]
            if words:
                out.append(self.table.encode(words)[0])
            if m:
                out.append(np.array([self.special[m[0]]]))
                at = m.end()
        return np.concatenate(out)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, bounds per text)."""
        if len(self.pieces) > KEPT_WORDS:
            self._clear()
        points, bounds = code_points([t.lower() for t in texts])
        # a capital sigma is lower-cased by its place in the word here, but not by the library
        easy = seal_odd_rows(points, bounds, [self.cut.search(t) is not None or "Σ" in t for t in texts], COMPOSED)
        begin, end = split_words(points)
        numbers, new = self.pieces.number(points, begin, end)
        if len(new):
            text, _ = joined_lines(points, begin[new], end[new])
            ids, cuts = self.table.encode([w.encode("utf-8") for w in text[:-1].split("\n")])
            self.pool.add(ids, np.diff(cuts))
        ids, total = self.pool.gather(numbers)
        at = total[np.searchsorted(begin, bounds)]
        if easy.all():
            return ids, at
        cuts = at.tolist()
        parts = [ids[a:b] if e else self._odd_ids(t) for t, e, a, b in zip(texts, easy.tolist(), cuts, cuts[1:])]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by blanks, as a file without a decoder asks for."""
        return " ".join(self.names[ids].tolist())


_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def text_groups(batch: pa.RecordBatch, column: int, limit: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) groups of a batch near ``limit`` characters; a null text is empty."""
    first, held, size = 0, [], 0
    for row, value in enumerate(batch.column(column)):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield first, held
            first, held, size = row + 1, [], 0
    if held:
        yield first, held


def _digests(source):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_keeps("word encoder", source.value, WordEncoder)
        for batch in batches:
            for first, texts in text_groups(batch, 1):
                ids, cuts = coder.encode(texts)
                sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()
                spans = list(zip(cuts.tolist(), cuts[1:].tolist()))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.diff(cuts)),
                        pa.array([sha(" ".join(coder.digits[ids[a:b]].tolist())) for a, b in spans]),
                        pa.array([sha(coder.decode(ids[a:b])) for a, b in spans]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def _encodings(source):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_keeps("word encoder", source.value, WordEncoder)
        for batch in batches:
            for first, texts in text_groups(batch, 1):
                ids, cuts = coder.encode(texts)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32))),
                        pa.array([coder.decode(ids[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return run


def tokenizer_source(spark: SparkSession, path: str):
    """A tokenizer file (a few MB, checked) for every task."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    if len(source) > 64 << 20:
        raise ValueError(f"{path}: too large for a tokenizer file")
    return spark.sparkContext.broadcast(source)


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded text) of every document."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = texts.mapInArrow(_encodings(tokenizer_source(docs.sparkSession, tokenizer)), "doc_id long, ids array<int>, decoded string")
    return out.withColumnRenamed("doc_id", id_col)


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count and digests of ids and decoded text, without moving the ids themselves."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_digests(tokenizer_source(docs.sparkSession, tokenizer)), _DDL).withColumnRenamed("doc_id", id_col)


def op7_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document encoded with word_bpe_49k.json and decoded again, as digests."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return bpe_digests(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
