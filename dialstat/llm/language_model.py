"""Language-model scoring (operator 5): a log-bilinear model trained with noise contrast.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; every text ends in one end token.  A
document takes part in learning if crc32 of its id as text modulo 10 is not 0.

Counts.  Every training token is counted (by 64-bit word hash, summed map-side per task, then by
Spark).  N is their number, V the number of distinct ones.

Model.  Output classes are the end token, the most frequent words and, for all rarer words,
``RARE`` classes by a word's last two bytes (endings tell languages and parts of speech apart).  With r a class's vector, c1 and c2 the diagonal position weights and
w1, w2 the two classes before a token (a start symbol before the first), the log-bilinear score
of class w is ``(c1*r[w1] + c2*r[w2]) . r[w] + b[w]``.  A word of a rare class has, within it,
probability (c+0.1)/(N_k + 0.1*(V_k+1)), with the class's own tokens and distinct words and one
unseen word of c = 0: all probabilities after a context sum to one.

Training.  Rows are dealt to shards of about ``SHARD_TOKENS`` tokens and to ``ROUNDS`` rounds by the
hash of their id and text.  In a round every shard runs noise-contrastive estimation (Adagrad steps
in numpy, noise from the class frequencies) over its rows of that round in order of their hash,
starting from the parameters and the Adagrad sums that the round before left; Spark averages what
the shards made of them, weighted by tokens, and sends it to the next round.  So every training
token is learned from once, and the model depends on the rows alone, not on how the input is cut
into partitions.  Between the rounds lies a written table of classes, two bytes a token.

Scoring.  ``exp`` of a bilinear score is a product over the two positions, so the normalisers of
*all* contexts are one matrix product, done once; a token then costs a few table reads.

The most frequent words (at most ``HEAD`` of them, the bound picks the count from which a word
is one of them) go to every task.  The rest of a document's words are joined with the counts by
hash and summed per document: nothing of the corpus's size is broadcast or sent to the driver.

Defined results for odd rows: a null or wordless text is one end token; a null id is held out
(it has no crc32); document rows with equal ids are scored each by itself; without any training
token every count is 0 and all words are unseen.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm import bytescan as B
from dialstat.llm.staging import stage

CLASSES = 1024  # output classes
RARE = 64  # of them, classes of rare words
WIDTH = 16
HEAD = 1 << 18  # words whose counts go to every task: 4 MB
NOISE = 32  # noise classes drawn for each step
SHARD_TOKENS = 4_000_000
ROUNDS = 4
PIECE_TOKENS = 1 << 18  # tokens that a shard learns from at a time; a longer text is cut
STEP_ROWS = 8192
LEARNING_RATE = 0.1
SMOOTH = 0.1
END_HASH = np.int64(-7046029254386353131)  # the end token's key among the word hashes
END = 0  # class numbers: the end token, then the rare classes, then words
FIRST_WORD = 1 + RARE


def class_tokens(raw, bounds, find) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of every token with each row's end token, word hashes, word bounds per row)."""
    words, at = B.lowered_words(raw, bounds, B.SPACED)
    rows = len(bounds) - 1
    out = np.full(len(words) + rows, END, dtype=np.int64)
    place = np.arange(len(words)) + np.repeat(np.arange(rows), np.diff(at))
    own = find(words)
    rare = own < 0
    own[rare] = 1 + B.word_tails(raw, bounds, B.SPACED, RARE)[rare]
    out[place] = own
    return out, words, at


def contexts(classes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token; END also stands for the start of a text."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[0], one[1:] = END, classes[:-1]
    two[:2], two[2:] = END, classes[:-2]
    after = ends[ends < len(classes)]  # first tokens of the rows but for the first
    one[after] = END
    two[after] = END
    second = after + 1
    second = second[(second < len(classes)) & ~np.isin(second, ends)]
    two[second] = END
    return one, two


def _finder(hashes: np.ndarray, values: np.ndarray, missing):
    """Lookup of words in a sorted hash table."""
    order = np.argsort(hashes)
    keys, values = hashes[order], values[order]

    def find(words: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(words), missing)
        at = np.minimum(keys.searchsorted(words), len(keys) - 1)
        return np.where(keys[at] == words, values[at], missing)

    return find


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word hash, count) of a task's training rows, summed over pieces of bounded size."""
    held, size, ends = [], 0, 0

    def flush():
        words, first, codes = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        sums = np.bincount(codes, np.concatenate([h[1] for h in held])).astype(np.int64)
        kinds = np.concatenate([h[2] for h in held])[first].astype(np.int32)
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(sums), pa.array(kinds)], names=["word", "n", "kind"])

    for batch in batches:
        for lo, hi, raw, bounds in B.chunks(batch.column(0)):
            words, _ = B.lowered_words(raw, bounds, B.SPACED)
            codes, keys = pd.factorize(words)
            kinds = np.zeros(len(keys), dtype=np.int64)
            kinds[codes] = B.word_tails(raw, bounds, B.SPACED, RARE)
            held.append((keys, np.bincount(codes, minlength=len(keys)), kinds))
            size += len(keys)
            ends += hi - lo
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()
    if ends:
        end = [pa.array([END_HASH]), pa.array([ends]), pa.array([0], pa.int32())]
        yield pa.record_batch(end, names=["word", "n", "kind"])


def initial(frequencies: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class vectors, position weights, biases) before training."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (len(frequencies), WIDTH)).astype(np.float32)
    weights = np.full((2, WIDTH), 0.5, dtype=np.float32)
    return vectors, weights, np.log(frequencies).astype(np.float32)


class Trainer:
    """Noise-contrastive estimation of the log-bilinear model with Adagrad."""

    def __init__(self, frequencies: np.ndarray, seed: int, state: np.ndarray | None = None):
        self.q = frequencies
        self.r, self.c, self.b = initial(frequencies, seed)
        self.squares = [np.full(x.shape, 1e-2, dtype=np.float32) for x in (self.r, self.c, self.b)]
        if state is not None:
            cuts = np.cumsum([x.size for x in self.parts()])[:-1]
            for x, values in zip(self.parts(), np.split(state, cuts)):
                x[...] = values.reshape(x.shape)
        self.rng = np.random.default_rng(seed + 1)
        self.tokens = 0

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.c, self.b, *self.squares]

    def state(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()]).astype(np.float64)

    def _move(self, k: int, x: np.ndarray, grad: np.ndarray) -> None:
        self.squares[k] += grad * grad
        x += LEARNING_RATE * grad / np.sqrt(self.squares[k])

    def step(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray, times: np.ndarray) -> None:
        """One step over weighted (context, token) rows; the noise is shared by the rows."""
        r1, r2, rw = self.r[w1], self.r[w2], self.r[w]
        noise = self.rng.choice(len(self.q), NOISE, p=self.q)
        rn = self.r[noise]
        context = self.c[0] * r1 + self.c[1] * r2
        log_kq = np.log(NOISE * self.q).astype(np.float32)
        true = (context * rw).sum(1) + self.b[w] - log_kq[w]
        false = context @ rn.T + (self.b[noise] - log_kq[noise])
        scale = (times / times.sum()).astype(np.float32) * np.sqrt(np.float32(len(w)))
        up = scale / (1 + np.exp(np.clip(true, -30, 30)))
        down = -scale[:, None] / (1 + np.exp(np.clip(-false, -30, 30)))
        d_context = up[:, None] * rw + down @ rn
        grad_c = np.stack([(d_context * r1).sum(0), (d_context * r2).sum(0)])
        grad_r = np.zeros_like(self.r)
        for index, rows in ((w1, d_context * self.c[0]), (w2, d_context * self.c[1]), (w, up[:, None] * context)):
            for d in range(WIDTH):
                grad_r[:, d] += np.bincount(index, rows[:, d], minlength=len(self.q))
        np.add.at(grad_r, noise, down.T @ context)
        grad_b = np.bincount(w, up, minlength=len(self.q)).astype(np.float32)
        np.add.at(grad_b, noise, down.sum(0))
        for k, (x, grad) in enumerate(((self.r, grad_r), (self.c, grad_c), (self.b, grad_b))):
            self._move(k, x, grad)
        self.tokens += int(times.sum())

    def learn(self, classes: np.ndarray, ends: np.ndarray) -> None:
        """All tokens of some rows; equal (context, token) rows are one weighted row."""
        one, two = contexts(classes, ends)
        k = len(self.q)
        rows, times = np.unique((one * k + two) * k + classes, return_counts=True)
        order = self.rng.permutation(len(rows))
        rows, times = rows[order], times[order]
        for lo in range(0, len(rows), STEP_ROWS):
            part = rows[lo : lo + STEP_ROWS]
            self.step(part // (k * k), part // k % k, part % k, times[lo : lo + STEP_ROWS])


def _sequences(shared):
    """(hash, text) -> (hash, the text's classes as 16-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = shared.value
        find = _finder(words, np.arange(FIRST_WORD, FIRST_WORD + len(words)), -1)
        for batch in batches:
            for lo, hi, raw, bounds in B.chunks(batch.column(1)):
                classes, _, at = class_tokens(raw, bounds, find)
                cuts = (2 * (at + np.arange(hi - lo + 1))).astype(np.int32)
                data = [None, pa.py_buffer(cuts), pa.py_buffer(classes.astype("<u2"))]
                texts = pa.Array.from_buffers(pa.binary(), hi - lo, data)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), texts], names=["hash", "classes"])

    return run


def _train(shared, model, seed: int):
    """One round: (shard, classes) in order -> sums over the task's shards of tokens x state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, frequencies = shared.value
        total, tokens = 0.0, 0
        trainer, own, held, size = None, None, [], 0

        def learn():
            if held:
                trainer.learn(np.concatenate(held).astype(np.int64), np.cumsum([len(x) for x in held]))
                held.clear()

        def close():
            nonlocal total, tokens
            if trainer is not None:
                learn()
                total, tokens = total + trainer.state() * trainer.tokens, tokens + trainer.tokens

        for batch in batches:
            for shard, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != own:
                    close()
                    trainer, own, size = Trainer(frequencies, seed, model.value), shard, 0
                    trainer.rng = np.random.default_rng([seed, shard])
                classes = np.frombuffer(text.as_buffer(), "<u2")
                for lo in range(0, len(classes), PIECE_TOKENS):
                    part = classes[lo : lo + PIECE_TOKENS]
                    held.append(part)
                    size += len(part)
                    if size >= PIECE_TOKENS:
                        learn()
                        size = 0
        close()
        if tokens:
            yield pa.record_batch(
                [pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), float(tokens)))],
                names=["place", "total", "tokens"],
            )

    return run


def _trained(spark: SparkSession, rows: DataFrame, shared, frequencies: np.ndarray, tokens: int, seed: int):
    """(r, c, b) learned from rows (hash, text) in ROUNDS rounds over all shards."""
    shards = max(1, -(-tokens // SHARD_TOKENS))
    dealt = rows.mapInArrow(_sequences(shared), "hash long, classes binary").select(
        F.pmod("hash", F.lit(shards)).alias("shard"), F.pmod(F.expr(f"hash div {shards}L"), F.lit(ROUNDS)).alias("round"), "hash", "classes"
    )
    order = ["shard", "round", "hash", "classes"]
    # whole shards in order: each is far smaller than a row group, which is read by one task
    dealt = stage(dealt.repartition(shards, "shard").sortWithinPartitions(*order), "shards")
    trainer = Trainer(frequencies, seed)
    state = trainer.state()
    for k in range(ROUNDS):
        model = spark.sparkContext.broadcast(state)
        made = dealt.filter(F.col("round") == k).select("shard", "classes")
        made = made.mapInArrow(_train(shared, model, seed + 1 + k), "place long, total double, tokens double")
        # one row per parameter
        made = made.groupBy("place").agg((F.sum("total") / F.sum("tokens")).alias("value")).toPandas().sort_values("place")
        state = made["value"].to_numpy() if len(made) else state
        model.unpersist()
    trainer = Trainer(frequencies, seed, state)
    return trainer.r, trainer.c, trainer.b


class Scorer:
    """Log10 probabilities of classes after contexts, from the normalisers of all contexts."""

    def __init__(self, r: np.ndarray, c: np.ndarray, b: np.ndarray):
        r, c, b = (x.astype(np.float64) for x in (r, c, b))
        self.first, self.second, self.bias = (r * c[0]) @ r.T, (r * c[1]) @ r.T, b
        # log sum_w exp(first[w1, w] + second[w2, w] + b[w]), as one matrix product
        top1, top2 = self.first.max(1), (self.second + b).max(1)
        mass = np.exp(self.first - top1[:, None]) @ np.exp(self.second + b - top2[:, None]).T
        self.norm = np.log(mass) + top1[:, None] + top2[None, :]
        self.first, self.second, self.norm = (x.astype(np.float32) for x in (self.first, self.second, self.norm))

    def log10(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.first[w1, w] + self.second[w2, w] + self.bias[w] - self.norm[w1, w2]) / np.log(10)


def _score(shared):
    """Per row: tokens, class score and counts of the words that travel with the task; the other
    words as (hash, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, head, counts, rare_logs, model = shared.value
        scorer = Scorer(*model)
        classes_of = _finder(words, np.arange(FIRST_WORD, FIRST_WORD + len(words)), -1)
        count_of = _finder(head, counts, -1)
        for batch in batches:
            for lo, hi, raw, bounds in B.chunks(batch.column(2)):
                classes, hashes, at = class_tokens(raw, bounds, classes_of)
                ends = at[1:] + np.arange(1, hi - lo + 1)
                logs = scorer.log10(*contexts(classes, ends), classes)
                total = np.concatenate([[0.0], np.cumsum(logs)])
                begins = np.concatenate([[0], ends[:-1]])
                counted = count_of(hashes)
                known = np.where(counted >= 0, np.log10(np.maximum(counted, 0) + SMOOTH), 0.0)
                word_class = np.delete(classes, ends - 1)
                is_rare = word_class < FIRST_WORD
                rare = np.where(is_rare, known - rare_logs[np.minimum(word_class, RARE)], 0.0)
                # words outside the head: one (row, word) pair for each, in order of row
                out = np.flatnonzero(counted < 0)
                row_of = np.searchsorted(at, out, side="right") - 1
                pair, times = np.unique(np.rec.fromarrays([row_of, hashes[out]], names="row,word"), return_counts=True)
                cuts = np.searchsorted(pair["row"], np.arange(hi - lo + 1)).astype(np.int32)
                tail = pa.StructArray.from_arrays(
                    [pa.array(pair["word"].view(np.int64)), pa.array(times)], names=["word", "times"]
                )
                sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (known, rare, counted > 0)]
                sums = [x[at[1:]] - x[at[:-1]] for x in sums]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(np.diff(at) + 1),
                        pa.array(total[ends] - total[begins]),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        pa.array(sums[2].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts), tail),
                    ],
                    names=[f.split()[0] for f in _ROW.split(", ")],
                )

    return run


_ROW = (
    "row long, doc_id long, n_tokens long, class_score double, head_log double, head_rare_log double, "
    "head_known long, tail array<struct<word:bigint,times:bigint>>"
)


def _head_threshold(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` words have it or more.

    Counts are grouped by power of two and then, within the group where the bound falls, by
    64ths of it: the driver sees 64 + 64 rows, whatever the vocabulary.
    """
    power = F.floor(F.log2("n"))
    groups = {r[0]: r[1] for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("k")).collect()}
    above = 0
    for p in sorted(groups, reverse=True):
        if above + groups[p] > most:
            low = 1 << p
            step = max(1, low // 64)
            parts = counts.filter(power == p).groupBy(F.floor((F.col("n") - low) / step).alias("s")).count().collect()
            for s, k in sorted(map(tuple, parts), reverse=True):
                if above + k > most:
                    return low + (s + 1) * step
                above += k
            return low
        above += groups[p]
    return 1


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    held_fold: int = 0,
    classes: int = CLASSES,
    head: int = HEAD,
    seed: int = 7,
) -> DataFrame:
    """Base and model log10 probabilities of every document; see the module's notes."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(True))
    training = texts.filter(~held).select("text")
    counts = stage(
        training.mapInArrow(_counts, "word long, n long, kind int")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.first("kind").alias("kind")),
        "counts",
    )
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, vocabulary = int(totals[0]), int(totals[1])
    plain = counts.filter(F.col("word") != F.lit(int(END_HASH)))
    often = plain.filter(F.col("n") >= _head_threshold(plain, head)).toPandas()  # at most ``head`` rows
    often = often.sort_values(["n", "word"], ascending=[False, True])
    hashes, amounts = often["word"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)
    top = max(0, classes - FIRST_WORD)
    named = hashes[:top]
    ends = counts.filter(F.col("word") == F.lit(int(END_HASH))).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    # Tokens and distinct words of the rare classes: all words but the named ones.
    per_kind = plain.groupBy("kind").agg(F.sum("n"), F.count("*")).collect()  # RARE rows at most
    tokens, distinct = np.zeros(RARE), np.zeros(RARE)
    for kind, n, k in per_kind:
        tokens[kind], distinct[kind] = n, k
    kinds = often["kind"].to_numpy()[:top]
    tokens -= np.bincount(kinds, amounts[:top], minlength=RARE)
    distinct -= np.bincount(kinds, minlength=RARE)
    rare_logs = np.concatenate([[0.0], np.log10(tokens + SMOOTH * (distinct + 1))])
    frequencies = np.concatenate([[ends], tokens, amounts[:top]]) + 1.0
    frequencies /= frequencies.sum()

    shared = spark.sparkContext.broadcast((named, frequencies))
    rows = texts.filter(~held).select(F.xxhash64("doc_id", "text").alias("hash"), "text")
    model = _trained(spark, rows, shared, frequencies, n_all, seed)
    table = spark.sparkContext.broadcast((named, hashes, amounts, rare_logs, model))
    scored = stage(
        texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(_score(table), _ROW), "scored"
    )
    tail = (
        scored.select("row", F.inline("tail"))
        .join(plain, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("tail_log"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    zero = F.lit(0.0)
    tail_log = F.coalesce("tail_log", zero)
    base_mass = F.lit(log10(n_all + SMOOTH * (vocabulary + 1)))
    end_log = F.lit(log10(int(ends) + SMOOTH))
    return scored.drop("tail").join(tail, "row", "left").select(
        F.col("doc_id").alias(id_col),
        held.alias("held_out"),
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log + end_log - F.col("n_tokens") * base_mass).alias("base_score"),
        (F.col("class_score") + F.col("head_rare_log") + tail_log).alias("score"),
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; those whose crc32 modulo 10 is 0 are held out of learning."""
    return score_documents(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
