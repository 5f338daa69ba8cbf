"""Language identification by a byte convolutional network (operator 9).

A window of ``WINDOW`` bytes is read through byte embeddings and filters of widths 2, 3 and 4;
each filter keeps its largest response in the window and a softmax over the learned languages
follows.  The network is trained in numpy with Adam, in ``STEPS`` steps or one pass over the
sample, whichever is longer.

Learning uses a bounded sample: of each language's learnable rows, the ``per_language`` ones with
the smallest hash of their id, and of each of these up to ``WINDOWS_PER_TEXT`` windows spread
over the whole text.  Language, source and id are no inputs of the network.

Prediction covers whole texts: windows that overlap by three bytes, so no byte run of a filter's
width is lost at a seam.  A text's probabilities are its windows' means, weighted by bytes.  For
prediction the filters are tables over byte pairs (embedding and filter weights are linear), so a
position costs two table reads.

Defined results for odd rows: a null text, a text without a letter and any text when nothing
could be learned are ``und`` with score 0; a null id is held out of learning; ids may repeat.
More than ``MOST_LANGUAGES`` labels are an error.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm import bytescan as B
from dialstat.llm.staging import rows_within
from dialstat.operators.ranking import top_n_per_group, within_cutoffs

WINDOW = 256
STEP = WINDOW - 3
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
PER_LANGUAGE = 400  # sampled rows of each language
WINDOWS_PER_TEXT = 6
BROADCAST_ROWS = 1_000_000
STEPS, BATCH, RATE = 900, 64, 0.004
MOST_LANGUAGES = 500  # the sample of each is 600 KB on the driver
UNKNOWN = "und"


def cut_windows(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as rows of bytes padded with 0, the row of each, its bytes) of all texts."""
    sizes = np.diff(bounds)
    many = np.where(sizes > 0, np.maximum(1, -(-(sizes - 3) // STEP)), 0)
    row = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    starts = bounds[:-1][row] + nth * STEP
    left = np.minimum(bounds[1:][row] - starts, WINDOW)
    at = starts[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < left[:, None]
    padded = raw if len(raw) else np.zeros(1, np.uint8)
    return np.where(inside, padded[np.minimum(at, len(padded) - 1)], 0).astype(np.uint8), row, left


class Network:
    """The byte convolutional network; parameters are a dict of float32 arrays."""

    def __init__(self, classes: int, seed: int):
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"embedding": normal(0.5, 256, EMBEDDING)}
        for w in WIDTHS:
            self.p[f"filter{w}"] = normal((w * EMBEDDING) ** -0.5, w * EMBEDDING, FILTERS)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.p["dense"] = normal(0.1, FILTERS * len(WIDTHS), classes)
        self.p["offset"] = np.zeros(classes, np.float32)

    def _forward(self, x: np.ndarray):
        p, size = self.p, x.shape[1]
        vectors = p["embedding"][x]
        pooled, places = [], []
        for w in WIDTHS:
            stretch = np.concatenate([vectors[:, o : size - w + 1 + o] for o in range(w)], axis=2)
            response = stretch @ p[f"filter{w}"]
            where = response.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(response, where[:, None], 1)[:, 0] + p[f"bias{w}"], 0))
            places.append(where)
        return vectors, np.concatenate(pooled, 1), places

    @staticmethod
    def softmax(logits: np.ndarray) -> np.ndarray:
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        vectors, pooled, places = self._forward(x)
        wrong = self.softmax(pooled @ p["dense"] + p["offset"])
        wrong[np.arange(n), y] -= 1
        wrong /= n
        g = {"dense": pooled.T @ wrong, "offset": wrong.sum(0), "embedding": np.zeros_like(p["embedding"])}
        back = (wrong @ p["dense"].T) * (pooled > 0)
        rows = np.arange(n)[:, None]
        for k, w in enumerate(WIDTHS):
            own, where = back[:, k * FILTERS : (k + 1) * FILTERS], places[k]
            # only a filter's best place in each window gets a gradient
            stretch = np.concatenate([vectors[rows, where + o] for o in range(w)], axis=2)  # n, filters, w*emb
            g[f"filter{w}"] = np.einsum("nfe,nf->ef", stretch, own)
            g[f"bias{w}"] = own.sum(0)
            for o in range(w):
                part = p[f"filter{w}"][o * EMBEDDING : (o + 1) * EMBEDDING]
                np.add.at(g["embedding"], x[rows, where + o], own[:, :, None] * part.T[None])
        return g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int) -> None:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = np.zeros(0, dtype=np.int64)
        for step in range(1, max(STEPS, -(-len(x) // BATCH)) + 1):
            if len(order) < BATCH:  # the rows again and again, in a new order each time
                order = np.concatenate([order, rng.permutation(len(x))])
            part, order = order[:BATCH], order[BATCH:]
            for k, g in self.gradients(x[part], y[part]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                self.p[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)


class Predictor:
    """Window probabilities from tables over byte pairs."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        single = {
            w: [p["embedding"] @ p[f"filter{w}"][o * EMBEDDING : (o + 1) * EMBEDDING] for o in range(w)] for w in WIDTHS
        }
        pair = lambda a, b: (a[:, None] + b[None, :]).reshape(65536, FILTERS)
        # first pair of every width; then what the widths 3 and 4 add two bytes later
        self.here = np.concatenate([pair(single[w][0], single[w][1]) for w in WIDTHS], axis=1)
        self.later = np.concatenate([pair(single[3][2], np.zeros_like(single[3][2])), pair(single[4][2], single[4][3])], axis=1)
        self.bias = np.concatenate([p[f"bias{w}"] for w in WIDTHS])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(windows), 64):
            x = windows[lo : lo + 64].astype(np.int32)
            pairs = x[:, :-1] * 256 + x[:, 1:]
            here, later = self.here[pairs], self.later[pairs[:, 2:]]
            best = np.empty((len(x), FILTERS * 3), dtype=np.float32)
            best[:, :FILTERS] = here[:, :, :FILTERS].max(1)
            # width 3 has one place more than width 4: its last byte has no pair of its own
            here[:, :-2, FILTERS:] += later
            best[:, FILTERS:] = here[:, :-2, FILTERS:].max(1)
            last = self.here[pairs[:, -2], FILTERS : 2 * FILTERS] + self.later[x[:, -1] * 256, :FILTERS]
            np.maximum(best[:, FILTERS : 2 * FILTERS], last, out=best[:, FILTERS : 2 * FILTERS])
            pooled = np.maximum(best + self.bias, 0)
            out.append(Network.softmax(pooled @ self.p["dense"] + self.p["offset"]))
        return np.concatenate(out) if out else np.zeros((0, len(self.p["offset"])), np.float32)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, window) of sampled texts: windows spread evenly over each whole text."""
    for batch in batches:
        for lo, hi, raw, bounds in B.chunks(batch.column(1)):
            windows, row, _ = cut_windows(raw, bounds)
            at = np.searchsorted(row, np.arange(hi - lo + 1))
            picked = [np.unique(np.linspace(a, b - 1, min(b - a, WINDOWS_PER_TEXT)).astype(int)) for a, b in zip(at[:-1], at[1:]) if b > a]
            chosen = np.concatenate(picked) if picked else np.zeros(0, int)
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo).take(pa.array(row[chosen])), pa.array([w.tobytes() for w in windows[chosen]], pa.binary())],
                names=["lang", "window"],
            )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, parameters = model.value
        predictor = Predictor(parameters) if languages else None
        for batch in batches:
            texts, letters, carried = batch.column(0), batch.column(1).to_pylist(), batch.columns[2:]
            for lo, hi, raw, bounds in B.chunks(texts):
                named, scores = [UNKNOWN] * (hi - lo), [0.0] * (hi - lo)
                if predictor:
                    windows, row, left = cut_windows(raw, bounds)
                    weighted = predictor.probabilities(windows) * left[:, None]
                    total = np.stack([np.bincount(row, weighted[:, k], minlength=hi - lo) for k in range(len(languages))], 1)
                    share = total / np.maximum(np.diff(bounds), 1)[:, None]
                    share /= np.maximum(share.sum(1, keepdims=True), 1e-12)
                    best = share.argmax(1).tolist()
                    for k in range(hi - lo):
                        if letters[lo + k]:
                            named[k], scores[k] = languages[best[k]], min(1.0, float(share[k, best[k]]))
                yield pa.record_batch(
                    [pa.array(named, pa.string()), pa.array(scores, pa.float64()), *(c.slice(lo, hi - lo) for c in carried)],
                    names=["lang_pred", "score", *batch.schema.names[2:]],
                )

    return run


def fit_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_fold: int = 1,
    per_language: int = PER_LANGUAGE,
    seed: int = 11,
) -> tuple[list[str], dict[str, np.ndarray]]:
    """(languages, parameters) learned from the bounded sample; empty without labelled rows."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == held_fold, F.lit(True))
    learnable = docs.filter(~held & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if learnable.select(lang_col).distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct labels in {lang_col}: languages are expected")
    # The first of each language in order of hash.  Rows beyond a language's cut-off, taken from a
    # histogram of its hashes, leave where they are read; what is left to be ranked is little
    # more than the sample.
    chosen = learnable.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.xxhash64(id_col).bitwiseAND(F.lit((1 << 63) - 1)).alias("hash"),
    )
    chosen = within_cutoffs(chosen, ["lang"], ["hash"], per_language)
    chosen = top_n_per_group(chosen, "lang", ["hash"], per_language, ["doc_id"]).select("doc_id").distinct()
    if rows_within(chosen, BROADCAST_ROWS):
        chosen = F.broadcast(chosen)
    sample = learnable.join(chosen, learnable[id_col] == chosen["doc_id"], "left_semi")
    # An id that occurs again and again still gives one text of each language.
    sample = sample.groupBy(F.col(lang_col).cast("string").alias("lang"), id_col).agg(F.min(text_col).alias("text")).select("lang", "text")
    rows = sample.mapInArrow(_sample_windows, "lang string, window binary").toPandas().sort_values(["lang", "window"])
    languages = sorted(rows["lang"].unique().tolist())
    if not languages:
        return [], {}
    x = np.frombuffer(b"".join(rows["window"]), dtype=np.uint8).reshape(-1, WINDOW)
    y = np.searchsorted(languages, rows["lang"].to_numpy())
    network = Network(len(languages), seed)
    network.train(x, y, seed + 1)
    return languages, network.p


def predict_languages(
    docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]], text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """lang_pred and score of every row, then the ``carry`` columns of ``docs`` as carried_0, ..."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(text_col).cast("string")
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    rows = docs.select(text.alias("text"), has_letter(F.col(text_col)).alias("letter"), *carried)
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    found = rows.mapInArrow(_predict(shared), "lang_pred string, score double" + kinds)
    return found


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_fold: int = 1,
    per_language: int = PER_LANGUAGE,
    seed: int = 11,
) -> DataFrame:
    """One row per document: held_out, lang_pred and score; see the module's notes."""
    model = fit_languages(docs, id_col, text_col, lang_col, folds, held_fold, per_language, seed)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == held_fold, F.lit(True))
    found = predict_languages(docs, model, text_col, [id_col]).withColumnRenamed("carried_0", id_col)
    return found.select(id_col, held.alias("held_out"), "lang_pred", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; those whose crc32 modulo 3 is 1 are held out of learning."""
    return identify_languages(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
