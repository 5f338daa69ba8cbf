"""A corpus pipeline over ``documents`` from five of the training-data operators.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the rows
they keep with the columns of ``documents``.  Decisions are made per row, so rows with equal or
null ids stay or go each by itself.  Numbers of rows that go are broadcast while there are
few of them, which is checked; beyond that Spark joins by shuffle.

Three of the four filter stages have a row's verdict where its text is, and filter in place.  The
near-duplicate stage numbers the rows of its input by file and place in the file, so every read gives
a row the same number; a table that is no plain Parquet scan is written first.  Only what that
stage removes is joined back to the texts.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from dialstat.llm.bpe import bpe_encode
from dialstat.llm.decontaminate import clean_documents
from dialstat.llm.jaccard_join import jaccard_components
from dialstat.llm.language_id import UNKNOWN, fit_languages, has_letter, predict_languages
from dialstat.llm.quality import judge_quality
from dialstat.llm.sharding import number_rows
from dialstat.llm.staging import rows_within, stage

BROADCAST_IDS = 1_000_000  # 8 MB
BROADCAST_FILES = 1_000_000  # 16 MB
LEAST_SCORE = 0.3  # language scores below are no language that was learned


def _free(name: str, columns: list[str]) -> str:
    """``name``, with underscores until no column has it."""
    while name in columns:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a distinct number for every row, the same in every read, and the number's column.

    Files are numbered in order of their paths and meet their rows by a hash of the path, 16 bytes for
    a file, so up to a million files nothing but the texts' own scan is read.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = stage(docs, "numbered")
    path, row = F.col("_metadata.file_path"), _free("row_number", docs.columns)
    for seed in itertools.count():
        key = F.xxhash64(F.lit(seed), path)
        files = stage(docs.select(key.alias("file_key"), path.alias("file_path")).distinct(), "files")
        if files.groupBy("file_key").count().filter("count > 1").isEmpty():
            break
    files, _ = number_rows(files, "file_path")
    files = stage(files.select("file_key", F.col("row_number").alias("file_number")), "files")
    files = F.broadcast(files) if rows_within(files, BROADCAST_FILES) else files
    own = [_free(n, docs.columns) for n in ("file_key", "file_number", "file_row")]
    placed = docs.select("*", key.alias(own[0]), F.col("_metadata.row_index").alias(own[2]))
    files = files.toDF("key_of_file", own[1])
    number = F.shiftleft(F.col(own[1]), 40) + F.col(own[2])  # 40 bits for a file's rows
    joined = placed.join(files, placed[own[0]] == files["key_of_file"])
    return joined.select(*[placed[c] for c in docs.columns], number.alias(row)), row


def without(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` but for the rows whose ``key`` is in ``gone(key)``."""
    gone = stage(gone.select(F.col(key).alias("gone_key")).distinct(), "gone")
    if rows_within(gone, BROADCAST_IDS):
        gone = F.broadcast(gone)
    return docs.join(gone, docs[key].eqNullSafe(gone["gone_key"]), "left_anti")


def _carried(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The columns of ``docs`` that went along as carried_0, carried_1, ..."""
    return judged.select(*[F.col(f"carried_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return _carried(docs, judge_quality(docs, carry=docs.columns).filter("kept"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network has learned; without a learned language, those
    with a letter."""
    model = fit_languages(docs)
    if not model[0]:
        return docs.filter(has_letter(F.col("text")))
    found = predict_languages(docs, model, carry=docs.columns)
    return _carried(docs, found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: five-word shingles, similarity 0.8 or more; the smallest id, nulls
    last, and of rows with that id the first."""
    columns = docs.columns
    docs, row = numbered(docs)
    rows, _ = jaccard_components(docs, id_col=row, n=5, num=80, den=100)
    rows = stage(rows.select(row, "component_id").join(docs.select(row, "doc_id"), row), "members")
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first"))
    kept = first.select(F.col("first")[row].alias(row))
    return without(docs, rows.join(kept, row, "left_anti"), row).select(*columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % stands in benchmark windows."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return clean_documents(docs, benchmark)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their count."""
    encoded = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained network is beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
