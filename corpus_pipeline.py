"""The training-data pipeline: language, exact copies, near copies, benchmark passages, tokens.

Each stage reads all that the stage before kept, written as Parquet; all but the last return the
columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import decontaminate, exact_dedup, jaccard_join, language_id, sentencepieces
from attesta.llm.common import ensure_checkpoint_dir, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language: null texts, texts without a letter and texts that even their best language hardly explains go."""
    return language_id.keep_known(docs, language_id.learn(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    Rows are told by doc_id and text, so that one doc_id with two texts loses only the copy; equal
    rows of one doc_id stay together.
    """
    gone = exact_dedup.exact_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256) == gone["_sha"])
    return docs.join(gone, same, "left_anti").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of five-word shingles (0.8 or more) connect, the least doc_id.

    Exact copies, by contrast, keep the largest doc_id, as that operator's contract has it.
    """
    return jaccard_join.keep_one(docs).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256."""
    return sentencepieces.digests(docs, sentencepieces.default_model())


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what stages hand over lies in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
    return docs


#: Neither cross-parsing, near-duplicate groups nor token ids can be said in SQL.
ORACLE_SQL = None
