"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept and returns the columns of ``documents``
(``doc_id text lang source n_chars``; ``n_chars`` follows the text); the last returns tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.llm import decontaminate, line_dedup, ngram_join, quality_rules, sentence_pieces
from plantmetrics.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines the rules remove."""
    docs = docs.select(*COLUMNS)
    return quality_rules.clean(docs, quality_rules.quality_rules(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a line stays only in the first document that holds it."""
    done = line_dedup.line_dedup(docs.select(*COLUMNS))
    return done.select("doc_id", F.col("line_dedup.kept").alias("text"), "lang", "source",
                       F.length("line_dedup.kept").cast("long").alias("n_chars"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the lowest id, of each class of near-duplicates."""
    docs = docs.select(*COLUMNS)
    return ngram_join.keep_one(docs, ngram_join.similar_documents(docs))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, the bytes each piece covers, and the decoded text."""
    return sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("n-gram Jaccard join", near_duplicate_stage),
          ("benchmark decontamination", benchmark_stage), ("SentencePiece encoding", piece_stage)]

#: Connected classes of near-duplicates and piece ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written once before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
