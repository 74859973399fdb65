"""The operators over their whole tables: name -> (spark, sf_dir) -> DataFrame.

The operators return texts, spans and bitmaps; these queries turn them into the digest columns
of their contracts. Import errors are not caught here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.llm import chat_format as chat
from plantmetrics.llm import decontaminate as leaks
from plantmetrics.llm import line_dedup as lines
from plantmetrics.llm import filter_audit as audits
from plantmetrics.llm import hard_negatives as hard
from plantmetrics.llm import lm_score as lm
from plantmetrics.llm import minhash_dedup as near
from plantmetrics.llm import ngram_join as ngrams
from plantmetrics.llm import quality_rules as quality
from plantmetrics.llm import secret_scan as secrets
from plantmetrics.llm import sentence_pieces as pieces
from plantmetrics.llm import suffix_dedup as suffixes
from plantmetrics.llm import token_lengths as lengths
from plantmetrics.llm.common import sha, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of 50 words or more that another document holds, and its spans."""
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    span = F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast("string")))
    words = {c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["words"]) for c in ("spans", "later")}
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), words["spans"].alias("repeated_words"),
                        words["later"].alias("later_words"), F.array_join(span, ",").alias("spans"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and link counts of all documents."""
    return ngrams.similar_documents(table(spark, sf_dir, "documents"))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids, decoded text and byte spans."""
    return pieces.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep each line of 10 code points or more in the first document that holds it."""
    done = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", sha(F.col("line_dedup.kept")).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdicts, with lines that too many documents of a host hold removed."""
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left_words")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the items."""
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.leaked_documents(found).select("doc_id", "item_ids", F.round("best", 6).alias("best"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one of control strings; figures read back from the output."""
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.chat_format(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(told).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), sha(F.col("loss_text")).alias("loss_sha256"),
                       "formatted_chars")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and automaton scores of all documents, learned from six sevenths of them."""
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed patterns and random-looking runs in every document."""
    found = secrets.secret_scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 3)
    # expressions, as a lambda's second parameter would be taken for the position in the array
    count = {k: F.expr(f"cast(size(filter(spans, x -> x.kind = {i})) as long)") for i, k in enumerate(secrets.KINDS)}
    return found.select("doc_id", *[count[k].alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        sha(secrets.span_text(base)).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums over the exact histogram of encoded lengths."""
    return lengths.histogram(lengths.counts(table(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the labels of every seventh moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard.hard_negatives(hard.integer_vectors(table(spark, sf_dir, "embeddings"), label=label), F.col("vec_id") % 100 == 0)


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates on four-word shingles, over all documents."""
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in all 120 orders, from a stream over the table's files."""
    return audits.filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_ngram_join, op3_sentence_pieces, op4_line_dedup, op5_quality_rules, op6_decontamination, op7_chat_format, op8_lm_score, op9_secret_scan, op10_token_counts, op11_hard_negatives, op12_minhash_dedup, op13_filter_audit)}
