"""Token counts by an exact length histogram.

Documents are encoded once, each becomes its token count, and everything else is answered
from the histogram of counts: suffix sums over the distinct lengths give, for any context
limit, how many documents reach it and how many tokens a truncation there keeps.

Defined cases: a null or empty text has 0 tokens; every row counts, repeated rows and rows
with a null id too; an empty table gives an empty histogram; only ``text`` is read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths per block of the two-level suffix sums.
BLOCK = 4096


def counts(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """One ``n_tokens`` per row of ``docs``: its text in the byte-pair ranks of ``rank_file``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for b in batches:
            n = [len(encode(t.as_py() or "")) for t in b.column(0)]
            yield pa.record_batch([pa.array(n, pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct ``n_tokens`` L: ``n_docs`` of that length, ``docs_at_least`` (length
    >= L), ``tokens_at_least`` (their tokens), ``tokens_total`` of all, and ``truncated_total``
    (tokens kept when every document is cut to L).

    Counts are combined before the shuffle. The suffix sums run inside blocks of lengths, in
    parallel, and once over the block totals (longest length / BLOCK rows).
    """
    hist = (lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
            .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)))
    from_end = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(from_end), F.lit(0)).alias("docs_after"),
                           F.coalesce(F.sum("t").over(from_end), F.lit(0)).alias("tokens_after"),
                           F.sum("t").over(Window.orderBy(F.col("block").desc()).rowsBetween(
                               Window.unboundedPreceding, Window.unboundedFollowing)).alias("tokens_total"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = hist.join(blocks, "block")
    joined = joined.select(
        "n_tokens", "n_docs", "tokens_total",
        (F.col("docs_after") + F.sum("n_docs").over(inside)).alias("docs_at_least"),
        (F.col("tokens_after") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)).alias("tokens_at_least"))
    kept = F.col("tokens_total") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return joined.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "tokens_total",
                         kept.alias("truncated_total"))


def truncated_total(hist: DataFrame, limits: DataFrame) -> DataFrame:
    """``limits(context_limit)`` with ``kept_tokens``: the tokens left when all documents are cut
    there, from the first distinct length at or above the limit."""
    limits = limits.select("context_limit").distinct()
    above = (limits.join(hist, F.col("n_tokens") >= F.col("context_limit"), "left").groupBy("context_limit")
             .agg(F.min_by(F.struct("docs_at_least", "tokens_at_least"), "n_tokens").alias("s")))
    total = hist.select(F.max("tokens_total").alias("all_tokens"))
    kept = F.col("all_tokens") - F.coalesce("s.tokens_at_least", F.lit(0)) + F.col("context_limit") * F.coalesce(
        "s.docs_at_least", F.lit(0))
    return above.join(F.broadcast(total), F.lit(True), "left").select(
        "context_limit", F.coalesce(kept, F.lit(0)).alias("kept_tokens"))


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """One row, ``n_tokens``: the smallest length with at least a share ``q`` of the documents
    at or below it (null for an empty histogram)."""
    total = hist.agg(F.sum("n_docs").alias("all_docs"))
    below = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return hist.join(F.broadcast(total), F.lit(True)).filter(below >= F.lit(q) * F.col("all_docs")).agg(
        F.min("n_tokens").alias("n_tokens"))
