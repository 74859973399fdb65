"""Line deduplication by range-partitioned line hashes.

Every line's key hash is range-partitioned and sorted by document and position, so the first
document that holds a line passes by first and all later lines are dropped as they stream
past. A key is dealt over SALTS slices of its documents; only the lines of each slice's first
document meet once more, under the key alone, to find the first of all. What comes back is,
per document, a sparse bitmap of 64-line words; texts are only read again to apply it.

Defined cases: a null or empty text is one empty line; keys under ``min_chars`` code points
are never dropped; a line repeated inside its first document stays; rows with one id are one
document, each with its own lines; a null id counts as the greatest id; an empty table gives
an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.llm.common import SPACE, fold

SALTS = 32
LAST = 2**63 - 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_bitmaps(docs: DataFrame, min_chars: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``id``, ``version`` (hash of the row's text) and ``words``: array<struct<word, bits>>, where
    bit b of word w is set if line 64 * w + b is dropped; words and documents without a dropped
    line are left out."""
    line = F.posexplode(_lines(F.col(text))).alias("pos", "line")
    lines = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("version"), line)
    norm = fold(F.trim(F.col("line"), F.lit(SPACE)))
    lines = lines.withColumn("norm", norm).filter(F.length("norm") >= min_chars)
    lines = lines.select(F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"),
                         F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"), "id", "version", "pos")
    dealt = lines.repartitionByRange("h1", "h2", "salt")
    slice_order = Window.partitionBy("h1", "h2", "salt").orderBy("id", "version", "pos")
    dealt = dealt.withColumn("first", F.first("id").over(slice_order))
    late = dealt.filter(F.col("id") > F.col("first")).select("id", "version", "pos")
    heads = dealt.filter(F.col("id") == F.col("first")).drop("first")
    heads = heads.withColumn("first", F.min("id").over(Window.partitionBy("h1", "h2")))
    late = late.unionByName(heads.filter(F.col("id") > F.col("first")).select("id", "version", "pos"))
    bit = F.expr("shiftleft(1L, cast(pmod(pos, 64) as int))")
    words = late.groupBy("id", "version", F.expr("cast(pos div 64 as int)").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("id", "version").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with ``line_dedup``: struct<n_lines, n_dropped, kept>, ``kept`` being
    the text that is left. No row is lost."""
    own = docs.select("*", F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("__id"), F.xxhash64(text).alias("__version"))
    marks = bitmaps.select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("words").alias("__words"))
    own = own.join(marks, ["__id", "__version"], "left")
    lines = _lines(F.col(text))
    dropped = F.expr("flatten(transform(__words, w -> filter(sequence(w.word * 64, w.word * 64 + 63),"
                     " p -> shiftrightunsigned(w.bits, p - w.word * 64) & 1L = 1L)))")
    own = own.withColumn("__lines", lines).withColumn("__dropped", dropped)
    kept = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __dropped), i -> __lines[i]), '\\n')")
    done = F.struct(F.size("__lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("__dropped").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(kept).alias("kept"))
    return own.select(*[F.col(f"`{c}`") for c in docs.columns], done.alias("line_dedup"))


def line_dedup(docs: DataFrame, min_chars: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``line_dedup``: the lines kept after later holders of a line lose it."""
    return apply_bitmaps(docs, dropped_bitmaps(docs, min_chars, text, key), text, key)
