"""Quality rules with cross-document line frequency.

Per document: word and symbol counts, repeated lines and repeated 8-word windows. Across
documents: every normalised line (words in lower case, single spaces) is hashed, the distinct
documents of each host that hold it are counted, and a line that more than
``max(min_docs, share * documents of the host)`` of them hold is removed from all but the
lowest id. A document is rejected when the base rules fail or when too little is left of it:
under ``min_words`` words or under ``min_left`` of its words.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a
host of its own; rows with one id are one document where documents are counted, and each
row is judged by itself; a null id counts as the greatest; an empty table gives an empty
result; only the id, the text and the host are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut
from plantmetrics.llm.words import Grams, Words, slices

WINDOW = 8
LAST = 2**63 - 1
#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
MIN_DOCS, SHARE, MIN_WORDS, MIN_LEFT = 10, 0.01, 20, 0.3

_PROFILE = ("doc_id long, host string, version long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, lines array<struct<h: long, n: int>>")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def repeat_words(words: Words) -> np.ndarray:
    """Per row, the words inside WINDOW-word windows that occur twice or more in the row."""
    n = len(words.hash)
    at = np.flatnonzero(np.arange(n) + WINDOW <= words.row_end())
    if not len(at):
        return np.zeros(len(words.row) - 1, dtype=np.int64)
    row = words.row_of_word()[at]
    grams = Grams(words.hash).of(at, at + WINDOW)
    order = np.lexsort((grams, row))
    same = (grams[order][1:] == grams[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order] = np.r_[False, same] | np.r_[same, False]
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + WINDOW, -1)
    return _sums(np.cumsum(step[:n]) > 0, words.row)


def _profile(part: pa.RecordBatch) -> pa.RecordBatch:
    texts = part.column("text")
    exact, folded = Words(texts), Words(texts, fold=True)
    raw, rows = exact.raw, part.num_rows
    points = exact.code_points()
    word_chars = _sums(points[exact.end] - points[exact.start], exact.row)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    n_symbols = _sums(symbol[raw], exact.offsets)
    # lines: one more starts after every newline and at every row's start
    breaks = np.flatnonzero(raw == 10)
    owner = np.searchsorted(exact.offsets, breaks, side="right") - 1
    line_row = np.concatenate([np.arange(rows), owner])
    line_start = np.concatenate([exact.offsets[:-1], breaks + 1])
    line_stop_order = np.lexsort((line_start, line_row))
    line_row, line_start = line_row[line_stop_order], line_start[line_stop_order]
    first, stop = np.searchsorted(exact.start, line_start), None
    next_row = np.r_[line_row[1:] != line_row[:-1], True]
    stop = np.where(next_row, exact.row[line_row + 1], np.r_[first[1:], 0])
    line_end = np.where(next_row, exact.offsets[line_row + 1], np.r_[line_start[1:] - 1, 0])
    has_word = stop > first
    line_row, first, stop, line_start, line_end = (x[has_word] for x in (line_row, first, stop, line_start, line_end))
    keys = Grams(folded.hash).of(first, stop).astype(np.int64)
    dup = np.zeros(len(line_row), dtype=np.int64)
    data, seen, of = raw.tobytes(), set(), -1
    for i, (r, a, b) in enumerate(zip(line_row.tolist(), line_start.tolist(), line_end.tolist(), strict=True)):
        if r != of:
            seen, of = set(), r
        line = data[a:b]
        dup[i] = line in seen
        seen.add(line)
    per_row = np.searchsorted(line_row, np.arange(rows + 1))
    lines = pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(keys), pa.array((stop - first).astype(np.int32))], names=["h", "n"]))
    return pa.record_batch(
        [part.column("doc_id"), part.column("host"), part.column("version"), pa.array(np.diff(exact.row)),
         pa.array(word_chars), pa.array(n_symbols), pa.array(_sums(dup, per_row)), pa.array(repeat_words(exact)), lines],
        names=["doc_id", "host", "version", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in slices(b):
            yield _profile(part)


def profile(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """Base figures of every row, and its lines as (hash of the normalised line, its words)."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                      F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    return own.mapInArrow(_profiles, _PROFILE)


def frequent_lines(profiles: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``host, h, first_doc``: the lines above their host's limit."""
    doc = F.coalesce("doc_id", F.lit(LAST)).alias("doc")
    held = profiles.select("host", doc, F.explode(F.expr("array_distinct(transform(lines, x -> x.h))")).alias("h"))
    held = held.groupBy("host", "h").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("first_doc"))
    hosts = profiles.select("host", doc).groupBy("host").agg(F.count_distinct("doc").alias("host_docs"))
    held = held.filter(F.col("n") > min_docs).alias("l").join(hosts.alias("d"), F.col("l.host").eqNullSafe(F.col("d.host")))
    return held.filter(F.col("n") > share * F.col("host_docs")).select("l.host", "h", "first_doc")


def removed_lines(profiles: DataFrame, frequent: DataFrame) -> DataFrame:
    """``doc, version, removed`` (array of line hashes) of the documents that lose lines."""
    held = profiles.select("host", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "version",
                           F.explode(F.expr("array_distinct(transform(lines, x -> x.h))")).alias("h")).alias("a")
    hit = held.join(frequent.alias("f"), F.col("a.h").eqNullSafe(F.col("f.h")) & F.col("a.host").eqNullSafe(F.col("f.host")))
    hit = hit.filter(F.col("doc") > F.col("first_doc")).select("doc", "version", F.col("a.h").alias("h"))
    return hit.groupBy("doc", "version").agg(F.collect_set("h").alias("removed"))


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, min_words: int = MIN_WORDS,
                  min_left: float = MIN_LEFT, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base figures, ``base_failed``, ``kept``,
    ``n_left_words`` and ``removed`` (hashes of the lines it loses; null if none)."""
    profiles = cut(profile(docs, text, key, host))
    removed = removed_lines(profiles, frequent_lines(profiles, min_docs, share))
    base = profiles.withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    base = base.join(removed, ["doc", "version"], "left")
    left = F.expr("aggregate(filter(lines, x -> removed is null or not array_contains(removed, x.h)), 0L, (s, x) -> s + x.n)")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    enough = (F.col("n_left_words") >= min_words) & (F.col("n_left_words") >= min_left * F.col("n_words"))
    base = base.withColumn("n_left_words", left).withColumn("base_failed", failed)
    return base.select("doc_id", "version", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", (~F.col("base_failed") & enough).alias("kept"), "n_left_words", "removed")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t, gone in zip(b.column("text").to_pylist(), b.column("removed").to_pylist(), strict=True):
            if gone:
                lines, drop = t.split("\n"), set(gone)
                words = Words(pa.array(lines, pa.string()), fold=True)
                hashes = Grams(words.hash).of(words.row[:-1], words.row[1:]).astype(np.int64).tolist()
                t = "\n".join(x for x, h, n in zip(lines, hashes, np.diff(words.row), strict=True) if not n or h not in drop)
            out.append(t)
        i = b.schema.get_field_index("text")
        yield b.set_column(i, "text", pa.array(out, b.schema.field(i).type)).drop_columns(["removed"])


def clean(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents that ``quality_rules`` keeps, without the lines it removes; the columns are
    those of ``documents`` (``doc_id text lang source n_chars``)."""
    keep = verdicts.filter("kept").select(F.coalesce("doc_id", F.lit(LAST)).alias("k_doc"), F.col("version").alias("k_version"),
                                          "removed").dropDuplicates(["k_doc", "k_version"])
    own = docs.select("doc_id", "text", "lang", "source", "n_chars").join(
        keep, (F.coalesce("doc_id", F.lit(LAST)) == F.col("k_doc")) & (F.xxhash64("text") == F.col("k_version")))
    own = own.select("doc_id", "text", "lang", "source", "n_chars", "removed")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return own.mapInArrow(_without, schema).withColumn("n_chars", F.length("text").cast("long"))
