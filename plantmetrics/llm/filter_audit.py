"""Which filter removes what, in every order of five filters, kept up to date from a stream.

The files of a document table are processed as available-now micro-batches. Four filters look at one
text alone and give a mask at once; the fifth fails a document if a smaller id has the same text
anywhere in the table, so its verdict can change when a later file brings that smaller id. Keyed
state holds, for every distinct text, the least id seen so far with its mask, part and labels. When
a smaller id arrives, the mask of the former least one is retracted (-1) and told again with the
fifth bit (+1). What leaves the stream are such signed counts of (part, mask, quality, toxic);
their sums are the part counters, from which all 120 orders follow without touching a document again.

State is kept per bucket of text digests, as one small Arrow table a bucket, in the state store that the
session names (``spark.sql.streaming.stateStore.providerClass``; RocksDB keeps it out of the heap where
texts by the billion need it); buckets grow in number with the table, so that a bucket stays at about
BUCKET_ROWS texts. A text that holds a third
of all rows meets itself inside each Arrow batch before the shuffle: only the least id of a batch goes
on, the others are certain repeats and leave as counts.

Defined cases: a null text is empty, a null ``lang`` the part ``''``; a document without an id can't
be compared, so it never fails E and makes no other fail; rows with one id and one text are all judged
by smaller ids only (they don't fail each other) and each counts; a document without a label is
neither good nor toxic, of several labels of one id any 1 counts; an empty table gives no rows;
only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plantmetrics.llm.common import partitions
from plantmetrics.llm.words import Words, slices
from plantmetrics.session import ensure_checkpoint_dir

FILTERS = "ABCDE"
#: The bit of the fifth filter, the one that depends on other documents.
REPEAT = 16
BUCKET_ROWS, MICRO_BATCHES = 8192, 4

_MARK = np.zeros(256, dtype=bool)
_MARK[np.frombuffer(b"#$%&*|", dtype=np.uint8)] = True

_TOLD = ["part", "mask", "good", "toxic"]
_ROW = "bucket int, key binary, doc_id long, part string, mask int, good int, toxic int, n long"
_DELTA = "part string, mask int, good int, toxic int, n long"


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def text_masks(texts: pa.Array) -> np.ndarray:
    """For each text the bits 1, 2, 4 and 8: it fails filter A, B, C or D."""
    w = Words(texts)
    n = np.diff(w.row)
    distinct = np.zeros(len(n), dtype=np.int64)
    for i in np.flatnonzero(n):
        h = np.sort(w.hash[w.row[i]:w.row[i + 1]])
        distinct[i] = 1 + np.count_nonzero(h[1:] != h[:-1])
    capitals = _per_row((w.raw >= 65) & (w.raw <= 90), w.offsets)
    points = np.diff(w.offsets) - _per_row((w.raw & 0xC0) == 0x80, w.offsets)
    marks = _per_row(_MARK[w.raw], w.offsets)
    failed = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * points, marks > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks and digests in place of texts."""
    for b in batches:
        for part in slices(b):
            keys = [hashlib.sha256(x.as_buffer() if x.is_valid else b"").digest() for x in part.column("text").cast(pa.large_binary())]
            yield pa.record_batch([part.column("doc_id"), part.column("part"), pa.array(text_masks(part.column("text")), pa.int32()),
                                   pa.array(keys, pa.binary())], names=["doc_id", "part", "mask", "key"])


def _labels(labels: DataFrame) -> DataFrame:
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    return labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(one("quality"), one("toxic"))


def judged(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """A row per document, without its text: digest, id, part, mask of the four text filters, labels."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), "text")
    rows = rows.mapInArrow(_judge, "doc_id long, part string, mask int, key binary")
    # ids that are null match nothing; their digest spreads them over the join's partitions
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(F.lit(0).cast("long")))
    known = _labels(labels).withColumn("label_salt", F.lit(0).cast("long"))
    rows = rows.join(known, (F.col("doc_id") == F.col("labelled")) & (F.col("salt") == F.col("label_salt")), "left")
    return rows.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", "doc_id", "part", "mask",
                       F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def _combine(buckets: int):
    """Per Arrow batch: the least id of every text, and counts of the certain repeats (key null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId() % buckets
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            least = t.select(["key", "doc_id"]).group_by("key").aggregate([("doc_id", "min")])
            t = t.join(least, "key").combine_chunks()
            nameless = pc.is_null(t["doc_id"])
            first = pc.fill_null(pc.equal(t["doc_id"], t["doc_id_min"]), False)
            on = t.filter(first).group_by(["bucket", "key", "doc_id", *_TOLD]).aggregate([([], "count_all")]).rename_columns(
                ["bucket", "key", "doc_id", *_TOLD, "n"])
            mask = pc.if_else(nameless, t["mask"], pc.bit_wise_or(t["mask"], pa.scalar(REPEAT, pa.int32())))
            rest = t.set_column(t.column_names.index("mask"), "mask", mask).filter(pc.invert(first))
            rest = rest.group_by(_TOLD).aggregate([([], "count_all")]).rename_columns([*_TOLD, "n"])
            m = rest.num_rows
            rest = rest.append_column("bucket", pa.array([own] * m, pa.int32())).append_column(
                "key", pa.nulls(m, pa.binary())).append_column("doc_id", pa.nulls(m, pa.int64()))
            yield from pa.concat_tables([on, rest.select(on.column_names)]).combine_chunks().to_batches()
    return run


_HELD = ["key", "doc_id", *_TOLD, "n"]


def _load(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas()


def _dump(rows: pd.DataFrame) -> bytes:
    t = pa.Table.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def _update(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Merge a micro-batch into one bucket's least ids; yield signed counts."""
    told = []
    held = _load(state.get[0]) if state.exists else None
    for new in parts:
        counts = new[new["key"].isnull()]
        told.append(counts[[*_TOLD, "n"]])
        new = new[new["key"].notnull()][_HELD].astype({"doc_id": "int64"})
        if not len(new):
            continue
        both = new if held is None else pd.concat([held, new], ignore_index=True)
        fresh = pd.Series(range(len(both)), index=both.index) >= len(both) - len(new)
        top = both["doc_id"] == both.groupby("key")["doc_id"].transform("min")
        # a new least id stands as it is, any other new row repeats it
        told.append(both[fresh & top][[*_TOLD, "n"]])
        later = both[fresh & ~top]
        told.append(later.assign(mask=later["mask"] | REPEAT)[[*_TOLD, "n"]])
        # an earlier least id that is no longer least: take back, tell again as a repeat
        gone = both[~fresh & ~top]
        told.append(gone.assign(n=-gone["n"])[[*_TOLD, "n"]])
        told.append(gone.assign(mask=gone["mask"] | REPEAT)[[*_TOLD, "n"]])
        held = both[top].groupby(_HELD[:-1], as_index=False, sort=False)["n"].sum()
    if held is not None:
        state.update((_dump(held),))
    sums = pd.concat(told).groupby(_TOLD, as_index=False)["n"].sum()
    yield sums[sums["n"] != 0].astype({"mask": "int32", "good": "int32", "toxic": "int32"})


def deltas(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """Signed counts of (part, mask, good, toxic) of a stream of documents."""
    rows = judged(docs, labels, buckets).mapInArrow(_combine(buckets), _ROW)
    return rows.groupBy("bucket").applyInPandasWithState(_update, _DELTA, "held binary", "append", GroupStateTimeout.NoTimeout)


def run_stream(spark: SparkSession, path: str, labels: DataFrame, root: str, buckets: int, files: int) -> None:
    """Process what files of ``path`` are new to the stream stored under ``root`` (a shared folder), at
    most ``files`` a micro-batch. A restart goes on after the last finished micro-batch, and one
    that was broken off is repeated with the state it had (the sink drops its half-written files)."""
    # as a pattern (of one match), since a stream takes a single file only that way
    every = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(every)
    query = (deltas(stream, labels, buckets).writeStream.format("parquet").outputMode("append")
             .option("path", f"{root}/deltas").option("checkpointLocation", f"{root}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def counters(spark: SparkSession, root: str) -> DataFrame:
    """``part, mask, n, good, toxic``: the part counters that all deltas so far add up to."""
    told = spark.read.schema(_DELTA).parquet(f"{root}/deltas").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return told.filter("n > 0")


def audit(counts: DataFrame) -> DataFrame:
    """Every step of every order of the five filters, per part, from the counters alone.

    A part holds at most 32 masks, so its counters are one short array; a step adds up the masks it asks
    for. ``shapley`` is the filter's removals over all orders: of the 120, a document that fails k filters
    is removed by each of them in 120 / k."""
    parts = counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("mask", "n", "good", "toxic"))).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = parts.select("part", "cells", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = {x: F.instr("filter_order", x) for x in FILTERS}
    bit = sum((F.when(at[x] == F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    early = sum((F.when(at[x] < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    rows = rows.withColumn("bit", bit).withColumn("early", early)

    def total(wanted, field=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", wanted), F.lit(0).cast("long"), lambda a, c: a + field(c))

    fails = lambda c: c["mask"].bitwiseAND(F.col("bit")) != 0
    gone = lambda c: c["mask"].bitwiseAND(F.col("early")) != 0
    here = lambda c: fails(c) & ~gone(c)
    size = len(list(permutations(FILTERS)))
    return rows.select(
        "part", "filter_order", "step", total(lambda c: ~fails(c) & ~gone(c)).alias("kept"), total(here).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"), total(lambda c: c["mask"] == F.col("bit")).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"), total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, lambda c: (c["n"] * size / F.bit_count(c["mask"])).cast("long")).alias("shapley"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Stream all files of the document table at ``path`` once and return the audit.

    ``micro_batches`` sets how many files a micro-batch takes, not which: all are processed."""
    table = spark.read.parquet(path)
    buckets = max(4 * partitions(spark), -(-table.count() // bucket_rows))
    files = max(1, -(-len(table.inputFiles()) // micro_batches))
    root = f"{ensure_checkpoint_dir(spark)}/filter_audit-{uuid.uuid4().hex}"
    run_stream(spark, path, labels, root, buckets, files)
    return audit(counters(spark, root))
