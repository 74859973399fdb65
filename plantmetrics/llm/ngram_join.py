"""N-gram Jaccard self-join by banded MinHash.

Every text becomes the set of its five-word shingles; texts with one and the same set are one
representative with a count of copies. Each has TREES bands of MinHash values,
each folded into one hash: representatives with an equal band meet. A band is shortened
from DEPTH values until ``1 - (1 - similarity ** depth) ** TREES``, the chance that a pair just as
similar as asked meets in some band, reaches the target recall. Verification is exact: shingle
sets of representatives that the bands connect are intersected and counted.

Pairs are never written out. A connected group is dealt into blocks of bounded size by hash,
each pair of blocks is one task's work, and what leaves it is a row per representative: how
many documents it is linked with, and one edge to a local root that keeps the class connected.
So the links of a huge group are counted in full, while rows stay in proportion to documents
times blocks. (A group of m texts that differ has m * m / 2 links; counting them exactly is
quadratic work, spread over (m / BLOCK_ROWS) ** 2 / 2 tasks.)

Words are runs of non-white-space with A-Z in lower case. Defined cases: a text of one to
four words has one shingle, all its words; an empty or null text has no shingle, no links and
its own class; rows with one id are one document, rows without an id are left out; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut
from plantmetrics.llm.components import components
from plantmetrics.llm.words import Grams, U, Words, mix, slices

SHINGLE, SIMILARITY = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Bounds of a block: rows, and shingles of all its rows together.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1_000_000


def prefix_depth(similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, from ``depth`` down, at which the forest reaches the recall."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and where each row's begin (one more entry)."""
    words = Words(texts, fold=True)
    n = len(words.hash)
    end = words.row_end()
    begin = np.repeat(words.row[:-1], np.diff(words.row))
    at = np.flatnonzero((np.arange(n) + SHINGLE <= end) | (np.arange(n) == begin))
    row = words.row_of_word()[at]
    hashes = Grams(words.hash).of(at, np.minimum(at + SHINGLE, end[at]))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])][:len(hashes)]
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(words.row)))


def _set_keys(hashes: np.ndarray, bounds: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that know a set, whatever the order of its members."""
    out = []
    for salt in (U(1), U(2)):
        sums = np.zeros(len(bounds) - 1, dtype=U)
        sums[filled] = np.add.reduceat(mix(hashes + salt), bounds[:-1][filled])
        out.append(mix(sums + np.diff(bounds).astype(U)).view(np.int64))
    return out[0], out[1]


def _signatures(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                hashes, bounds = shingle_sets(part.column("text"))
                filled = np.flatnonzero(np.diff(bounds) > 0)
                starts = bounds[:-1][filled]
                keys = np.zeros((len(filled), trees), dtype=U)
                with np.errstate(over="ignore"):
                    for f in range(trees * depth if len(filled) else 0):
                        tree, level = divmod(f, depth)
                        # one odd multiplier and one offset for each function
                        value = np.minimum.reduceat((hashes ^ mix(U(2 * f + 1))) * (mix(U(2 * f + 2)) | U(1)) >> U(16), starts)
                        keys[:, tree] = mix(keys[:, tree] * U(31) + value + U(level))
                tree_keys = np.zeros((part.num_rows, trees), dtype=U)
                tree_keys[filled] = keys
                s1, s2 = _set_keys(hashes, bounds, filled)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(s1), pa.array(s2), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * trees),
                                              pa.array(tree_keys.ravel().view(np.int64)))], names=["doc_id", "s1", "s2", "n", "keys"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in slices(b):
            hashes, bounds = shingle_sets(part.column("text"))
            s1, s2 = _set_keys(hashes, bounds, np.flatnonzero(np.diff(bounds) > 0))
            same = (s1 == part.column("s1").to_numpy()) & (s2 == part.column("s2").to_numpy())
            members = pa.array([hashes[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            out = part.drop_columns(["text", "s1", "s2"]).append_column("members", members)
            yield out.filter(pa.array(same))


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[left] with sets[right]."""
    sizes = [len(s) for s in sets]
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    counts = np.bincount(column, minlength=len(values))
    often = counts >= 2
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(often.sum()), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        dense = np.zeros((len(sets), 4096), dtype=np.float32)
        dense[row[a:b], column[a:b] - first] = 1
        out += dense[left] @ dense[right].T
    return out


def _verify(similarity: float):
    def block(ids, copies, sets, side) -> tuple[list, list, list]:
        n = np.array([len(s) for s in sets])
        # side 0: all pairs of one block; else the pairs of a row of side -1 with one of side 1
        left = np.flatnonzero(side <= 0)
        right = left if (side == 0).any() else np.flatnonzero(side > 0)
        shared = _shared(sets, left, right).astype(np.float64)
        linked = shared >= similarity * (n[left][:, None] + n[right][None, :] - shared) - 1e-6
        if right is left:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), dtype=np.int64)
        links[left] += linked.astype(np.float64).dot(copies[right]).astype(np.int64)
        if right is not left:
            links[right] += linked.T.astype(np.float64).dot(copies[left]).astype(np.int64)
        # least id reachable inside the block
        root = ids.copy()
        top = np.iinfo(np.int64).max
        while True:
            new = root.copy()
            new[left] = np.minimum(new[left], np.where(linked, root[right][None, :], top).min(axis=1, initial=top))
            new[right] = np.minimum(new[right], np.where(linked, new[left][:, None], top).min(axis=0, initial=top))
            if (new == root).all():
                break
            root = new
        at = np.flatnonzero(links > 0)
        return ids[at], links[at], root[at]

    def run(table: pa.Table) -> pa.Table:
        comp, side = table.column("comp").to_numpy(), table.column("side").to_numpy()
        order = np.argsort(comp, kind="stable")
        bounds = np.flatnonzero(np.r_[True, comp[order][1:] != comp[order][:-1], True])
        ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        members = table.column("members")
        out = [[], [], []]
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[i:j]
            sets = [np.frombuffer(members[int(k)].as_py(), dtype=U) for k in at]
            for o, x in zip(out, block(ids[at], copies[at], sets, side[at]), strict=True):
                o.append(x)
        cols = [pa.array(np.concatenate(o) if o else np.zeros(0, dtype=np.int64), pa.int64()) for o in out]
        return pa.table(cols, names=["rep", "links", "root"])
    return run


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH,
                      recall: float = RECALL, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` that has an id: ``doc_id``, ``class_id`` (least id of the documents
    connected by links) and ``n_links``, the other documents whose shingle sets have a Jaccard
    similarity of ``similarity`` or more with its own."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    levels = prefix_depth(similarity, trees, depth, recall)
    signed = cut(docs.mapInArrow(_signatures(trees, levels), "doc_id long, s1 long, s2 long, n long, keys array<long>"))
    reps = cut(signed.filter("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.count_distinct("doc_id").alias("copies"), F.first("n").alias("n"),
        F.min(F.struct("doc_id", "keys")).alias("own")).select("s1", "s2", "rep", "copies", "n", "own.keys"))
    nodes = reps.select("rep", F.posexplode("keys").alias("tree", "prefix"))
    met = nodes.groupBy("tree", "prefix").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most")
    edges = nodes.join(met, ["tree", "prefix"]).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    groups = components(edges)
    found = reps.select("rep", "s1", "s2", "copies", "n").join(groups, F.col("rep") == F.col("node")).select(
        "rep", "s1", "s2", "copies", "n", F.col("root").alias("comp"))
    sizes = found.groupBy("comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    found = cut(found.join(sizes.select("comp", blocks.alias("blocks")), "comp"))
    total = found.agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-total // BLOCK_SHINGLES))
    own = docs.join(found.withColumnRenamed("rep", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("rep"), "text", "s1", "s2", "copies", "comp", "blocks")
    own = own.mapInArrow(_sets, "rep long, copies long, comp long, blocks int, members binary").dropDuplicates(["rep", "comp"])
    # a group of one block shares its task with other small groups; a larger one meets block by block
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    dealt = own.withColumn("mine", mine).withColumn("other", other)
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    single = F.col("blocks") == 1
    dealt = dealt.select(
        F.when(single, F.pmod(F.xxhash64("comp"), F.lit(packs))).otherwise(F.col("comp")).alias("pack"),
        F.when(single, -1).otherwise(low).alias("low"), F.when(single, -1).otherwise(high).alias("high"), "comp", "rep", "copies", "members",
        F.when(low == high, 0).when(F.col("mine") == low, -1).otherwise(1).alias("side"))
    proven = cut(dealt.groupBy("pack", "low", "high").applyInArrow(_verify(similarity), "rep long, links long, root long"))
    links = proven.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(proven.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_rep = reps.select("s1", "s2", "rep", "copies").join(links, "rep", "left").join(
        classes.select(F.col("node").alias("rep"), "root"), "rep", "left")
    out = signed.select("doc_id", "s1", "s2", "n").join(of_rep, ["s1", "s2"], "left")
    known = F.col("n") > 0
    return out.select("doc_id", F.when(known, F.coalesce("root", "rep")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.when(known, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their class's least one, and those without an id; of equal
    rows (id and text) one."""
    least = classes.filter("doc_id = class_id").select(F.col("doc_id").alias("__kept")).distinct()
    own = docs.join(least, F.col("doc_id") == F.col("__kept"), "left")
    own = own.filter(F.col("__kept").isNotNull() | F.col("doc_id").isNull()).drop("__kept")
    return own.withColumn("__version", F.xxhash64("text")).dropDuplicates(["doc_id", "__version"]).drop("__version")
