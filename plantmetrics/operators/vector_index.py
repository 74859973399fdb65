"""A persisted vector index for exact cosine top-k: clustered lists with centre and radius.

``build`` clusters the patterns' directions and writes two tables: ``rows``, the patterns split by list,
and ``lists``, one row a list with its centre, the least cosine of a member to the centre (its radius)
and its size. Centres are fitted on a bounded sample (SAMPLE rows, LISTS centres); every pattern is
indexed, in the list of its nearest centre. Zero vectors, whose cosine is 0 with everything, have a list of
their own. ``add`` puts new patterns into the lists that are there; a list's radius grows with them.

``search`` is exact. By the angle's triangle inequality no member of a list with radius cosine ``f`` can have
a cosine above ``s * f + sqrt(1 - s * s) * sqrt(1 - f * f)`` with a query whose cosine to the centre is ``s < f``.
Each query first reads its best lists until they hold k patterns; the k-th similarity found there is a
floor that only lists with a bound of as much or more can change. Those are read in a second pass, all
others are skipped: folders of lists that no query of the chunk wants are not opened at all.

Queries go in chunks of bounded bytes, one after the other: a chunk is broadcast, searched, merged and
stored before the next one is fetched. Candidates are merged in two levels, tasks to GROUPS groups and
groups to the result, so the last window reads k * GROUPS rows a query at most, whatever the number of
tasks. ``skipped`` tells which share of the (query, pattern) pairs was never compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantmetrics.plans import versions
from plantmetrics.session import ensure_checkpoint_dir

LISTS, SAMPLE, ROUNDS = 256, 20_000, 8
#: Sample rows a list is fitted on at least; small stores have fewer lists.
LIST_ROWS = 256
QUERY_BYTES = 64 * 1024 * 1024
GROUPS = 64
#: Similarities are compared as whole billionths; a bound is widened by so many.
SLACK = 4
ZERO_LIST, NO_LIST = -1, -2


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit rows of a column of equally long lists; zero vectors stay zero."""
    flat = np.asarray(pc.list_flatten(vectors), dtype=np.float64)
    mat = flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))
    norms = np.linalg.norm(mat, axis=1, keepdims=True)
    return np.divide(mat, norms, out=np.zeros_like(mat), where=norms > 0)


def fit_centres(patterns: DataFrame, lists: int = LISTS, sample: int = SAMPLE, list_rows: int = LIST_ROWS,
                rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means on a bounded sample (the least hashes of ``pattern_id``)."""
    table = patterns.where("embedding is not null").select("embedding", F.xxhash64("pattern_id").alias("h")).orderBy("h").limit(sample).toArrow()
    x = unit_rows(table.column("embedding"))
    x = x[x.any(1)]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    k = max(1, min(lists, len(x) // list_rows))
    # spread the first centres: each next one is the sample row least covered by those before
    chosen, cover = [0], x @ x[0]
    for _ in range(k - 1):
        chosen.append(int(cover.argmin()))
        cover = np.maximum(cover, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.where(norms > 1e-12, norms, 1), centres)
    return centres


def _assign(centres: np.ndarray):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = unit_rows(b.column("embedding"))
            zero = ~x.any(1)
            sims = x @ centres.T if len(centres) else np.zeros((len(x), 1))
            own, best = sims.argmax(1), sims.max(1)
            yield b.append_column("list_id", pa.array(np.where(zero, ZERO_LIST, own), pa.int32())).append_column(
                "to_centre", pa.array(np.where(zero, 0.0, best)))
    return run


def _write(patterns: DataFrame, path: str, centres: np.ndarray, before: DataFrame | None) -> None:
    """A new version with the rows of ``patterns`` and the lists as they are with them."""
    spark = patterns.sparkSession
    patterns = patterns.where("embedding is not null").withColumn("embedding", F.col("embedding").cast("array<double>"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in patterns.schema.fields) + ", list_id int, to_centre double"

    def write(target: str) -> None:
        rows = patterns.mapInArrow(_assign(centres), schema)
        rows.hint("rebalance", F.col("list_id")).write.partitionBy("list_id").parquet(f"{target}/kind=rows")
        # a list without rows tells readers the columns when there are no others
        rows.where("false").drop("list_id").write.parquet(f"{target}/kind=rows/list_id={NO_LIST}")
        stored = spark.read.schema(rows.schema).parquet(f"{target}/kind=rows")
        sizes = stored.groupBy("list_id").agg(F.min("to_centre").alias("radius_cos"), F.count(F.lit(1)).alias("n"))
        if before is not None:
            sizes = sizes.unionByName(before.select("list_id", "radius_cos", "n")).groupBy("list_id").agg(
                F.min("radius_cos").alias("radius_cos"), F.sum("n").alias("n"))
        known = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "list_id int, centre array<double>")
        # a list that is still empty keeps its centre
        lists = sizes.join(known, "list_id", "full").select("list_id", F.coalesce("radius_cos", F.lit(1.0)).alias("radius_cos"),
                                                            F.coalesce("n", F.lit(0).cast("long")).alias("n"), "centre")
        lists.coalesce(1).write.parquet(f"{target}/kind=lists")

    versions.write_version(spark, path, write, append=before is not None)


def build(patterns: DataFrame, path: str, lists: int = LISTS, sample: int = SAMPLE, list_rows: int = LIST_ROWS) -> None:
    """Write the index of ``patterns`` (with ``pattern_id``, ``embedding`` and payload) under ``path``, in place of what was there."""
    _write(patterns, path, fit_centres(patterns, lists, sample, list_rows), None)


def add(patterns: DataFrame, path: str) -> None:
    """Add new patterns to the lists of the index: their rows are written, the rows that are there stay where they are."""
    lists = _lists(patterns.sparkSession, path)
    rows = [r.centre for r in lists.orderBy("list_id").collect() if r.centre is not None]
    if not rows:      # built without any direction to go by
        held = _rows(patterns.sparkSession, path).drop("list_id", "to_centre")
        build(held.unionByName(patterns.select(*held.columns)).checkpoint(), path)
        return
    _write(patterns, path, np.array(rows, dtype=np.float64), lists)


def _lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{versions.folders(spark, path)[-1]}/kind=lists")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    parts = [f"{f}/kind=rows" for f in versions.folders(spark, path)]
    return spark.read.option("basePath", path).parquet(*parts).drop("v", "kind")


class Index:
    """The current version of an index."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.rows = _rows(spark, path)
        # bounded: one row a list
        table = _lists(spark, path).where("n > 0").orderBy("list_id").collect()
        self.ids = np.array([r.list_id for r in table], dtype=np.int64)
        self.sizes = np.array([r.n for r in table], dtype=np.int64)
        self.radius = np.clip(np.array([r.radius_cos for r in table], dtype=np.float64), -1, 1)
        dims = max((len(r.centre) for r in table if r.centre is not None), default=1)
        self.centres = np.array([r.centre or [0.0] * dims for r in table], dtype=np.float64).reshape(-1, dims)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The most that a member of each list can score with each query, in billionths."""
        if not len(self.ids):
            return np.zeros((len(q), 0), dtype=np.int64)
        if self.centres.shape[1] != q.shape[1]:      # zero vectors only
            return np.zeros((len(q), len(self.ids)), dtype=np.int64) + SLACK
        s = np.clip(q @ self.centres.T, -1, 1)
        far = s * self.radius + np.sqrt((1 - s * s) * (1 - self.radius * self.radius))
        most = np.where(s >= self.radius, 1.0, far)
        most[:, self.ids == ZERO_LIST] = 0.0
        most[~q.any(1)] = 0.0
        return np.ceil(most * 1e9).astype(np.int64) + SLACK


#: Queries and patterns that are scored at once.
TILE = 2048, 1024
#: Below every key that a similarity can have.
LOWEST = np.iinfo(np.int64).min


class Best:
    """The k best patterns so far of each query, and the payload rows they point to.

    Similarities are compared as whole billionths, ties go to the lower id. A tile is scored in single precision
    first; only cells that reach a query's k-th similarity so far (less ``slack``, twice what single precision can
    be off by) are scored exactly. ``least`` holds keys that the k-th best is known to reach. State: k rows a query."""

    def __init__(self, q: np.ndarray, k: int, least: np.ndarray | None = None) -> None:
        self.q, self.q32, self.k, self.pay, self.base = q, q.astype(np.float32), k, None, 0
        self.keys = np.full((len(q), k), LOWEST)
        self.ids, self.refs = np.zeros((len(q), k), dtype=np.int64), np.full((len(q), k), -1)
        self.sims = np.zeros((len(q), k))
        self.least = np.full(len(q), LOWEST) if least is None else least
        self.slack = (q.shape[1] + 4) * 2.0**-22 + 4e-9

    def _exact(self, rows: np.ndarray, x: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarities of pairs and their keys, in pieces of bounded size."""
        step = max(1, (1 << 22) // self.q.shape[1])
        sims = [np.einsum("ij,ij->i", self.q[rows[s:s + step]], x[cols[s:s + step]]) for s in range(0, len(rows), step)]
        out = np.concatenate(sims) if sims else np.zeros(0)
        return out, np.rint(out * 1e9).astype(np.int64)

    def _tile(self, some: np.ndarray, x: np.ndarray, x32: np.ndarray, pids: np.ndarray, refs: np.ndarray) -> None:
        k, m = self.k, len(x)
        sims = self.q32[some] @ x32.T
        known = np.maximum(self.keys[some, -1], self.least[some])
        fresh = np.flatnonzero(known == LOWEST)
        if len(fresh) and m >= k:      # any k patterns give a first floor
            near = np.argpartition(-sims[fresh], k - 1, axis=1)[:, :k]
            known[fresh] = self._exact(np.repeat(some[fresh], k), x, near.ravel())[1].reshape(-1, k).min(axis=1)
        floor = (known / 1e9 - self.slack).astype(np.float32)
        asking = np.flatnonzero(~(sims.max(axis=1) < floor))      # most queries find nothing new in a tile
        row, col = np.divmod(np.flatnonzero(~(sims[asking] < floor[asking, None])), m)
        row = asking[row]
        exact, key = self._exact(some[row], x, col)
        at = some[row]
        last, last_id = self.keys[at, -1], self.ids[at, -1]
        wins = (key >= known[row]) & ((key > last) | ((key == last) & (pids[col] < last_id)) | (self.refs[at, -1] < 0))
        if not wins.any():
            return
        at, key, exact, col = at[wins], key[wins], exact[wins], col[wins]
        old = np.unique(at)
        held = self.refs[old] >= 0
        cols = [np.r_[np.repeat(old, k)[held.ravel()], at], np.r_[self.keys[old][held], key], np.r_[self.ids[old][held], pids[col]],
                np.r_[self.sims[old][held], exact], np.r_[self.refs[old][held], refs[col]]]
        order = np.lexsort((cols[2], -cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        cols, rank = [c[rank < k] for c in cols], rank[rank < k]
        for state, values in zip((self.keys, self.ids, self.sims, self.refs), cols[1:], strict=True):
            state[cols[0], rank] = values

    def offer(self, x: np.ndarray, pids: np.ndarray, refs: np.ndarray, asks: np.ndarray) -> None:
        """Patterns (unit rows, ids, payload rows) for the queries ``asks``."""
        x32 = x.astype(np.float32)
        for p in range(0, len(x), TILE[1]):
            part = slice(p, p + TILE[1])
            for s in range(0, len(asks), TILE[0]):
                self._tile(asks[s:s + TILE[0]], x[part], x32[part], pids[part], refs[part])

    def extend(self, payload: pa.Table) -> np.ndarray:
        """Hold a batch's payload rows; their numbers."""
        self.base = 0 if self.pay is None else len(self.pay)
        self.pay = payload if self.pay is None else pa.concat_tables([self.pay, payload])
        return self.base + np.arange(len(payload))

    def trim(self) -> None:
        """Drop payload rows that are no longer referred to."""
        held = self.refs >= 0
        keep, inverse = np.unique(self.refs[held], return_inverse=True)
        self.pay, self.refs[held] = self.pay.take(keep), inverse.ravel()

    def table(self, names: np.ndarray) -> pa.Table:
        """Payload, ``machine_id``, ``sim`` and ``sim_key`` of all that is held."""
        held = self.refs >= 0
        owner = np.broadcast_to(np.asarray(names)[:, None], held.shape)[held]
        return self.pay.take(self.refs[held]).append_column("machine_id", pa.array(owner, pa.int32())).append_column(
            "sim", pa.array(self.sims[held])).append_column("sim_key", pa.array(self.keys[held])).combine_chunks()


def _scorer(bc, k: int):
    """Per task the k best patterns of each query among the lists that it wants."""
    def run(batches):
        ids, q, wanted, least = bc.value
        best = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).combine_chunks()
            x, pids, lists = unit_rows(t.column("embedding")), t.column("pattern_id").to_numpy(), t.column("list_id").to_numpy()
            best = best or Best(q, k, least)
            refs = best.extend(t.drop_columns(["embedding", "list_id"]))
            for one in np.unique(lists):
                asks, at = wanted.get(int(one)), np.flatnonzero(lists == one)
                if asks is not None:
                    best.offer(x[at], pids[at], refs[at], asks)
            best.trim()
        if best is not None:
            yield from best.table(ids).to_batches()
    return run


def merge_levels(candidates: DataFrame, k: int, groups: int = GROUPS) -> DataFrame:
    """The k best of each query: tasks are merged by group first, so the last window reads k * groups rows a query."""
    order = [F.desc("sim_key"), F.asc("pattern_id")]
    in_group = Window.partitionBy("machine_id", "_group").orderBy(*order)
    some = candidates.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    some = some.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= k).drop("rank", "_group")
    last = Window.partitionBy("machine_id").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def _candidates(index: Index, ids, q, want: np.ndarray, payload: list[str], k: int, least: np.ndarray | None = None):
    """Candidates of one pass and the broadcast they need; ``want`` marks (query, list), ``least`` holds the
    keys that an earlier pass has found k patterns for."""
    lists = np.flatnonzero(want.any(0))
    bc = index.spark.sparkContext.broadcast((ids, q, {int(index.ids[i]): np.flatnonzero(want[:, i]) for i in lists}, least))
    rows = index.rows.where(F.col("list_id").isin([int(index.ids[i]) for i in lists]))
    fields = {f.name: f.dataType.simpleString() for f in index.rows.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in payload) + ", machine_id int, sim double, sim_key bigint"
    return rows.select(*payload, "embedding", "list_id").mapInArrow(_scorer(bc, k), schema), bc


def _search_chunk(index: Index, chunk: DataFrame, payload: list[str], k: int) -> tuple[DataFrame | None, int, int]:
    """Stored top-k of one chunk, and how many (query, pattern) pairs were compared of how many."""
    table = chunk.toArrow()
    if not len(table) or not len(index.ids):
        return None, 0, 0
    ids, q = table.column("machine_id").to_numpy(), unit_rows(table.column("embedding"))
    bound = index.bounds(q)
    # the best lists of each query until they hold k patterns
    order = np.argsort(-bound, axis=1, kind="stable")
    before = np.cumsum(index.sizes[order], axis=1) - index.sizes[order]
    probe = np.zeros(bound.shape, dtype=bool)
    np.put_along_axis(probe, order, before < k, axis=1)
    found, bc = _candidates(index, ids, q, probe, payload, k)
    first = merge_levels(found, k).drop("rank").checkpoint()
    bc.destroy()
    # k numbers a query of the chunk
    floors = {r.machine_id: r.least for r in first.groupBy("machine_id").agg(
        F.min("sim_key").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).collect()}
    floor = np.array([floors.get(int(i), LOWEST) for i in ids], dtype=np.int64)
    more = ~probe & (bound >= floor[:, None])
    compared = int(((probe | more) * index.sizes).sum())
    if not more.any():
        return merge_levels(first, k).checkpoint(), compared, len(ids) * int(index.sizes.sum())
    found, bc = _candidates(index, ids, q, more, payload, k, floor)
    out = merge_levels(first.unionByName(found), k).checkpoint()
    bc.destroy()
    return out, compared, len(ids) * int(index.sizes.sum())


class Found:
    """Result of a search: ``rows`` as of ``retrieval.similar_failures``, and the share of pairs skipped."""

    def __init__(self, rows: DataFrame, compared: int, pairs: int) -> None:
        self.rows, self.compared, self.pairs = rows, compared, pairs
        self.skipped = 1 - compared / pairs if pairs else 0.0


def search(queries: DataFrame, index: Index, k: int = 3, query_bytes: int = QUERY_BYTES) -> Found:
    """The k patterns of the highest cosine for each of ``queries(machine_id, embedding)``; ties go to the lower id."""
    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    payload = [c for c in index.rows.columns if c not in ("machine_id", "embedding", "list_id", "to_centre")]
    queries = queries.select("machine_id", "embedding").where("embedding is not null").checkpoint()
    n, d = queries.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    chunks = max(1, math.ceil(n * (d or 1) * 8 / query_bytes))
    place = F.pmod(F.xxhash64("machine_id"), F.lit(chunks))
    parts = [_search_chunk(index, queries.where(place == c), payload, k) for c in range(chunks)]
    empty = index.rows.select(*payload).where("false").select(
        *payload, F.lit(0).alias("machine_id"), F.lit(0.0).alias("sim"), F.lit(0).cast("long").alias("sim_key"), F.lit(0).alias("rank"))
    rows = None
    for part, _, _ in parts:
        if part is not None:
            rows = part if rows is None else rows.unionByName(part)
    rows = (empty if rows is None else rows).withColumnRenamed("sim", "similarity").drop("sim_key")
    return Found(rows.select("machine_id", "rank", *payload, "similarity"), sum(p[1] for p in parts), sum(p[2] for p in parts))
