"""Hard negatives by threshold joins over integer vectors.

For every anchor the best rows of its own label are its positives, and each positive opens a window of
scores in which the best rows of other labels are wanted. Both steps are one search: *for each query
the k best rows inside each of its score windows*. It runs as a threshold join with lowered thresholds:

- Dimensions go by falling energy and in steps. A row is entered in the posting lists of its first steps
  only: the remaining ones are left out as soon as the norm of the row's rest times the norm of every
  query's rest stays below that query's threshold, so a row that never shows up cannot reach it.
- Partial scores are summed list by list; after each step a row is dropped when its partial score plus
  the product of the remaining norms stays below the thresholds of all queries that still want it.
- What survives is scored in full. A query whose windows are not full lowers its threshold and asks
  again for the scores between the new and the old one, until its windows are full or it is at their
  lower ends. Windows that earlier rows have filled begin at their k-th best score.

Queries (one row in a hundred, say) and rows are dealt in blocks: a task gets one block of queries and
streams one block of rows past them in pieces of an Arrow batch. It holds the queries, their windows
and one piece, whatever the table's size, and sends on k rows a window at most; the k best of all tasks
are picked per window. Nothing passes through the driver but two counts.

Defined cases: rows without an id, label or vector, or with a component that is null or not finite, take
no part; rows with one id are one row, the least by label and components; a shorter vector counts as
filled up with zeros; an empty table gives no rows; a label without other rows gives no positives, and
a negative positive score an empty window. Scores are exact; one beyond the range of a long is held at its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut, partitions

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Queries of one task, rows of one task, queries scored at once; dimensions of a step.
QUERY_BLOCK, ROW_BLOCK, AT_ONCE, STEP = 16384, 1 << 20, 256, 8
#: How far a threshold has gone down from its window's upper to its lower end at each level.
LEVELS = (0.25, 0.5, 0.75, 1.0)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
_EXACT = 2.0 ** 52


def _suffix_norms(m: np.ndarray) -> np.ndarray:
    """Norms of each row's components from every step on (the last one is 0)."""
    steps = np.add.reduceat(m * m, np.arange(0, m.shape[1], STEP), axis=1)
    return np.sqrt(np.c_[np.cumsum(steps[:, ::-1], axis=1)[:, ::-1], np.zeros(len(m))])


class Rows:
    """One piece of the rows, its dimensions ordered by energy."""

    def __init__(self, m: np.ndarray) -> None:
        self.order = np.argsort(-(m * m).sum(0), kind="stable")
        self.m = m[:, self.order]
        self.norms = _suffix_norms(self.m)
        self.longest = self.norms[:, 0].max(initial=0)


def reaching(rows: Rows, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, row, score) with a score of ``least[query]`` or more, by posting lists of the steps."""
    q = q[:, rows.order]
    rest = _suffix_norms(q)
    steps = rest.shape[1] - 1
    slack = 0.5 + 1e-12 * rest[:, 0].max(initial=0) * rows.longest
    low = least - slack
    with np.errstate(divide="ignore", invalid="ignore"):
        limit = np.where(rest > 0, low[:, None] / rest, np.where(low[:, None] > 0, np.inf, -np.inf)).min(0)
    # steps of each row that are entered: from there on the row's rest can't reach any threshold
    entered = np.minimum((rows.norms >= limit).cumprod(1).sum(1), steps)
    row = np.argsort(-entered, kind="stable")
    row = row[:np.count_nonzero(entered)]
    score = np.zeros((len(q), len(row)))
    found = []

    def finish(row: np.ndarray, score: np.ndarray, s: int) -> None:
        alive = score + rest[:, s][:, None] * rows.norms[row, s] >= low[:, None]
        at, of = np.nonzero(alive)
        if s == steps or not len(at):
            full = score[at, of]
        elif len(at) * 8 > alive.size:
            full = (score + q[:, s * STEP:] @ rows.m[row, s * STEP:].T)[at, of]
        else:
            full = score[at, of] + np.concatenate([
                np.einsum("ij,ij->i", q[at[i:i + 65536], s * STEP:], rows.m[row[of[i:i + 65536]], s * STEP:])
                for i in range(0, len(at), 65536)])
        good = full >= least[at]
        found.append((at[good], row[of[good]], full[good]))

    for s in range(steps):
        n = int(np.searchsorted(-entered[row], -s, side="left"))   # rows in this step's list
        finish(row[n:], score[:, n:], s)
        row, score = row[:n], score[:, :n]
        if not n:
            break
        cols = slice(s * STEP, (s + 1) * STEP)
        score = score + q[:, cols] @ rows.m[row, cols].T
        wanted = (score + rest[:, s + 1][:, None] * rows.norms[row, s + 1] >= low[:, None]).any(0)
        row, score = row[wanted], score[:, wanted]
    else:
        finish(row, score, steps)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2 + (np.zeros(0),)


def _all_pairs(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair, in whole numbers of any size; for vectors whose products doubles can't hold."""
    full = np.clip(q.astype(object) @ x.T.astype(object), LEAST, MOST).astype(np.int64)
    at, of = np.indices(full.shape).reshape(2, -1)
    return at, of, full.ravel()


class Queries:
    """Some queries with their windows and the best rows seen so far."""

    def __init__(self, ids, labels, m, window, low, high, k: int, same: bool) -> None:
        self.ids, self.labels, self.m, self.window, self.low, self.high, self.k, self.same = ids, labels, m, window, low, high, k, same
        self.floats = m.astype(np.float64)
        self.norms = np.linalg.norm(self.floats, axis=1)
        none = np.zeros(0, dtype=np.int64)
        self.best = [none, none, none, none]         # query, window, score, row id
        self.floor = low.copy()                      # k-th best score of a full window, else its lower end
        self.full = np.zeros(low.shape, dtype=bool)

    def absorb(self, at, score, ids) -> None:
        new = [[] for _ in self.best]
        for w in range(self.low.shape[1]):
            on = (score >= self.floor[at, w]) & (score <= self.high[at, w])
            for x, v in zip(new, (at[on], np.full(np.count_nonzero(on), w), score[on], ids[on]), strict=True):
                x.append(v)
        q, w, score, ids = (np.concatenate([b, *n]) for b, n in zip(self.best, new, strict=True))
        # the complement turns the order of whole numbers round, without overflow
        order = np.lexsort((ids, ~score, w, q))
        q, w, score, ids = q[order], w[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (w[1:] != w[:-1])][:len(q)])
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        last = rank == self.k - 1
        self.full[q[last], w[last]] = True
        self.floor[q[last], w[last]] = score[last]
        keep = rank < self.k
        self.best = [q[keep], w[keep], score[keep], ids[keep]]

    def _take(self, at, of, score, ids, labels) -> None:
        same = self.labels[at] == labels[of]
        on = (same & (self.ids[at] != ids[of])) if self.same else ~same
        self.absorb(at[on], score[on].astype(np.int64), ids[of[on]])

    def search(self, rows: Rows | None, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Lower the thresholds over one piece of the rows until every window is full or at its end."""
        if rows is None:
            self._take(*_all_pairs(x, self.m), ids, labels)
            return
        reach = np.ceil(self.norms * rows.longest)[:, None] + 1
        top, end = np.minimum(self.high, reach), np.maximum(self.low, -reach)
        before = np.full(len(self.ids), np.inf)
        open_ = (self.floor <= top) & (end <= top)
        for level in LEVELS:
            goal = np.where(self.full, np.maximum(self.floor, end), np.floor(top - level * (top - end)))
            least = np.where(open_, goal, np.inf).min(1)
            asked = np.flatnonzero(least < before)
            if len(asked):
                at, of, score = reaching(rows, self.floats[asked], least[asked])
                new = score < before[asked[at]]
                self._take(asked[at[new]], of[new], score[new], ids, labels)
                before[asked] = least[asked]
            seen = before[:, None] <= np.where(self.full, np.maximum(self.floor, end), end)
            open_ &= ~seen
            if not open_.any():
                break


def _matrix(vectors: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to one length of ``dims`` or more."""
    sizes = np.asarray(pc.list_value_length(vectors), dtype=np.int64)
    dims = max(dims, int(sizes.max(initial=0)), 1)
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = np.asarray(vectors.flatten(), dtype=np.int64)
    return out


def _queries(t: pa.Table, k: int, same: bool) -> list[Queries]:
    t = t.combine_chunks()
    m = _matrix(t["v"].combine_chunks())
    ids, labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
    lists = [[np.asarray(x, dtype=np.int64) for x in t[c].to_pylist()] for c in ("window", "low", "high")]
    width = max(len(x) for x in lists[0])
    closed = [np.zeros((len(ids), width), dtype=np.int64), np.full((len(ids), width), MOST), np.full((len(ids), width), LEAST)]
    for column, filled in zip(lists, closed, strict=True):
        for i, x in enumerate(column):
            filled[i, :len(x)] = x
    return [Queries(ids[i:i + AT_ONCE], labels[i:i + AT_ONCE], m[i:i + AT_ONCE], *(c[i:i + AT_ONCE] for c in closed), k, same)
            for i in range(0, len(ids), AT_ONCE)]


def _task(k: int, same: bool):
    """Queries come first, then their rows; keep the best rows of every window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, queries = [], None
        for b in batches:
            t = pa.Table.from_batches([b])
            asks = pc.equal(t["kind"], 0)
            if (own := t.filter(asks)).num_rows:
                held.append(own)
            t = t.filter(pc.invert(asks)).combine_chunks()
            if not t.num_rows or not held and queries is None:
                continue
            if queries is None:
                queries, held = _queries(pa.concat_tables(held), k, same), []
            x, ids, labels = _matrix(t["v"].combine_chunks(), queries[0].m.shape[1]), t["vec_id"].to_numpy(), t["label"].to_numpy()
            for q in queries:
                if q.m.shape[1] < x.shape[1]:
                    q.m, q.floats = (np.pad(y, ((0, 0), (0, x.shape[1] - y.shape[1]))) for y in (q.m, q.floats))
            size = np.abs(x.astype(np.float64)).max(initial=0) * x.shape[1]
            rows = Rows(x.astype(np.float64))
            for q in queries:
                q.search(rows if size * np.abs(q.floats).max(initial=0) < _EXACT else None, x, ids, labels)
        for q in queries or []:
            at, w, score, ids = q.best
            yield pa.record_batch([pa.array(q.ids[at]), pa.array(q.window[at, w].astype(np.int32), pa.int32()), pa.array(ids),
                                   pa.array(score)], names=["anchor_id", "window", "vec_id", "score"])
    return run


def best_in_windows(queries: DataFrame, rows: DataFrame, k: int, same: bool, query_block: int = QUERY_BLOCK,
                    row_block: int = ROW_BLOCK) -> DataFrame:
    """``anchor_id, window, rank, vec_id, score``: for every window of ``queries(vec_id, label, v, window, low,
    high)``, the last three arrays, the first ``k`` rows of ``rows(vec_id, label, v)`` by falling score, then id,
    with ``low <= score <= high`` and the query's own label (``same``, itself left out) or another."""
    spark = rows.sparkSession
    nq, n = queries.count(), rows.count()
    across, down = max(1, -(-nq // query_block)), max(partitions(spark), -(-n // row_block))
    place = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asks = queries.select(place(across).alias("across"), every(down).alias("down"), F.lit(0).alias("kind"),
                          "vec_id", "label", "v", "window", "low", "high")
    none = F.lit(None).cast("array<bigint>")
    dealt = asks.unionByName(rows.select(every(across).alias("across"), place(down).alias("down"), F.lit(1).alias("kind"),
                                         "vec_id", "label", "v", none.alias("window"), none.alias("low"), none.alias("high")))
    # one block of queries with one block of rows is one partition
    dealt = dealt.repartitionById(across * down, F.col("across") * down + F.col("down")).sortWithinPartitions("kind")
    found = dealt.mapInArrow(_task(k, same), "anchor_id long, window int, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "anchor_id", "window", "rank", "vec_id", "score")


def integer_vectors(table: DataFrame, scale: int = 256, label: Column | None = None) -> DataFrame:
    """``vec_id, label, v``: rows that take part, their components times ``scale`` rounded down."""
    x = table.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                     F.col("embedding").alias("e"))
    usable = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    x = x.filter("vec_id is not null and label is not null and e is not null").filter(usable)
    x = x.select("vec_id", F.struct("label", F.transform("e", lambda c: F.floor(scale * c.cast("double")).cast("long")).alias("v")).alias("row"))
    return x.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def _share(percent: int, end) -> Column:
    """``percent`` of the score, in whole numbers, towards ``end``."""
    return end(F.col("score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")).cast("long")


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each row of
    ``vectors(vec_id, label, v)`` that meets ``anchors`` and each of its first ``positives`` rows of the same
    label, the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's."""
    vectors = cut(vectors)
    asked = vectors.filter(anchors)
    whole = asked.select("*", *[F.array(F.lit(x).cast("long")).alias(c) for c, x in (("window", 0), ("low", LEAST), ("high", MOST))])
    near = cut(best_in_windows(whole, vectors, positives, True, query_block, row_block).select(
        "anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), "score"))
    ranges = near.filter("score >= 0").select("anchor_id", F.struct(
        F.col("place").cast("long").alias("window"), _share(low, F.ceil).alias("low"), _share(high, F.floor).alias("high")).alias("r"))
    ranges = ranges.groupBy("anchor_id").agg(F.sort_array(F.collect_list("r")).alias("r"))
    asked = asked.join(ranges, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "v", "r.window", "r.low", "r.high")
    found = best_in_windows(asked, vectors, negatives, False, query_block, row_block)
    found = found.select("anchor_id", F.col("window").alias("place"), "rank", F.col("vec_id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    return found.join(near, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score")
