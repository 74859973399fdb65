"""Repeated passages by sparse suffix arrays.

Suffixes are kept where a word run's hash is the least of its neighbourhood (a minimiser of
SEED-word runs over the windows of a passage), so two copies of a passage keep suffixes at the
same words. The kept suffixes are sorted over the whole corpus, by the hash of their first
SEED words and then by the hash of all words that the windows anchored there cover; each is
compared with its neighbours. Equal neighbours repeat the whole anchored run. Neighbours that
share only the first words mark the border of two runs: there the match is extended to the
left and to the right one window at a time, by sorting and comparing the windows themselves.

The result is exact: a word belongs to a repeated span if and only if it lies in a window of
``passage`` words that another document holds too (words compared by 64-bit hashes, windows by
128 bits). Proof sketch: equal windows choose equal anchors at equal places. If the two
anchored runs are equal, sorting puts them side by side. If not, both runs share their first
words but differ, so each stands in a block of equal runs that borders another; the first
document of every such block sends its windows, equal windows meet in the second sort, and the
other members of a block are repeats of the first throughout.

Nothing is grouped by key: both sorts are by range, with the document as the last key, so a
passage that a third of all documents share is spread over many tasks. Neighbours across a
border of two tasks are known from the edge rows of every task (two small rows each).

Words are runs of non-white-space, compared as they stand. Defined cases: a null or empty text
has no spans, nor has one shorter than ``passage`` words; a passage repeated only inside one
document is not reported; rows with one id are one document; rows without an id are left out;
an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut, partitions
from plantmetrics.llm.words import Grams, U, Words, mix, slices

PASSAGE, SEED = 50, 20
#: How a run is known: repeats another document's; repeats one of a lower id; extend it.
REPEATED, LATER, EXTEND = 1, 2, 4


class Anchors:
    """Of one slice of rows: valid windows, and the runs of windows that share an anchor."""

    def __init__(self, texts: pa.Array, passage: int, seed: int) -> None:
        self.words = w = Words(texts)
        self.passage = passage
        self.grams = Grams(w.hash)
        n, span = len(w.hash), passage - seed + 1
        #: Windows by their first word.
        self.window = np.flatnonzero(np.arange(n) + passage <= w.row_end())
        seeds = self.grams.of(np.arange(max(n - seed + 1, 0)), np.arange(max(n - seed + 1, 0)) + seed)
        if len(self.window):
            view = np.lib.stride_tricks.sliding_window_view(seeds, span)
            anchor = np.concatenate([part + view[part].argmin(axis=1) for part in np.array_split(
                self.window, len(self.window) // 100_000 + 1)])
        else:
            anchor = np.zeros(0, dtype=np.int64)
        row = w.row_of_word()[self.window]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])][:len(anchor)]
        self.first = np.flatnonzero(new)                       # index of a run's first window
        self.last = np.r_[self.first[1:], len(anchor)][:len(self.first)] - 1
        a, b = self.window[self.first], self.window[self.last] + passage
        self.row = row[self.first]
        self.seed_hash = seeds[anchor[self.first]] if len(anchor) else np.zeros(0, dtype=U)
        with np.errstate(over="ignore"):
            self.run_hash = mix(self.grams.of(a, b) + (anchor[self.first] - a).astype(U))

    def window_hash(self, index: np.ndarray) -> np.ndarray:
        start = self.window[index]
        return self.grams.of(start, start + self.passage)


def _suffixes(passage: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                a = Anchors(part.column("text"), passage, seed)
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)[a.row]
                order = np.lexsort((a.run_hash, a.seed_hash, doc))
                doc, g, r = doc[order], a.seed_hash[order], a.run_hash[order]
                new = np.r_[True, (doc[1:] != doc[:-1]) | (g[1:] != g[:-1]) | (r[1:] != r[:-1])][:len(doc)]
                yield pa.record_batch([pa.array(g[new].view(np.int64)), pa.array(r[new].view(np.int64)), pa.array(doc[new])],
                                      names=["g", "r", "doc_id"])
    return run


def _sorted(rows: DataFrame, *keys: str) -> tuple[DataFrame, dict]:
    """The rows in global order by ``keys``, fixed by a checkpoint, and for each task's rows the
    row before, the row after, and where its first block of equal leading keys began.

    Collects four numbers for each task's first and last row; nothing grows with the rows."""
    n = partitions(rows.sparkSession)
    done = cut(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        lead, start = None, None    # the current block of equal leading keys, and its first document
        for b in batches:
            if not b.num_rows:
                continue
            k = [b.column(c).to_numpy(zero_copy_only=False) for c in keys]
            new = np.zeros(b.num_rows, dtype=bool)
            for x in k[:-1]:
                new[1:] |= x[1:] != x[:-1]
            new[0] = lead != tuple(x[0] for x in k[:-1])
            if new.any():
                start = int(k[-1][np.flatnonzero(new)[-1]])
            lead = tuple(x[-1] for x in k[:-1])
            part = b.column("part")[0].as_py()
            if first is None:
                first = [int(x[0]) for x in k]
            last = [int(x[-1]) for x in k]
        if first is not None:
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([first], pa.list_(pa.int64())), pa.array([last], pa.list_(pa.int64())),
                                   pa.array([start])], names=["part", "first", "last", "start"])

    got = done.mapInArrow(edges, "part int, first array<long>, last array<long>, start long").orderBy("part").collect()
    near: dict[int, tuple] = {}
    before = block = None
    for i, e in enumerate(got):
        near[e["part"]] = (before, tuple(got[i + 1]["first"]) if i + 1 < len(got) else None, block)
        # the last block began in this task, or before it if the task is one block
        same = before is not None and tuple(e["first"][:-1]) == before[:-1] and tuple(e["first"][:-1]) == tuple(e["last"][:-1])
        block = block if same else e["start"]
        before = tuple(e["last"])
    return done, near


def _neighbours(near: dict, keys: tuple[str, ...]):
    """Streams sorted batches; gives each batch with its key arrays, flags against the row before
    and after (equal on the first j keys), and the first document of each row's block."""
    def walk(batches: Iterator[pa.RecordBatch]):
        held, before, block = None, None, None

        def told(b, after):
            nonlocal before, block
            k = [b.column(c).to_numpy(zero_copy_only=False) for c in keys]
            ahead = [np.r_[x[1:], after[j] if after else 0] for j, x in enumerate(k)]
            behind = [np.r_[before[j] if before else 0, x[:-1]] for j, x in enumerate(k)]
            up, down = np.ones(len(k[0]), dtype=bool), np.ones(len(k[0]), dtype=bool)
            up[-1], down[0] = after is not None, before is not None
            ups, downs = [], []
            for x, a, z in zip(k, ahead, behind, strict=True):
                up, down = up & (x == a), down & (x == z)
                ups.append(up)
                downs.append(down)
            opens = np.flatnonzero(~downs[-2])
            which = np.searchsorted(opens, np.arange(len(k[0])), side="right") - 1
            first = np.where(which >= 0, k[-1][opens[which]] if len(opens) else 0, block if block is not None else 0)
            before, block = tuple(int(x[-1]) for x in k), int(first[-1])
            return k, ups, downs, first

        for b in batches:
            if not b.num_rows:
                continue
            if held is None:
                before, _, block = near[b.column("part")[0].as_py()]
            else:
                yield held, *told(held, tuple(b.column(c)[0].as_py() for c in keys))
            held = b
        if held is not None:
            yield held, *told(held, near[held.column("part")[0].as_py()][1])
    return walk


def _marks(near: dict):
    keys = ("g", "r", "doc_id")
    walk = _neighbours(near, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (g, r, doc), up, down, first in walk(batches):
            # rows of one id may each bring the run; the outer ones then stand beside another document's
            later = down[1] & (first < doc)
            other = later | (up[1] & ~up[2]) | (down[1] & ~down[2])
            kind = np.where(other, REPEATED | np.where(later, LATER, 0), 0)
            # borders of two different runs with the same first words
            border = (up[0] & ~up[1]) | (down[0] & ~down[1])
            keep = np.flatnonzero(kind)
            at = np.flatnonzero(border)
            yield pa.record_batch(
                [pa.array(np.r_[doc[keep], first[at]]), pa.array(np.r_[g[keep], g[at]]), pa.array(np.r_[r[keep], r[at]]),
                 pa.array(np.r_[kind[keep], np.full(len(at), EXTEND)].astype(np.int32))], names=["doc_id", "g", "r", "kind"])
    return run


def _expand(passage: int, seed: int):
    """Per document with marked runs: its known spans, and the windows still to be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                a = Anchors(part.column("text"), passage, seed)
                marks = part.column("marks")
                counts = np.asarray(pa.compute.list_value_length(marks))
                flat = marks.flatten()
                m_row = np.repeat(np.arange(part.num_rows), counts)
                m_key = mix(mix(flat.field("g").to_numpy().view(U)) ^ flat.field("r").to_numpy().view(U) ^ mix(m_row.astype(U)))
                key = mix(mix(a.seed_hash) ^ a.run_hash ^ mix(a.row.astype(U)))
                order = np.argsort(m_key, kind="stable")
                kind = np.zeros(len(key), dtype=np.int32)
                value = flat.field("kind").to_numpy()
                for bit in (REPEATED, LATER, EXTEND):
                    have = np.unique(m_key[order][(value[order] & bit) != 0])
                    kind |= np.where(np.isin(key, have), bit, 0).astype(np.int32)
                run_of = np.repeat(np.arange(len(a.first)), a.last - a.first + 1)
                of_window = kind[run_of]
                hashes = a.window_hash(np.arange(len(a.window)))
                w_row = a.row[run_of]
                # a window whose equal in the same document lies in a repeated run is repeated too
                if (of_window & EXTEND).any():
                    own = mix(hashes ^ mix(w_row.astype(U)))
                    for bit in (REPEATED, LATER):
                        of_window |= np.where(np.isin(own, own[(of_window & bit) != 0]), bit, 0).astype(np.int32)
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)
                points = a.words.code_points()
                base = points[a.words.offsets[:-1]]
                start_at = points[a.words.start[a.window]] - base[w_row]
                stop_at = points[a.words.end[a.window + passage - 1]] - base[w_row]
                word = a.window - a.words.row[w_row]
                for bit, what in ((REPEATED, 0), (LATER, 1)):
                    yield _span_rows(doc, w_row, word, start_at, stop_at, (of_window & bit) != 0, passage, what)
                ask = np.flatnonzero(((of_window & EXTEND) != 0) & ((of_window & LATER) == 0))
                yield _window_rows(doc, w_row[ask], a.seed_hash[run_of][ask], hashes[ask], word[ask], start_at[ask], stop_at[ask])
    return run


_ROWS = "what int, doc_id long, g long, h long, places array<struct<word: int, stop_word: int, start: int, stop: int>>"
_PLACE = pa.struct([(n, pa.int32()) for n in ("word", "stop_word", "start", "stop")])
#: Kinds of rows: a repeated span, a span that an earlier document holds, a window to compare.
SPAN, LATER_SPAN, WINDOW = 0, 1, 2


def _rows(what, doc, g, h, lengths, word, stop_word, start, stop) -> pa.RecordBatch:
    places = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(np.asarray(x).astype(np.int32)) for x in (word, stop_word, start, stop)], fields=list(_PLACE)))
    return pa.record_batch([pa.array(np.full(len(lengths), what, dtype=np.int32)), pa.array(doc), pa.array(g), pa.array(h), places],
                           names=["what", "doc_id", "g", "h", "places"])


def _span_rows(doc, row, word, start, stop, on, passage, what) -> pa.RecordBatch:
    """Unions of the marked windows, one row per document."""
    at = np.flatnonzero(on)
    word, start, stop, row = word[at], start[at], stop[at], row[at]
    new = np.r_[True, (row[1:] != row[:-1]) | (word[1:] > word[:-1] + passage)][:len(at)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)][:len(first)] - 1
    rows, counts = np.unique(row[first], return_counts=True)
    zero = np.zeros(len(rows), dtype=np.int64)
    return _rows(what, doc[rows], zero, zero, counts, word[first], word[last] + passage, start[first], stop[last])


def _window_rows(doc, row, g, h, word, start, stop) -> pa.RecordBatch:
    """One row per document and window, with all its places."""
    order = np.lexsort((word, h, g, row))
    row, g, h, word, start, stop = (x[order] for x in (row, g, h, word, start, stop))
    new = np.r_[True, (row[1:] != row[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])][:len(row)]
    first = np.flatnonzero(new)
    counts = np.diff(np.r_[first, len(row)])
    return _rows(WINDOW, doc[row[first]], g[first].view(np.int64), h[first].view(np.int64), counts, word, word * 0 - 1, start, stop)


def _equal_windows(near: dict, passage: int):
    walk = _neighbours(near, ("g", "h", "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, (_, _, doc), up, down, first in walk(batches):
            later = down[1] & (first < doc)
            other = later | (up[1] & ~up[2]) | (down[1] & ~down[2])
            for what, on in ((SPAN, other), (LATER_SPAN, later)):
                part = b.filter(pa.array(on))
                yield pa.record_batch([pa.array(np.full(part.num_rows, what, dtype=np.int32)), *[
                    part.column(c) for c in ("doc_id", "g", "h", "places")]], names=["what", "doc_id", "g", "h", "places"])
    return run


def _merge(passage: int):
    """Unions of a document's spans, by words."""
    def one(places) -> list[dict]:
        out: list[list[int]] = []
        for p in sorted((p["word"], p["stop_word"] if p["stop_word"] >= 0 else p["word"] + passage, p["start"], p["stop"]) for p in places):
            if out and p[0] <= out[-1][1]:
                if p[1] > out[-1][1]:
                    out[-1][1], out[-1][3] = p[1], p[3]
            else:
                out.append(list(p))
        return [{"start": s, "stop": e, "words": b - a} for a, b, s, e in out]

    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [pa.array([one(x or []) for x in b.column(c).to_pylist()], kind) for c in ("spans", "later")]
            yield pa.record_batch([b.column("doc_id"), *cols], names=["doc_id", "spans", "later"])
    return run


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document that holds a passage of ``passage`` words or more found in another
    document: ``doc_id``, ``spans`` and ``later``, arrays of struct<start, stop (code points),
    words>. ``later`` covers only what a document of a lower id holds too: removing it leaves
    every passage in its first document."""
    if not 0 < seed <= passage:
        raise ValueError("seed must lie between 1 and the passage length")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    suffixes = cut(docs.mapInArrow(_suffixes(passage, seed), "g long, r long, doc_id long"))
    ordered, near = _sorted(suffixes, "g", "r", "doc_id")
    marks = ordered.mapInArrow(_marks(near), "doc_id long, g long, r long, kind int")
    marks = marks.groupBy("doc_id").agg(F.collect_list(F.struct("g", "r", "kind")).alias("marks"))
    rows = cut(docs.join(marks, "doc_id").select("doc_id", "text", "marks").mapInArrow(_expand(passage, seed), _ROWS))
    windows, beside = _sorted(rows.filter(F.col("what") == WINDOW), "g", "h", "doc_id")
    more = windows.mapInArrow(_equal_windows(beside, passage), _ROWS)
    spans = rows.filter(F.col("what") != WINDOW).unionByName(more)
    spans = spans.groupBy("doc_id").agg(
        F.flatten(F.collect_list(F.when(F.col("what") == SPAN, F.col("places")))).alias("spans"),
        F.flatten(F.collect_list(F.when(F.col("what") == LATER_SPAN, F.col("places")))).alias("later"))
    pair = "array<struct<start: int, stop: int, words: int>>"
    return spans.mapInArrow(_merge(passage), f"doc_id long, spans {pair}, later {pair}").filter(F.size("spans") > 0)
