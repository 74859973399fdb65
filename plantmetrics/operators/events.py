"""Event streams: greedy per-machine cooldown, downtime derivation from failure flags.

Greedy cooldown: walk a machine's events in time order and keep an event only if more
than ``cooldown`` has passed since the last *kept* event. A ``lag`` filter is wrong
(it compares with the previous event, kept or not), and folding each machine's event
list in one task does not survive a machine holding a third of all events. The batch
form here is exact, has one path, no loop over jobs, and the same few shuffles for any data:

* Of rows at one (key, instant) only the first can be kept, so rows are first reduced to
  one node per (key, instant), with map-side combine: a burst of copies is one node.
* A key's time is cut into blocks of SPAN cooldowns. What happens in a block depends on the past
  through one number, the time of the last kept event before it. So each block is summed up as a map
  from that entry to its exit, the last event kept in the block: a task streams the block's
  events and carries along a walk from every event that an entry could make the first one, those
  within a cooldown of the block's first event. Walks that reach one event go on as one; after SPAN
  steps few are left, and first events with one exit are one row of the map.
* One pass over the maps of a key, in time order, tells every block its entry.
* A second walk over each block, from its entry, gives the kept events.

A task holds the walks of one block (at most the instants of one key in one cooldown) and one
Arrow batch, however many events the block has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.operators.ids import assign_ids
from plantmetrics.session import ensure_checkpoint_dir

# --- Fixed values: failure flag -> reason code, first match wins ------------------------
FAILURE_REASONS = [
    ("TWF", "TOOLING_FAILURE"),
    ("HDF", "MATERIAL_JAM"),
    ("PWF", "POWER_FLUCTUATION"),
    ("OSF", "OPERATOR_ERROR"),
    ("RNF", "UNPLANNED_BREAKDOWN"),
]
DEFAULT_REASON = "UNPLANNED_BREAKDOWN"
# ------------------------------------------------------------------------------------------

_EPOCH = "1970-01-01 00:00:00"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 for a TIMESTAMP_NTZ (no time-zone dependence)."""
    from plantmetrics.functions.columns import ntz_micros
    return ntz_micros(ts)


#: Cooldowns per block.
SPAN = 512


def greedy_cooldown(events: DataFrame, key: str, ts: str, tiebreak: list[str], cooldown_s: int) -> DataFrame:
    """Rows of ``events`` kept by the greedy cooldown (strictly more than ``cooldown_s``
    seconds after the previous kept row of the same key). Rows are walked in
    (ts, *tiebreak) order; rows equal on all of those are ordered by an internal row id.

    Rows with a NULL key form a key of their own; rows with a NULL time are all kept, as
    nothing shows them to fall into a cooldown."""
    ensure_checkpoint_dir(events.sparkSession)
    T = int(cooldown_s) * 1_000_000
    tagged = events.withColumn("_rid", F.monotonically_increasing_id()).checkpoint()
    nodes = (tagged.where(F.col(ts).isNotNull()).groupBy(F.col(key).alias("k"), epoch_micros(F.col(ts)).alias("t"))
             .agg(F.min(F.struct(*tiebreak, "_rid"))["_rid"].alias("id")))
    # stored, so that sorts and joins further on don't walk again
    kept = _kept_ids(nodes, T).select(F.col("id").alias("_rid")).checkpoint() if T > 0 else nodes.select(F.col("id").alias("_rid"))
    untimed = tagged.where(F.col(ts).isNull()).select("_rid")
    return tagged.join(kept.unionByName(untimed), "_rid", "left_semi").drop("_rid")


def _pieces(batches, *names):
    """Batches cut at the edges of the groups ``g``: (kind, piece, columns). Groups that lie whole inside a
    batch come together as "whole"; the first and last of a batch, which may go on in another, one by one
    as "new" or "more"."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        g, *cols = (b.column(n).to_numpy(zero_copy_only=False) for n in ("g", *names))
        edges = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True])
        parts = list(zip(edges[:-1], edges[1:], strict=True))
        if len(parts) > 2:
            parts[1:-1] = [(parts[1][0], parts[-2][1])]
        for n, (i, j) in enumerate(parts):
            kind = "whole" if 0 < n < len(parts) - 1 else "more" if last is not None and g[i] == last else "new"
            yield kind, b.slice(i, j - i), [g[i:j], *(c[i:j] for c in cols)]
            last = g[j - 1]


def _axis(g: np.ndarray, t: np.ndarray, T: int):
    """Sorted times of whole groups on one axis, the groups more than a cooldown apart: (row where each group
    begins, group of each row, times, next event after a cooldown or -1)."""
    begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    size = np.diff(np.r_[begin, len(g)])
    of = np.repeat(np.arange(len(begin)), size)
    length = t[begin + size - 1] - t[begin] + 2 * T + 2
    base = np.r_[0, np.cumsum(length)[:-1]]
    x = base[of] + (t - t[begin][of])
    then = np.searchsorted(x, x + T, side="right")
    then[(then == len(x)) | (of[np.minimum(then, len(x) - 1)] != of)] = -1
    return begin, of, x, then


def _walk(t: np.ndarray, last: np.ndarray, T: int) -> np.ndarray:
    """Take walks that stand at ``last`` as far as they go through the sorted times ``t``."""
    while True:
        at = np.searchsorted(t, last + T, side="right")
        on = at < len(t)
        if not on.any():
            return last
        last[on] = t[at[on]]


def _map_rows(T: int):
    """Per block: first events (the last of those with one exit) and exits."""
    def run(batches):
        key = starts = None

        gathered, rows = [], 0

        def told():
            exits = walks[of]
            last = np.flatnonzero(np.r_[exits[1:] != exits[:-1], True])
            gathered.append((key, len(last), block, starts[last], exits[last]))
            return len(last)

        def batch():
            keys = pa.concat_arrays([pa.concat_arrays([k] * n) for k, n, *_ in gathered])
            blocks = np.repeat([x[2] for x in gathered], [x[1] for x in gathered])
            out = pa.record_batch([keys, pa.array(blocks), *(pa.array(np.concatenate([x[i] for x in gathered])) for i in (3, 4))],
                                  names=["k", "block", "start", "exit"])
            gathered.clear()
            return out

        for kind, b, (g, t, blocks) in _pieces(batches, "t", "block"):
            if kind == "whole":
                begin, group, x, then = _axis(g, t, T)
                exits = np.where(then < 0, np.arange(len(t)), then)
                while (exits[exits] != exits).any():
                    exits = exits[exits]
                # up to a cooldown after the block's first event, or the next one after that
                late = x - x[begin][group] > T
                first = np.flatnonzero(~late | (np.r_[False, ~late[:-1]] & np.r_[False, group[1:] == group[:-1]]))
                last = np.r_[(exits[first][1:] != exits[first][:-1]) | (group[first][1:] != group[first][:-1]), True]
                first = first[last]
                yield pa.record_batch([b.column("k").take(pa.array(first)), pa.array(blocks[first]), pa.array(t[first]), pa.array(t[exits[first]])],
                                      names=["k", "block", "start", "exit"])
                continue
            if kind == "new":
                if starts is not None:
                    rows += told()
                    if rows > 10_000:
                        yield batch()
                        rows = 0
                key, block, begin, beyond = b.column("k").slice(0, 1), blocks[0], t[0], False
                starts, walks, of = (np.zeros(0, dtype=np.int64) for _ in range(3))
            # an entry comes before the first event: up to a cooldown after it, or the next one after that
            more = t[:0] if beyond else t[:np.searchsorted(t, begin + T, side="right") + 1]
            beyond = beyond or bool(len(more)) and more[-1] > begin + T
            of = np.r_[of, len(walks) + np.arange(len(more))]
            starts, walks = np.r_[starts, more], _walk(t, np.r_[walks, more], T)
            walks, same = np.unique(walks, return_inverse=True)
            of = same[of]
        if starts is not None:
            told()
            yield batch()
    return run


def _entries(T: int):
    """One pass over a key's maps: each block with the last kept time before it (null: none)."""
    def run(batches):
        x, block, done = None, None, True
        for b in batches:
            blocks, entries, at = [], [], []
            cols = (b.column(n).to_pylist() for n in ("g", "block", "start", "exit"))
            for i, (g, blk, start, out) in enumerate(zip(*cols, strict=True)):
                if block is None or g != block[0]:
                    x = None
                if block != (g, blk):
                    block, done = (g, blk), False
                    blocks.append(blk)
                    entries.append(x)
                    at.append(i)
                if not done and (x is None or start > x + T):
                    x, done = out, True
            yield pa.record_batch([b.column("k").take(pa.array(at, pa.int64())), pa.array(blocks, pa.int64()),
                                   pa.array(entries, pa.int64())], names=["k", "block", "t"])
    return run


def _kept_walk(T: int):
    """The kept events of each block; its entry comes first (``entry`` 1, or 2 if nothing was kept before)."""
    def run(batches):
        x, out, held = None, [], 0
        for kind, _, (g, t, ids, entry) in _pieces(batches, "t", "id", "entry"):
            if kind == "whole":
                # a block's first row is its entry; one that is out of reach, or none, stands just beyond it
                head = np.flatnonzero(entry > 0)
                beyond = t[np.minimum(head + 1, len(t) - 1)] - T - 1
                t = t.copy()
                t[head] = np.where(entry[head] == 2, beyond, np.maximum(t[head], beyond))
                at = _axis(g, t, T)[3]
                step = at[head]
                while len(step := step[step >= 0]):
                    out.append(ids[step].astype(np.int64))
                    held += len(step)
                    step = at[step]
            elif kind == "new":
                x = None if entry[0] == 2 else t[0]
                t, ids = t[1:], ids[1:]
            if kind == "whole":
                if held > 10_000:
                    yield pa.record_batch([pa.array(np.concatenate(out))], names=["id"])
                    out, held = [], 0
                continue
            then = np.searchsorted(t, t + T, side="right").tolist()
            kept, at = [], 0 if x is None else int(np.searchsorted(t, x + T, side="right"))
            while at < len(t):
                kept.append(at)
                at = then[at]
            if kept:
                x = t[kept[-1]]
                out.append(ids[kept].astype(np.int64))
                held += len(kept)
            if held > 10_000:
                yield pa.record_batch([pa.array(np.concatenate(out))], names=["id"])
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(np.concatenate(out))], names=["id"])
    return run


def _kept_ids(nodes: DataFrame, T: int) -> DataFrame:
    """``id`` of the kept ones of ``nodes(k, t, id)``, one node per (k, t)."""
    kind = nodes.schema["k"].dataType.simpleString()
    # blocks of 1e14 microseconds at most, so that those of one Arrow batch fit on one axis
    width = max(1, min(SPAN, 10 ** 14 // T)) * T
    block = F.expr(f"(t - pmod(t, {width})) div {width}")
    ev = nodes.select("k", block.alias("block"), "t", "id")
    of_block = F.xxhash64(F.col("k").isNull(), "k", "block").alias("g")
    maps = (ev.select("k", "block", "t", of_block).repartition("k", "block").sortWithinPartitions("k", "block", "t")
            .mapInArrow(_map_rows(T), f"k {kind}, block long, start long, exit long"))
    maps = maps.withColumn("g", F.xxhash64(F.col("k").isNull(), "k")).repartition("k").sortWithinPartitions("k", "block", "start")
    entries = maps.mapInArrow(_entries(T), f"k {kind}, block long, t long")
    entries = entries.select("k", "block", F.coalesce("t", F.lit(0).cast("long")).alias("t"), F.lit(-1).cast("long").alias("id"),
                             F.when(F.col("t").isNull(), 2).otherwise(1).alias("entry"))
    both = ev.withColumn("entry", F.lit(0)).unionByName(entries).select("*", of_block)
    return (both.repartition("k", "block").sortWithinPartitions("k", "block", F.desc("entry"), "t")
            .mapInArrow(_kept_walk(T), "id long"))


def failure_reason(flags: dict[str, Column] | None = None) -> Column:
    """First raised failure flag's reason (declared order), else the default reason."""
    expr = None
    for flag, reason in FAILURE_REASONS:
        cond = F.coalesce(F.col(flag), F.lit(0)) == 1 if flags is None else flags[flag]
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit(DEFAULT_REASON))


def stoppage_minutes(row_key: Column, machine_id: Column) -> Column:
    """Deterministic stoppage length in [15, 180] minutes (stands in for a random draw)."""
    return F.lit(15) + F.pmod(row_key * 7 + machine_id, F.lit(166))


def derive_downtime(signal_rows: DataFrame, existing_ids: DataFrame, cooldown_s: int) -> DataFrame:
    """Failure rows -> stoppage events: per machine greedy cooldown, reason from the
    flags, deterministic length, and event ids continuing after the existing maximum."""
    fails = signal_rows.where(F.col("Machine failure") == 1)
    kept = greedy_cooldown(fails, "machine_id", "ts", ["UDI", "Product ID"], cooldown_s)
    ev = kept.select(
        "UDI", "Product ID", "machine_id", F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(mins=stoppage_minutes(F.col("UDI"), F.col("machine_id")).cast("int")))
        .alias("ended_at"),
        failure_reason().alias("reason_code"))
    start = existing_ids.select(F.coalesce(F.max("event_id"), F.lit(0)) + 1).scalar()
    return assign_ids(ev, ["started_at", "machine_id", "UDI", "Product ID"], "event_id", start).select(
        "event_id", "machine_id", "started_at", "ended_at", "reason_code")
