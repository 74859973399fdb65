"""Arrived rows of a stream, stored as they came and folded into parts of days.

``land`` writes a micro-batch under its own ``epoch=N`` folder, split by date, and overwrites
that folder when the engine repeats the batch after a failure. So the store holds every row
once, whatever the order and lateness of arrival, and what is derived from it can be
recomputed for the touched dates at any time, also after a restart. The ``rebalance`` hint
lets AQE split a date that holds most rows and join small ones before the write.

``fold`` keeps the number of folders a date has bounded. Once ``PENDING`` older micro-batches wait, their rows
become one new part of each date they hold (``v=<n>/<day>=<date>``). Parts have a level: as soon as a
date has ``FAN`` parts of one level, they and the new one become one part of the next, so a row is
rewritten once a level and a date with p folded micro-batches has at most FAN * log(p) parts. The list
of parts and the last epoch folded are one pointer file, swapped in a single rename (``plans.versions``):
a fold that breaks off changes nothing. The newest micro-batch is never folded, as the engine may
repeat it. ``landed`` opens the folders of the dates asked for, and no others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plantmetrics.plans import versions
from plantmetrics.plans.versions import NO_DAY

#: Micro-batches that wait before they are folded; parts of one level that are merged.
PENDING, FAN = 16, 4


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders under ``path``."""
    hadoop, fs = versions._fs(spark, path)
    root = hadoop.Path(path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def _state(spark: SparkSession, path: str) -> tuple[dict, list[int]]:
    """What has been folded, and the epochs that wait."""
    told = versions.pointer(spark, path) or {"parts": [], "folded": -1, "tiers": {}, "replaced": []}
    return told, sorted(e for e in map(int, _children(spark, path, "epoch=")) if e > told["folded"])


def _open(spark: SparkSession, path: str, schema: StructType, level: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField(level, LongType())])
    return spark.read.schema(full).option("basePath", path).parquet(*folders).select(*schema.names)


def land(batch: DataFrame, path: str, epoch_id: int, day: str) -> DataFrame:
    """Store ``batch`` split by its date column ``day`` (rows without a date too) and return it
    as stored. A batch that has been folded is stored already and not written again."""
    spark, target = batch.sparkSession, f"{path}/epoch={epoch_id}"
    if epoch_id <= _state(spark, path)[0]["folded"]:
        return batch
    (batch.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(day).parquet(target))
    return spark.read.schema(batch.schema).parquet(target)


def landed(spark: SparkSession, path: str, schema: StructType, day: str, low: dt.date | None = None,
           high: dt.date | None = None, undated: bool = True) -> DataFrame:
    """The rows that have landed, with a date from ``low`` to ``high`` (None: no bound) or, if ``undated``, without one."""
    told, waiting = _state(spark, path)

    def asked(name: str) -> bool:
        if name == NO_DAY:
            return undated
        return (low is None or name >= low.isoformat()) and (high is None or name <= high.isoformat())

    parts = [f"{path}/v={n}/{day}={d}" for d, ns in told["tiers"].items() if asked(d) for n, _ in ns]
    new = [f"{path}/epoch={e}/{day}={d}" for e in waiting for d in _children(spark, f"{path}/epoch={e}", f"{day}=") if asked(d)]
    return _open(spark, path, schema, "v", parts).unionByName(_open(spark, path, schema, "epoch", new))


def last_day(spark: SparkSession, path: str, day: str) -> dt.date | None:
    """The last date that rows have landed for, from the names of folders."""
    told, waiting = _state(spark, path)
    names = set(told["tiers"]).union(*[_children(spark, f"{path}/epoch={e}", f"{day}=") for e in waiting]) - {NO_DAY}
    return dt.date.fromisoformat(max(names)) if names else None


def fold(spark: SparkSession, path: str, schema: StructType, day: str, epoch_id: int, pending: int = PENDING) -> int:
    """Fold the micro-batches before ``epoch_id`` once ``pending`` of them wait; returns how many were folded.

    Older ones are committed in the engine's log when it runs ``epoch_id``, so that they aren't repeated."""
    told, waiting = _state(spark, path)
    ripe = [e for e in waiting if e < epoch_id]
    if len(ripe) < pending:
        return 0
    new = [(e, d) for e in ripe for d in _children(spark, f"{path}/epoch={e}", f"{day}=")]
    number, days, absorbed = versions._next(spark, path), dict(told["tiers"]), []
    for d in {d for _, d in new}:
        kept, level = list(days.get(d, [])), 0
        while len(same := [p for p in kept if p[1] == level]) >= FAN - 1:
            absorbed += [(n, d) for n, _ in same]
            kept, level = [p for p in kept if p[1] != level], level + 1
        days[d] = [*kept, [number, level]]
    rows = _open(spark, path, schema, "epoch", [f"{path}/epoch={e}/{day}={d}" for e, d in new]).unionByName(
        _open(spark, path, schema, "v", [f"{path}/v={n}/{day}={d}" for n, d in absorbed]))
    rows.hint("rebalance", F.col(day)).write.partitionBy(day).parquet(f"{path}/v={number}")
    before = versions.pointer(spark, path)
    after = {"parts": sorted({n for ns in days.values() for n, _ in ns}), "folded": ripe[-1], "tiers": days, "replaced": absorbed}
    versions._commit(spark, path, before, after)
    # nobody reads these any more: epochs that are folded, and what the commit before this one replaced
    stale = [f"epoch={e}" for e in map(int, _children(spark, path, "epoch=")) if e <= ripe[-1]]
    stale += [f"v={n}/{day}={d}" for n, d in told["replaced"]]
    hadoop, fs = versions._fs(spark, path)
    for s in stale:
        fs.delete(hadoop.Path(f"{path}/{s}"), True)
    return len(ripe)


def replace_days(rows: DataFrame, path: str, day: str) -> None:
    """Overwrite just the dates that ``rows`` hold."""
    (rows.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(path))
