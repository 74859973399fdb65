"""Greedy per-machine cooldown kept up to date from a stream of events.

Every micro-batch is stored. Only the keys it holds can change, and only from their first new event on. The
walk of such a key starts again at the last event kept before that one and goes on until, at or after
the key's last new event, it keeps an event at an instant at which the stored table keeps one too:
the state of a walk is that one time, so from there on both are the same. The days looked at grow
fourfold until every key has met its stored sequence or the events end; then just the dates that differ
are written. A live feed looks at its last day, and a row that is a month late costs the days up to
the meeting point. The table is equal to the batch operator's result for any order or lateness of
arrival; a repeated micro-batch and a restart change nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators.events import greedy_cooldown
from plantmetrics.plans.incremental import _exists
from plantmetrics.streaming.store import PENDING, fold, land, landed, last_day, replace_days


def update_cooldown(batch: DataFrame, epoch_id: int, root: str, key: str, ts: str, tiebreak: list[str],
                    cooldown_s: int, pending: int = PENDING) -> int:
    """Store a micro-batch of events under ``root`` and redo the cooldown where it can have changed; returns
    the number of dates written. Once ``pending`` older micro-batches wait in the store, they are folded
    into parts of days first.

    A date that is written always gets a row in the table (``is_kept`` false if it is only there to
    say so), so that a date whose last kept event goes is overwritten too."""
    if batch.isEmpty():
        return 0
    spark, columns = batch.sparkSession, batch.columns
    dated = batch.withColumn("event_date", F.to_date(ts))
    store = f"{root}/events"
    fold(spark, store, dated.schema, "event_date", epoch_id, pending)
    new = land(dated, store, epoch_id, "event_date")
    low, high, untimed = new.agg(F.min("event_date"), F.max("event_date"), F.count_if(F.col("event_date").isNull())).first()
    written = 0
    if low is not None:
        def events(first, last):
            return landed(spark, store, dated.schema, "event_date", first, last, undated=False)
        changed = _resynchronised(new, events, last_day(spark, store, "event_date"), _stored(spark, root, dated), key, ts, tiebreak, cooldown_s, low, high, columns)
        written += changed.select("event_date").distinct().count()
        if written:
            replace_days(changed, f"{root}/kept_events", "event_date")
    if untimed:       # nothing shows these to fall into a cooldown
        nothing = (dt.date.max, dt.date.min)
        rows = landed(spark, store, dated.schema, "event_date", *nothing).withColumn("is_kept", F.lit(True))
        replace_days(rows.select(*columns, "event_date", "is_kept"), f"{root}/kept_events", "event_date")
        written += 1
    return written


def _stored(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    if _exists(spark, f"{root}/kept_events"):
        return _table(spark, root, like)
    return spark.createDataFrame([], like.withColumn("is_kept", F.lit(True)).schema)


def _resynchronised(new: DataFrame, events, last: dt.date, stored: DataFrame, key: str, ts: str, tiebreak: list[str], cooldown_s: int,
                    low, high, columns: list[str]) -> DataFrame:
    """All rows of the dates that differ from the stored table once the new events are in it;
    ``events(first, last)`` are those of these dates."""
    day, same = F.col("event_date"), F.col(key).eqNullSafe(F.col("_k"))
    keys = new.where(F.col(ts).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi")).checkpoint()
    reach, span = cooldown_s // 86400 + 1, 1
    while True:
        end = high + dt.timedelta(days=span)
        before = stored.where((day >= F.lit(low) - F.expr(f"interval {reach} days")) & (day <= F.lit(high)) & F.col("is_kept"))
        seeds = before.join(keys, same).where(F.col(ts) < F.col("_lo")).groupBy(key).agg(F.max(ts).alias(ts)).withColumn("is_kept", F.lit(False))
        window = day.between(low, end)
        walked = events(low, end).join(keys, same).where(F.col(ts) >= F.col("_lo")).select(*columns, "event_date")
        walked = walked.withColumn("is_kept", F.lit(True)).unionByName(seeds, allowMissingColumns=True)
        kept = greedy_cooldown(walked, key, ts, tiebreak, cooldown_s).where("is_kept").checkpoint()
        old = stored.where(window & F.col("is_kept"))
        both = kept.select(F.col(key).alias("_bk"), F.col(ts).alias("_t")).join(
            old, F.col("_bk").eqNullSafe(F.col(key)) & (F.col("_t") == F.col(ts)), "left_semi")
        met = both.join(keys, F.col("_bk").eqNullSafe(F.col("_k"))).where(F.col("_t") >= F.col("_hi")).groupBy("_k").agg(F.min("_t").alias("_m"))
        met = keys.join(met.withColumnRenamed("_k", "_mk"), F.col("_k").eqNullSafe(F.col("_mk")), "left").select("_k", "_lo", "_m").checkpoint()
        if end >= last or met.where("_m is null").isEmpty():
            break
        span *= 4
    # from a key's first new event to its meeting point (none: the end) the walk stands for the stored rows
    inside = (F.col(ts) >= F.col("_lo")) & (F.col("_m").isNull() | (F.col(ts) <= F.col("_m")))
    names = [*columns, "event_date"]
    now = kept.join(met, same).where(inside).select(*names)
    was = old.join(met, same).where(inside).select(*names)
    dates = now.exceptAll(was).unionByName(was.exceptAll(now)).select("event_date").distinct().checkpoint()
    touched = stored.where(window).join(dates, "event_date", "left_semi").where("is_kept")
    rest = touched.join(met, same, "left").where(F.col("_lo").isNull() | ~inside).select(*names)
    now = now.join(dates, "event_date", "left_semi").select(*names)
    out = rest.unionByName(now).withColumn("is_kept", F.lit(True)).unionByName(
        dates.withColumn("is_kept", F.lit(False)), allowMissingColumns=True)
    # stored before the folder that it is read from is written
    return out.select(*names, "is_kept").checkpoint()


def _table(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.withColumn("is_kept", F.lit(True)).schema).parquet(f"{root}/kept_events")


def kept_events(spark: SparkSession, root: str) -> DataFrame:
    """The kept events, with ``event_date``."""
    return spark.read.parquet(f"{root}/kept_events").where("is_kept").drop("is_kept")


def start_cooldown_stream(events: DataFrame, root: str, checkpoint: str, key: str, ts: str, tiebreak: list[str],
                          cooldown_s: int, trigger: dict | None = None):
    """Keep ``{root}/kept_events`` up to date; ``root`` and ``checkpoint`` are shared folders."""
    return (events.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, epoch: update_cooldown(batch, epoch, root, key, ts, tiebreak, cooldown_s))
            .trigger(**(trigger or {"availableNow": True})).start())
