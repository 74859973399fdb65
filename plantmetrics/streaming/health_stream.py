"""Daily health kept up to date from a stream of readings.

Every micro-batch is stored, and the days it touches are recomputed from all stored readings
of those days and overwritten in a date-partitioned table. The table is therefore equal to
the batch model for any file layout, order or lateness of arrival; a repeated micro-batch and
a restart change nothing. A micro-batch opens the touched days only, each a bounded number of
folders (``store.fold``), so a
feed that is about in time order costs about its own days. No reading is dropped, and no
state is held beside the two tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators.health import HEALTH_COLUMNS, machine_health
from plantmetrics.operators.staging import stg_sensor
from plantmetrics.params import DEFAULT, Params
from plantmetrics.streaming.store import PENDING, fold, land, landed, replace_days


def update_health(batch: DataFrame, epoch_id: int, root: str, params: Params = DEFAULT, pending: int = PENDING) -> None:
    """Store a micro-batch of raw readings under ``root`` and recompute the days it touches; once ``pending``
    older micro-batches wait in the store, they are folded into parts of days first."""
    if batch.isEmpty():
        return
    staged, store = stg_sensor(batch), f"{root}/sensor_readings"
    fold(batch.sparkSession, store, staged.schema, "reading_date", epoch_id, pending)
    new = land(staged, store, epoch_id, "reading_date")
    touched = new.select(F.col("reading_date").alias("touched")).distinct()
    low, high = new.agg(F.min("reading_date"), F.max("reading_date")).first()
    low, high = low or dt.date.max, high or dt.date.min         # undated rows only
    rows = landed(batch.sparkSession, store, staged.schema, "reading_date", low, high)
    rows = rows.join(touched, F.col("reading_date").eqNullSafe(F.col("touched")), "left_semi")
    replace_days(machine_health(rows, params).select(*HEALTH_COLUMNS), f"{root}/mart_machine_health", "reading_date")


def health_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/mart_machine_health").select(*HEALTH_COLUMNS)


def start_health_stream(readings: DataFrame, root: str, checkpoint: str, params: Params = DEFAULT,
                        trigger: dict | None = None):
    """Keep ``{root}/mart_machine_health`` up to date; ``root`` and ``checkpoint`` are shared folders."""
    return (readings.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, epoch: update_health(batch, epoch, root, params))
            .trigger(**(trigger or {"availableNow": True})).start())
