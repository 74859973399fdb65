"""New-data trigger: refresh the models whenever new readings arrive.

A checkpointed file stream over the readings folder replaces the row-count poll:
offsets record exactly which files were processed (no cursor that resets when rows are
deleted, no cursor advanced before the run succeeds), and ``foreachBatch`` calls run one
after another, so at most one refresh is active at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantmetrics.streaming.ingest import readings_stream


def ordered_refresh(steps):
    """Compose refresh steps (facts -> patterns -> recommendations -> queue) into one
    callable that runs them in order for a micro-batch."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        for step in steps:
            step(batch, epoch_id)

    return run


def start_refresh_trigger(spark: SparkSession, readings_path: str, checkpoint: str, steps,
                          interval: str | None = "60 seconds", available_now: bool = False):
    trig = {"availableNow": True} if available_now else {"processingTime": interval}
    return (readings_stream(spark, readings_path).writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(ordered_refresh(steps)).trigger(**trig).start())
