"""Continuous ingest of sensor readings (the live feed) into a date-partitioned table.

The source is a folder of Parquet files read as a stream with the fixed schema;
offsets live in the checkpoint, so a restart resumes exactly where it stopped (no
row-count cursor, no position arithmetic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators.staging import stg_sensor
from plantmetrics.sources.schemas import SENSOR_READINGS


def readings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(SENSOR_READINGS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def start_ingest(readings: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None):
    """Append staged readings to ``sink_path`` partitioned by reading_date."""
    w = (stg_sensor(readings).writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint).partitionBy("reading_date"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
