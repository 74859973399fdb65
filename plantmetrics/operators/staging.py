"""Staging projections: cast, trim and upper-case raw columns; derive dates and hours.

Narrow projections only; Catalyst fuses them into the scans (column pruning and filter
pushdown reach the Parquet reader).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType

from plantmetrics.functions.columns import hours_between, trunc_hour


def stg_machines(machines: DataFrame) -> DataFrame:
    return machines.select(
        F.col("machine_id").cast(IntegerType()).alias("machine_id"),
        F.trim("machine_name").alias("machine_name"),
        F.upper(F.trim("machine_type")).alias("machine_type"),
        F.upper(F.trim("production_line")).alias("production_line"),
        F.col("theoretical_rate_per_hr").cast(IntegerType()).alias("theoretical_rate_per_hr"),
        F.col("install_date").cast("date").alias("install_date"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Adds shift_date (start day: night shifts count whole on their start day) and
    shift_duration_hrs DECIMAL(5,2)."""
    return orders.select(
        F.col("order_id").cast(LongType()).alias("order_id"),
        F.col("machine_id").cast(IntegerType()).alias("machine_id"),
        F.trim("product_sku").alias("product_sku"),
        F.upper(F.trim("shift_label")).alias("shift_label"),
        F.col("shift_start").cast("timestamp_ntz").alias("shift_start"),
        F.col("shift_end").cast("timestamp_ntz").alias("shift_end"),
        F.to_date("shift_start").alias("shift_date"),
        hours_between("shift_start", "shift_end", 5, 2).alias("shift_duration_hrs"),
        F.col("planned_qty").cast(IntegerType()).alias("planned_qty"),
        F.col("actual_qty").cast(IntegerType()).alias("actual_qty"),
    )


def stg_defects(defects: DataFrame) -> DataFrame:
    return defects.select(
        F.col("defect_id").cast(LongType()).alias("defect_id"),
        F.col("order_id").cast(LongType()).alias("order_id"),
        F.upper(F.trim("defect_type")).alias("defect_type"),
        F.col("qty_defective").cast(IntegerType()).alias("qty_defective"),
    )


def stg_sensor(readings: DataFrame) -> DataFrame:
    """Adds ts_hour and reading_date."""
    return readings.select(
        F.col("machine_id").cast(IntegerType()).alias("machine_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        trunc_hour(F.col("ts")).alias("ts_hour"),
        F.to_date("ts").alias("reading_date"),
        F.col("temperature_c").cast(DecimalType(5, 2)).alias("temperature_c"),
        F.col("vibration_mm_s").cast(DecimalType(6, 3)).alias("vibration_mm_s"),
        F.col("power_kw").cast(DecimalType(7, 3)).alias("power_kw"),
    )


def stg_downtime(events: DataFrame) -> DataFrame:
    """Adds event_date (start day: long stoppages count whole on their start day) and
    duration_hrs DECIMAL(8,4)."""
    return events.select(
        F.col("event_id").cast(LongType()).alias("event_id"),
        F.col("machine_id").cast(IntegerType()).alias("machine_id"),
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        F.col("ended_at").cast("timestamp_ntz").alias("ended_at"),
        F.to_date("started_at").alias("event_date"),
        hours_between("started_at", "ended_at", 8, 4).alias("duration_hrs"),
        F.upper(F.trim("reason_code")).alias("reason_code"),
    )
