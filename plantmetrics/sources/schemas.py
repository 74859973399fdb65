"""Explicit schemas of the raw domain tables (never inferred).

Identifier columns that grow with the data (orders, defects, events, patterns,
recommendations) are 64-bit; machine ids stay 32-bit like the reference.
"""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


MACHINES = _s(
    ("machine_id", IntegerType(), False),
    ("machine_name", StringType(), True),
    ("machine_type", StringType(), True),
    ("production_line", StringType(), True),
    ("theoretical_rate_per_hr", IntegerType(), True),
    ("install_date", DateType(), True),
)

PRODUCTION_ORDERS = _s(
    ("order_id", LongType(), False),
    ("machine_id", IntegerType(), False),
    ("product_sku", StringType(), True),
    ("shift_label", StringType(), True),
    ("shift_start", TimestampNTZType(), True),
    ("shift_end", TimestampNTZType(), True),
    ("planned_qty", IntegerType(), True),
    ("actual_qty", IntegerType(), True),
)

DEFECTS = _s(
    ("defect_id", LongType(), True),
    ("order_id", LongType(), False),
    ("defect_type", StringType(), True),
    ("qty_defective", IntegerType(), True),
)

SENSOR_READINGS = _s(
    ("machine_id", IntegerType(), False),
    ("ts", TimestampNTZType(), False),
    ("temperature_c", DecimalType(5, 2), True),
    ("vibration_mm_s", DecimalType(6, 3), True),
    ("power_kw", DecimalType(7, 3), True),
)

DOWNTIME_EVENTS = _s(
    ("event_id", LongType(), True),
    ("machine_id", IntegerType(), False),
    ("started_at", TimestampNTZType(), True),
    ("ended_at", TimestampNTZType(), True),
    ("reason_code", StringType(), True),
)

FAILURE_PATTERNS = _s(
    ("pattern_id", LongType(), False),
    ("machine_id", IntegerType(), False),
    ("machine_type", StringType(), False),
    ("event_date", DateType(), False),
    ("reason_code", StringType(), False),
    ("downtime_hrs", DecimalType(8, 3), False),
    ("description", StringType(), False),
    ("embedding", ArrayType(DoubleType()), False),
)

MAINTENANCE_RECOMMENDATIONS = _s(
    ("rec_id", LongType(), False),
    ("machine_id", IntegerType(), False),
    ("machine_name", StringType(), False),
    ("generated_at", TimestampNTZType(), True),
    ("anomaly_score", DecimalType(6, 3), True),
    ("root_cause", StringType(), True),
    ("recommended_action", StringType(), True),
    ("estimated_hours_to_failure", DecimalType(6, 1), True),
    ("confidence", StringType(), True),
    ("similar_pattern_ids", StringType(), True),
)

# Raw predictive-maintenance trace rows (the CSV the reference downloads), typed.
SIGNAL_CSV = _s(
    ("UDI", LongType(), True),
    ("Product ID", StringType(), True),
    ("Type", StringType(), True),
    ("Air temperature [K]", DoubleType(), True),
    ("Process temperature [K]", DoubleType(), True),
    ("Rotational speed [rpm]", DoubleType(), True),
    ("Torque [Nm]", DoubleType(), True),
    ("Tool wear [min]", DoubleType(), True),
    ("Machine failure", IntegerType(), True),
    ("TWF", IntegerType(), True),
    ("HDF", IntegerType(), True),
    ("PWF", IntegerType(), True),
    ("OSF", IntegerType(), True),
    ("RNF", IntegerType(), True),
)

RESPONSES = _s(
    ("response_id", LongType(), False),
    ("machine_id", IntegerType(), False),
    ("response", StringType(), True),
)

BOOL = BooleanType()
