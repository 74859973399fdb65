"""Predictive-maintenance trace rows: CSV loading, unit conversion, statistics and
per-machine z-score rescaling.

All column arithmetic; the statistics are one global aggregate whose values enter the
rescale as scalar subqueries (Catalyst merges them into a single aggregate job), and the
per-machine baselines are a fixed 10-row table, broadcast by the planner.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from plantmetrics.operators.events import failure_reason

# --- Fixed values: per-machine signal baselines (mean and std-dev) -----------------------
#     machine, temp, vib, pwr, temp_std, vib_std, pwr_std
BASELINES = [
    (1, 68.0, 1.20, 18.5, 3.0, 0.15, 1.5),
    (2, 70.5, 1.35, 19.2, 3.0, 0.15, 1.5),
    (3, 55.0, 0.85, 12.0, 2.5, 0.10, 1.0),
    (4, 56.5, 0.90, 12.8, 2.5, 0.10, 1.0),
    (5, 82.0, 2.10, 35.0, 5.0, 0.25, 3.0),
    (6, 81.5, 2.05, 34.5, 5.0, 0.25, 3.0),
    (7, 60.0, 1.00, 22.0, 3.0, 0.12, 2.0),
    (8, 75.0, 0.60, 45.0, 4.0, 0.08, 4.0),
    (9, 74.5, 0.65, 44.8, 4.0, 0.08, 4.0),
    (10, 40.0, 0.20, 8.5, 2.0, 0.05, 0.8),
]
KELVIN_OFFSET = 273.15
MIN_TEMP_C = 20.0
# ------------------------------------------------------------------------------------------

CSV_SCHEMA = StructType([
    StructField("UDI", LongType()), StructField("Process temperature [K]", DoubleType()),
    StructField("Rotational speed [rpm]", DoubleType()), StructField("Torque [Nm]", DoubleType()),
    StructField("Machine failure", IntegerType()),
    *[StructField(f, IntegerType()) for f in ["TWF", "HDF", "PWF", "OSF", "RNF"]],
])
_REQUIRED = [f.name for f in CSV_SCHEMA.fields if f.name != "UDI"]


def judge_signal_csv(lines: DataFrame, col: str = "line") -> DataFrame:
    """CSV text lines -> typed columns, ``line`` and ``reason``: the first required column that is missing or does
    not parse, NULL for a line to keep. ``line`` is NULL where the line is kept."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CSV_SCHEMA.fields)
    # each line is parsed once: no filter on the fields is put below a generator, where every field that it
    # names would parse the line anew
    rows = lines.select(F.col(col).alias("line")).select(
        "line", F.inline(F.array(F.from_csv("line", ddl, {"mode": "PERMISSIVE"}))))
    reason = F.coalesce(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in _REQUIRED])
    rows = rows.select(*[f"`{f.name}`" for f in CSV_SCHEMA.fields], "line").withColumn("reason", reason)
    return rows.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))


def parse_signal_csv(lines: DataFrame, col: str = "line") -> DataFrame:
    """CSV text lines -> typed rows; lines with a number or a flag that does not parse are skipped
    (the loader's DROPMALFORMED behaviour, expressed on a string column). ``sources.csv_load`` keeps
    the skipped lines in a side table."""
    return judge_signal_csv(lines, col).where("reason is null").select(*[f"`{f.name}`" for f in CSV_SCHEMA.fields])


def signal_features(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Process temperature in °C, speed, and shaft power P = torque x rpm x pi/30/1000 kW."""
    return rows.select(
        "UDI", *keep,
        (F.col("`Process temperature [K]`") - F.lit(KELVIN_OFFSET)).alias("process_temp_c"),
        F.col("`Rotational speed [rpm]`").alias("rpm"),
        (F.col("`Torque [Nm]`") * F.col("`Rotational speed [rpm]`") * F.lit(math.pi) / 30.0 / 1000.0).alias("power_kw"),
        (F.coalesce(F.col("`Machine failure`"), F.lit(0)) == 1).alias("failure"),
        failure_reason().alias("failure_reason"),
    )


def signal_stats(features: DataFrame) -> DataFrame:
    """Mean and sample std-dev of the three signals, failure count and rate (one row)."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("process_temp_c").alias("temp_mean"), F.stddev_samp("process_temp_c").alias("temp_std"),
        F.avg("rpm").alias("rpm_mean"), F.stddev_samp("rpm").alias("rpm_std"),
        F.avg("power_kw").alias("pwr_mean"), F.stddev_samp("power_kw").alias("pwr_std"),
        F.count_if("failure").alias("failures"),
        F.avg(F.col("failure").cast("int")).alias("failure_rate"),
    )


def baselines(spark) -> DataFrame:
    return spark.createDataFrame(
        BASELINES, "baseline_id int, temp double, vib double, pwr double, temp_std double, vib_std double, "
                   "pwr_std double")


def _z(raw, mean, std, target_mean, target_std):
    z = F.when(std > 0, (raw - mean) / std).otherwise(F.lit(0.0))
    return target_mean + z * target_std


def zscale_signals(features_with_machine: DataFrame) -> DataFrame:
    """Rescale each row's signals to its machine's baseline, keeping the row's z-score.

    Machines map onto the fixed baselines by ``machine_id mod 10 + 1``. Results are
    rounded (temperature 2 places, vibration and power 3) and floored like the loader:
    temperature >= 20 °C, vibration and power >= 0 (absolute values).
    """
    f = features_with_machine
    st = signal_stats(f)  # statistics over all rows, like the loader
    s = {c: st.select(c).scalar() for c in ["temp_mean", "temp_std", "rpm_mean", "rpm_std", "pwr_mean", "pwr_std"]}
    b = baselines(f.sparkSession)
    j = f.join(b, (F.pmod(F.col("machine_id"), F.lit(10)) + 1) == F.col("baseline_id"))
    temp = _z(F.col("process_temp_c"), s["temp_mean"], s["temp_std"], F.col("temp"), F.col("temp_std"))
    vib = _z(F.col("rpm"), s["rpm_mean"], s["rpm_std"], F.col("vib"), F.col("vib_std"))
    pwr = _z(F.col("power_kw"), s["pwr_mean"], s["pwr_std"], F.col("pwr"), F.col("pwr_std"))
    return j.select(
        "UDI", "machine_id",
        F.greatest(F.lit(MIN_TEMP_C), F.round(temp, 2)).alias("temperature_c"),
        F.greatest(F.lit(0.0), F.round(F.abs(vib), 3)).alias("vibration_mm_s"),
        F.greatest(F.lit(0.0), F.round(F.abs(pwr), 3)).alias("power_kw"),
    )
