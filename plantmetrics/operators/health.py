"""Daily sensor health per machine with an anomaly flag.

One hash aggregate on (machine_id, reading_date) with map-side partial aggregation: a
machine that emits a third of all readings still sends one partial row per map task.
The aggregate is split into raw sums/counts/maxima (``health_parts``) and the finishing
projection (``health_finish``) so the streaming job can keep the parts as state and
finish them per micro-batch with the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from plantmetrics.functions.columns import dec
from plantmetrics.params import DEFAULT, Params

HEALTH_COLUMNS = ["machine_id", "reading_date", "reading_count", "avg_temp_c", "max_temp_c", "avg_vibration_mm_s",
                  "max_vibration_mm_s", "avg_power_kw", "max_power_kw", "anomaly_flag"]


def health_parts(sensor: DataFrame, *keys) -> DataFrame:
    """COUNT, SUM, MAX and non-null COUNT per signal, grouped by ``keys``."""
    aggs = [F.count(F.lit(1)).alias("reading_count")]
    for c, n in [("temperature_c", "t"), ("vibration_mm_s", "v"), ("power_kw", "p")]:
        aggs += [F.sum(c).alias(f"_sum_{n}"), F.count(c).alias(f"_n_{n}"), F.max(c).alias(f"_max_{n}")]
    return sensor.groupBy(*keys).agg(*aggs)


def _mean(n: str, p: int, s: int):
    """Spark's AVG(decimal(p,s)) = sum/count rounded half-up to scale s+4."""
    return F.when(F.col(f"_n_{n}") > 0, (F.col(f"_sum_{n}") / F.col(f"_n_{n}")).cast(DecimalType(p + 4, s + 4)))


def health_finish(parts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Means, maxima and the anomaly flag from the parts.

    The flag compares the raw peak with the raw mean times the ratio, strictly. It is
    evaluated as ``max * count > sum * ratio`` in exact decimals so a rounded mean cannot
    flip a tie.
    """
    t_hot = F.col("_max_t") * F.col("_n_t") > F.col("_sum_t") * dec(params.temp_ratio, 6, 3)
    v_hot = F.col("_max_v") * F.col("_n_v") > F.col("_sum_v") * dec(params.vib_ratio, 6, 3)
    return parts.select(
        "machine_id", "reading_date", "reading_count",
        _mean("t", 5, 2).cast(DecimalType(6, 2)).alias("avg_temp_c"),
        F.col("_max_t").cast(DecimalType(6, 2)).alias("max_temp_c"),
        _mean("v", 6, 3).cast(DecimalType(7, 3)).alias("avg_vibration_mm_s"),
        F.col("_max_v").cast(DecimalType(7, 3)).alias("max_vibration_mm_s"),
        _mean("p", 7, 3).cast(DecimalType(8, 3)).alias("avg_power_kw"),
        F.col("_max_p").cast(DecimalType(8, 3)).alias("max_power_kw"),
        F.when(t_hot, True).when(v_hot, True).otherwise(False).alias("anomaly_flag"),
    )


def machine_health(sensor: DataFrame, params: Params = DEFAULT, since=None) -> DataFrame:
    """COUNT, AVG/MAX of temperature, vibration and power, and the anomaly flag, per
    machine and reading day. ``since`` restricts to days >= since (pushed to the scan)."""
    if since is not None:
        # the raw-timestamp twin of the date filter pushes down to the scan (row-group
        # skipping); for TIMESTAMP_NTZ, ts >= since 00:00 exactly when to_date(ts) >= since
        sensor = sensor.where((F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
                              & (F.col("reading_date") >= F.lit(since)))
    return health_finish(health_parts(sensor, "machine_id", "reading_date"), params)
