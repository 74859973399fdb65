"""Window anchors: 7-day OEE trend per machine, recent health, at-risk selection.

Anchors differ on purpose: the OEE trend anchors on *each machine's* last OEE day, the
health window on the *fleet's* last reading day.

The trend is one shuffle: a window max per machine over the daily facts (at most one
row per machine-day, so bounded per key by the calendar, not by raw volume), then a
grouped aggregate that reuses the same hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from plantmetrics.functions.columns import dec
from plantmetrics.params import DEFAULT, Params

RATE = DecimalType(5, 4)


def oee_trend_7d(oee: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per machine: mean OEE over [anchor-7, anchor] and [anchor-14, anchor-7), with the
    exact sums and counts kept for the decline test."""
    w = params.window_days
    o = oee.select("machine_id", "shift_date", "oee",
                   F.max("shift_date").over(Window.partitionBy("machine_id")).alias("max_date"))
    recent = F.col("shift_date") >= F.date_sub("max_date", w)
    prior = (F.col("shift_date") >= F.date_sub("max_date", 2 * w)) & (F.col("shift_date") < F.date_sub("max_date", w))
    return o.groupBy("machine_id").agg(
        F.max("max_date").alias("max_date"),
        F.avg(F.when(recent, F.col("oee"))).alias("oee_last_7d"),
        F.avg(F.when(prior, F.col("oee"))).alias("oee_prior_7d"),
        F.sum(F.when(recent, F.col("oee"))).alias("_s1"), F.count(F.when(recent, F.col("oee"))).alias("_n1"),
        F.sum(F.when(prior, F.col("oee"))).alias("_s0"), F.count(F.when(prior, F.col("oee"))).alias("_n0"),
    )


def declining(trend: DataFrame | None = None, params: Params = DEFAULT):
    """last < prior - drop, both windows non-empty; evaluated as
    s1*n0 < s0*n1 - drop*n0*n1 so no rounded mean decides a tie."""
    s1, n1, s0, n0 = F.col("_s1"), F.col("_n1"), F.col("_s0"), F.col("_n0")
    drop = dec(params.oee_drop, 4, 2)
    return (n1 > 0) & (n0 > 0) & (s1 * n0 < s0 * n1 - drop * n0 * n1)


def trend_columns() -> list:
    """The rounded trend columns shown in the queue (from the raw means)."""
    return [F.col("oee_last_7d").cast(RATE).alias("oee_last_7d"),
            F.col("oee_prior_7d").cast(RATE).alias("oee_prior_7d"),
            (F.col("oee_last_7d") - F.col("oee_prior_7d")).cast(DecimalType(6, 4)).alias("oee_trend_delta")]


def trend_report(trend: DataFrame) -> DataFrame:
    """Rounded trend columns as shown in the queue."""
    return trend.select("machine_id", "max_date", *trend_columns())


def recent_health(health: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Health over the fleet's last ``window_days``+1 days, per machine (raw means).

    The fleet anchor is an uncorrelated scalar subquery: evaluated once, then the filter
    runs map-side before the per-machine aggregate.
    """
    anchor = health.select(F.max("reading_date")).scalar()
    h = health.where(F.col("reading_date") >= F.date_sub(anchor, params.window_days))
    return h.groupBy("machine_id").agg(
        F.max("reading_date").alias("reading_date"),
        F.max("anomaly_flag").alias("anomaly_flag"),
        F.avg("avg_temp_c").alias("avg_temp_c"),
        F.max("max_temp_c").alias("max_temp_c"),
        F.avg("avg_vibration_mm_s").alias("avg_vibration_mm_s"),
        F.max("max_vibration_mm_s").alias("max_vibration_mm_s"),
        F.avg("avg_power_kw").alias("avg_power_kw"),
        F.max("max_power_kw").alias("max_power_kw"),
    )


def latest_health(health: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The queue's health block, rounded to the mart's output types."""
    h = recent_health(health, params)
    return h.select(
        "machine_id", "reading_date", "anomaly_flag",
        F.col("avg_temp_c").cast(DecimalType(6, 2)).alias("avg_temp_c"),
        F.col("max_temp_c").cast(DecimalType(6, 2)).alias("max_temp_c"),
        F.col("avg_vibration_mm_s").cast(DecimalType(7, 3)).alias("avg_vibration_mm_s"),
        F.col("max_vibration_mm_s").cast(DecimalType(7, 3)).alias("max_vibration_mm_s"),
    )


def _rel_dev(mx, avg):
    return F.when(avg > 0, F.abs(mx - avg) / avg).otherwise(F.lit(0))


def at_risk_machines(machines: DataFrame, health: DataFrame, trend: DataFrame,
                     params: Params = DEFAULT) -> DataFrame:
    """Machines with an active anomaly or a declining OEE trend, scored and ordered.

    Health is the driving side (inner join to machines); the trend is a left join whose
    missing means become 0, as the agent does.
    """
    h = recent_health(health, params)
    j = (h.join(machines.select("machine_id", "machine_name", "machine_type", "production_line"), "machine_id")
         .join(trend, "machine_id", "left"))
    score = F.greatest(_rel_dev(F.col("max_temp_c"), F.col("avg_temp_c")),
                       _rel_dev(F.col("max_vibration_mm_s"), F.col("avg_vibration_mm_s")))
    zero = F.lit(0).cast(DecimalType(9, 8))
    return (j.where((F.col("anomaly_flag") == True) | declining(params=params))  # noqa: E712
            .select("machine_id", "machine_name", "machine_type", "production_line", "reading_date",
                    "anomaly_flag", "avg_temp_c", "max_temp_c", "avg_vibration_mm_s", "max_vibration_mm_s",
                    "avg_power_kw", "max_power_kw",
                    F.coalesce("oee_last_7d", zero).alias("oee_last_7d"),
                    F.coalesce("oee_prior_7d", zero).alias("oee_prior_7d"),
                    score.cast(DecimalType(10, 6)).alias("anomaly_score"))
            .orderBy(F.desc("anomaly_score"), "machine_id"))
