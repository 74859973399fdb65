"""Reporting queries behind the dashboards, as DataFrames.

Fleet-level results are single-row aggregates (partial per task, one final merge);
arg-max/arg-min use ``max_by``/``min_by`` over a struct key with an explicit name
tie-break, never a driver loop. Percentages are exact decimals rounded half-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from plantmetrics.functions.columns import dec
from plantmetrics.params import DEFAULT, Params


def oee_summary_7d(oee: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per machine mean OEE and components over the fleet's last 8 calendar days."""
    anchor = oee.select(F.max("shift_date")).scalar()
    return (oee.where(F.col("shift_date") >= F.date_sub(anchor, params.window_days))
            .groupBy("machine_name", "machine_type", "production_line")
            .agg(F.avg("oee").alias("avg_oee"), F.avg("availability_rate").alias("avg_availability"),
                 F.avg("performance_rate").alias("avg_performance"), F.avg("quality_rate").alias("avg_quality"))
            .orderBy(F.desc_nulls_last("avg_oee"), "machine_name"))


def oee_band(x, params: Params = DEFAULT):
    """NONE / WORLD_CLASS (>= 0.85) / ACCEPTABLE (>= 0.60) / AT_RISK."""
    return (F.when(x.isNull(), "NONE").when(x >= dec(params.world_class_oee, 3, 2), "WORLD_CLASS")
            .when(x >= dec(params.at_risk_oee, 3, 2), "ACCEPTABLE").otherwise("AT_RISK"))


def fleet_kpis(summary: DataFrame, params: Params = DEFAULT) -> DataFrame:
    a = F.col("avg_oee")
    return summary.agg(F.avg(a).alias("fleet_avg_oee"),
                       F.count_if(a >= dec(params.world_class_oee, 3, 2)).alias("n_world_class"),
                       F.count_if(a < dec(params.at_risk_oee, 3, 2)).alias("n_at_risk"),
                       F.count(F.lit(1)).alias("n_machines"))


def fleet_trend(oee: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Fleet mean OEE over the last 8 days vs the 7 days before, direction and |delta|."""
    w = params.window_days
    anchor = oee.select(F.max("shift_date")).scalar()
    d = F.col("shift_date")
    r = oee.agg(F.avg(F.when(d >= F.date_sub(anchor, w), F.col("oee"))).alias("recent_oee"),
                F.avg(F.when((d >= F.date_sub(anchor, 2 * w)) & (d < F.date_sub(anchor, w)), F.col("oee")))
                .alias("prior_oee"))
    ok = F.col("recent_oee").isNotNull() & F.col("prior_oee").isNotNull() & (F.col("prior_oee") > 0)
    return r.select("recent_oee", "prior_oee",
                    F.when(ok, F.when(F.col("recent_oee") >= F.col("prior_oee"), "improved").otherwise("declined"))
                    .alias("direction"),
                    F.when(ok, F.abs(F.col("recent_oee") - F.col("prior_oee"))).alias("abs_delta"))


def weakest_component(summary: DataFrame) -> DataFrame:
    """The component with the lowest fleet mean (ties: Availability, Performance, Quality)."""
    means = summary.agg(F.avg("avg_availability").alias("Availability"), F.avg("avg_performance").alias("Performance"),
                        F.avg("avg_quality").alias("Quality"))
    long = means.unpivot([], ["Availability", "Performance", "Quality"], "component", "rate")
    order = F.when(F.col("component") == "Availability", 1).when(F.col("component") == "Performance", 2).otherwise(3)
    return (long.where(F.col("rate").isNotNull())
            .agg(F.min_by(F.struct("component", "rate"), F.struct(F.col("rate"), order)).alias("w"))
            .select("w.component", "w.rate"))


def lowest_performer(summary: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Machine with the lowest 7-day OEE, its gap to world class, machines under target."""
    target = dec(params.world_class_oee, 3, 2)
    key = F.struct(F.col("avg_oee"), F.col("machine_name"))
    return summary.agg(
        F.min_by(F.when(F.col("avg_oee").isNotNull(), F.col("machine_name")),
                 F.when(F.col("avg_oee").isNotNull(), key)).alias("machine_name"),
        F.min("avg_oee").alias("avg_oee"),
        (target - F.min("avg_oee")).alias("gap_to_target"),
        F.count_if(F.col("avg_oee") < target).alias("n_below_target"),
        F.count(F.lit(1)).alias("n_machines"))


def oee_pct_by_machine(oee: DataFrame) -> DataFrame:
    return oee.groupBy("machine_id").agg(
        F.round(F.avg("oee") * 100, 1).alias("avg_oee_pct"),
        F.round(F.min("oee") * 100, 1).alias("min_oee_pct"),
        F.round(F.max("oee") * 100, 1).alias("max_oee_pct"))


def anomaly_days_by_machine(health: DataFrame) -> DataFrame:
    return health.groupBy("machine_id").agg(
        F.sum(F.when(F.col("anomaly_flag"), 1).otherwise(0)).cast("long").alias("anomaly_days"),
        F.count(F.lit(1)).alias("total_days"))


def health_with_names(health: DataFrame, oee: DataFrame) -> DataFrame:
    """Health rows with the machine's name and type taken from the OEE facts (DISTINCT
    dimension triple, as the dashboard does)."""
    names = oee.select("machine_id", "machine_name", "machine_type").distinct()
    return health.join(names, "machine_id").select(
        "machine_id", "machine_name", "machine_type", "reading_date", "avg_temp_c", "max_temp_c",
        "avg_vibration_mm_s", "max_vibration_mm_s", "avg_power_kw", "max_power_kw", "anomaly_flag")


def latest_health_status(named: DataFrame) -> DataFrame:
    """Machines whose latest health day is flagged, machine count, latest date."""
    per = named.groupBy("machine_name").agg(
        F.max("reading_date").alias("last_date"),
        F.max_by("anomaly_flag", F.when(F.col("anomaly_flag").isNotNull(),
                                        F.struct("reading_date", "machine_id"))).alias("last_flag"))
    return per.agg(F.count_if(F.col("last_flag")).alias("n_active_anomaly"),
                   F.count(F.lit(1)).alias("n_machines"), F.max("last_date").alias("latest_reading_date"))


def anomaly_pivot(named: DataFrame) -> DataFrame:
    """Machines x days matrix of the anomaly flag, one row per machine: number of days, of anomaly
    days, and ``days``, "date=flag" for each of its days in order (flag 1, 0 or empty). The schema
    does not depend on the data, so no day list is fetched and no number of days is too large."""
    daily = named.groupBy("machine_name", "reading_date").agg(F.max(F.col("anomaly_flag").cast("int")).alias("a"))
    cell = F.concat(F.col("reading_date").cast("string"), F.lit("="), F.coalesce(F.col("a").cast("string"), F.lit("")))
    return daily.groupBy("machine_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.count_if(F.col("a") == 1).alias("n_anomaly_days"),
        F.array_join(F.array_sort(F.collect_list(cell)), " ").alias("days"))


def most_anomalous(named: DataFrame) -> DataFrame:
    """Machine with the most anomaly days (ties: first name), and distinct days overall."""
    per = named.groupBy("machine_name").agg(F.sum(F.col("anomaly_flag").cast("int")).alias("days"))
    total = named.select(F.countDistinct("reading_date")).scalar()
    return per.agg(F.min_by("machine_name", F.struct((-F.col("days")).alias("nd"), F.col("machine_name")))
                   .alias("machine_name"),
                   F.max("days").alias("anomaly_days")).select("machine_name", "anomaly_days",
                                                               total.alias("total_days"))


def anomaly_driver(named: DataFrame) -> DataFrame:
    """Per machine with anomaly days: peak vs mean for temperature and vibration, and
    which of the two has the larger peak/mean ratio."""
    g = named.groupBy("machine_name").agg(
        F.count_if("anomaly_flag").alias("anomaly_days"),
        F.max("max_temp_c").alias("peak_temp_c"), F.avg("avg_temp_c").alias("avg_temp_c"),
        F.max("max_vibration_mm_s").alias("peak_vibration_mm_s"), F.avg("avg_vibration_mm_s").alias("avg_vibration_mm_s"))
    primary = F.when(F.col("peak_temp_c") * F.col("avg_vibration_mm_s") > F.col("peak_vibration_mm_s") * F.col("avg_temp_c"),
                     "temperature").otherwise("vibration")
    return g.where(F.col("anomaly_days") > 0).withColumn("primary_driver", primary)


def anomaly_days(named: DataFrame) -> DataFrame:
    return named.where(F.col("anomaly_flag")).select("machine_name", "reading_date", "max_temp_c",
                                                      "max_vibration_mm_s", "max_power_kw")


def oee_components_long(summary: DataFrame) -> DataFrame:
    """Wide 7-day component means -> (machine, Component, rate)."""
    long = summary.select("machine_name", "avg_availability", "avg_performance", "avg_quality").unpivot(
        ["machine_name"], ["avg_availability", "avg_performance", "avg_quality"], "component", "rate")
    return long.select("machine_name", F.initcap(F.regexp_replace(F.col("component"), "^avg_", "")).alias("component"),
                       "rate")


def worst_machine(weekly: DataFrame) -> DataFrame:
    """Machine with the most downtime over all weeks (arg-max; ties: first name)."""
    per = weekly.groupBy("machine_name").agg(F.sum("total_downtime_hrs").alias("downtime_hrs"))
    return per.agg(
        F.min_by("machine_name", F.struct((-F.col("downtime_hrs")).alias("nh"), F.col("machine_name")))
        .alias("machine_name"),
        F.max("downtime_hrs").alias("downtime_hrs"))


def downtime_share(weekly: DataFrame) -> DataFrame:
    """Machine with the most downtime over all weeks and its share of the fleet total."""
    per = weekly.groupBy("machine_name").agg(F.sum("total_downtime_hrs").alias("hrs"))
    r = per.agg(F.min_by("machine_name", F.struct((-F.col("hrs")).alias("nh"), F.col("machine_name"))).alias("machine_name"),
                F.max("hrs").alias("machine_hrs"), F.sum("hrs").alias("total_hrs"))
    return r.where(F.col("total_hrs") > 0).withColumn(
        "share", (F.col("machine_hrs") / F.col("total_hrs")).cast(DecimalType(10, 6)))


def latest_week(weekly: DataFrame) -> DataFrame:
    wk = weekly.select(F.max("week_start")).scalar()
    return weekly.where(F.col("week_start") == wk)


def latest_week_kpis(weekly: DataFrame) -> DataFrame:
    return latest_week(weekly).agg(
        F.max("week_start").alias("week_start"),
        F.sum("total_units_produced").alias("units_produced"), F.sum("total_good_units").alias("good_units"),
        F.sum("total_defects").alias("defects"), F.sum("total_downtime_hrs").alias("downtime_hrs"))


def latest_week_detail(weekly: DataFrame) -> DataFrame:
    u = F.col("total_units_produced")
    rate = F.when(u == 0, F.lit(0)).otherwise(
        F.col("total_defects").cast(DecimalType(20, 0)) / u.cast(DecimalType(20, 0)))
    return latest_week(weekly).select(
        "machine_name", "machine_type", "total_units_produced", "total_good_units", "total_defects",
        "total_downtime_hrs", "avg_oee", F.coalesce(rate, F.lit(0)).cast(DecimalType(10, 6)).alias("defect_rate"))


def week_over_week(weekly: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Fleet mean of weekly OEE: latest week vs the week before it (the previous week
    present), and machines under target in the latest week; empty with fewer than two
    weeks or no prior mean. Two scalar anchors and conditional aggregates: no window,
    all partial."""
    last = weekly.select(F.max("week_start")).scalar()
    prev = weekly.where(F.col("week_start") < last).select(F.max("week_start")).scalar()
    per_week = (weekly.where(F.col("week_start") >= prev)
                .groupBy("week_start").agg(F.avg("avg_oee").alias("fleet_oee"),
                                           F.count_if(F.col("avg_oee") < dec(params.world_class_oee, 3, 2))
                                           .alias("below")))
    r = per_week.agg(F.max(F.when(F.col("week_start") == last, F.col("week_start"))).alias("latest_week"),
                     F.max(F.when(F.col("week_start") == last, F.col("fleet_oee"))).alias("latest_oee"),
                     F.max(F.when(F.col("week_start") == prev, F.col("fleet_oee"))).alias("prior_oee"),
                     F.max(F.when(F.col("week_start") == last, F.col("below"))).alias("n_below_target"),
                     F.count(F.lit(1)).alias("weeks"))
    delta = F.col("latest_oee") - F.col("prior_oee")
    return (r.where((F.col("weeks") == 2) & F.col("prior_oee").isNotNull())
            .select("latest_week", "latest_oee", "prior_oee", delta.alias("delta"),
                    F.when(delta >= 0, "up").otherwise("down").alias("direction"), "n_below_target"))


def coverage_gaps(machines: DataFrame, orders: DataFrame, shift_labels: list[str]) -> DataFrame:
    """Machine x day x shift slots between the first and last shift day with no order.

    The calendar spine is generated per machine row (``sequence`` + ``explode``), no
    cross join; the anti join removes slots that have an order.
    """
    lo = orders.select(F.min("shift_date")).scalar()
    hi = orders.select(F.max("shift_date")).scalar()
    grid = machines.select("machine_id", F.explode(F.sequence(lo, hi)).alias("shift_date")).select(
        "machine_id", "shift_date", F.explode(F.array(*[F.lit(s) for s in shift_labels])).alias("shift_label"))
    # distinct slots first: the partial aggregate collapses many orders of one slot map-side
    have = orders.select("machine_id", "shift_date", "shift_label").distinct()
    return grid.join(have, ["machine_id", "shift_date", "shift_label"], "left_anti")
