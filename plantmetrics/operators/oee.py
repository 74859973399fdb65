"""OEE facts: availability, performance, quality and their product per machine and day.

Plan shape (all joins on (machine_id, date), so the three daily aggregates share one
hash partitioning and the joins add no extra exchange):

    orders  --agg(machine_id, shift_date)--+
    downtime--agg(machine_id, event_date)--+--> left joins --> x machines (dimension)
    defects x orders(order_id) --agg-------+

Orders are aggregated once for all three components (the reference aggregates them three
times). Every aggregate is partial+final, so a hot machine only ships one partial row
per map task. The machine dimension is left to the planner: it is broadcast only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run
time), otherwise it is sort-merge joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

RATE = DecimalType(5, 4)
_KEYS = ["machine_id", "shift_date"]


def daily_orders(orders: DataFrame) -> DataFrame:
    """One row per machine-day: planned hours, actual and planned quantities."""
    return orders.groupBy("machine_id", "shift_date").agg(
        F.sum("shift_duration_hrs").alias("planned_time_hrs"),
        F.sum("actual_qty").cast(LongType()).alias("total_actual_qty"),
        F.sum("planned_qty").cast(LongType()).alias("total_planned_qty"),
    )


def daily_downtime(downtime: DataFrame) -> DataFrame:
    """Stoppage hours per machine and start day (overlaps are summed, as in the reference)."""
    return (downtime.groupBy("machine_id", F.col("event_date").alias("shift_date"))
            .agg(F.sum("duration_hrs").alias("downtime_hrs")))


def daily_defects(defects: DataFrame, orders: DataFrame) -> DataFrame:
    """Defective units resolved to (machine, day) through their order."""
    o = orders.select("order_id", "machine_id", "shift_date")
    return (defects.select("order_id", "qty_defective").join(o, "order_id")
            .groupBy("machine_id", "shift_date")
            .agg(F.sum("qty_defective").cast(LongType()).alias("total_defects")))


#: Bits of the filter of order ids: 16 MiB however many ids there are, so it can always be broadcast.
FILTER_BITS, _BLOCK = 1 << 27, 1 << 15


def defects_of(defects: DataFrame, orders: DataFrame) -> DataFrame:
    """The defects of ``orders`` and a few others: those whose order id is in a Bloom filter of the ids.

    The filter is a table of at most 4,096 blocks of 4 KiB, made by one aggregate over the orders' ids and
    broadcast, so defects of other orders end in the task that scans them. n ids let n / 2**27 of the
    others through (one in 100 for 1.3 million orders); the join by order id that follows is exact."""
    def at(key):
        return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(FILTER_BITS))

    blocks = (orders.where(F.col("order_id").isNotNull()).select(at("order_id").alias("_h"))
              .groupBy((F.col("_h") / _BLOCK).cast("int").alias("_block"))
              .agg(F.bitmap_construct_agg(F.col("_h") % _BLOCK).alias("_bits")))
    rows = defects.withColumn("_h", at("order_id")).withColumn("_b", (F.col("_h") / _BLOCK).cast("int"))
    rows = rows.join(F.broadcast(blocks), F.col("_b") == F.col("_block"))
    place = F.col("_h") % _BLOCK
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.where(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8).cast("int") + 1)) != 0
                      ).select(*defects.columns)


def _availability_cols(planned, downtime):
    down = F.coalesce(downtime, F.lit(0).cast(DecimalType(18, 4)))
    avail = F.greatest(F.lit(0), planned - down)
    rate = (F.when(planned == 0, F.lit(None))
            .otherwise(F.greatest(F.lit(0), F.try_divide(planned - down, planned))).cast(RATE))
    return down, avail, rate


def availability(orders: DataFrame, downtime: DataFrame) -> DataFrame:
    """(planned - downtime) / planned; clamped below at 0; NULL when nothing was planned."""
    shifts = orders.groupBy("machine_id", "shift_date").agg(F.sum("shift_duration_hrs").alias("planned_time_hrs"))
    j = shifts.join(daily_downtime(downtime), _KEYS, "left")
    down, avail, rate = _availability_cols(F.col("planned_time_hrs"), F.col("downtime_hrs"))
    return j.select("machine_id", "shift_date", "planned_time_hrs", down.alias("downtime_hrs"),
                    avail.alias("available_time_hrs"), rate.alias("availability_rate"))


def _performance_cols(actual, rate_hr, avail):
    den = rate_hr * avail
    theo = den.cast(DecimalType(10, 2))
    perf = (F.when(den == 0, F.lit(None))
            .otherwise(F.least(F.lit(1), F.try_divide(actual.cast(DecimalType(20, 0)), den))).cast(RATE))
    return theo, perf


def performance(orders: DataFrame, machines: DataFrame, avail: DataFrame) -> DataFrame:
    """actual / (theoretical rate x available hours); clamped above at 1; NULL when the
    machine had no available time."""
    o = orders.groupBy("machine_id", "shift_date").agg(
        F.sum("actual_qty").cast(LongType()).alias("total_actual_qty"),
        F.sum("planned_qty").cast(LongType()).alias("total_planned_qty"))
    j = (o.join(machines.select("machine_id", "theoretical_rate_per_hr"), "machine_id")
         .join(avail.select(*_KEYS, "available_time_hrs"), _KEYS))
    theo, perf = _performance_cols(F.col("total_actual_qty"), F.col("theoretical_rate_per_hr"),
                                   F.col("available_time_hrs"))
    return j.select("machine_id", "shift_date", "total_actual_qty", "total_planned_qty",
                    "theoretical_rate_per_hr", "available_time_hrs", theo.alias("theoretical_output"),
                    perf.alias("performance_rate"))


def _quality_cols(units, defects):
    d = F.coalesce(defects, F.lit(0).cast(LongType()))
    good = units - d
    q = (F.when(units == 0, F.lit(None))
         .otherwise(F.try_divide(good.cast(DecimalType(20, 0)), units.cast(DecimalType(20, 0)))).cast(RATE))
    return d, good, q


def quality(orders: DataFrame, defects: DataFrame) -> DataFrame:
    """(units - defective) / units; not clamped (negative when defects exceed output)."""
    o = orders.groupBy("machine_id", "shift_date").agg(F.sum("actual_qty").cast(LongType()).alias("total_units"))
    j = o.join(daily_defects(defects, orders), _KEYS, "left")
    d, good, q = _quality_cols(F.col("total_units"), F.col("total_defects"))
    return j.select("machine_id", "shift_date", "total_units", d.alias("total_defects"),
                    good.alias("good_units"), q.alias("quality_rate"))


OEE_COLUMNS = [
    "machine_id", "machine_name", "production_line", "machine_type", "theoretical_rate_per_hr",
    "shift_date", "planned_time_hrs", "downtime_hrs", "available_time_hrs", "availability_rate",
    "total_actual_qty", "theoretical_output", "performance_rate", "total_units", "good_units",
    "total_defects", "quality_rate", "oee",
]


def oee_daily(machines: DataFrame, orders: DataFrame, downtime: DataFrame, defects: DataFrame,
              since=None) -> DataFrame:
    """One row per machine and shift day: A, P, Q and OEE = A x P x Q as DECIMAL(5,4).

    ``since`` (a date) restricts to shift days >= since; the filter reaches the order and
    downtime scans' date columns before any shuffle, and defects, which carry no shift day, are
    kept by a filter of the window's order ids before they are shuffled.
    """
    if since is not None:
        # raw-timestamp twins of the date filters reach the scans (row-group skipping)
        start = F.lit(since).cast("timestamp_ntz")
        orders = orders.where((F.col("shift_start") >= start) & (F.col("shift_date") >= F.lit(since)))
        downtime = downtime.where((F.col("started_at") >= start) & (F.col("event_date") >= F.lit(since)))
        defects = defects_of(defects, orders)
    od = daily_orders(orders)
    j = (od.join(daily_downtime(downtime), _KEYS, "left")
         .join(daily_defects(defects, orders), _KEYS, "left")
         .join(machines.select("machine_id", "machine_name", "production_line", "machine_type",
                               "theoretical_rate_per_hr"), "machine_id"))
    down, avail, a = _availability_cols(F.col("planned_time_hrs"), F.col("downtime_hrs"))
    j = j.select("*", down.alias("_down"), avail.alias("available_time_hrs"), a.alias("availability_rate"))
    theo, p = _performance_cols(F.col("total_actual_qty"), F.col("theoretical_rate_per_hr"),
                                F.col("available_time_hrs"))
    d, good, q = _quality_cols(F.col("total_actual_qty"), F.col("total_defects"))
    out = j.select(
        "machine_id", "machine_name", "production_line", "machine_type", "theoretical_rate_per_hr",
        "shift_date", "planned_time_hrs", F.col("_down").alias("downtime_hrs"), "available_time_hrs",
        "availability_rate", "total_actual_qty", theo.alias("theoretical_output"), p.alias("performance_rate"),
        F.col("total_actual_qty").alias("total_units"), good.alias("good_units"), d.alias("total_defects"),
        q.alias("quality_rate"))
    return out.withColumn(
        "oee", (F.col("availability_rate") * F.col("performance_rate") * F.col("quality_rate")).cast(RATE))


def production_summary(oee: DataFrame) -> DataFrame:
    """Weekly roll-up per machine (weeks start on Monday). Averages are unweighted means of
    the daily rates, as in the reference."""
    from plantmetrics.functions.columns import monday_of
    return (oee.groupBy("machine_id", "machine_name", "production_line", "machine_type",
                        monday_of("shift_date").alias("week_start"))
            .agg(F.count("shift_date").alias("days_in_week"),
                 F.avg("oee").cast(RATE).alias("avg_oee"),
                 F.min("oee").cast(RATE).alias("min_oee"),
                 F.max("oee").cast(RATE).alias("max_oee"),
                 F.sum("total_units").cast(LongType()).alias("total_units_produced"),
                 F.sum("good_units").cast(LongType()).alias("total_good_units"),
                 F.sum("total_defects").cast(LongType()).alias("total_defects"),
                 F.sum("downtime_hrs").cast(DecimalType(18, 4)).alias("total_downtime_hrs"),
                 F.avg("availability_rate").cast(RATE).alias("avg_availability"),
                 F.avg("performance_rate").cast(RATE).alias("avg_performance"),
                 F.avg("quality_rate").cast(RATE).alias("avg_quality")))


_WEEK = ["machine_id", "machine_name", "production_line", "machine_type", "week_start"]
_MEANS = {"oee": "avg_oee", "availability_rate": "avg_availability", "performance_rate": "avg_performance", "quality_rate": "avg_quality"}
SUMMARY_COLUMNS = [*_WEEK, "days_in_week", "avg_oee", "min_oee", "max_oee", "total_units_produced", "total_good_units",
                   "total_defects", "total_downtime_hrs", "avg_availability", "avg_performance", "avg_quality"]


def weekly_partials(oee: DataFrame) -> DataFrame:
    """The weekly roll-up of some days in a form that merges: sums and counts in place of means."""
    from plantmetrics.functions.columns import monday_of
    return oee.groupBy(*_WEEK[:-1], monday_of("shift_date").alias("week_start")).agg(
        F.count("shift_date").alias("days_in_week"),
        *[F.sum(c).cast(DecimalType(15, 4)).alias(f"sum_{c}") for c in _MEANS], *[F.count(c).alias(f"n_{c}") for c in _MEANS],
        F.min("oee").alias("min_oee"), F.max("oee").alias("max_oee"),
        F.sum("total_units").cast(LongType()).alias("total_units_produced"),
        F.sum("good_units").cast(LongType()).alias("total_good_units"),
        F.sum("total_defects").cast(LongType()).alias("total_defects"),
        F.sum("downtime_hrs").cast(DecimalType(18, 4)).alias("total_downtime_hrs"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of disjoint sets of days -> one row per machine and week."""
    smallest = {"min_oee": F.min, "max_oee": F.max}
    types = partials.schema
    return partials.groupBy(*_WEEK).agg(*[smallest.get(c, F.sum)(c).cast(types[c].dataType).alias(c)
                                          for c in partials.columns if c not in _WEEK])


def weekly_rows(partials: DataFrame) -> DataFrame:
    """Merged partials -> the rows of ``production_summary``."""
    means = [F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}").cast(DecimalType(20, 0))).cast(DecimalType(9, 8)).cast(RATE).alias(name)
             for c, name in _MEANS.items()]
    return partials.select("*", *means).select(*SUMMARY_COLUMNS)
