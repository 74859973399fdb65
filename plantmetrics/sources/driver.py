"""Adapter: the driver's generic test tables seen as the manufacturing source tables.

The test data carries no manufacturing tables, so each raw domain table is a fixed,
documented projection of a driver table (FIXTURES.md §2). The oracle SQL applies the same
mapping. Each mapping is a narrow projection (no shuffles); the only data-dependent
constants (supplier count, embedding count) enter as scalar subqueries, evaluated once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType

from plantmetrics.sources.readers import Source

# --- Fixed values (value domains of the reference's seed data) -----------------------
MACHINE_TYPES = ["CNC_MILL", "LATHE", "WELDING_ROBOT", "ASSEMBLY_BOT", "INJECTION_MOLD", "QUALITY_SCANNER"]
PRODUCTION_LINES = ["LINE_A", "LINE_B", "LINE_C"]
SHIFT_LABELS = ["MORNING", "AFTERNOON", "NIGHT"]
SHIFT_START_HOURS = [6, 14, 22]
DEFECT_TYPES = ["DIMENSIONAL_ERROR", "SURFACE_SCRATCH", "WELD_DEFECT", "ASSEMBLY_GAP", "MATERIAL_FLAW"]
REASON_CODES = ["UNPLANNED_BREAKDOWN", "MATERIAL_JAM", "TOOLING_FAILURE", "POWER_FLUCTUATION", "OPERATOR_ERROR"]
CONFIDENCE_LEVELS = ["HIGH", "MEDIUM", "LOW"]
# -------------------------------------------------------------------------------------

EPOCH = "2024-01-01 00:00:00"
SHIFT_HOURS = 4


def pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def k_of(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def rate_of(machine_id: Column) -> Column:
    return (F.lit(100) + (machine_id % 5) * 50).cast("int")


class DriverTables(Source):
    """Raw domain tables derived from ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The driver table (one file listing per adapter instance)."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # Data-dependent constants of the mapping: one row count each, taken once per adapter
    # (Parquet answers a bare count from file metadata) and used as literals.
    @cached_property
    def n_machines(self) -> Column:
        return F.lit(self.raw("supplier").count())

    @cached_property
    def n_vectors(self) -> Column:
        return F.lit(self.raw("embeddings").count())

    def table(self, name: str) -> DataFrame:
        """A raw domain table. Every mapping below casts each column to the declared
        schema itself (``tests/test_sources.py`` pins this), so no extra projection."""
        builder = getattr(self, f"_{name}", None)
        if builder is None:
            raise KeyError(name)
        return builder()

    # --- ERP side ---------------------------------------------------------------------
    def _machines(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            F.col("s_suppkey").cast(IntegerType()).alias("machine_id"),
            F.col("s_name").alias("machine_name"),
            pick(MACHINE_TYPES, F.col("s_nationkey") % 6).alias("machine_type"),
            pick(PRODUCTION_LINES, F.col("s_nationkey") % 3).alias("production_line"),
            rate_of(F.col("s_suppkey")).alias("theoretical_rate_per_hr"),
            F.lit("2020-01-01").cast("date").alias("install_date"),
        )

    def _production_orders(self) -> DataFrame:
        o = self.raw("orders")
        key = F.col("o_orderkey")
        mid = (F.col("o_custkey") % self.n_machines).cast(IntegerType())
        shift = key % 3
        start = (F.lit(EPOCH).cast("timestamp_ntz")
                 + F.make_dt_interval(days=(key % 30).cast("int"),
                                      hours=pick([str(h) for h in SHIFT_START_HOURS], shift).cast("int")))
        planned = rate_of(mid) * SHIFT_HOURS
        return (o.select(key.alias("order_id"), mid.alias("machine_id"), shift.alias("_shift"),
                         start.alias("shift_start"))
                .select(
                    "order_id", "machine_id",
                    F.concat(F.lit("SKU-"), F.lpad((F.col("machine_id") * 100 + F.col("order_id") % 5 + 1)
                                                   .cast("string"), 4, "0")).alias("product_sku"),
                    pick(SHIFT_LABELS, F.col("_shift")).alias("shift_label"),
                    "shift_start",
                    (F.col("shift_start") + F.make_dt_interval(hours=F.lit(SHIFT_HOURS))).alias("shift_end"),
                    (rate_of(F.col("machine_id")) * SHIFT_HOURS).alias("planned_qty"),
                    F.expr(f"(({SHIFT_HOURS} * (100 + (machine_id % 5) * 50)) * (70 + order_id % 29)) div 100")
                    .cast(IntegerType()).alias("actual_qty"),
                ))

    def _defects(self) -> DataFrame:
        li = self.raw("lineitem")
        return (li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
                .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast(LongType()).alias("defect_id"),
                        F.col("l_orderkey").alias("order_id"),
                        pick(DEFECT_TYPES, F.col("l_partkey") % 5).alias("defect_type"),
                        F.col("l_quantity").cast(IntegerType()).alias("qty_defective")))

    # --- IoT side ---------------------------------------------------------------------
    def _events(self, kinds: list[str], negate: bool = False) -> DataFrame:
        e = self.raw("events")
        cond = F.col("event_type").isin(kinds)
        return e.where(~cond if negate else cond)

    def _sensor_readings(self) -> DataFrame:
        e = self._events(["error"], negate=True)
        v2 = F.col("value").cast(DecimalType(10, 2))
        k = k_of(F.col("props"))
        return e.select(
            (F.col("user_id") % self.n_machines).cast(IntegerType()).alias("machine_id"),
            F.col("ts"),
            (F.lit(20) + v2 * F.lit("0.1").cast(DecimalType(1, 1))).cast(DecimalType(5, 2)).alias("temperature_c"),
            (k * F.lit("0.1").cast(DecimalType(1, 1))).cast(DecimalType(6, 3)).alias("vibration_mm_s"),
            v2.cast(DecimalType(7, 3)).alias("power_kw"),
        )

    def _downtime_events(self) -> DataFrame:
        e = self._events(["error"])
        k = k_of(F.col("props"))
        return e.select(
            F.col("event_id"),
            (F.col("user_id") % self.n_machines).cast(IntegerType()).alias("machine_id"),
            F.col("ts").alias("started_at"),
            (F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 600).cast(DecimalType(18, 6))))
            .alias("ended_at"),
            pick(REASON_CODES, k % 5).alias("reason_code"),
        )

    # --- AI side ----------------------------------------------------------------------
    def _maintenance_recommendations(self) -> DataFrame:
        e = self._events(["signup"])
        k = k_of(F.col("props"))
        v2 = F.col("value").cast(DecimalType(10, 2))
        mid = (F.col("user_id") % self.n_machines).cast(IntegerType())
        return e.select(
            F.col("event_id").alias("rec_id"),
            mid.alias("machine_id"),
            F.concat(F.lit("Machine "), mid.cast("string")).alias("machine_name"),
            F.col("ts").alias("generated_at"),
            (v2 * F.lit("0.01").cast(DecimalType(2, 2))).cast(DecimalType(6, 3)).alias("anomaly_score"),
            F.concat(F.lit("Pattern "), k.cast("string")).alias("root_cause"),
            F.concat(F.lit("Inspect component "), (k % 7).cast("string")).alias("recommended_action"),
            F.when(k == 0, F.lit(None)).otherwise(v2.cast(DecimalType(6, 1))).alias("estimated_hours_to_failure"),
            pick(CONFIDENCE_LEVELS, k % 3).alias("confidence"),
            F.concat(F.lit("["), k.cast("string"), F.lit("]")).alias("similar_pattern_ids"),
        )

    def _responses(self) -> DataFrame:
        """LLM response texts: one per click event; some broken on purpose."""
        e = self._events(["click"])
        k = k_of(F.col("props"))
        hours = F.col("value").cast(DecimalType(10, 2)).cast("string")
        rc = F.concat(F.lit('"root_cause": "Bearing wear pattern '), k.cast("string"), F.lit('"'))
        act = F.lit('"recommended_action": "Replace spindle bearing"')
        conf = F.concat(F.lit('"confidence": "'), pick(CONFIDENCE_LEVELS, k % 3), F.lit('"'))
        num = F.concat(F.lit('"estimated_hours_to_failure": '), hours)
        text = (F.when(k % 10 == 0, F.concat(F.lit("{"), rc))
                .when(k % 10 == 1, F.concat_ws(", ", F.concat(F.lit("{"), rc), act, F.concat(conf, F.lit("}"))))
                .when(k % 10 == 2, F.concat_ws(", ", F.concat(F.lit("{"), rc), act,
                                               F.concat(F.lit('"estimated_hours_to_failure": "'), hours, F.lit('"')),
                                               F.concat(conf, F.lit("}"))))
                .when(k % 10 == 3, F.concat_ws(", ", F.concat(F.lit("{"), rc), act, num,
                                               F.lit('"confidence": "CERTAIN"}')))
                .otherwise(F.concat_ws(", ", F.concat(F.lit("{"), rc), act, num, F.concat(conf, F.lit("}")))))
        return e.select(F.col("event_id").alias("response_id"),
                        (F.col("user_id") % self.n_machines).cast(IntegerType()).alias("machine_id"),
                        text.alias("response"))

    def embeddings(self) -> DataFrame:
        """(vec_id, embedding array<double>)."""
        return self.raw("embeddings").select(
            "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))

    def machine_vectors(self, machines: DataFrame) -> DataFrame:
        """Query vector per machine: the embedding whose vec_id = machine_id mod count."""
        m = machines.select("machine_id", (F.col("machine_id") % self.n_vectors).alias("vec_id"))
        return m.join(self.embeddings(), "vec_id").select("machine_id", "embedding")

    def pattern_vectors(self, events: DataFrame) -> DataFrame:
        """Embedding per failure event: vec_id = pattern_id mod count (stand-in for an
        embedding service; the description text is kept alongside)."""
        ev = events.withColumn("vec_id", F.col("pattern_id") % self.n_vectors)
        return ev.join(self.embeddings(), "vec_id").drop("vec_id")

    def _signal_columns(self) -> list[Column]:
        fail = F.col("l_returnflag") == "R"
        sel = F.col("l_partkey") % 7
        flags = [(fail & (sel == i)).cast("int").alias(n) for i, n in enumerate(["TWF", "HDF", "PWF", "OSF", "RNF"])]
        return [
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("UDI"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"))
            .alias("Product ID"),
            (F.col("l_suppkey") % self.n_machines).cast(IntegerType()).alias("machine_id"),
            (F.col("l_shipdate") + F.make_dt_interval(mins=((F.col("l_orderkey") % 288) * 5).cast("int")))
            .alias("ts"),
            (F.lit(300.0) + F.col("l_quantity") / 10).alias("Process temperature [K]"),
            (F.lit(1000.0) + F.col("l_extendedprice") % 2000).alias("Rotational speed [rpm]"),
            F.col("l_quantity").alias("Torque [Nm]"),
            fail.cast("int").alias("Machine failure"),
            *flags,
        ]

    def signal_rows(self) -> DataFrame:
        """Raw trace rows in the predictive-maintenance CSV layout, one per lineitem."""
        return self.raw("lineitem").select(*self._signal_columns())

    def signal_csv_lines(self) -> DataFrame:
        """The trace rows as CSV text lines (UDI, temperature, speed, torque, failure, five
        type flags). Rows whose line number is 7 carry a broken speed field, the kind of
        line the loader must skip."""
        rows = self.raw("lineitem").select(*self._signal_columns(), "l_linenumber")
        rpm = (F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
               .otherwise(F.col("Rotational speed [rpm]").cast("string")))
        fields = [F.col("UDI").cast("string"), F.col("Process temperature [K]").cast("string"), rpm,
                  F.col("Torque [Nm]").cast("string")]
        fields += [F.col(c).cast("string") for c in ["Machine failure", "TWF", "HDF", "PWF", "OSF", "RNF"]]
        return rows.select(F.concat_ws(",", *fields).alias("line"))
