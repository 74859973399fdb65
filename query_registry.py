"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame.

Each entry runs library operators over the whole driver tables (via the adapter).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def edge(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE (the oracle SQL does the same)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def model(spark: SparkSession, sf_dir: str, params=None):
    from plantmetrics.params import DEFAULT
    from plantmetrics.plans.model import Model
    from plantmetrics.sources.driver import DriverTables
    return Model(spark, DriverTables(spark, sf_dir), params or DEFAULT)


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return edge(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _attr(name: str, attr: str | None = None, doc: str = ""):
    def fn(spark, sf_dir):
        return getattr(model(spark, sf_dir), attr or name)
    fn.__doc__ = doc
    register(name)(fn)


_attr("stg_machines", doc="PRJ-1: staged machine master.")
_attr("stg_orders", doc="PRJ-2: staged orders with shift_date and shift hours.")
_attr("stg_defects", doc="PRJ-3: staged defects.")
_attr("stg_sensor", doc="PRJ-4: staged readings with hour bucket and date.")
_attr("stg_downtime", doc="PRJ-5: staged stoppages with event_date and hours.")
_attr("availability", doc="JN-1/AGG-1: availability per machine-day.")
_attr("performance", doc="JN-2/AGG-1: performance per machine-day.")
_attr("quality", doc="JN-3/JN-4: quality per machine-day.")
_attr("oee_daily", doc="JN-5/PRJ-7: OEE per machine-day.")
_attr("machine_health", doc="AGG-2/PRJ-11: daily sensor health with anomaly flag.")
_attr("production_summary", doc="AGG-3: weekly roll-up.")


@register("oee_trend_7d")
def _q_oee_trend(spark, sf):
    """JN-6/AGG-4: per-machine 7-day OEE trend (own anchor)."""
    from plantmetrics.operators import trend
    m = model(spark, sf)
    return trend.trend_report(m.oee_trend)


_attr("latest_health", doc="AGG-5/JN-7: recent health per machine (fleet anchor).")
_attr("at_risk_machines", doc="REC-5/FLT-2/JN-9/PRJ-12: at-risk machines with anomaly score.")
_attr("maintenance_queue", doc="REC-11/JN-8/PRJ-9/SRT-1: the maintenance queue.")


@register("latest_recommendation")
def _q_latest_rec(spark, sf):
    """WIN-1: newest recommendation per machine."""
    from plantmetrics.operators import recommend
    return recommend.latest_recommendation(model(spark, sf).recommendations_raw)


@register("urgency_tiers")
def _q_urgency_tiers(spark, sf):
    """PRJ-9: urgency tier of every stored recommendation."""
    from plantmetrics.operators import recommend
    r = model(spark, sf).recommendations_raw
    return r.select("rec_id", "machine_id", "estimated_hours_to_failure",
                    recommend.urgency_tier(F.col("estimated_hours_to_failure")).alias("urgency_tier"))


@register("urgency_breakdown")
def _q_urgency_breakdown(spark, sf):
    """AGG-12: machines per urgency tier in the queue."""
    from plantmetrics.operators import recommend
    return recommend.urgency_breakdown(model(spark, sf).maintenance_queue)


@register("queue_headline")
def _q_queue_headline(spark, sf):
    """REC-12: one-row queue summary."""
    from plantmetrics.operators import recommend
    return recommend.queue_headline(model(spark, sf).maintenance_queue)


@register("queue_cards")
def _q_queue_cards(spark, sf):
    """RPT-7: card labels per queued machine."""
    from plantmetrics.operators import recommend
    return recommend.queue_cards(model(spark, sf).maintenance_queue)


@register("validate_responses")
def _q_validate(spark, sf):
    """FN-J1/REC-8: JSON response validation with clamping and defaults."""
    from plantmetrics.operators import recommend
    from plantmetrics.sources.driver import DriverTables
    return recommend.validate_responses(DriverTables(spark, sf).table("responses"))


@register("safe_cast")
def _q_safe_cast(spark, sf):
    """FN-M5: Python-style float() with default 0 over the raw estimate field."""
    from plantmetrics.operators import recommend
    from plantmetrics.sources.driver import DriverTables
    r = DriverTables(spark, sf).table("responses")
    raw = F.get_json_object("response", "$.estimated_hours_to_failure")
    return r.select("response_id", raw.alias("raw_hours"), recommend.safe_number(raw).alias("hours"))


_attr("failure_history", doc="REC-1/JN-10/FLT-3: stoppages with machine, day health and OEE.")


@register("failure_descriptions")
def _q_failure_descriptions(spark, sf):
    """REC-2/FN-S6/FN-S7: description text per failure event."""
    from plantmetrics.operators import retrieval
    return retrieval.with_descriptions(model(spark, sf).failure_history).select("event_id", "description")


@register("assign_ids")
def _q_assign_ids(spark, sf):
    """FN-K1: consecutive pattern ids in (started_at, machine_id, event_id) order."""
    return model(spark, sf).numbered_history.select("event_id", "pattern_id")


@register("failure_patterns")
def _q_failure_patterns(spark, sf):
    """REC-4: the failure-pattern vector store (embedding shown as its dimension)."""
    p = model(spark, sf).failure_patterns
    return p.select("pattern_id", "machine_id", "machine_type", "event_date", "reason_code", "downtime_hrs",
                    "description", F.size("embedding").alias("embedding_dims"))


@register("similar_failures")
def _q_similar_failures(spark, sf):
    """REC-6/JN-12/FN-A3/SRT-5: cosine top-3 failures per at-risk machine (similarity to 6 places)."""
    s = model(spark, sf).similar_failures
    return s.withColumn("similarity", F.round("similarity", 6))


def _fresh_folder(spark, name):
    import uuid

    from plantmetrics.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("similar_failures_indexed")
def _q_similar_failures_indexed(spark, sf):
    """REC-6/JN-12/SRT-5 through the stored vector index: patterns of the first stoppages indexed, those of
    later ones (every fifth event) added, then searched list by list."""
    from plantmetrics.operators import vector_index
    m, path = model(spark, sf), _fresh_folder(spark, "pattern_index")
    p = m.failure_patterns.join(m.numbered_history.select("pattern_id", "event_id"), "pattern_id").drop("description")
    late = F.col("event_id") % 5 == 0
    vector_index.build(p.where(~late).drop("event_id"), path)
    vector_index.add(p.where(late).drop("event_id"), path)
    s = vector_index.search(m.query_vectors, vector_index.Index(spark, path), m.params.top_k).rows
    return s.withColumn("similarity", F.round("similarity", 6))


@register("grown_pattern_ids")
def _q_grown_pattern_ids(spark, sf):
    """REC-4/FN-K1: the pattern store after late stoppages (every fifth event) have arrived in a second run: the
    ids of the first run stay, new ones go on after them."""
    from plantmetrics.operators import retrieval
    from plantmetrics.operators.ids import assign_ids
    from plantmetrics.plans import versions
    path, history = _fresh_folder(spark, "pattern_store"), model(spark, sf).failure_history
    late = F.col("event_id") % 5 == 0
    first = assign_ids(history.where(~late), ["started_at", "machine_id", "event_id"], "pattern_id").select("event_id", "pattern_id")
    versions.write_version(spark, path, lambda folder: first.write.parquet(folder))
    fresh = retrieval.fresh_history(history, versions.read(spark, path)).select("event_id", "pattern_id")
    versions.write_version(spark, path, lambda folder: fresh.write.parquet(folder), append=True)
    return versions.read(spark, path)


@register("pattern_preview")
def _q_pattern_preview(spark, sf):
    """FN-S2/SRT-3: ten newest patterns with a 120-character description preview."""
    p = model(spark, sf).failure_patterns
    return (p.select("pattern_id", "machine_type", "event_date", "reason_code", "downtime_hrs",
                     F.substring("description", 1, 120).alias("description_preview"))
            .orderBy(F.desc("event_date"), F.desc("pattern_id")).limit(10))


@register("embedding_dims")
def _q_embedding_dims(spark, sf):
    """FN-S3/FN-A2: stored text form of each embedding: characters and dimensions."""
    from plantmetrics.functions.vectors import format_vector, vector_dims
    p = model(spark, sf).failure_patterns.select("pattern_id", format_vector("embedding").alias("text"))
    return p.select("pattern_id", F.length("text").alias("embedding_chars"), vector_dims("text").alias("embedding_dims"))


@register("vector_parse")
def _q_vector_parse(spark, sf):
    """FN-A1/FN-A2/FN-A3: text round trip of every embedding and its self-cosine."""
    from plantmetrics.functions.vectors import cosine_expr, format_vector, parse_vector
    from plantmetrics.sources.driver import DriverTables
    e = DriverTables(spark, sf).embeddings()
    t = e.select("vec_id", "embedding", parse_vector(format_vector("embedding")).alias("parsed"))
    err = F.aggregate(F.zip_with("parsed", "embedding", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: F.greatest(s, x))
    return t.select("vec_id", F.size("parsed").alias("dims"), (err < 1e-8).alias("round_trip_ok"),
                    F.round(cosine_expr("parsed", "embedding"), 6).alias("self_cosine"))


@register("failures_by_reason")
def _q_failures_by_reason(spark, sf):
    """AGG-11: patterns per reason with mean downtime."""
    p = model(spark, sf).failure_patterns
    return p.groupBy("reason_code").agg(F.count(F.lit(1)).alias("occurrences"),
                                        F.round(F.avg("downtime_hrs"), 1).alias("avg_downtime_hrs"))


@register("machine_descriptions")
def _q_machine_descriptions(spark, sf):
    """REC-3: current-state text per at-risk machine."""
    from plantmetrics.operators import retrieval
    a = model(spark, sf).at_risk_machines
    c = F.col
    return a.select("machine_id", retrieval.machine_description(
        c("machine_type"), c("max_temp_c"), c("avg_temp_c"), c("max_vibration_mm_s"), c("avg_vibration_mm_s"),
        c("max_power_kw"), c("avg_power_kw"), c("oee_last_7d")).alias("description"))


_attr("prompts", doc="REC-7: LLM prompt per at-risk machine.")


@register("fallback_recommendations")
def _q_fallback(spark, sf):
    """REC-9/FN-S5: rule-based recommendation from the best match."""
    return model(spark, sf).fallback_recommendations


_attr("new_recommendations", doc="REC-10/FN-A4: recommendation rows for this run.")
QUERIES["recommendations"] = QUERIES.pop("new_recommendations")


@register("upsert_recommendations")
def _q_upsert(spark, sf):
    """SNK-8/FN-K1: replace today's row per machine, keep history, new ids after the max.
    Runs with as_of = 2024-01-30 so same-day rows exist and are replaced."""
    import datetime as dt

    from plantmetrics.params import DEFAULT
    from plantmetrics.plans.incremental import upsert_recommendations
    m = model(spark, sf, DEFAULT.with_(as_of=dt.date(2024, 1, 30)))
    return upsert_recommendations(m.recommendations_raw, m.new_recommendations)


# --- events & signals ------------------------------------------------------------------------
@register("cooldown_events")
def _q_cooldown(spark, sf):
    """ST-4: stoppages kept by the per-machine greedy 2-hour cooldown."""
    from plantmetrics.operators.events import greedy_cooldown
    d = model(spark, sf).source.table("downtime_events")
    return greedy_cooldown(d, "machine_id", "started_at", ["event_id"], model(spark, sf).params.cooldown_s)


@register("derive_downtime")
def _q_derive_downtime(spark, sf):
    """ST-5/FN-S8/FN-K1: stoppages derived from failure flags of the trace rows."""
    from plantmetrics.operators.events import derive_downtime
    from plantmetrics.sources.driver import DriverTables
    dt = DriverTables(spark, sf)
    return derive_downtime(dt.signal_rows(), dt.table("downtime_events"), model(spark, sf).params.cooldown_s)


@register("csv_clean")
def _q_csv_clean(spark, sf):
    """SRC-3: CSV trace lines parsed with a fixed schema; malformed lines skipped."""
    from plantmetrics.operators.signals import parse_signal_csv
    from plantmetrics.sources.driver import DriverTables
    return parse_signal_csv(DriverTables(spark, sf).signal_csv_lines())


@register("csv_rejected")
def _q_csv_rejected(spark, sf):
    """SRC-3: the lines that the loader skips, from the side table that the pass over all lines wrote."""
    import uuid

    from plantmetrics.operators.signals import judge_signal_csv
    from plantmetrics.session import ensure_checkpoint_dir
    from plantmetrics.sources.csv_load import load_csv
    from plantmetrics.sources.driver import DriverTables
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    return load_csv(judge_signal_csv(DriverTables(spark, sf).signal_csv_lines()), path).rejected.select("UDI", "reason")


@register("signal_features")
def _q_signal_features(spark, sf):
    """FN-M2: °C and shaft power from the parsed trace rows."""
    from plantmetrics.operators.signals import parse_signal_csv, signal_features
    from plantmetrics.sources.driver import DriverTables
    return signal_features(parse_signal_csv(DriverTables(spark, sf).signal_csv_lines()))


@register("signal_stats")
def _q_signal_stats(spark, sf):
    """AGG-23/AGG-24: signal means, sample std-devs, failure rate."""
    from plantmetrics.operators.signals import parse_signal_csv, signal_features, signal_stats
    from plantmetrics.sources.driver import DriverTables
    st = signal_stats(signal_features(parse_signal_csv(DriverTables(spark, sf).signal_csv_lines())))
    # floating sums depend on summation order: report the statistics to 9 decimals
    return st.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in st.dtypes])


@register("zscale_signals")
def _q_zscale(spark, sf):
    """FN-M3: per-machine z-score rescale of every trace row."""
    from plantmetrics.operators.signals import signal_features, zscale_signals
    from plantmetrics.sources.driver import DriverTables
    return zscale_signals(signal_features(DriverTables(spark, sf).signal_rows(), keep=("machine_id",)))


@register("failure_reason")
def _q_failure_reason(spark, sf):
    """FN-S8: reason code of each failing trace row (first raised flag wins)."""
    from plantmetrics.operators.events import failure_reason
    from plantmetrics.sources.driver import DriverTables
    r = DriverTables(spark, sf).signal_rows()
    return r.where(F.col("Machine failure") == 1).select("UDI", failure_reason().alias("reason_code"))


@register("coverage_gaps")
def _q_coverage_gaps(spark, sf):
    """JN-13/FN-D5: machine x day x shift slots without an order."""
    from plantmetrics.operators.reports import coverage_gaps
    from plantmetrics.sources.driver import SHIFT_LABELS
    m = model(spark, sf)
    return coverage_gaps(m.stg_machines, m.stg_orders, SHIFT_LABELS)


# --- reports ------------------------------------------------------------------------------------
def _rep(name, doc, fn):
    def q(spark, sf):
        return fn(model(spark, sf))
    q.__doc__ = doc
    register(name)(q)


def _summary(m):
    from plantmetrics.operators.reports import oee_summary_7d
    return oee_summary_7d(m.oee_daily, m.params)


def _named(m):
    from plantmetrics.operators.reports import health_with_names
    return health_with_names(m.machine_health, m.oee_daily)


def _r(fn_name):
    from plantmetrics.operators import reports
    return getattr(reports, fn_name)


_rep("oee_summary_7d", "AGG-8/FLT-1: 7-day means per machine.", _summary)
_rep("oee_bands", "PRJ-10: OEE band per machine (7-day mean).",
     lambda m: _summary(m).select("machine_name", "avg_oee", _r("oee_band")(F.col("avg_oee")).alias("band")))
_rep("fleet_kpis", "AGG-13: fleet mean OEE, world-class and at-risk counts.", lambda m: _r("fleet_kpis")(_summary(m)))
_rep("fleet_trend", "AGG-14: fleet recent vs prior week.", lambda m: _r("fleet_trend")(m.oee_daily, m.params))
_rep("weakest_component", "AGG-15: weakest OEE component fleet-wide.", lambda m: _r("weakest_component")(_summary(m)))
_rep("lowest_performer", "RPT-4/AGG-16: lowest 7-day OEE machine and gap.", lambda m: _r("lowest_performer")(_summary(m)))
_rep("oee_pct_by_machine", "AGG-9: min/avg/max OEE percent per machine.", lambda m: _r("oee_pct_by_machine")(m.oee_daily))
_rep("anomaly_days_by_machine", "AGG-10: anomaly days per machine.", lambda m: _r("anomaly_days_by_machine")(m.machine_health))
_rep("health_with_names", "JN-11/AGG-7: health with names from the OEE facts.", _named)
_rep("latest_health_status", "WIN-2/RPT-6: machines with an active anomaly.", lambda m: _r("latest_health_status")(_named(m)))
_rep("most_anomalous", "AGG-16/AGG-17: machine with most anomaly days.", lambda m: _r("most_anomalous")(_named(m)))
_rep("anomaly_driver", "AGG-20: primary anomaly driver per machine.", lambda m: _r("anomaly_driver")(_named(m)))
_rep("anomaly_days", "RPT-5/FLT-8: anomaly-day listing.", lambda m: _r("anomaly_days")(_named(m)))
_rep("oee_components_long", "AGG-22: unpivoted 7-day components.", lambda m: _r("oee_components_long")(_summary(m)))
_rep("worst_machine", "AGG-16: machine with the most downtime (arg-max).", lambda m: _r("worst_machine")(m.production_summary))
_rep("downtime_share", "AGG-18: top machine's share of downtime.", lambda m: _r("downtime_share")(m.production_summary))
_rep("latest_week_kpis", "AGG-19: latest-week totals.", lambda m: _r("latest_week_kpis")(m.production_summary))
_rep("latest_week_detail", "RPT-1/PRJ-13: latest-week rows with defect rate.", lambda m: _r("latest_week_detail")(m.production_summary))
_rep("week_over_week", "RPT-3/WIN-3: week-on-week fleet change.", lambda m: _r("week_over_week")(m.production_summary, m.params))
_rep("weekly_downtime", "RPT-2: weekly downtime per machine.",
     lambda m: m.production_summary.select("week_start", "machine_name", "total_downtime_hrs"))
_rep("oee_trend_series", "SRT-6: daily OEE series in date order.",
     lambda m: m.oee_daily.select("machine_name", "shift_date", "oee", "availability_rate", "performance_rate",
                                  "quality_rate").orderBy("shift_date", "machine_name"))


@register("oee_trend_selected")
def _q_oee_trend_selected(spark, sf):
    """FLT-6: daily OEE of the default selection (first four machine names)."""
    o = model(spark, sf).oee_daily
    chosen = o.select("machine_name").distinct().orderBy("machine_name").limit(4)
    return (o.join(chosen, "machine_name", "left_semi")
            .select("machine_name", "shift_date", "oee").orderBy("shift_date", "machine_name"))


@register("anomaly_pivot")
def _q_anomaly_pivot(spark, sf):
    """AGG-21: machines x days anomaly matrix."""
    from plantmetrics.operators.reports import anomaly_pivot
    return anomaly_pivot(_named(model(spark, sf)))


@register("latest_readings")
def _q_latest_readings(spark, sf):
    """SRT-3: ten newest sensor readings."""
    return (model(spark, sf).stg_sensor.select("machine_id", "ts", "temperature_c", "vibration_mm_s", "power_kw")
            .orderBy(F.desc("ts"), "machine_id").limit(10))


@register("latest_downtime")
def _q_latest_downtime(spark, sf):
    """SRT-3/FN-D2: ten newest stoppages with their hours."""
    return (model(spark, sf).stg_downtime.select("machine_id", "reason_code", "started_at", "ended_at",
                                                  F.col("duration_hrs").alias("downtime_hrs"))
            .orderBy(F.desc("started_at"), F.desc("machine_id")).limit(10))


@register("worst_recent_weeks")
def _q_worst_recent_weeks(spark, sf):
    """SRT-4: 20 rows by newest week, then lowest OEE percent."""
    w = model(spark, sf).production_summary
    return (w.select("machine_id", "week_start", F.round(F.col("avg_oee") * 100, 1).alias("avg_oee_pct"),
                     "total_downtime_hrs")
            .orderBy(F.desc("week_start"), F.asc_nulls_last("avg_oee_pct"), "machine_id").limit(20))


# --- data quality -----------------------------------------------------------------------------
@register("dq_not_null")
def _q_dq_not_null(spark, sf):
    """DQ-1: OEE rows with a NULL OEE."""
    from plantmetrics.operators.dq import not_null
    return not_null(model(spark, sf).oee_daily, "oee").select("machine_id", "shift_date")


@register("dq_unique")
def _q_dq_unique(spark, sf):
    """DQ-2: duplicated defect ids."""
    from plantmetrics.operators.dq import unique
    return unique(model(spark, sf).stg_defects, "defect_id")


@register("dq_accepted_range")
def _q_dq_range(spark, sf):
    """DQ-3: stored recommendations whose estimate is outside [1, 720] hours."""
    from plantmetrics.operators.dq import accepted_range
    r = model(spark, sf).recommendations_raw
    return accepted_range(r, "estimated_hours_to_failure", 1, 720).select("rec_id", "estimated_hours_to_failure")


@register("dq_accepted_values")
def _q_dq_values(spark, sf):
    """DQ-4: responses whose confidence is not HIGH/MEDIUM/LOW."""
    from plantmetrics.operators.dq import accepted_values
    from plantmetrics.sources.driver import DriverTables
    r = DriverTables(spark, sf).table("responses").select(
        "response_id", F.get_json_object("response", "$.confidence").alias("confidence"))
    return accepted_values(r, "confidence", ["HIGH", "MEDIUM", "LOW"])


@register("dq_unique_combo")
def _q_dq_combo(spark, sf):
    """DQ-5: (order_id, defect_type) pairs reported more than once."""
    from plantmetrics.operators.dq import unique_combination
    return unique_combination(model(spark, sf).stg_defects, ["order_id", "defect_type"])


@register("dq_oee_bounds")
def _q_dq_bounds(spark, sf):
    """DQ-6/FLT-5: OEE rows out of [0, 1] or with NULL OEE."""
    from plantmetrics.operators.dq import oee_bounds
    return oee_bounds(model(spark, sf).oee_daily)


@register("dq_foreign_key")
def _q_dq_fk(spark, sf):
    """DQ-7: orders without a machine, defects without an order, non-positive quantities."""
    from plantmetrics.operators.dq import foreign_key
    m = model(spark, sf)
    a = foreign_key(m.stg_orders, m.stg_machines, "machine_id").select(F.lit("orders.machine_id").alias("check_name"), F.col("order_id").alias("key"))
    b = foreign_key(m.stg_defects, m.stg_orders, "order_id").select(F.lit("defects.order_id").alias("check_name"), F.col("defect_id").alias("key"))
    c = m.stg_defects.where(F.col("qty_defective") <= 0).select(F.lit("defects.qty_defective>0").alias("check_name"), F.col("defect_id").alias("key"))
    return a.unionByName(b).unionByName(c)


@register("dq_report")
def _q_dq_report(spark, sf):
    """DQ-9: one-pass rule suite over the marts and sources."""
    from plantmetrics.operators.dq import dq_report, dq_rules
    m = model(spark, sf)
    tables = {"oee_daily": m.oee_daily, "machine_health": m.machine_health,
              "production_summary": m.production_summary, "maintenance_recommendations": m.recommendations_raw,
              "defects": m.stg_defects}
    return dq_report(tables, dq_rules())


@register("table_counts")
def _q_table_counts(spark, sf):
    """DQ-8/SET-1/AGG-6: row counts of the model's tables."""
    from plantmetrics.operators.dq import table_counts
    m = model(spark, sf)
    return table_counts({
        "sensor_readings": m.source.table("sensor_readings"), "downtime_events": m.source.table("downtime_events"),
        "machines": m.source.table("machines"), "mart_oee_daily": m.oee_daily, "mart_machine_health": m.machine_health,
        "mart_production_summary": m.production_summary, "failure_patterns": m.failure_patterns,
        "maintenance_recommendations": m.recommendations_raw, "mart_maintenance_queue": m.maintenance_queue})


# --- sinks ---------------------------------------------------------------------------------------
@register("incremental_oee")
def _q_incremental_oee(spark, sf):
    """SNK-5: OEE table after a delete+insert of the trailing window (as_of - 3 days)."""
    from plantmetrics.operators import oee
    from plantmetrics.plans.incremental import merge_window, trailing_start
    m = model(spark, sf)
    since = trailing_start(m.params.as_of, m.params.lookback_days)
    batch = oee.oee_daily(m.stg_machines, m.stg_orders, m.stg_downtime, m.stg_defects, since=since)
    return merge_window(m.oee_daily, batch, ["machine_id", "shift_date"], "shift_date", since)


@register("incremental_health")
def _q_incremental_health(spark, sf):
    """SNK-5: health table after a delete+insert of the trailing window."""
    from plantmetrics.operators import health
    from plantmetrics.plans.incremental import merge_window, trailing_start
    m = model(spark, sf)
    since = trailing_start(m.params.as_of, m.params.lookback_days)
    batch = health.machine_health(m.stg_sensor, m.params, since=since)
    return merge_window(m.machine_health, batch, ["machine_id", "reading_date"], "reading_date", since)


@register("overwrite_reload")
def _q_overwrite_reload(spark, sf):
    """SNK-2/SNK-4: readings under other dates, then the staged readings, both written with
    overwrite to the shared folder and read back: nothing of the first write is left."""
    import uuid

    from plantmetrics.plans.incremental import full_refresh
    from plantmetrics.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/reload-{uuid.uuid4().hex}/sensor_readings"
    s = model(spark, sf).stg_sensor
    full_refresh(s.withColumn("reading_date", F.date_add("reading_date", 400)), path, "reading_date")
    full_refresh(s, path, "reading_date")
    return spark.read.parquet(path).select(*s.columns)


# --- sources & small projections ------------------------------------------------------------------
@register("scan_sensor_readings")
def _q_scan_sensor(spark, sf):
    """SRC-1: the raw readings table with its fixed schema."""
    return model(spark, sf).source.table("sensor_readings")


@register("scan_machines")
def _q_scan_machines(spark, sf):
    """SRC-2: the machine master through the source interface."""
    return model(spark, sf).source.table("machines")


@register("sku_format")
def _q_sku_format(spark, sf):
    """FN-S4: product codes 'SKU-' + 4-digit zero-padded number, orders per code."""
    return model(spark, sf).stg_orders.groupBy("product_sku").agg(F.count(F.lit(1)).alias("orders"))


@register("clamp_null_safe")
def _q_clamp(spark, sf):
    """PRJ-8/§1.4-1: how often each clamp or zero-denominator guard decided a rate."""
    o = model(spark, sf).oee_daily
    return o.agg(
        F.count_if((F.col("planned_time_hrs") > 0) & (F.col("downtime_hrs") > F.col("planned_time_hrs")))
        .alias("availability_clamped_at_0"),
        F.count_if(F.col("availability_rate").isNull()).alias("availability_null"),
        F.count_if(F.col("performance_rate").isNull()).alias("performance_null"),
        F.count_if(F.col("performance_rate") == 1).alias("performance_at_1"),
        F.count_if(F.col("quality_rate") < 0).alias("quality_negative"),
        F.count(F.lit(1)).alias("rows"))


# --- streaming (fed from the test tables) --------------------------------------------------------
def _streamed(spark, df, start, chunks: int = 3) -> str:
    """Deliver ``df`` in ``chunks`` parts, in no order of time, to a folder that ``start(stream,
    root)`` reads; the stream is started anew for each part. Returns the shared folder used."""
    import uuid

    from plantmetrics.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64(*df.columns), F.lit(chunks))
    for i in range(chunks):
        df.where(part == i).write.parquet(f"{root}/in/b{i:03d}")
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        start(stream, root).awaitTermination()
    return root


@register("stream_health")
def _q_stream_health(spark, sf):
    """ST-1/ST-3: readings streamed in three parts in no order of time, with a restart after
    each; the touched days of the written health table are recomputed per micro-batch."""
    from plantmetrics.streaming.health_stream import health_table, start_health_stream
    root = _streamed(spark, model(spark, sf).source.table("sensor_readings"),
                     lambda stream, r: start_health_stream(stream, r, f"{r}/ckpt"))
    return health_table(spark, root)


@register("stream_cooldown")
def _q_stream_cooldown(spark, sf):
    """ST-4 (streaming): stoppages streamed in three parts in no order of time, with a restart
    after each; the written table of kept events is recomputed from the first touched date."""
    from plantmetrics.streaming.cooldown_stream import kept_events, start_cooldown_stream
    src, cooldown = model(spark, sf).source.table("downtime_events"), model(spark, sf).params.cooldown_s
    root = _streamed(spark, src, lambda stream, r: start_cooldown_stream(
        stream, r, f"{r}/ckpt", "machine_id", "started_at", ["event_id"], cooldown))
    return kept_events(spark, root).select(*src.columns)


@register("maintenance_queue_strict")
def _q_queue_strict(spark, sf):
    """REC-11 with anomaly ratios 1.8 / 2.2: the OEE-decline branch decides alone."""
    from plantmetrics.params import DEFAULT
    return model(spark, sf, DEFAULT.with_(temp_ratio="1.8", vib_ratio="2.2")).maintenance_queue
