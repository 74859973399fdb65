"""Ordered refresh: facts -> failure patterns -> recommendations -> queue.

One Python call per run; each step writes a table under ``out_root`` and the next step
reads what Spark derives from the previous ones. Independent steps are submitted as
concurrent Spark jobs (up to ``threads``, like running several models at once); the
shared lazy inputs are built before they fan out. Run it from ``foreachBatch`` (see
``streaming.refresh``) for the new-data trigger: micro-batches run one after another, so
two refreshes never overlap.

Patterns, recommendations, weekly roll-up and queue are versioned (``plans.versions``): a write that
breaks off leaves the table as it was. A run adds to the pattern store the events that it lacks and
leaves all others, with their ids, where they are; the vector index is extended by the same rows.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators import dq, health, oee, retrieval, vector_index
from plantmetrics.params import DEFAULT, Params
from plantmetrics.plans import incremental as inc
from plantmetrics.plans import versions
from plantmetrics.plans.model import Model
from plantmetrics.sources.readers import Source

TABLES = ["mart_oee_daily", "mart_machine_health", "mart_production_summary", "failure_patterns",
          "maintenance_recommendations", "mart_maintenance_queue"]
#: The index over the stored patterns; the day column that splits the recommendations; weekly sums of closed days.
INDEX, DAY, WEEKLY = "failure_pattern_index", "generated_date", "weekly_partials"
#: Columns that split the tables of which a run replaces some days.
SPLIT = {"maintenance_recommendations": DAY, "mart_production_summary": "week_start"}


def _together(threads: int, *steps) -> None:
    """Run independent steps as concurrent Spark jobs; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for f in [pool.submit(s) for s in steps]:
            f.result()


def run(spark: SparkSession, source: Source, out_root: str, params: Params = DEFAULT, full: bool = False,
        threads: int = 4) -> dict:
    """Build or incrementally refresh the marts, then patterns, recommendations, queue.

    Returns the row counts written per table.
    """
    m = Model(spark, source, params)
    keys_oee, keys_h = ["machine_id", "shift_date"], ["machine_id", "reading_date"]
    staged = [m.stg_machines, m.stg_orders, m.stg_downtime, m.stg_defects, m.stg_sensor]  # build once  # noqa: F841
    _together(
        threads,
        lambda: inc.refresh_incremental(
            spark, f"{out_root}/mart_oee_daily",
            lambda since: oee.oee_daily(m.stg_machines, m.stg_orders, m.stg_downtime, m.stg_defects, since=since),
            keys_oee, "shift_date", params.as_of, params.lookback_days, full=full),
        lambda: inc.refresh_incremental(
            spark, f"{out_root}/mart_machine_health",
            lambda since: health.machine_health(m.stg_sensor, params, since=since),
            keys_h, "reading_date", params.as_of, params.lookback_days, full=full),
    )
    # downstream steps read the stored facts
    stored = Model(spark, source, params).using(
        oee_daily=spark.read.parquet(f"{out_root}/mart_oee_daily").select(*oee.OEE_COLUMNS),
        machine_health=spark.read.parquet(f"{out_root}/mart_machine_health").select(*health.HEALTH_COLUMNS))
    recs_path, patterns_path, index_path = (f"{out_root}/{t}" for t in ("maintenance_recommendations", "failure_patterns", INDEX))
    _together(
        threads,
        lambda: refresh_weekly(spark, out_root, stored.oee_daily, inc.trailing_start(params.as_of, params.lookback_days), full),
        lambda: _grow_patterns(stored, patterns_path, index_path, full),
    )
    stored.using(failure_patterns=read(spark, out_root, "failure_patterns"),
                 similar_failures=vector_index.search(stored.query_vectors, vector_index.Index(spark, index_path), params.top_k).rows)
    new_recs = stored.new_recommendations

    def write_recs():
        # the history is split by day; a run reads and replaces its own days only
        told = versions.pointer(spark, recs_path)
        if told is None:
            existing, highest = stored.recommendations_raw, None
        else:
            days = [r[0] for r in new_recs.select(F.to_date("generated_at")).distinct().collect()]     # the run's day
            existing = read(spark, out_root, "maintenance_recommendations", F.col(DAY).isin(days))
            existing, highest = existing.select(*stored.recommendations_raw.columns), told["highest"]
        merged = inc.upsert_recommendations(existing, new_recs, highest).withColumn(DAY, F.to_date("generated_at"))
        versions.write_days(merged, recs_path, DAY, told is None, "rec_id")

    write_recs()
    stored.using(recommendations_raw=read(spark, out_root, "maintenance_recommendations"))
    _commit(spark, out_root, "mart_maintenance_queue", stored.maintenance_queue)
    return {r.table_name: r.rows for r in stored_counts(spark, out_root).collect()}


def stored_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """(table_name, rows) of the tables that the last run stored. No column is read, so the counts come from the
    files' footers, and no model is built."""
    return dq.table_counts({t: read(spark, out_root, t) for t in TABLES if inc._exists(spark, f"{out_root}/{t}")})


def drop(spark: SparkSession, out_root: str, names: list[str] | None = None) -> list[str]:
    """Delete stored tables (all derived ones unless named; the weekly sums and the index go with their tables);
    returns the names of those that were there. Raw tables and recommendations stay unless named."""
    gone = []
    for name in names or [t for t in TABLES if t != "maintenance_recommendations"]:
        if name not in TABLES:
            raise ValueError(f"no derived table named {name}")
        beside = {"failure_patterns": [INDEX], "mart_production_summary": [WEEKLY]}.get(name, [])
        for n in [name, *beside]:
            hadoop, fs = versions._fs(spark, f"{out_root}/{n}")
            if fs.delete(hadoop.Path(f"{out_root}/{n}"), True) and n == name:
                gone.append(name)
    return gone


def refresh_weekly(spark: SparkSession, out_root: str, daily: DataFrame, since: dt.date, full: bool = False) -> None:
    """Bring the weekly roll-up up to date from the days that a run can have changed.

    Days before ``since`` are closed: no later run changes them. Their sums are stored per machine and week,
    with the date they reach up to. A run adds the days that have been closed since then to the weeks they fall
    into, reads the open days, and replaces those weeks of the mart that hold any of both. It reads no other
    day. A run date that goes back, or a full run, builds all anew."""
    state, mart = f"{out_root}/{WEEKLY}", f"{out_root}/mart_production_summary"
    day, week = F.col("shift_date"), F.col("week_start")
    told = versions.pointer(spark, state)
    anew = full or told is None or since.isoformat() < told["until"]
    if anew:
        closed = oee.weekly_partials(daily.where((day < F.lit(since)) | day.isNull()))
    else:
        until = dt.date.fromisoformat(told["until"])
        closed = oee.weekly_partials(daily.where((day >= F.lit(until)) & (day < F.lit(since))))
        held = _weeks(spark, state, closed, monday(until))
        closed = oee.merge_partials(closed.unionByName(held))
    if anew or until < since:
        versions.write_days(closed, state, "week_start", anew, note={"until": since.isoformat()})
    done = versions.pointer(spark, mart)
    first = None if anew or not done or "until" not in done else monday(dt.date.fromisoformat(done["until"]))
    opened = oee.weekly_partials(daily.where(day >= F.lit(since)))
    rows = oee.weekly_rows(oee.merge_partials(opened.unionByName(_weeks(spark, state, closed, first))))
    versions.write_days(rows, mart, "week_start", first is None, note={"until": since.isoformat()})


def monday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def _weeks(spark: SparkSession, path: str, like: DataFrame, first: dt.date | None) -> DataFrame:
    """The stored weekly sums from the week ``first`` on (None: all, those without a date too)."""
    wanted = None if first is None else F.col("week_start") >= F.lit(first)
    return versions.read_days(spark, path, like.schema, "week_start", wanted).select(*like.columns)


def _commit(spark: SparkSession, out_root: str, name: str, rows: DataFrame) -> None:
    versions.write_version(spark, f"{out_root}/{name}", lambda folder: rows.write.parquet(folder))


def _grow_patterns(model: Model, path: str, index_path: str, full: bool) -> None:
    """Number, embed and store the events that the store lacks (``full``: all anew), and index them."""
    spark = model.spark
    first = full or not versions.exists(spark, path)
    fresh = model.numbered_history if first else retrieval.fresh_history(model.failure_history, versions.read(spark, path))
    if first or not fresh.isEmpty():
        rows = retrieval.failure_patterns(fresh, model.source.pattern_vectors, ("event_id",))
        versions.write_version(spark, path, lambda folder: rows.write.parquet(folder), append=not first)
    held = versions.read(spark, path)
    if first or not versions.exists(spark, index_path):
        vector_index.build(held.drop("description", "event_id"), index_path)
        return
    # also what an earlier run stored and broke off before it was indexed
    last = vector_index.Index(spark, index_path).rows.agg(F.coalesce(F.max("pattern_id"), F.lit(0))).first()[0]
    new = held.where(F.col("pattern_id") > last).drop("description", "event_id")
    if not new.isEmpty():
        vector_index.add(new, index_path)


def read(spark: SparkSession, out_root: str, name: str, days=None) -> DataFrame:
    """A table of the last run (``days``: of the days or weeks that meet this expression)."""
    path = f"{out_root}/{name}"
    told = versions.pointer(spark, path)
    if told is None:
        return spark.read.parquet(path)
    if "parts" in told:
        return versions.read(spark, path)
    schema = spark.read.parquet(versions.folders(spark, path)[-1]).schema
    rows = versions.read_days(spark, path, schema, SPLIT[name], days)
    return rows.select(*oee.SUMMARY_COLUMNS) if name == "mart_production_summary" else rows
