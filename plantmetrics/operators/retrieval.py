"""Failure history, descriptions, the failure-pattern vector store and cosine top-k.

Similarity search is exact. The query vectors (one per at-risk machine) are dealt by hash into
chunks of about QUERY_BYTES, one chunk for any fleet that fits; each chunk is a broadcast
matrix, held alone: the next one is fetched when the chunk's result is stored. Patterns are
dealt evenly to a few tasks a core: each scores its patterns in tiles with numpy, keeping only the k best
per query, and the tasks' candidates are merged in two levels (``vector_index.merge_levels``).
No cross join is planned and no pair is materialised beyond the per-task top-k. A stored
pattern table is searched through its index instead (``vector_index``), which skips lists.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from plantmetrics.functions.columns import hours_between
from plantmetrics.operators.ids import assign_ids
from plantmetrics.operators.vector_index import Best, merge_levels, unit_rows
from plantmetrics.params import DEFAULT, Params

QUERY_BYTES = 256 * 1024 * 1024          # size of one chunk's query matrix
TASKS_PER_CORE = 4


def failure_history(downtime_raw: DataFrame, machines: DataFrame, health: DataFrame, oee: DataFrame,
                    params: Params = DEFAULT) -> DataFrame:
    """Every stoppage with its machine, that day's sensor profile and OEE (0.70 when no
    OEE row). Stoppages on days without sensor data are dropped (the outer join plus
    not-null filter becomes an inner join in the optimised plan)."""
    d = downtime_raw.select("event_id", "machine_id", "started_at", "ended_at", "reason_code",
                            F.to_date("started_at").alias("event_date"))
    h = health.select("machine_id", F.col("reading_date").alias("event_date"), "avg_temp_c", "max_temp_c",
                      "avg_vibration_mm_s", "max_vibration_mm_s", "avg_power_kw", "max_power_kw")
    o = oee.select("machine_id", F.col("shift_date").alias("event_date"), "oee")
    j = (d.join(machines.select("machine_id", "machine_type"), "machine_id")
         .join(h, ["machine_id", "event_date"], "left")
         .join(o, ["machine_id", "event_date"], "left")
         .where(F.col("avg_temp_c").isNotNull()))
    return j.select(
        "event_id", "started_at", "machine_id", "machine_type", "event_date", "reason_code",
        "avg_temp_c", "max_temp_c", "avg_vibration_mm_s", "max_vibration_mm_s", "avg_power_kw", "max_power_kw",
        F.coalesce("oee", F.lit(params.default_event_oee).cast(DecimalType(5, 4))).alias("oee"),
        hours_between("started_at", "ended_at", 8, 3).alias("downtime_hrs"),
    )


def fixed(x: Column, decimals: int) -> Column:
    """x formatted with a fixed number of decimals (half-up), NULL as 0."""
    return F.coalesce(x, F.lit(0)).cast(DecimalType(24, decimals)).cast("string")


def percent1(x: Column) -> Column:
    return F.concat(fixed(F.coalesce(x, F.lit(0)) * 100, 1), F.lit("%"))


def clean_label(x: Column) -> Column:
    return F.upper(F.trim(F.coalesce(x, F.lit("UNKNOWN"))))


# --- Fixed values: the text layouts of the failure and machine descriptions below -------------
# (labels, units and decimals per field are the stored format; numbers render half-up)


def failure_description(machine_type: Column, reason: Column, event_date: Column, max_t, avg_t, max_v, avg_v,
                        max_p, avg_p, oee: Column, downtime: Column) -> Column:
    """The stored natural-language description of a failure event (fixed layout)."""
    date_s = F.coalesce(F.substring(event_date.cast("string"), 1, 10), F.lit("unknown"))
    return F.concat(
        F.lit("Machine type: "), clean_label(machine_type), F.lit("\n"),
        F.lit("Failure type: "), clean_label(reason), F.lit("\n"),
        F.lit("Date: "), date_s, F.lit("\n"),
        F.lit("Sensor readings on failure day:\n"),
        F.lit("  Temperature: max "), fixed(max_t, 1), F.lit("°C, average "), fixed(avg_t, 1), F.lit("°C\n"),
        F.lit("  Vibration: max "), fixed(max_v, 3), F.lit(" mm/s, average "), fixed(avg_v, 3), F.lit(" mm/s\n"),
        F.lit("  Power: max "), fixed(max_p, 2), F.lit(" kW, average "), fixed(avg_p, 2), F.lit(" kW\n"),
        F.lit("OEE: "), percent1(oee), F.lit("\n"),
        F.lit("Downtime: "), fixed(downtime, 1), F.lit(" hours"),
    )


def machine_description(machine_type: Column, max_t, avg_t, max_v, avg_v, max_p, avg_p, oee7: Column) -> Column:
    """The text embedded for an at-risk machine's current state (fixed layout)."""
    return F.concat(
        F.lit("Machine type: "), clean_label(machine_type), F.lit("\n"),
        F.lit("Current anomaly detected\n"),
        F.lit("Sensor readings (recent 7-day window):\n"),
        F.lit("  Temperature: max "), fixed(max_t, 1), F.lit("°C, average "), fixed(avg_t, 1), F.lit("°C\n"),
        F.lit("  Vibration: max "), fixed(max_v, 3), F.lit(" mm/s, average "), fixed(avg_v, 3), F.lit(" mm/s\n"),
        F.lit("  Power: max "), fixed(max_p, 2), F.lit(" kW, average "), fixed(avg_p, 2), F.lit(" kW\n"),
        F.lit("7-day OEE: "), percent1(oee7),
    )


def with_descriptions(history: DataFrame) -> DataFrame:
    c = F.col
    return history.withColumn("description", failure_description(
        c("machine_type"), c("reason_code"), c("event_date"), c("max_temp_c"), c("avg_temp_c"),
        c("max_vibration_mm_s"), c("avg_vibration_mm_s"), c("max_power_kw"), c("avg_power_kw"), c("oee"),
        c("downtime_hrs")))


def numbered_history(history: DataFrame) -> DataFrame:
    """History rows with pattern_id = 1.. in (started_at, machine_id, event_id) order."""
    return assign_ids(history, ["started_at", "machine_id", "event_id"], "pattern_id")


def fresh_history(history: DataFrame, stored: DataFrame) -> DataFrame:
    """History rows whose event is not stored yet, numbered on from the largest stored ``pattern_id``:
    an id that has been given stays with its event, however late an earlier stoppage arrives."""
    new = history.join(stored.select("event_id").distinct(), "event_id", "left_anti")
    start = stored.agg(F.coalesce(F.max("pattern_id"), F.lit(0))).first()[0] + 1
    return assign_ids(new, ["started_at", "machine_id", "event_id"], "pattern_id", start)


def failure_patterns(numbered: DataFrame, embed, keep: tuple[str, ...] = ()) -> DataFrame:
    """The vector store: one row per described failure with its embedding.

    ``embed`` maps a frame with ``pattern_id`` and ``description`` to the same frame plus
    ``embedding`` (an external embedding service, or the driver adapter's vectors);
    rows it cannot embed are skipped. ``keep`` names further columns of ``numbered`` to store.
    """
    d = with_descriptions(numbered)
    e = embed(d)
    return e.select(
        F.col("pattern_id").cast(LongType()).alias("pattern_id"), "machine_id",
        clean_label(F.col("machine_type")).alias("machine_type"), "event_date",
        clean_label(F.col("reason_code")).alias("reason_code"),
        F.coalesce("downtime_hrs", F.lit(0).cast(DecimalType(8, 3))).alias("downtime_hrs"),
        "description", "embedding", *keep)


# --- cosine top-k -----------------------------------------------------------------------------
_OUT = StructType([
    StructField("machine_id", IntegerType()), StructField("pattern_id", LongType()),
    StructField("sim", DoubleType()), StructField("sim_key", LongType()),
    StructField("machine_type", StringType()), StructField("event_date", DateType()),
    StructField("reason_code", StringType()), StructField("downtime_hrs", DecimalType(8, 3)),
])


def _topk_scorer(bc, k: int):
    """mapInArrow function: per task, keep the k best patterns per query (``vector_index.Best``).

    State per task is bounded: k candidates per query and their payload rows, whatever
    the number of patterns the task reads.
    """

    def run(batches):
        qids, qmat = bc.value
        best = None
        for b in batches:
            if not b.num_rows or not len(qids):
                continue
            b = pa.Table.from_batches([b]).combine_chunks()
            best = best or Best(qmat, k)
            refs = best.extend(b.drop_columns(["embedding"]))
            best.offer(unit_rows(b.column("embedding")), b.column("pattern_id").to_numpy(), refs, np.arange(len(qids)))
            best.trim()
        if best is not None:
            yield from best.table(qids).select([f.name for f in _OUT.fields]).to_batches()

    return run


def _score_chunk(queries: DataFrame, patterns: DataFrame, k: int):
    tbl = queries.select("machine_id", "embedding").toArrow()
    matrix = unit_rows(tbl.column("embedding")) if len(tbl) else None
    bc = patterns.sparkSession.sparkContext.broadcast((tbl.column("machine_id").to_numpy(), matrix))
    cols = ["pattern_id", "embedding", "machine_type", "event_date", "reason_code", "downtime_hrs"]
    # even tasks, a few for each core: a task's work is its patterns times all queries of the chunk, not its bytes
    tasks = TASKS_PER_CORE * patterns.sparkSession.sparkContext.defaultParallelism
    dealt = patterns.select(*cols).where("embedding is not null").repartition(tasks, "pattern_id")
    return dealt.mapInArrow(_topk_scorer(bc, k), _OUT), bc


def similar_failures(queries: DataFrame, patterns: DataFrame, k: int = 3, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Top-k patterns per query vector by cosine similarity (zero vectors score 0),
    ranked by similarity (to 9 decimals) then pattern_id. Rows without a vector have no part."""
    # materialised once (shared checkpoint folder), so the count and the chunks see the same rows
    from plantmetrics.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(queries.sparkSession)
    queries = queries.select("machine_id", "embedding").where("embedding is not null").checkpoint()
    n, d = queries.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    chunks = max(1, math.ceil(n * (d or 1) * 8 / query_bytes))
    place = F.pmod(F.xxhash64("machine_id"), F.lit(chunks))
    best = None
    for c in range(chunks):
        scored, bc = _score_chunk(queries.where(place == c), patterns, k)
        # stored before the next chunk is fetched, so nothing that reads the result scores anew
        found = merge_levels(scored, k).checkpoint()
        bc.destroy()
        best = found if best is None else best.unionByName(found)
    return best.select("machine_id", "rank", "pattern_id", "machine_type", "event_date", "reason_code",
                       "downtime_hrs", F.col("sim").alias("similarity"))
