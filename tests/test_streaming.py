"""Stream = batch: daily health, cooldown (files in any order, restarts, repeats), refresh trigger."""

import datetime as dt
import os
import random
import tempfile

import pytest
from plant_support import SF
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from plantmetrics.operators import health, staging
from plantmetrics.operators.events import greedy_cooldown
from plantmetrics.plans import versions
from plantmetrics.sources.driver import DriverTables
from plantmetrics.sources.schemas import SENSOR_READINGS
from plantmetrics.streaming import cooldown_stream, health_stream, ingest, refresh
from plantmetrics.streaming.store import fold, land, landed, last_day


def _feed(df, files):
    """The rows in files that each span the whole time: the feed arrives in no order."""
    root = tempfile.mkdtemp(prefix="pm-stream-")
    df.repartition(files).write.parquet(f"{root}/in")
    return root


def _stream(spark, root, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(f"{root}/in"))


def _run_health(spark, root):
    health_stream.start_health_stream(_stream(spark, root, SENSOR_READINGS), root, f"{root}/ckpt").awaitTermination(300)
    return sorted(map(tuple, health_stream.health_table(spark, root).collect()))


def _batch_health(readings):
    return sorted(map(tuple, health.machine_health(staging.stg_sensor(readings)).select(*health.HEALTH_COLUMNS).collect()))


def test_health_stream_equals_batch_for_files_in_any_order_and_after_a_restart(spark):
    src = DriverTables(spark, SF).table("sensor_readings")
    early, rest = src.where("machine_id % 2 = 0"), src.where("machine_id % 2 = 1")
    root = _feed(early, 2)
    assert _run_health(spark, root) == _batch_health(early)
    rest.repartition(2).write.mode("append").parquet(f"{root}/in")
    assert _run_health(spark, root) == _batch_health(src)      # a new query on the same checkpoint
    assert _run_health(spark, root) == _batch_health(src)      # nothing new: nothing changes


def test_repeated_micro_batch_and_late_reading(spark):
    rows1 = [(1, dt.datetime(2024, 1, 10, 10), "50.0"), (1, dt.datetime(2024, 1, 20, 10), "50.0")]
    rows2 = [(1, dt.datetime(2024, 1, 10, 11), "90.0"), (1, dt.datetime(2024, 1, 19, 11), "60.0")]
    root = tempfile.mkdtemp(prefix="pm-late-")
    frames = [spark.createDataFrame(r, "machine_id int, ts timestamp_ntz, t string").select(
        "machine_id", "ts", F.col("t").cast("decimal(5,2)").alias("temperature_c"),
        F.lit(1).cast("decimal(6,3)").alias("vibration_mm_s"), F.lit(1).cast("decimal(7,3)").alias("power_kw"))
        for r in (rows1, rows2)]
    for epoch, df in [(0, frames[0]), (0, frames[0]), (1, frames[1]), (1, frames[1])]:
        health_stream.update_health(df, epoch, root)
    got = {r.reading_date: (r.reading_count, float(r.max_temp_c)) for r in health_stream.health_table(spark, root).collect()}
    assert got == {dt.date(2024, 1, 10): (2, 90.0), dt.date(2024, 1, 19): (1, 60.0), dt.date(2024, 1, 20): (1, 50.0)}


def test_cooldown_stream_equals_batch_for_files_in_any_order_and_after_a_restart(spark):
    d = DriverTables(spark, SF).table("downtime_events")
    late, rest = d.where("event_id % 3 = 0"), d.where("event_id % 3 > 0")
    root = _feed(rest, 2)

    def run():
        cooldown_stream.start_cooldown_stream(_stream(spark, root, d.schema), root, f"{root}/ckpt", "machine_id", "started_at",
                                              ["event_id"], 7200).awaitTermination(300)
        return sorted(r.event_id for r in cooldown_stream.kept_events(spark, root).collect())

    def batch(df):
        return sorted(r.event_id for r in greedy_cooldown(df, "machine_id", "started_at", ["event_id"], 7200).collect())

    assert run() == batch(rest)
    late.repartition(1).write.mode("append").parquet(f"{root}/in")
    assert run() == batch(d)


def test_cooldown_stream_clears_a_date_that_loses_its_kept_event(spark):
    def day(n, h):
        return dt.datetime(2024, 1, n, h)
    schema = "machine_id int, event_id long, started_at timestamp_ntz"
    root = tempfile.mkdtemp(prefix="pm-clear-")
    frames = [spark.createDataFrame(r, schema) for r in (
        [(1, 1, day(2, 1)), (1, 2, day(5, 0)), (2, 3, None)], [(1, 4, day(1, 23))], [(1, 5, day(3, 0))])]
    got = []
    for epoch, df in enumerate(frames):
        cooldown_stream.update_cooldown(df, epoch, root, "machine_id", "started_at", ["event_id"], 6 * 3600)
        got.append(sorted(r.event_id for r in cooldown_stream.kept_events(spark, root).collect()))
    assert got == [[1, 2, 3], [2, 3, 4], [2, 3, 4, 5]]


def test_late_rows_rewrite_the_days_up_to_the_meeting_point(spark):
    """Random lateness, null and several keys: equal to the batch after every micro-batch; a row that is
    weeks late rewrites a few dates only, and a repeated micro-batch none."""
    r, begin = random.Random(5), dt.datetime(2024, 1, 1)
    schema = "machine_id int, event_id long, started_at timestamp_ntz"
    rows = [(r.choice([1, 2, None]), i, begin + dt.timedelta(minutes=r.randrange(45 * 1440))) for i in range(900)]
    early = sorted((x for x in rows if x[1] % 9), key=lambda x: x[2])
    late = [x for x in rows if x[1] % 9 == 0]
    root, seen = tempfile.mkdtemp(prefix="pm-late-"), []
    feed = [early[:500], early[500:], late[:40], late[40:] + [(1, 5000, None)]]
    one = (1, 6000, begin + dt.timedelta(days=6, hours=5, minutes=1))
    feed += [[one], [(1, 6001, begin + dt.timedelta(days=44, hours=23, minutes=59))]]
    counts = []
    for epoch, batch in enumerate(feed):
        seen += batch
        df = spark.createDataFrame(batch, schema)
        counts.append(cooldown_stream.update_cooldown(df, epoch, root, "machine_id", "started_at", ["event_id"], 3 * 3600))
        if epoch in (1, 3, 4, 5):
            want = greedy_cooldown(spark.createDataFrame(seen, schema), "machine_id", "started_at", ["event_id"], 3 * 3600)
            got = cooldown_stream.kept_events(spark, root)
            assert sorted(x.event_id for x in got.collect()) == sorted(x.event_id for x in want.collect()), epoch
    assert counts[4] <= 6 and counts[5] <= 2, counts
    again = cooldown_stream.update_cooldown(spark.createDataFrame([one], schema), 4, root, "machine_id", "started_at", ["event_id"], 3 * 3600)
    assert again == 0


def test_refresh_trigger_runs_steps_once_per_new_batch(spark):
    src = DriverTables(spark, SF).table("sensor_readings")
    root = tempfile.mkdtemp(prefix="pm-refresh-")
    src.coalesce(1).write.parquet(f"{root}/in/b0")
    seen = []
    q = refresh.start_refresh_trigger(spark, f"{root}/in/b0", f"{root}/ckpt",
                                      [lambda b, e: seen.append(("facts", e, b.count())),
                                       lambda b, e: seen.append(("queue", e))], available_now=True)
    q.awaitTermination(120)
    assert [s[0] for s in seen] == ["facts", "queue"] and seen[0][2] == src.count()
    q2 = refresh.start_refresh_trigger(spark, f"{root}/in/b0", f"{root}/ckpt",
                                       [lambda b, e: seen.append(("again", e))], available_now=True)
    q2.awaitTermination(120)
    assert [s[0] for s in seen] == ["facts", "queue"]   # no new files: no second run


def test_ingest_appends_staged_rows(spark):
    src = DriverTables(spark, SF).table("sensor_readings")
    root = tempfile.mkdtemp(prefix="pm-ingest-")
    src.coalesce(1).write.parquet(f"{root}/in")
    q = ingest.start_ingest(ingest.readings_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{root}/out").count() == src.count()


def _folders(root, table):
    found = [d for d, _, files in os.walk(f"{root}/{table}") if any(f.endswith(".parquet") for f in files)]
    per_day = {}
    for d in found:
        per_day.setdefault(os.path.basename(d), []).append(os.path.basename(os.path.dirname(d)))
    return per_day


def test_folded_store_keeps_few_folders_a_day_and_equals_the_batch(spark):
    """Micro-batches for three dates (and none), folded two at a time; two are repeated."""
    r, begin = random.Random(3), dt.datetime(2024, 1, 1)
    schema = "machine_id int, event_id long, started_at timestamp_ntz"
    root, rows = tempfile.mkdtemp(prefix="pm-fold-"), []
    dated = StructType([*spark.createDataFrame([], schema).schema.fields, StructField("event_date", DateType())])
    store = f"{root}/events"

    def arrive(epoch, batch):
        df = spark.createDataFrame(batch, schema).withColumn("event_date", F.to_date("started_at"))
        folded = fold(spark, store, dated, "event_date", epoch, 2)
        land(df, store, epoch, "event_date")
        return folded

    folded = 0
    for epoch in range(36):
        batch = [(1, 10 * epoch + i, None if r.random() < 0.1 else begin + dt.timedelta(minutes=r.randrange(3 * 1440))) for i in range(4)]
        rows += batch
        folded += arrive(epoch, batch)
        if epoch in (20, 31):
            folded += arrive(epoch, batch)
    got = landed(spark, store, dated, "event_date").collect()
    assert sorted(x.event_id for x in got) == sorted(x[1] for x in rows)
    assert folded >= 33 and last_day(spark, store, "event_date") == dt.date(2024, 1, 3)
    days = _folders(root, "events")
    assert len(days) == 4 and max(map(len, days.values())) <= 3 * 3 + 3 + 4, days      # levels, waiting, replaced last
    one = landed(spark, store, dated, "event_date", dt.date(2024, 1, 2), dt.date(2024, 1, 2), undated=False)
    assert sorted(x.event_id for x in one.collect()) == sorted(x[1] for x in rows if x[2] and x[2].day == 2)
    assert all("event_date=2024-01-02" in f for f in one.inputFiles())
    # a repeat of what has been folded is not stored twice
    land(spark.createDataFrame(rows[:4], schema).withColumn("event_date", F.to_date("started_at")), store, 0, "event_date")
    assert landed(spark, store, dated, "event_date").count() == len(rows)


def test_a_fold_that_breaks_off_changes_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="pm-broken-fold-")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "event_id long, event_date date")
    for epoch in range(3):
        land(df, root, epoch, "event_date")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", fail)
        with pytest.raises(OSError):
            fold(spark, root, df.schema, "event_date", 3, 2)
    assert landed(spark, root, df.schema, "event_date").count() == 6
    assert fold(spark, root, df.schema, "event_date", 3, 2) == 3
    assert landed(spark, root, df.schema, "event_date").count() == 6


def test_streams_equal_batch_while_the_store_is_folded(spark):
    d = DriverTables(spark, SF)
    readings, events = d.table("sensor_readings"), d.table("downtime_events")
    root, n = tempfile.mkdtemp(prefix="pm-folding-"), 5
    for epoch in range(n):
        part = F.pmod(F.xxhash64("machine_id", "ts"), F.lit(n)) == epoch
        health_stream.update_health(readings.where(part), epoch, root, pending=2)
        cooldown_stream.update_cooldown(events.where(F.col("event_id") % n == epoch), epoch, root, "machine_id", "started_at",
                                        ["event_id"], 7200, pending=2)
    assert versions.pointer(spark, f"{root}/events")["folded"] == versions.pointer(spark, f"{root}/sensor_readings")["folded"] == 3
    assert sorted(map(tuple, health_stream.health_table(spark, root).collect())) == _batch_health(readings)
    want = greedy_cooldown(events, "machine_id", "started_at", ["event_id"], 7200)
    assert sorted(r.event_id for r in cooldown_stream.kept_events(spark, root).collect()) == sorted(r.event_id for r in want.collect())
