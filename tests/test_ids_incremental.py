"""Surrogate ids, keyed delete+insert, idempotent upsert, schema guard, write paths."""

import datetime as dt
import os
import tempfile

import pytest
from plant_support import D, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantmetrics.operators.ids import assign_ids
from plantmetrics.plans import incremental as inc


def test_assign_ids_are_consecutive_in_order(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"), F.col("id").alias("v")).repartition(7)
    got = assign_ids(df, ["k"], "rid", start=11).select("k", "rid")
    w = Window.orderBy("k")
    exp = df.select("k", (F.row_number().over(w) + 10).alias("rid"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def health_rows(spark, rows):
    return spark.createDataFrame(rows, "machine_id int, reading_date date, v int")


def test_delete_insert_keeps_absent_keys(spark):
    stored = health_rows(spark, [(1, dt.date(2024, 1, 30), 1), (2, dt.date(2024, 1, 30), 2), (1, dt.date(2024, 1, 20), 3)])
    batch = health_rows(spark, [(1, dt.date(2024, 1, 30), 10)])
    got = inc.merge_window(stored, batch, ["machine_id", "reading_date"], "reading_date", dt.date(2024, 1, 28))
    assert sorted(map(tuple, got.collect())) == [(1, dt.date(2024, 1, 20), 3), (1, dt.date(2024, 1, 30), 10),
                                                (2, dt.date(2024, 1, 30), 2)]


def test_merge_twice_equals_once(spark):
    stored = health_rows(spark, [(1, dt.date(2024, 1, 30), 1)])
    batch = health_rows(spark, [(1, dt.date(2024, 1, 30), 5), (3, dt.date(2024, 1, 29), 6)])
    keys, since = ["machine_id", "reading_date"], dt.date(2024, 1, 28)
    once = inc.merge_window(stored, batch, keys, "reading_date", since)
    twice = inc.merge_window(once, batch, keys, "reading_date", since)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_schema_change_fails(spark):
    a = health_rows(spark, [(1, dt.date(2024, 1, 30), 1)])
    b = a.withColumn("v", F.col("v").cast("long"))
    with pytest.raises(inc.SchemaChanged):
        inc.delete_insert(a, b, ["machine_id"])


def recs(spark, rows):
    return spark.createDataFrame(rows, "rec_id long, machine_id int, generated_at timestamp_ntz, note string")


def test_upsert_replaces_same_day_only_and_is_idempotent(spark):
    existing = recs(spark, [(1, 1, ts("2024-01-30 08:00"), "old today"), (2, 1, ts("2024-01-29 08:00"), "yesterday"),
                            (3, 2, ts("2024-01-30 09:00"), "other machine")])
    new = recs(spark, [(None, 1, ts("2024-01-30 12:00"), "new")]).drop("rec_id")
    once = inc.upsert_recommendations(existing, new)
    got = sorted(map(tuple, once.collect()))
    assert got == [(2, 1, ts("2024-01-29 08:00"), "yesterday"), (3, 2, ts("2024-01-30 09:00"), "other machine"),
                   (4, 1, ts("2024-01-30 12:00"), "new")]
    twice = inc.upsert_recommendations(once, new)
    assert sorted((r.machine_id, r.generated_at, r.note) for r in twice.collect()) == \
        sorted((r[1], r[2], r[3]) for r in got)


def test_refresh_incremental_writes_only_window(spark):
    from plantmetrics.operators import health, staging
    from plantmetrics.sources import schemas
    rows = [(1, ts(f"2024-01-{d:02d} 10:00"), D("50.00"), D("1.000"), D("2.000")) for d in range(20, 31)]
    sensor = staging.stg_sensor(spark.createDataFrame(rows, schemas.SENSOR_READINGS))
    path = os.path.join(tempfile.mkdtemp(prefix="pm-inc-"), "health")

    def build(since):
        return health.machine_health(sensor, since=since)

    inc.refresh_incremental(spark, path, build, ["machine_id", "reading_date"], "reading_date",
                            dt.date(2024, 1, 31), 3)
    first = spark.read.parquet(path).count()
    inc.refresh_incremental(spark, path, build, ["machine_id", "reading_date"], "reading_date",
                            dt.date(2024, 1, 31), 3)
    again = spark.read.parquet(path)
    assert first == again.count() == 11
    assert sorted(r.reading_date for r in again.select("reading_date").collect())[0] == dt.date(2024, 1, 20)


def test_full_refresh_drops_dates_that_are_gone(spark, tmp_path):
    from plantmetrics.plans.incremental import full_refresh
    path = str(tmp_path / "shrinking")
    two = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    full_refresh(two, path, "d")
    full_refresh(two.where("v = 2"), path, "d")
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]


def test_replaced_table_is_empty(spark, tmp_path):
    from plantmetrics.plans.catalog import create_table
    rows = spark.createDataFrame([(1, "a")], "v int, p string")
    for name, parts in (("replaced_plain", None), ("replaced_parts", ["p"])):
        path = str(tmp_path / name)
        create_table(spark, name, rows.schema, path, replace=True, partition_by=parts)
        rows.write.mode("append").insertInto(name)
        assert spark.table(name).count() == 1
        create_table(spark, name, rows.schema, path, replace=True, partition_by=parts)
        assert spark.table(name).count() == 0
        spark.sql(f"DROP TABLE {name}")


def test_bulk_insert_appends_rows_and_days(spark):
    root = tempfile.mkdtemp(prefix="pm-append-")
    one = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "x int, day date")
    two = spark.createDataFrame([(3, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 1))], "x int, day date")
    for name, day in (("plain", None), ("days", "day")):
        for rows in (one, two):
            inc.append_rows(rows, f"{root}/{name}", day)
        got = spark.read.parquet(f"{root}/{name}").select("x", "day")
        assert sorted(map(str, got.collect())) == sorted(map(str, one.union(two).collect()))
    assert spark.read.parquet(f"{root}/days").where("day = date'2024-01-01'").count() == 2
