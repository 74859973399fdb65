"""Micro-fixtures for availability, performance, quality and OEE (FIXTURES §4)."""

import datetime as dt
from decimal import Decimal

import pytest
from plant_support import D, ts

from plantmetrics.operators import dq, oee, staging
from plantmetrics.sources import schemas


@pytest.fixture
def machines(spark):
    return staging.stg_machines(spark.createDataFrame(
        [(1, "M1", "lathe", "line_a", 100, dt.date(2020, 1, 1)),
         (2, "M2", "cnc_mill", "line_b", 200, dt.date(2020, 1, 1))], schemas.MACHINES))


def orders(spark, rows):
    return staging.stg_orders(spark.createDataFrame(rows, schemas.PRODUCTION_ORDERS))


def downtime(spark, rows):
    return staging.stg_downtime(spark.createDataFrame(rows, schemas.DOWNTIME_EVENTS))


def defects(spark, rows):
    return staging.stg_defects(spark.createDataFrame(rows, schemas.DEFECTS))


def run(spark, machines, o, d=(), f=()):
    return {(r.machine_id, r.shift_date): r for r in
            oee.oee_daily(machines, orders(spark, o), downtime(spark, list(d)), defects(spark, list(f))).collect()}


def test_staging_trims_and_uppercases(spark, machines):
    r = machines.where("machine_id = 1").first()
    assert r.machine_type == "LATHE" and r.production_line == "LINE_A"


def test_no_downtime_gives_full_availability(spark, machines):
    out = run(spark, machines, [(1, 1, "S", "morning", ts("2024-01-02 06:00"), ts("2024-01-02 14:00"), 800, 600)])
    r = out[(1, dt.date(2024, 1, 2))]
    assert r.downtime_hrs == 0 and r.availability_rate == D("1.0000")
    assert r.planned_time_hrs == D("8.00")
    assert r.performance_rate == D("0.7500") and r.quality_rate == D("1.0000") and r.oee == D("0.7500")


def test_downtime_without_orders_has_no_row(spark, machines):
    out = run(spark, machines, [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 14:00"), 800, 600)],
              [(9, 1, ts("2024-01-05 10:00"), ts("2024-01-05 11:00"), "x")])
    assert list(out) == [(1, dt.date(2024, 1, 2))]


def test_downtime_longer_than_planned(spark, machines):
    out = run(spark, machines, [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 10:00"), 400, 300)],
              [(9, 1, ts("2024-01-02 05:00"), ts("2024-01-02 11:00"), "x")])
    r = out[(1, dt.date(2024, 1, 2))]
    assert r.available_time_hrs == 0 and r.availability_rate == D("0.0000")
    assert r.performance_rate is None and r.oee is None


def test_zero_planned_time_gives_null_availability(spark, machines):
    out = run(spark, machines, [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 06:00"), 0, 0)])
    r = out[(1, dt.date(2024, 1, 2))]
    assert r.planned_time_hrs == 0 and r.availability_rate is None and r.oee is None


def test_output_above_theoretical_clamps_to_one(spark, machines):
    out = run(spark, machines, [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 14:00"), 800, 1000)])
    assert out[(1, dt.date(2024, 1, 2))].performance_rate == D("1.0000")


def test_defects_above_output_go_negative_and_dq_catches(spark, machines):
    o = [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 14:00"), 800, 100)]
    f = [(1, 1, "scratch", 150)]
    res = oee.oee_daily(machines, orders(spark, o), downtime(spark, []), defects(spark, f))
    r = res.first()
    assert r.quality_rate == D("-0.5000") and r.good_units == -50
    assert dq.oee_bounds(res).count() == 1


def test_two_defect_rows_sum_without_fanout(spark, machines):
    o = [(1, 1, "S", "M", ts("2024-01-02 06:00"), ts("2024-01-02 14:00"), 800, 400),
         (2, 1, "S", "A", ts("2024-01-02 14:00"), ts("2024-01-02 22:00"), 800, 400)]
    f = [(1, 1, "a", 5), (2, 1, "b", 7)]
    r = run(spark, machines, o, (), f)[(1, dt.date(2024, 1, 2))]
    assert r.total_units == 800 and r.total_defects == 12 and r.good_units == 788


def test_night_shift_and_overnight_stoppage_count_on_start_day(spark, machines):
    o = [(1, 1, "S", "NIGHT", ts("2024-01-02 22:00"), ts("2024-01-03 06:00"), 800, 600)]
    d = [(9, 1, ts("2024-01-02 23:00"), ts("2024-01-03 01:00"), "jam")]
    out = run(spark, machines, o, d)
    assert list(out) == [(1, dt.date(2024, 1, 2))]
    r = out[(1, dt.date(2024, 1, 2))]
    assert r.planned_time_hrs == D("8.00") and r.downtime_hrs == D("2.0000")
    assert r.availability_rate == D("0.7500")


def test_fractional_seconds_count(spark, machines):
    d = downtime(spark, [(9, 1, ts("2024-01-02 10:00:00"), ts("2024-01-02 10:00:01.800000"), "x")])
    assert d.first().duration_hrs == D("0.0005")


def test_weekly_summary_starts_monday_and_averages_days(spark, machines):
    o = [(i, 1, "S", "M", ts(f"2024-01-0{d} 06:00"), ts(f"2024-01-0{d} 14:00"), 800, q)
         for i, (d, q) in enumerate([(7, 800), (8, 400), (9, 600)], start=1)]
    daily = oee.oee_daily(machines, orders(spark, o), downtime(spark, []), defects(spark, []))
    weeks = {r.week_start: r for r in oee.production_summary(daily).collect()}
    assert set(weeks) == {dt.date(2024, 1, 1), dt.date(2024, 1, 8)}
    w2 = weeks[dt.date(2024, 1, 8)]
    assert w2.days_in_week == 2 and w2.avg_oee == D("0.6250") and w2.min_oee == D("0.5000")
    assert w2.total_units_produced == 1000
