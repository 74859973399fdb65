"""OEE rates against an exact Decimal computation on random machine-days."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from plantmetrics.operators import oee, staging
from plantmetrics.sources import schemas

BASE = dt.datetime(2024, 1, 1)
Q4 = Decimal("0.0001")


def q(x, places):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def hours(td, places):
    us = Decimal(td.days * 86_400_000_000 + td.seconds * 1_000_000 + td.microseconds)
    return q(us / Decimal(3_600_000_000), places)


def expected(orders, downs, defs, rate):
    by_day = {}
    for oid, day, start_h, dur_min, actual in orders:
        start = BASE + dt.timedelta(days=day, hours=start_h)
        d = by_day.setdefault(start.date(), {"planned": Decimal(0), "actual": 0, "oids": set(), "down": Decimal(0)})
        d["planned"] += hours(dt.timedelta(minutes=dur_min), 2)
        d["actual"] += actual
        d["oids"].add(oid)
    for day, start_h, dur_s in downs:
        start = BASE + dt.timedelta(days=day, hours=start_h)
        if start.date() in by_day:
            by_day[start.date()]["down"] += hours(dt.timedelta(seconds=dur_s / 1000), 4)
    out = {}
    for date, d in by_day.items():
        defects = sum(qty for oid, qty in defs if oid in d["oids"])
        p, down = d["planned"], d["down"]
        avail_t = max(Decimal(0), p - down)
        a = None if p == 0 else q(max(Decimal(0), (p - down) / p), 4)
        den = rate * avail_t
        perf = None if den == 0 else q(min(Decimal(1), Decimal(d["actual"]) / den), 4)
        units = d["actual"]
        qual = None if units == 0 else q(Decimal(units - defects) / Decimal(units), 4)
        o = None if None in (a, perf, qual) else q(a * perf * qual, 4)
        out[date] = (a, perf, qual, o)
    return out


order_st = st.tuples(st.integers(0, 2), st.sampled_from([6, 14, 22]), st.integers(0, 600), st.integers(0, 2000))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(order_st, min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 23), st.integers(0, 40_000_000)), max_size=8),
       st.lists(st.tuples(st.integers(0, 11), st.integers(1, 500)), max_size=8))
@example(orders_raw=[(0, 6, 0, 1)], downs=[], defs_raw=[(0, 11)])   # quality -10: overflow
def test_rates_match_exact_decimal(spark, orders_raw, downs, defs_raw):
    rate = 150
    orders = [(i, day, h, dur, act) for i, (day, h, dur, act) in enumerate(orders_raw)]
    defs = [(oid % len(orders), qty) for oid, qty in defs_raw]
    machines = staging.stg_machines(spark.createDataFrame([(1, "M", "T", "L", rate, dt.date(2020, 1, 1))],
                                                          schemas.MACHINES))
    o = staging.stg_orders(spark.createDataFrame(
        [(i, 1, "S", "M", BASE + dt.timedelta(days=day, hours=h),
          BASE + dt.timedelta(days=day, hours=h, minutes=dur), 0, act) for i, day, h, dur, act in orders],
        schemas.PRODUCTION_ORDERS))
    d = staging.stg_downtime(spark.createDataFrame(
        [(j, 1, BASE + dt.timedelta(days=day, hours=h), BASE + dt.timedelta(days=day, hours=h, milliseconds=ms), "x")
         for j, (day, h, ms) in enumerate(downs)], schemas.DOWNTIME_EVENTS))
    f = staging.stg_defects(spark.createDataFrame([(k, oid, "t", qty) for k, (oid, qty) in enumerate(defs)],
                                                  schemas.DEFECTS))
    exp = expected(orders, [(day, h, ms) for day, h, ms in downs], defs, Decimal(rate))
    res = oee.oee_daily(machines, o, d, f)
    if any(v[2] is not None and abs(v[2]) >= 10 for v in exp.values()):
        # DECIMAL(5,4) holds |x| < 10: defects above ten times the output overflow and raise
        # (ANSI decimal semantics, as decided in SURVEY §1.4-2), never a silent NULL
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            res.collect()
        return
    got = {r.shift_date: (r.availability_rate, r.performance_rate, r.quality_rate, r.oee) for r in res.collect()}
    assert got == exp
