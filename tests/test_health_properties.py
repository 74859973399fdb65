"""Daily health against an exact Decimal computation on random readings."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plantmetrics.operators import health, staging
from plantmetrics.sources import schemas

BASE = dt.datetime(2024, 1, 1)


def q(x, places):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def mean(vals, s, out_s):
    """AVG(decimal(p,s)) is half-up at scale s+4, then the cast rounds to out_s."""
    return q(q(sum(vals) / Decimal(len(vals)), s + 4), out_s)


reading = st.tuples(st.integers(1, 2), st.integers(0, 47), st.integers(2000, 9000), st.integers(0, 9999),
                    st.integers(0, 99999))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=40))
def test_health_matches_exact_decimal(spark, data):
    rows = [(m, BASE + dt.timedelta(hours=h), Decimal(t).scaleb(-2), Decimal(v).scaleb(-3), Decimal(p).scaleb(-3))
            for m, h, t, v, p in data]
    df = staging.stg_sensor(spark.createDataFrame(rows, schemas.SENSOR_READINGS))
    got = {(r.machine_id, r.reading_date): r for r in health.machine_health(df).collect()}
    groups = {}
    for m, ts, t, v, p in rows:
        groups.setdefault((m, ts.date()), []).append((t, v, p))
    assert set(got) == set(groups)
    for k, g in groups.items():
        t, v, p = zip(*g)
        r = got[k]
        assert r.reading_count == len(g)
        assert (r.avg_temp_c, r.avg_vibration_mm_s, r.avg_power_kw) == (mean(t, 2, 2), mean(v, 3, 3), mean(p, 3, 3))
        assert (r.max_temp_c, r.max_vibration_mm_s, r.max_power_kw) == (max(t), max(v), max(p))
        flag = max(t) * len(t) > sum(t) * Decimal("1.15") or max(v) * len(v) > sum(v) * Decimal("1.50")
        assert r.anomaly_flag == flag
