"""Greedy cooldown: fixtures, strictness, and a property test against a Python walk."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantmetrics.operators import events
from plantmetrics.operators.events import failure_reason, greedy_cooldown

BASE = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "machine_id int, event_id long, ts timestamp_ntz")


def kept(spark, rows, cooldown=7200):
    return sorted(r.event_id for r in greedy_cooldown(frame(spark, rows), "machine_id", "ts", ["event_id"],
                                                     cooldown).collect())


def walk(rows, cooldown):
    out = []
    for m in {r[0] for r in rows}:
        last = None
        for _, eid, t in sorted((r for r in rows if r[0] == m), key=lambda r: (r[2], r[1])):
            if last is None or (t - last).total_seconds() > cooldown:
                out.append(eid)
                last = t
    return sorted(out)


def test_reference_example(spark):
    hrs = [0, 1.5, 2.5, 4.0]
    rows = [(1, i, BASE + dt.timedelta(hours=h)) for i, h in enumerate(hrs)]
    assert kept(spark, rows) == [0, 2]


def test_exactly_cooldown_apart_is_suppressed(spark):
    rows = [(1, 1, BASE), (1, 2, BASE + dt.timedelta(seconds=7200)), (1, 3, BASE + dt.timedelta(seconds=7201))]
    assert kept(spark, rows) == [1, 3]


def test_lag_filter_would_differ(spark):
    # every gap is 1 h: a lag filter keeps only the first; the greedy walk keeps every third hour
    rows = [(1, i, BASE + dt.timedelta(hours=i)) for i in range(10)]
    assert kept(spark, rows) == [0, 3, 6, 9]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40 * 3600)), min_size=1, max_size=60))
def test_matches_python_walk(spark, data):
    rows = [(m, i, BASE + dt.timedelta(seconds=s)) for i, (m, s) in enumerate(data)]
    assert kept(spark, rows) == walk(rows, 7200)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(-30, 60)), min_size=1, max_size=60), st.sampled_from([0, 1, 7]))
def test_short_cooldowns_match_python_walk(spark, data, cooldown):
    # also across 1970, where bucket numbers change sign
    rows = [(m, i, dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=500 * s)) for i, (m, s) in enumerate(data)]
    assert kept(spark, rows, cooldown) == walk(rows, cooldown)


def test_burst_of_copies(spark):
    rows = [(1, i, BASE) for i in range(500)] + [(1, 500 + i, BASE + dt.timedelta(minutes=30 * i)) for i in range(20)]
    assert kept(spark, rows) == [0, 505, 510, 515]


def test_hot_machine_matches_walk(spark):
    # one machine with 20,000 events a second or less apart, beside a quiet one
    rows = [(1, i, BASE + dt.timedelta(seconds=(i * 7919) % 15000)) for i in range(20000)]
    rows += [(2, 50000 + i, BASE + dt.timedelta(hours=5 * i)) for i in range(5)]
    assert kept(spark, rows, 60) == walk(rows, 60)


def test_null_key_is_a_key_and_null_times_stay(spark):
    rows = [(None, 1, BASE), (None, 2, BASE + dt.timedelta(hours=1)), (None, 3, BASE + dt.timedelta(hours=3)),
            (1, 4, None), (1, 5, BASE), (None, 6, None)]
    assert kept(spark, rows) == [1, 3, 4, 5, 6]


def test_dense_long_run_matches_walk(spark):
    # one machine failing every 10 minutes for 3 days: a single long run of buckets
    rows = [(1, i, BASE + dt.timedelta(minutes=10 * i)) for i in range(432)]
    rows += [(2, 1000 + i, BASE + dt.timedelta(minutes=37 * i)) for i in range(100)]
    assert kept(spark, rows) == walk(rows, 7200)


@pytest.mark.parametrize(("span", "records"), [(1, 3), (2, 5), (7, 10000)])
def test_blocks_compose_across_batches(spark, monkeypatch, span, records):
    """Hot, dense and null keys, cut into many short blocks, streamed in tiny batches."""
    r = random.Random(span)
    monkeypatch.setattr(events, "SPAN", span)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        rows = [(1, i, BASE + dt.timedelta(seconds=r.randrange(40000))) for i in range(900)]
        rows += [(None, 2000 + i, BASE + dt.timedelta(seconds=r.choice([1, 50, 900]) * i)) for i in range(60)]
        rows += [(3, 3000 + i, BASE - dt.timedelta(days=r.randrange(3), seconds=r.randrange(3000))) for i in range(80)]
        assert kept(spark, rows, 600) == walk(rows, 600)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_shuffles_do_not_depend_on_the_stretch(spark):
    """One plan without a loop over jobs: the same exchanges for a short and a long run of events."""
    def exchanges(n):
        nodes = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 420_000_000).alias("t"), "id")
        plan = events._kept_ids(nodes, 600_000_000)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange"), plan.count("MapInArrow")
    assert exchanges(10) == exchanges(30000) == (3, 3)      # the blocks' entries, then the walk: one plan, no loop over jobs


def test_failure_reason_first_flag_wins(spark):
    df = spark.createDataFrame([(1, 0, 1, 0, 1, 0), (2, 1, 0, 1, 0, 0), (3, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 1),
                                (5, 1, 1, 1, 1, 1)],
                               "i int, TWF int, HDF int, PWF int, OSF int, RNF int")
    got = {r.i: r.r for r in df.select("i", failure_reason().alias("r")).collect()}
    assert got == {1: "MATERIAL_JAM", 2: "TOOLING_FAILURE", 3: "UNPLANNED_BREAKDOWN", 4: "UNPLANNED_BREAKDOWN",
                   5: "TOOLING_FAILURE"}
