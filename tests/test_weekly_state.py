"""Weekly roll-up from stored sums of closed days; counts and drops of stored tables."""

import datetime as dt

import pytest
from plant_support import SF
from pyspark.sql import functions as F

from plantmetrics.operators import oee
from plantmetrics.plans import ordered_run, versions
from plantmetrics.plans.model import Model
from plantmetrics.sources.driver import DriverTables


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily"))
    Model(spark, DriverTables(spark, SF)).oee_daily.write.partitionBy("shift_date").parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/t").select(*oee.OEE_COLUMNS)


def _same(a, b):
    return a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_partials_merge_to_the_full_roll_up(daily):
    parts = [oee.weekly_partials(daily.where(F.pmod(F.dayofmonth("shift_date"), F.lit(3)) == i)) for i in range(3)]
    merged = oee.merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert _same(oee.weekly_rows(merged), oee.production_summary(daily))
    assert merged.dtypes == parts[0].dtypes


def test_refresh_reads_open_and_newly_closed_days_only(spark, daily, tmp_path):
    out = str(tmp_path)
    first, last = daily.agg(F.min("shift_date"), F.max("shift_date")).first()

    def known(until):
        return daily.where(F.col("shift_date") <= F.lit(until))

    for back in (20, 13, 11, 11, 3, 0):       # a day, a week and no day later
        now = last - dt.timedelta(days=back)
        ordered_run.refresh_weekly(spark, out, known(now), now - dt.timedelta(days=3))
        assert _same(ordered_run.read(spark, out, "mart_production_summary"), oee.production_summary(known(now))), back
    # days that are closed and stored are not read again: without them the result is the same
    since = last - dt.timedelta(days=3)
    ordered_run.refresh_weekly(spark, out, daily.where(F.col("shift_date") >= F.lit(since)), since)
    assert _same(ordered_run.read(spark, out, "mart_production_summary"), oee.production_summary(daily))
    # a run date that goes back builds anew
    ordered_run.refresh_weekly(spark, out, known(first + dt.timedelta(days=9)), first + dt.timedelta(days=6))
    assert _same(ordered_run.read(spark, out, "mart_production_summary"), oee.production_summary(known(first + dt.timedelta(days=9))))


def test_a_mart_write_that_breaks_off_is_made_up_for(spark, daily, tmp_path, monkeypatch):
    out = str(tmp_path)
    last = daily.agg(F.max("shift_date")).first()[0]
    early = daily.where(F.col("shift_date") <= F.lit(last - dt.timedelta(days=14)))
    ordered_run.refresh_weekly(spark, out, early, last - dt.timedelta(days=17))
    write, calls = versions.write_days, []

    def second_fails(*args, **named):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return write(*args, **named)

    with monkeypatch.context() as m:
        m.setattr(versions, "write_days", second_fails)
        with pytest.raises(OSError):
            ordered_run.refresh_weekly(spark, out, daily, last - dt.timedelta(days=3))
    assert _same(ordered_run.read(spark, out, "mart_production_summary"), oee.production_summary(early))
    ordered_run.refresh_weekly(spark, out, daily, last - dt.timedelta(days=3))
    assert _same(ordered_run.read(spark, out, "mart_production_summary"), oee.production_summary(daily))


def test_counts_come_from_footers_and_drop_deletes_what_a_run_stored(spark, tmp_path):
    out = str(tmp_path)
    counts = ordered_run.run(spark, DriverTables(spark, SF), out, full=True)
    assert set(counts) == set(ordered_run.TABLES) and min(counts.values()) > 0
    assert counts == {t: len(ordered_run.read(spark, out, t).collect()) for t in ordered_run.TABLES}
    plan = ordered_run.stored_counts(spark, out)._jdf.queryExecution().executedPlan().toString()
    reads = [x.split("ReadSchema: ", 1)[1].split("\n")[0] for x in plan.split("FileScan")[1:]]
    assert len(reads) == len(ordered_run.TABLES) and set(reads) == {"struct<>"} and "Join" not in plan, reads
    assert set(ordered_run.drop(spark, out)) == set(ordered_run.TABLES) - {"maintenance_recommendations"}
    assert [r.table_name for r in ordered_run.stored_counts(spark, out).collect()] == ["maintenance_recommendations"]
    assert ordered_run.drop(spark, out, ["failure_patterns"]) == []
    with pytest.raises(ValueError):
        ordered_run.drop(spark, out, ["../elsewhere"])
