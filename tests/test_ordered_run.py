"""Ordered refresh end to end: full build, then an incremental re-run changes nothing."""

import datetime as dt
import tempfile

import pytest
from plant_support import SF
from pyspark.sql import functions as F

from plantmetrics.operators import vector_index
from plantmetrics.params import DEFAULT
from plantmetrics.plans import catalog, ordered_run, versions
from plantmetrics.plans.model import Model
from plantmetrics.sources.driver import DriverTables
from plantmetrics.sources.readers import SCHEMAS, ParquetSource
from plantmetrics.sources.schemas import MACHINES


def test_full_then_incremental_refresh_is_stable(spark):
    out = tempfile.mkdtemp(prefix="pm-pipe-")
    src = DriverTables(spark, SF)
    first = ordered_run.run(spark, src, out, full=True)
    oee1 = sorted(map(tuple, spark.read.parquet(f"{out}/mart_oee_daily").collect()))
    second = ordered_run.run(spark, src, out)
    oee2 = sorted(map(tuple, spark.read.parquet(f"{out}/mart_oee_daily").collect()))
    assert oee1 == oee2
    assert first["mart_oee_daily"] == second["mart_oee_daily"] > 0
    assert second["mart_maintenance_queue"] > 0
    # the second run replaced its own same-day recommendations instead of adding more
    assert second["maintenance_recommendations"] == first["maintenance_recommendations"]


def test_refresh_on_stored_tables_equals_the_adapter(spark):
    """Raw tables and vectors stored as Parquet (machine vectors as text): the same queue."""
    root = tempfile.mkdtemp(prefix="pm-src-")
    src = DriverTables(spark, SF)
    for name in set(SCHEMAS) - {"failure_patterns"}:
        src.table(name).write.parquet(f"{root}/raw/{name}")
    m = Model(spark, src)
    src.pattern_vectors(m.numbered_history.select("event_id", "pattern_id")).select("event_id", "embedding").write.parquet(
        f"{root}/raw/pattern_vectors")
    m.query_vectors.select("machine_id", F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",").alias(
        "embedding")).write.parquet(f"{root}/raw/machine_vectors")
    tables = ["failure_patterns", "maintenance_recommendations", "mart_maintenance_queue"]
    got = ordered_run.run(spark, ParquetSource(spark, f"{root}/raw"), f"{root}/a", full=True)
    assert got == ordered_run.run(spark, src, f"{root}/b", full=True) and min(got.values()) > 0
    for t in tables:
        a, b = (ordered_run.read(spark, f"{root}/{x}", t) for x in "ab")
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), t


def test_create_and_drop_table(spark):
    path = tempfile.mkdtemp(prefix="pm-cat-") + "/machines"
    catalog.create_table(spark, "pm_test_machines", MACHINES, path)
    assert spark.catalog.tableExists("pm_test_machines")
    catalog.drop_tables(spark, ["pm_test_machines"])
    assert not spark.catalog.tableExists("pm_test_machines")


class _Late(DriverTables):
    """The driver tables before some stoppages are known."""

    def __init__(self, spark, sf, known):
        super().__init__(spark, sf)
        self.known = known

    def table(self, name):
        t = super().table(name)
        return t.where(self.known) if name == "downtime_events" else t


def test_pattern_ids_stay_when_late_events_arrive(spark):
    out = tempfile.mkdtemp(prefix="pm-late-")
    ordered_run.run(spark, _Late(spark, SF, F.col("event_id") % 9 != 4), out)
    before = {r.event_id: (r.pattern_id, r.description) for r in ordered_run.read(spark, out, "failure_patterns").collect()}
    parts = versions.folders(spark, f"{out}/failure_patterns")
    ordered_run.run(spark, DriverTables(spark, SF), out)
    now = ordered_run.read(spark, out, "failure_patterns")
    after = {r.event_id: (r.pattern_id, r.description) for r in now.collect()}
    grown = versions.folders(spark, f"{out}/failure_patterns")
    assert grown[:-1] == parts and {k: v for k, v in after.items() if k in before} == before
    new = sorted(v[0] for k, v in after.items() if k not in before)
    assert new and spark.read.parquet(grown[-1]).count() == len(new)
    assert new == list(range(len(before) + 1, len(after) + 1))
    index = vector_index.Index(spark, f"{out}/{ordered_run.INDEX}").rows
    assert sorted(r.pattern_id for r in index.select("pattern_id").collect()) == sorted(v[0] for v in after.values())
    # every pattern id in the recommendations is one of the store
    ordered_run.run(spark, DriverTables(spark, SF), out)
    assert versions.folders(spark, f"{out}/failure_patterns") == grown
    assert ordered_run.read(spark, out, "failure_patterns").count() == len(after)


def test_a_run_that_breaks_off_leaves_the_tables_whole(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="pm-broken-")
    src = DriverTables(spark, SF)
    ordered_run.run(spark, src, out)
    names = ["failure_patterns", "maintenance_recommendations", "mart_production_summary", "mart_maintenance_queue"]
    before = {t: sorted(map(str, ordered_run.read(spark, out, t).collect())) for t in names}

    def lost(*a, **k):
        raise RuntimeError("executor lost before the commit")

    monkeypatch.setattr(versions, "_commit", lost)       # everything is written, nothing is committed
    with pytest.raises(RuntimeError):
        ordered_run.run(spark, src, out, DEFAULT.with_(as_of=DEFAULT.as_of + dt.timedelta(days=1)))
    monkeypatch.undo()
    assert {t: sorted(map(str, ordered_run.read(spark, out, t).collect())) for t in names} == before
    got = ordered_run.run(spark, src, out, DEFAULT.with_(as_of=DEFAULT.as_of + dt.timedelta(days=1)))
    assert got["maintenance_recommendations"] >= len(before["maintenance_recommendations"])
    ids = [r.rec_id for r in ordered_run.read(spark, out, "maintenance_recommendations").select("rec_id").collect()]
    assert len(ids) == len(set(ids))
