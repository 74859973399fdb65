"""The Source layer: stored Parquet and CSV tables give the same marts as the adapter."""

import tempfile

from plant_support import SF

from plantmetrics.operators.signals import judge_signal_csv, parse_signal_csv
from plantmetrics.plans.model import Model
from plantmetrics.sources import CsvSource, DriverTables, ParquetSource
from plantmetrics.sources.csv_load import load_csv
from plantmetrics.sources.readers import KEYS, JdbcSource

RAW = ["machines", "production_orders", "defects", "sensor_readings", "downtime_events",
       "maintenance_recommendations"]


def _dump(spark, fmt):
    root = tempfile.mkdtemp(prefix=f"pm-src-{fmt}-")
    d = DriverTables(spark, SF)
    for t in RAW:
        w = d.table(t).write.mode("overwrite")
        (w.option("header", True).csv if fmt == "csv" else w.parquet)(f"{root}/{t}")
    return root, d


def test_parquet_source_matches_adapter(spark):
    root, d = _dump(spark, "parquet")
    a = Model(spark, d).oee_daily
    b = Model(spark, ParquetSource(spark, root)).oee_daily
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_csv_source_matches_adapter_and_drops_malformed(spark):
    root, d = _dump(spark, "csv")
    with open(f"{root}/machines/zz-broken.csv", "w") as f:
        f.write("machine_id,machine_name,machine_type,production_line,theoretical_rate_per_hr,install_date\n")
        f.write("not-a-number,Broken,LATHE,LINE_A,100,2020-01-01\n")
    a = Model(spark, d).machine_health
    b = Model(spark, CsvSource(spark, root)).machine_health
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    m = CsvSource(spark, root).table("machines")
    assert m.count() == d.table("machines").count()


def test_adapter_tables_have_the_declared_schemas(spark):
    from plantmetrics.sources.readers import SCHEMAS
    d = DriverTables(spark, SF)
    for name in RAW + ["responses"]:
        got = [(f.name, f.dataType.simpleString()) for f in d.table(name).schema.fields]
        assert got == [(f.name, f.dataType.simpleString()) for f in SCHEMAS[name].fields], name


def test_parquet_source_reads_zoned_timestamps(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="pm-src-ltz-")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5), 20.5, 1.25, 3.5)],
                               "machine_id long, ts timestamp, temperature_c double, vibration_mm_s double, power_kw double")
    df.write.parquet(f"{root}/sensor_readings")
    r = ParquetSource(spark, root).table("sensor_readings").first()
    assert r.ts == dt.datetime(2024, 1, 2, 3, 4, 5) and str(r.temperature_c) == "20.50"


def test_trace_lines_are_kept_or_rejected_with_a_reason(spark, tmp_path):
    lines = DriverTables(spark, SF).signal_csv_lines()
    more = spark.createDataFrame([("",), (None,), ("1,x,2,3,0,0,0,0,0,0",), ("1,300,2,3,0,0,0,0,0",), ("2,300,2,3,0,0,0,0,0,0",)], "line string")
    both = lines.unionByName(more)
    load = load_csv(judge_signal_csv(both), f"{tmp_path}/load")
    total = both.count()
    assert (load.n_kept, load.n_rejected) == (load.kept.count(), load.rejected.count())
    assert load.n_kept + load.n_rejected == total and load.n_rejected > 4
    want = parse_signal_csv(both)
    assert load.kept.columns == want.columns and sorted(map(repr, load.kept.collect())) == sorted(map(repr, want.collect()))
    got = {r.line: r.reason for r in load.rejected.collect()}
    assert got["1,x,2,3,0,0,0,0,0,0"] == "Process temperature [K]" and got["1,300,2,3,0,0,0,0,0"] == "RNF"
    assert "" in got and None in got and "2,300,2,3,0,0,0,0,0,0" not in got
    nothing = load_csv(judge_signal_csv(both.where("false")), f"{tmp_path}/load")     # replaces the load before
    assert (nothing.n_kept, nothing.kept.count(), nothing.rejected.count()) == (0, 0, 0)


def test_trace_lines_are_parsed_once(spark):
    """A filter on the parsed fields does not parse the line again for every field it names."""
    rows = parse_signal_csv(DriverTables(spark, SF).signal_csv_lines())
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_csv_source_keeps_rejected_lines_with_a_reason(spark, tmp_path):
    root, d = _dump(spark, "csv")
    bad = ["not-a-number,Broken,LATHE,LINE_A,100,2020-01-01", "7,NoDate,LATHE,LINE_A,100,no-date", "8,Short", ",NoId,LATHE,LINE_A,100,2020-01-01"]
    with open(f"{root}/machines/zz-broken.csv", "w") as f:
        f.write("\n".join(["machine_id,machine_name,machine_type,production_line,theoretical_rate_per_hr,install_date", *bad]) + "\n")
    src = CsvSource(spark, root)
    n = d.table("machines").count()
    load = load_csv(src.judged("machines"), f"{tmp_path}/load")
    assert (load.n_kept, load.n_rejected) == (n, len(bad))
    assert sorted(map(tuple, load.kept.collect())) == sorted(map(tuple, src.table("machines").collect()))
    got = {r.line: r.reason for r in load.rejected.collect()}
    assert {got.pop(x) for x in bad[:3]} == {"malformed"} and list(got.values()) == ["machine_id"]
    # the reason alone: nothing is pruned that decides
    assert src.judged("machines").select("reason").where("reason is not null").count() == len(bad)


def test_database_tables_are_read_in_slices_of_their_key():
    """The options that reach the reader; no database takes part."""
    asked = []

    class Known(JdbcSource):
        def bounds(self, name):
            asked.append(name)
            return known[name]

    import datetime as dt
    known = {"production_orders": (1, 90_000_000, 40_000_000), "machines": (1, 500, 500), "defects": (None, None, 0),
             "sensor_readings": (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1, 6), 3_500_000), "downtime_events": (5, 5, 9_000_000)}
    src = Known(None, "jdbc:x:y", {"user": "u", "fetchsize": "7"}, "erp", {"responses": ("machine_id", 1, 10, 3)})
    o = src.options("production_orders")
    assert o == {"url": "jdbc:x:y", "user": "u", "fetchsize": "7", "dbtable": "erp.production_orders", "partitionColumn": "order_id",
                 "lowerBound": "1", "upperBound": "90000000", "numPartitions": "16"}
    t = src.options("sensor_readings")
    assert (t["numPartitions"], t["lowerBound"], t["upperBound"]) == ("4", "2024-01-01 00:00:00", "2024-02-01 06:00:00")
    for one in ("machines", "defects", "downtime_events", "no_such_table"):
        assert "numPartitions" not in src.options(one)
    assert src.options("responses")["partitionColumn"] == "machine_id" and "responses" not in asked
    q = JdbcSource(None, "jdbc:x:y", schema_name="erp").bounds_options("defects")
    assert q["query"] == "SELECT MIN(order_id) AS lo, MAX(order_id) AS hi, COUNT(*) AS n FROM erp.defects" and q["fetchsize"] == "100000"
    from plantmetrics.sources.readers import SCHEMAS
    assert all(KEYS[n] in SCHEMAS[n].names for n in KEYS) and set(KEYS) == set(SCHEMAS)
