"""Rule suite in one scan per table, and defects filtered by the window's orders."""

import datetime as dt

from plant_support import SF
from pyspark.sql import functions as F

from plantmetrics.operators import oee
from plantmetrics.operators.dq import TableRules, dq_report, unique, unique_combination
from plantmetrics.plans.model import Model
from plantmetrics.sources.driver import DriverTables

RULES = TableRules("t", not_null=["a", "b"], ranges={"c": (0, 10)}, values={"d": ["x", "y"]}, unique=["a", "c"],
                   unique_combos=[["a", "b"], ["b", "d"]])
ROWS = [(1, 1, 5, "x"), (1, 1, 5, "y"), (None, 1, 11, "x"), (None, None, None, None), (2, None, -1, "z"), (2, None, 3, "z"),
        (None, None, None, None)]


def _plain(df):
    got = {"not_null(a)": df.where("a is null").count(), "not_null(b)": df.where("b is null").count(),
           "accepted_range(c,0,10)": df.where("c not between 0 and 10").count(),
           "accepted_values(d)": df.where("d not in ('x', 'y')").count()}
    for c in RULES.unique:
        got[f"unique({c})"] = unique(df, c).count()
    for cols in RULES.unique_combos:
        got[f"unique_combination({','.join(cols)})"] = unique_combination(df, cols).count()
    return got


def test_report_equals_the_single_rules(spark):
    for rows in (ROWS, ROWS[:1], []):
        df = spark.createDataFrame(rows, "a int, b int, c int, d string")
        got = {r.rule: r.failures for r in dq_report({"t": df}, [RULES]).collect()}
        assert got == _plain(df), rows


def test_each_table_is_scanned_once(spark, tmp_path):
    spark.createDataFrame(ROWS, "a int, b int, c int, d string").write.parquet(f"{tmp_path}/t")
    report = dq_report({"t": spark.read.parquet(f"{tmp_path}/t")}, [RULES])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") >= 1


def test_defects_outside_the_window_end_before_the_shuffle(spark):
    m = Model(spark, DriverTables(spark, SF))
    last = m.stg_orders.agg(F.max("shift_date")).first()[0]
    window = m.stg_orders.where(F.col("shift_date") >= F.lit(last - dt.timedelta(days=4)))
    wanted = m.stg_defects.join(window.select("order_id"), "order_id", "left_semi")
    kept = oee.defects_of(m.stg_defects, window)
    assert kept.columns == m.stg_defects.columns
    assert wanted.select(*kept.columns).exceptAll(kept).isEmpty()
    n = wanted.count()
    assert 0 < n <= kept.count() <= n + m.stg_defects.count() // 1000 < m.stg_defects.count()
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    nothing = oee.defects_of(m.stg_defects, window.where("order_id < 0"))
    assert nothing.isEmpty()


def test_the_window_alone_equals_the_window_of_all_days(spark):
    m = Model(spark, DriverTables(spark, SF))
    since = m.stg_orders.agg(F.max("shift_date")).first()[0] - dt.timedelta(days=5)
    part = oee.oee_daily(m.stg_machines, m.stg_orders, m.stg_downtime, m.stg_defects, since=since)
    whole = m.oee_daily.where(F.col("shift_date") >= F.lit(since))
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.collect()))
