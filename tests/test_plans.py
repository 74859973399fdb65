"""Plan tests: pushdown and pruning reach the scans, no unintended cartesian products,
top-1-per-key uses a partial window limit."""

from plant_support import SF

from query_registry import QUERIES, model


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_sensor_scan_prunes_columns_and_pushes_filter(spark):
    s = model(spark, SF).source.table("sensor_readings")
    txt = formatted(s)
    assert "PushedFilters" in txt and "event_type" in txt
    read_schema = [ln for ln in txt.splitlines() if "ReadSchema" in ln][0]
    assert "l_" not in read_schema and "event_id" not in read_schema   # only needed columns are read


def test_health_window_filter_reaches_scan(spark):
    import datetime as dt

    from plantmetrics.operators import health
    m = model(spark, SF)
    txt = formatted(health.machine_health(m.stg_sensor, since=dt.date(2024, 1, 28)))
    pushed = [ln for ln in txt.splitlines() if "PushedFilters" in ln]
    assert any("GreaterThanOrEqual(ts" in ln for ln in pushed), pushed


def test_no_cartesian_products_in_headline_queries(spark):
    for name in ["oee_daily", "maintenance_queue", "at_risk_machines", "similar_failures", "coverage_gaps",
                 "failure_patterns", "recommendations"]:
        p = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_latest_recommendation_uses_window_group_limit(spark):
    from plantmetrics.operators import recommend
    df = recommend.latest_recommendation(model(spark, SF).recommendations_raw)
    assert "WindowGroupLimit" in plan(df)


def test_aggregates_are_partial_before_shuffle(spark):
    p = plan(model(spark, SF).machine_health)
    assert p.count("HashAggregate") >= 2   # partial + final around the exchange


def test_machine_dimension_join_is_broadcast_when_small(spark):
    p = plan(model(spark, SF).oee_daily)
    assert "BroadcastHashJoin" in p
