"""Model tables as SQL views: figures from spark.sql equal sums over the model's own rows."""

from collections import defaultdict

from plant_support import SF

from plantmetrics.plans.catalog import register_views
from query_registry import model


def test_views_answer_sql(spark):
    m = model(spark, SF)
    names = register_views(m, {"mart_oee_daily": "oee_daily", "mart_machine_health": "machine_health",
                               "mart_ai_maintenance_queue": "maintenance_queue"})
    assert len(names) == 3
    best = defaultdict(list)
    for r in m.oee_daily.collect():
        if r.oee is not None:
            best[r.production_line].append(r.oee)
    got = spark.sql("SELECT production_line AS p, max(oee) AS top, count(oee) AS n FROM mart_oee_daily GROUP BY 1").collect()
    assert {r.p: (r.top, r.n) for r in got if r.n} == {p: (max(v), len(v)) for p, v in best.items()}
    flagged = sum(bool(r.anomaly_flag) for r in m.machine_health.collect())
    assert spark.sql("SELECT count_if(anomaly_flag) FROM mart_machine_health").first()[0] == flagged
    queue = spark.sql("SELECT machine_id FROM mart_ai_maintenance_queue WHERE urgency_tier = 'CRITICAL'").collect()
    assert len(queue) == sum(r.urgency_tier == "CRITICAL" for r in m.maintenance_queue.collect())
