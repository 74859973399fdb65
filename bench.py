"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}. Every query
is fully executed through the ``noop`` sink (no driver collect). Each timing is the
median of $BENCH_RUNS runs after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["oee_daily", "machine_health", "production_summary", "maintenance_queue", "similar_failures",
            "cooldown_events", "derive_downtime", "failure_patterns", "dq_report"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from plantmetrics.session import local_session
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="plantmetrics-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from query_registry import QUERIES, model

    def build_all():
        """The 12 models as the reference builds them: 8 staging/intermediate views (lazy,
        nothing runs for them on their own) and 4 mart tables written out, independent
        ones as concurrent jobs (the reference builds with 4 model threads); the weekly
        roll-up and the queue read the stored OEE and health tables."""
        import tempfile

        from plantmetrics.operators import health, oee
        from plantmetrics.plans.ordered_run import _together as together
        out = tempfile.mkdtemp(prefix="plantmetrics-bench-marts-")   # a new folder per run
        m = model(spark, sf_dir)
        for view in ["stg_machines", "stg_orders", "stg_defects", "stg_sensor", "stg_downtime", "availability",
                     "performance", "quality"]:
            getattr(m, view).createOrReplaceTempView(view)
        o, h = m.oee_daily, m.machine_health
        together(4, lambda: o.write.mode("overwrite").parquet(f"{out}/mart_oee_daily"),
                 lambda: h.write.mode("overwrite").parquet(f"{out}/mart_machine_health"))
        m.using(oee_daily=spark.read.parquet(f"{out}/mart_oee_daily").select(*oee.OEE_COLUMNS),
                machine_health=spark.read.parquet(f"{out}/mart_machine_health").select(*health.HEALTH_COLUMNS))
        weekly, queue = m.production_summary, m.maintenance_queue
        together(4, lambda: weekly.write.mode("overwrite").parquet(f"{out}/mart_production_summary"),
                 lambda: queue.write.mode("overwrite").parquet(f"{out}/mart_maintenance_queue"))

    def refresh_all_tables():
        import tempfile

        from plantmetrics.plans import ordered_run
        from plantmetrics.sources.driver import DriverTables
        out = tempfile.mkdtemp(prefix="plantmetrics-bench-")   # a new folder per run
        ordered_run.run(spark, DriverTables(spark, sf_dir), out, full=True)

    jobs = {"build_all_models": build_all, "refresh_all_tables": refresh_all_tables}
    for q in HEADLINE:
        jobs[q] = (lambda name: (lambda: _run(QUERIES[name](spark, sf_dir))))(q)

    for fn in jobs.values():  # warm-up: JIT, file listing caches
        fn()
    times: dict[str, list[float]] = {k: [] for k in jobs}
    for _ in range(runs):
        for k, fn in jobs.items():
            t0 = time.perf_counter()
            fn()
            times[k].append(time.perf_counter() - t0)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(med.values()), 3),
                      "unit": "sec", "queries": med, "sf": float(sf.group(1)) if sf else sf_dir,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
