"""Command line: ``python -m plantmetrics <command>``.

  run     build (or incrementally refresh) the marts, patterns, recommendations and queue
  dq      print the data-quality report
  stream  keep refreshing whenever new sensor files arrive (Ctrl+C to stop)
  counts  row counts of the stored tables, from their files' footers
  drop    delete stored derived tables (``--table`` names some)

Sources: ``--driver DIR`` (the test tables via the adapter) or ``--parquet DIR`` (one
folder per raw table and the two of vectors). ``--as-of`` defaults to the day of each refresh. The session comes from the environment (spark-submit) or a local
one for a laptop run.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json


def _source(spark, a):
    from plantmetrics.sources import DriverTables, ParquetSource
    return DriverTables(spark, a.driver) if a.driver else ParquetSource(spark, a.parquet)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="plantmetrics")
    ap.add_argument("command", choices=["run", "dq", "stream", "counts", "drop"])
    ap.add_argument("--driver")
    ap.add_argument("--parquet")
    ap.add_argument("--out", help="output folder for the marts")
    ap.add_argument("--table", action="append", help="table for drop (default: all derived ones)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--full", action="store_true", help="full refresh instead of the trailing window")
    ap.add_argument("--readings", help="folder watched by the stream command")
    ap.add_argument("--checkpoint", help="stream checkpoint folder (shared storage)")
    a = ap.parse_args(argv)
    from pyspark.sql import SparkSession

    from plantmetrics.params import DEFAULT
    from plantmetrics.session import ensure_checkpoint_dir, local_session
    spark = SparkSession.getActiveSession() or local_session()
    ensure_checkpoint_dir(spark)

    def params():
        """Today's run date unless one is given; asked for anew by every refresh."""
        return DEFAULT.with_(as_of=a.as_of or dt.date.today())

    src = _source(spark, a)
    if a.command == "run":
        from plantmetrics.plans import ordered_run
        print(json.dumps(ordered_run.run(spark, src, a.out, params(), full=a.full)))
    elif a.command == "counts":
        from plantmetrics.plans import ordered_run
        ordered_run.stored_counts(spark, a.out).show(100, truncate=False)
    elif a.command == "drop":
        from plantmetrics.plans import ordered_run
        print(json.dumps(ordered_run.drop(spark, a.out, a.table)))
    elif a.command == "dq":
        from plantmetrics.operators.dq import dq_report, dq_rules
        from plantmetrics.plans.model import Model
        m = Model(spark, src, params())
        tables = {"oee_daily": m.oee_daily, "machine_health": m.machine_health,
                  "production_summary": m.production_summary, "maintenance_recommendations": m.recommendations_raw,
                  "defects": m.stg_defects}
        dq_report(tables, dq_rules()).show(100, truncate=False)
    else:
        from plantmetrics.plans import ordered_run
        from plantmetrics.streaming.refresh import start_refresh_trigger
        q = start_refresh_trigger(spark, a.readings, a.checkpoint,
                                  [lambda batch, epoch: ordered_run.run(spark, src, a.out, params())])
        q.awaitTermination()


if __name__ == "__main__":
    main()
