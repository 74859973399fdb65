"""plantmetrics: equipment-effectiveness analytics as Spark DataFrame jobs.

Layers
------
sources/    typed readers (Parquet, JDBC, CSV) and the driver-table adapter
functions/  column-expression helpers (rates, clamps, hours, vectors, JSON)
operators/  staging, OEE facts, health, trend, retrieval, recommendations,
            events, signals, reports and data-quality rules
plans/      write paths: full refresh, incremental delete+insert, upsert, ordered refresh
streaming/  Structured Streaming ingest, event-time health, stateful cooldown
"""

from plantmetrics.params import Params

__all__ = ["Params"]
