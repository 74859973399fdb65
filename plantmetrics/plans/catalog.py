"""Table definitions and housekeeping: create with an explicit schema, drop derived tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

DERIVED_TABLES = ["mart_oee_daily", "mart_machine_health", "mart_production_summary", "mart_maintenance_queue",
                  "failure_patterns"]


def create_table(spark: SparkSession, name: str, schema: StructType, path: str, replace: bool = False,
                 partition_by: list[str] | None = None) -> None:
    """CREATE [OR REPLACE] TABLE name (schema) USING parquet LOCATION path. Replacing empties the
    location too: dropping a table with a location keeps its files."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        empty = spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static")
        (empty.partitionBy(*partition_by) if partition_by else empty).parquet(path)
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{part} LOCATION '{path}'")


def drop_tables(spark: SparkSession, names: list[str] | None = None) -> None:
    for n in names or DERIVED_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


VIEW_NAMES = {
    # raw sources
    "machines": "stg_machines", "sensor_readings": "stg_sensor", "downtime_events": "stg_downtime",
    # staging
    "stg_erp_machines": "stg_machines", "stg_erp_production_orders": "stg_orders", "stg_erp_defects": "stg_defects",
    "stg_iot_sensor_readings": "stg_sensor", "stg_iot_downtime_events": "stg_downtime",
    # intermediate
    "int_availability": "availability", "int_performance": "performance", "int_quality": "quality",
    # marts and the AI tables
    "mart_oee_daily": "oee_daily", "mart_machine_health": "machine_health",
    "mart_production_summary": "production_summary", "mart_ai_maintenance_queue": "maintenance_queue",
    "failure_patterns": "failure_patterns", "maintenance_recommendations": "recommendations_raw",
}


def register_views(model, names: dict | None = None) -> list[str]:
    """Expose the model's tables as temp views so existing SQL runs unchanged in
    ``spark.sql`` (views are lazy: nothing runs until a query reads them)."""
    made = []
    for view, attr in (names or VIEW_NAMES).items():
        getattr(model, attr).createOrReplaceTempView(view)
        made.append(view)
    return made
