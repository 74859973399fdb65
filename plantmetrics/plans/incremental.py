"""Write paths: full refresh, keyed delete+insert over a trailing window, idempotent
upsert, and the schema-change guard.

Stored facts are Parquet partitioned by date. An incremental run recomputes only the
trailing window, reads only those date partitions of the stored table (partition
pruning), removes stored rows whose key reappears (a key-level delete, so a machine
missing from the new batch keeps its old row), appends the batch, checkpoints the
result to the shared checkpoint folder (so the plan never reads the path it is about
to overwrite), and overwrites just the touched partitions (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.operators.ids import assign_ids
from plantmetrics.session import ensure_checkpoint_dir


class SchemaChanged(RuntimeError):
    pass


def check_schema(stored: DataFrame, new: DataFrame) -> None:
    """Fail when the new batch's columns or types differ from the stored table's."""
    a = [(f.name, f.dataType.simpleString()) for f in stored.schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in new.schema.fields]
    if a != b:
        raise SchemaChanged(f"schema change: stored={a} new={b}")


def delete_insert(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """stored minus rows whose key is in batch, plus batch (keyed delete+insert)."""
    check_schema(stored, batch)
    kept = stored.join(batch.select(*keys).distinct(), keys, "left_anti").select(*stored.columns)
    return kept.unionByName(batch)


def trailing_start(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def append_rows(df: DataFrame, path: str, date_col: str | None = None) -> None:
    """Bulk insert: append the rows (Spark batches the write per task)."""
    w = df.write.mode("append")
    (w.partitionBy(date_col) if date_col else w).parquet(path)


def full_refresh(df: DataFrame, path: str, date_col: str) -> None:
    """Rebuild the whole table: dates that the new rows lack go, whatever the session's overwrite mode."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(date_col).parquet(path)


def refresh_incremental(spark: SparkSession, path: str, build, keys: list[str], date_col: str,
                        as_of: dt.date, lookback_days: int, full: bool = False) -> DataFrame:
    """Recompute [as_of - lookback, ...] with ``build(since)`` and merge it into ``path``.

    Returns the merged rows of the touched window (already written).
    """
    since = trailing_start(as_of, lookback_days)
    if full or not _exists(spark, path):
        df = build(None)
        full_refresh(df, path, date_col)
        return spark.read.parquet(path)
    batch = build(since)
    stored = spark.read.parquet(path)
    stored = stored.select(*batch.columns)
    window = stored.where(F.col(date_col) >= F.lit(since))
    merged = delete_insert(window, batch, keys)
    ensure_checkpoint_dir(spark)
    merged = merged.checkpoint()
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return merged


def merge_window(stored: DataFrame, batch: DataFrame, keys: list[str], date_col: str, since) -> DataFrame:
    """The whole table after a delete+insert of ``batch`` over dates >= since (lazy form,
    used by queries and tests): untouched partitions pass through unchanged."""
    old = stored.where(F.col(date_col) < F.lit(since))
    new = delete_insert(stored.where(F.col(date_col) >= F.lit(since)), batch, keys)
    return old.unionByName(new)


def upsert_recommendations(existing: DataFrame, new: DataFrame, highest: int | None = None) -> DataFrame:
    """Delete each machine's rows generated on the run day, insert the new rows with
    rec_id continuing after the current maximum; every other day is kept. With ``highest``, the
    largest rec_id so far, ``existing`` need only hold the run days."""
    # written once: its keys, the order of its ids and its rows are all read from there
    ensure_checkpoint_dir(new.sparkSession)
    new = new.checkpoint()
    new_keys = new.select("machine_id", F.to_date("generated_at").alias("_d")).distinct()
    kept = (existing.withColumn("_d", F.to_date("generated_at"))
            .join(new_keys, ["machine_id", "_d"], "left_anti").select(*existing.columns))
    start = highest + 1 if highest is not None else existing.select(F.coalesce(F.max("rec_id"), F.lit(0)) + 1).scalar()
    ided = assign_ids(new, ["machine_id"], "rec_id", start)
    return kept.unionByName(ided.select(*existing.columns))
