"""SparkSession construction for tests, bench and local runs.

On a cluster the session comes from the platform; these helpers only fill in what is
unset. The checkpoint folder is read from ``spark.checkpoint.dir``; a scratch folder is
set only when that is missing (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "plantmetrics",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A scratch one is set only in local mode: on a cluster a
    machine's own folder is out of reach of the other executors, so there it must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="plantmetrics-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings to size a large run (apply when building the cluster session).

    Scan splits and shuffle partitions are sized so each task handles about
    ``target_partition_bytes``; AQE starts from that many shuffle partitions and coalesces
    small ones, splits skewed ones, and re-decides broadcasts from measured sizes.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle_parts = max(slots * 2, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # dimension-sized sides only; AQE checks the measured size before broadcasting
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
