"""CSV loads that keep what they reject.

Rows come judged: typed columns, ``line`` (the text of a rejected line) and ``reason`` (NULL for rows to
keep). One pass parses them, counts both kinds (``observe``) and writes them side by side, split by a
folder per kind, so that reading either opens only its own files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class CsvLoad:
    """Kept rows; rejected lines with their reason; how many of each the pass saw."""

    kept: DataFrame
    rejected: DataFrame
    n_kept: int
    n_rejected: int


def load_csv(judged: DataFrame, path: str) -> CsvLoad:
    """Write judged rows under ``path`` (a shared folder) in one pass, replacing what it held.

    The counts are those that the tasks reported while they wrote; a task that is run twice after a
    lost executor may be counted twice, the tables hold every row once. Without a row both are empty."""
    seen = Observation()
    rows = judged.withColumn("is_rejected", F.col("reason").isNotNull())
    rows = rows.observe(seen, F.count_if(~F.col("is_rejected")).alias("kept"), F.count_if("is_rejected").alias("rejected"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_rejected").parquet(path)
    written = judged.sparkSession.read.schema(rows.schema).parquet(path)
    kept = written.where(~F.col("is_rejected")).drop("line", "reason", "is_rejected")
    return CsvLoad(kept, written.where("is_rejected").drop("is_rejected"), seen.get["kept"], seen.get["rejected"])
