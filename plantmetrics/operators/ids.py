"""Surrogate keys: consecutive ids in a total order, without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into one task.
Instead: range-partition and sort by the order (distributed), tag each row with
``monotonically_increasing_id`` (partition index in the high bits, position in the low
bits), count rows per partition (one tiny row per partition), turn the counts into
offsets, and add. The tagged data is checkpointed to the shared checkpoint folder first,
so the counts and the final rows see one and the same partition layout, and lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.session import ensure_checkpoint_dir

_POS_BITS = 33


def assign_ids(df: DataFrame, order: list[Column | str], id_col: str = "id",
               start: Column | int = 1) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following ``order`` (must be a total order)."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    pid = F.shiftright("_mid", _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-partition window here is bounded by the partition count
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = (tagged.join(F.broadcast(offsets), pid == F.col("_pid"))
           .withColumn(id_col, (F.col("_off") + pos + start_col).cast("long")))
    return out.drop("_mid", "_pid", "_off")
