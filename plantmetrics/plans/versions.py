"""Versioned commits: write a new version folder beside the old ones, then swap one pointer.

A table kept this way is a folder with ``v=<n>`` folders and a small file ``CURRENT`` that says which of them
make up the table: all rows of some versions (``parts``), or for a table split by day the version that
holds each day (``days``). A write goes to a new folder and joins the table in the single step that renames
the new pointer over the old one. A write that breaks off leaves a folder that nobody reads, and the
next write takes a number above it. Readers resolve the pointer once and read what it names, even
while a newer version is written; what neither the new nor the former pointer names is deleted.

One writer at a time, as for every table here.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Name of the day of rows without one, as Spark names their folder.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pointer(spark: SparkSession, path: str) -> dict | None:
    """What has been committed, None if nothing has."""
    hadoop, fs = _fs(spark, path)
    file = hadoop.Path(f"{path}/CURRENT")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _named(told: dict | None) -> set[int]:
    return {*told.get("parts", []), *told.get("days", {}).values()} if told else set()


def exists(spark: SparkSession, path: str) -> bool:
    return pointer(spark, path) is not None


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    told = pointer(spark, path)
    if told is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return [f"{path}/v={n}" for n in sorted(_named(told))]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of a table written by ``write_version``."""
    return spark.read.parquet(*folders(spark, path))


def _numbers(fs, hadoop, path: str) -> list[int]:
    root = hadoop.Path(path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(x[2:]) for x in names if x.startswith("v=") and x[2:].isdigit())


def _commit(spark: SparkSession, path: str, before: dict | None, after: dict) -> None:
    hadoop, fs = _fs(spark, path)
    draft = hadoop.Path(f"{path}/.CURRENT-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(json.dumps(after).encode())
    out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(hadoop.Path(f"{path}/CURRENT")), options)
    for n in set(_numbers(fs, hadoop, path)) - _named(before) - _named(after):
        fs.delete(hadoop.Path(f"{path}/v={n}"), True)


def _next(spark: SparkSession, path: str) -> int:
    hadoop, fs = _fs(spark, path)
    return max(_numbers(fs, hadoop, path), default=0) + 1


def write_version(spark: SparkSession, path: str, write, append: bool = False) -> str:
    """Call ``write(folder)`` for a new version folder and commit it, in place of the table or (``append``)
    beside what it holds; returns the folder."""
    before, number = pointer(spark, path), _next(spark, path)
    write(f"{path}/v={number}")
    parts = before["parts"] if append and before else []
    _commit(spark, path, before, {"parts": [*parts, number]})
    return f"{path}/v={number}"


def write_days(rows: DataFrame, path: str, day: str, replace_all: bool = False, highest: str | None = None,
               note: dict | None = None) -> None:
    """Commit ``rows``, split by their date column ``day``: the days they hold take the place of those days in
    the table, all other days stay (``replace_all``: go). The pointer remembers the largest value that the
    column ``highest`` ever had, so that ids can go on from there without a look at the table; it carries ``note`` too."""
    spark = rows.sparkSession
    before, number = pointer(spark, path), _next(spark, path)
    target = f"{path}/v={number}"
    rows.write.partitionBy(day).parquet(target)
    hadoop, fs = _fs(spark, path)
    found = [s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(hadoop.Path(target)) if s.isDirectory()]
    days = {} if replace_all or not before else dict(before["days"])
    days |= {d: number for d in found}
    told = {**(note or {}), "days": days}
    if highest:
        new = spark.read.parquet(target).agg(F.max(highest)).first()[0] if found else None
        told["highest"] = max(new or 0, (before or {}).get("highest") or 0)
    _commit(spark, path, before, told)


def read_days(spark: SparkSession, path: str, schema: StructType, day: str, wanted: Column | None = None) -> DataFrame:
    """The committed rows, of the days that meet ``wanted`` (an expression of the day column) only.

    Version and day are folder names, so days and versions that aren't current are not opened."""
    told = pointer(spark, path)
    if told is None:
        raise FileNotFoundError(f"no committed version under {path}")
    full = StructType([*[f for f in schema.fields if f.name != day], schema[day], StructField("v", LongType())])
    rows = spark.read.schema(full).parquet(path)
    name = F.concat_ws("/", F.col("v").cast("string"), F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY)))
    rows = rows.where(name.isin([f"{n}/{d}" for d, n in told["days"].items()]))
    return (rows if wanted is None else rows.where(wanted)).select(*schema.names)
