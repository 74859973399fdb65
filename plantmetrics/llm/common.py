"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.session import ensure_checkpoint_dir

#: The six ASCII white-space characters that separate words, and the class of all others.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder (lineage ends there)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(c: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` in which ``name`` stands for ``value``, worked out once a row, also if ``body`` uses it in lambdas."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def chunks(items: str) -> str:
    """SQL: the array ``items`` (a name) in slices of about the square root of its size; none for an empty one."""
    return let("__c", f"cast(ceil(sqrt(greatest(size({items}), 1))) as int)",
               f"if(size({items}) = 0, slice(array({items}), 1, 0), "
               f"transform(sequence(0, (size({items}) - 1) div __c), i -> slice({items}, i * __c + 1, __c)))")


def running(items: str, length: str, keep: str, made: str, kind: str) -> str:
    """SQL: ``made`` (of SQL type ``kind``) for each ``x`` of the array ``items`` that meets ``keep``, where ``{at}`` in it
    is the sum of ``length`` over all earlier ones.

    Appending copies an array, so offsets run over slices of about sqrt(n) items and then over
    their sums: n ** 1.5 copied references for n items."""
    sums = let("__s", f"transform(__ch, part -> aggregate(part, 0L, (n, x) -> n + {length}))",
               "aggregate(__s, named_struct('at', 0L, 'out', cast(array() as array<bigint>)), "
               "(a, n) -> named_struct('at', a.at + n, 'out', concat(a.out, array(a.at))), a -> a.out)")
    walk = (f"aggregate(part, named_struct('at', __o[i], 'out', cast(array() as array<{kind}>)), (a, x) -> named_struct("
            f"'at', a.at + {length}, 'out', if({keep}, concat(a.out, array({made.format(at='a.at')})), a.out)), a -> a.out)")
    return let("__z", items, let("__ch", chunks("__z"), let("__o", sums, f"flatten(transform(__ch, (part, i) -> {walk}))")))
