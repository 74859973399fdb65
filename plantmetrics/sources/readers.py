"""Source interface: any reader that yields the raw domain tables with their schemas.

The reference reads ERP tables through a federation layer and IoT tables natively;
here every table is a DataFrame from a pluggable source, so Parquet, JDBC and CSV are
interchangeable and Catalyst pushes filters and column pruning into each scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plantmetrics.functions.vectors import parse_vector
from plantmetrics.sources import schemas

SCHEMAS = {
    "machines": schemas.MACHINES,
    "production_orders": schemas.PRODUCTION_ORDERS,
    "defects": schemas.DEFECTS,
    "sensor_readings": schemas.SENSOR_READINGS,
    "downtime_events": schemas.DOWNTIME_EVENTS,
    "failure_patterns": schemas.FAILURE_PATTERNS,
    "maintenance_recommendations": schemas.MAINTENANCE_RECOMMENDATIONS,
    "responses": schemas.RESPONSES,
}

#: Numeric, date or time columns by whose range a table is read in slices.
KEYS = {
    "machines": "machine_id", "production_orders": "order_id", "defects": "order_id", "sensor_readings": "ts",
    "downtime_events": "event_id", "failure_patterns": "pattern_id", "maintenance_recommendations": "rec_id",
    "responses": "response_id",
}


class Source:
    """A named-table provider.

    Beside the raw tables it has the vectors that an embedding service made:
    ``pattern_vectors(event_id, embedding)`` and ``machine_vectors(machine_id, embedding)``,
    ``embedding`` being an array or its text form."""

    def table(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def _vectors(self, name: str, key: str) -> DataFrame:
        t = self.table(name)
        vector = F.col("embedding")
        vector = parse_vector(vector) if isinstance(t.schema["embedding"].dataType, StringType) else vector.cast("array<double>")
        return t.select(F.col(key).cast("long").alias(key), vector.alias("embedding"))

    def pattern_vectors(self, events: DataFrame) -> DataFrame:
        """``events`` with the ``embedding`` of their ``event_id``; those without one are left out."""
        return events.join(self._vectors("pattern_vectors", "event_id"), "event_id")

    def machine_vectors(self, machines: DataFrame) -> DataFrame:
        """``machine_id, embedding`` of the machines asked for; those without one are left out."""
        return machines.select("machine_id").join(self._vectors("machine_vectors", "machine_id"), "machine_id").select(
            "machine_id", "embedding")


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = SCHEMAS.get(name)
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass
class ParquetSource(Source):
    """Tables stored as Parquet folders ``{root}/{name}`` (date-partitioned facts welcome)."""

    spark: SparkSession
    root: str
    paths: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """Read with the files' own schema, then cast to the declared one: files written by
        other tools (zoned timestamps, narrower ints) load too, and column pruning still
        reaches the scan through the projection."""
        path = self.paths.get(name, f"{self.root}/{name}")
        return _conform(self.spark.read.parquet(path), name)


@dataclass
class JdbcSource(Source):
    """ERP tables read from a relational database over JDBC.

    Tables are read in parallel slices of their key (``KEYS``). A query that the database answers gives the
    key's bounds and the number of rows; a table has one slice for each ``slice_rows`` rows, at most
    ``connections`` of them, as that many read from the database at once. ``partition`` maps a table to
    (column, lower, upper, num_partitions) of one's own. Rows without a key are in the first slice; an
    empty or unknown table is read by one task.
    """

    spark: SparkSession
    url: str
    properties: dict = field(default_factory=dict)
    schema_name: str | None = None
    partition: dict = field(default_factory=dict)
    fetchsize: int = 100_000
    slice_rows: int = 1_000_000
    connections: int = 16

    def _qualified(self, name: str) -> str:
        return f"{self.schema_name}.{name}" if self.schema_name else name

    def _base(self) -> dict:
        return {"fetchsize": str(self.fetchsize), **self.properties, "url": self.url}

    def bounds_options(self, name: str) -> dict:
        """Reader options of the one-row query for the smallest and largest key and the number of rows."""
        key = KEYS[name]
        return {**self._base(), "query": f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {self._qualified(name)}"}

    def bounds(self, name: str) -> tuple:
        row = self.spark.read.format("jdbc").options(**self.bounds_options(name)).load().first()
        return row[0], row[1], int(row[2])

    def options(self, name: str) -> dict:
        """Reader options of a table, with the slices it is read in."""
        out = {**self._base(), "dbtable": self._qualified(name)}
        if name in self.partition:
            key, lo, hi, slices = self.partition[name]
        elif name in KEYS:
            key = KEYS[name]
            lo, hi, n = self.bounds(name)
            slices = min(self.connections, -(-n // self.slice_rows))
        else:
            return out
        if lo is None or slices < 2 or lo == hi:
            return out
        # Spark reads up to the bound of each slice and beyond the last one, so no row is left out
        lo, hi = (x.isoformat(" ") if isinstance(x, dt.datetime) else str(x) for x in (lo, hi))
        return {**out, "partitionColumn": key, "lowerBound": lo, "upperBound": hi, "numPartitions": str(slices)}

    def table(self, name: str) -> DataFrame:
        return _conform(self.spark.read.format("jdbc").options(**self.options(name)).load(), name)


@dataclass
class CsvSource(Source):
    """Header CSV files; malformed rows are dropped, like the reference's loader."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        schema = SCHEMAS.get(name)
        reader = self.spark.read.option("header", True).option("mode", "DROPMALFORMED")
        if schema is not None:
            reader = reader.schema(schema)
        df = _conform(reader.csv(f"{self.root}/{name}"), name)
        if schema is not None:
            # CSV column pruning skips parsing of unread columns (a bare count would keep a
            # broken line); requiring the non-nullable fields makes the skip explicit
            required = [f.name for f in schema.fields if not f.nullable]
            if required:
                cond = F.col(required[0]).isNotNull()
                for c in required[1:]:
                    cond = cond & F.col(c).isNotNull()
                df = df.where(cond)
        return df

    def judged(self, name: str) -> DataFrame:
        """All lines of a declared table: its columns, ``line`` and ``reason`` (``sources.csv_load``).

        A line is rejected if it does not parse (``malformed``) or lacks a required field (its name); the rest
        are the rows of ``table``. The reason refers to every field, so that pruning of columns leaves all the
        parsing that decides."""
        schema = SCHEMAS[name]
        full = StructType([*schema.fields, StructField("_line", StringType())])
        rows = (self.spark.read.option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_line").schema(full).csv(f"{self.root}/{name}"))
        missing = [F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
        fields = F.to_csv(F.struct(*[f.name for f in schema.fields]))
        reason = F.coalesce(F.when(F.col("_line").isNotNull() & fields.isNotNull(), F.lit("malformed")), *missing)
        rows = rows.withColumn("reason", reason)
        text = F.coalesce("_line", fields)
        return rows.select(*[f.name for f in schema.fields], F.when(F.col("reason").isNotNull(), text).alias("line"), "reason")
